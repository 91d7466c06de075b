"""Compressed variants of a trained dense network, scored on a whole table
(C9-C11, V10, V12).

* ``weights_table``: the network's weights as rows (layer, row, col, value),
  col = -1 for the bias; three weight layers are required (C9).
* variants are built with the table operators of ``compress`` on that
  weights table: float16 rounding, weight-only int8 (symmetric per layer),
  full int8 (affine per layer, range incl. 0) and 70 % magnitude pruning per
  layer.  The weights are bounded by the model, so each variant is collected
  once and broadcast to the scorer.
* scoring is a forward pass in numpy inside ``mapInPandas`` over Arrow
  batches (sigmoid hidden layers, softmax output, as the MLP was trained),
  one ``variant`` column, no per-row loop;
* full int8 can also be scored in whole numbers (``integer_net``), with the ranges of
  inputs and sums that ``calibrate`` finds in one pass over a calibration table.
"""
from __future__ import annotations

import time
from typing import Dict, Iterator, List

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import compress as C
from . import evaluate as V

VARIANTS = ["float32", "float16", "int8_dynamic", "int8_full", "pruned_70"]


def weights_table(spark, mlp_model) -> DataFrame:
    """(layer, row, col, value) from a MultilayerPerceptronClassificationModel.

    Spark stores each layer as a column-major (out x in) matrix followed by the
    bias; ``row`` is the output unit, ``col`` the input (-1 = bias).
    """
    m = mlp_model.stages[-1] if hasattr(mlp_model, "stages") else mlp_model
    layers = list(m.getLayers())
    if len(layers) - 1 != 3:
        raise ValueError(f"expected 3 weight layers, got {len(layers) - 1}")
    w = m.weights.toArray()
    rows, off = [], 0
    for li, (a, b) in enumerate(zip(layers[:-1], layers[1:])):
        W = w[off: off + a * b].reshape(a, b)  # [in, out] (column-major out x in)
        off += a * b
        for i in range(a):
            for o in range(b):
                rows.append((li, o, i, float(W[i, o])))
        for o in range(b):
            rows.append((li, o, -1, float(w[off + o])))
        off += b
    return spark.createDataFrame(rows, "layer int, row int, col int, value double")


def make_variant(wt: DataFrame, variant: str) -> DataFrame:
    """The weights table of one variant (dequantized values, ready to score)."""
    if variant == "float32":
        return wt.withColumn("value", F.col("value").cast("float").cast("double"))
    if variant == "float16":
        return C.half(wt, "value")
    if variant == "int8_dynamic":
        s = wt.groupBy("layer").agg((F.max(F.abs("value")) / 127.0).alias("_s"))
        q = F.when(F.col("_s") == 0, F.lit(0.0)).otherwise(
            F.least(F.greatest(F.rint(F.col("value") / F.col("_s")), F.lit(-127)), F.lit(127)) * F.col("_s"))
        return wt.join(F.broadcast(s), "layer").withColumn("value", q).drop("_s")
    if variant == "int8_full":
        p = wt.groupBy("layer").agg(F.least(F.min("value"), F.lit(0.0)).alias("_mn"),
                                    F.greatest(F.max("value"), F.lit(0.0)).alias("_mx"))
        p = p.withColumn("_s", (F.col("_mx") - F.col("_mn")) / 255.0) \
             .withColumn("_z", F.rint(F.lit(-128.0) - F.col("_mn") / F.col("_s")))
        code = F.least(F.greatest(F.rint(F.col("value") / F.col("_s") + F.col("_z")), F.lit(-128)), F.lit(127))
        return (wt.join(F.broadcast(p), "layer")
                  .withColumn("value", F.when(F.col("_s") == 0, F.raise_error(F.lit("zero scale")))
                              .otherwise((code - F.col("_z")) * F.col("_s")))
                  .drop("_mn", "_mx", "_s", "_z"))
    if variant == "pruned_70":
        return C.prune(wt, "value", "layer", 0.7, tie=["row", "col"])
    raise ValueError(variant)


_PACKED = "variant string, layer int, n long, n_zero long, codes binary, positions binary, scale double, zero double"


def pack(wt: DataFrame, variant: str) -> DataFrame:
    """A variant as it is stored, a row a layer: codes of the weights in (row, col) order, the
    scale and zero point of integer codes, and for pruned weights a bitmap of the positions
    that are kept, whose values alone are stored."""
    pruned = make_variant(wt, variant) if variant == "pruned_70" else wt

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf.sort_values(["row", "col"])["value"].to_numpy(np.float64)
        positions, scale, zero = b"", 0.0, 0.0
        if variant == "float32":
            codes = w.astype("<f4")
        elif variant == "float16":
            codes = w.astype("<f2")
        elif variant == "int8_dynamic":
            scale = float(np.abs(w).max()) / 127.0
            codes = np.clip(np.rint(w / scale), -127, 127).astype(np.int8) if scale else np.zeros(len(w), np.int8)
        elif variant == "int8_full":
            low, high = min(float(w.min()), 0.0), max(float(w.max()), 0.0)
            scale = (high - low) / 255.0
            if not scale:
                raise ValueError("zero scale")
            zero = float(np.rint(-128.0 - low / scale))
            codes = np.clip(np.rint(w / scale + zero), -128, 127).astype(np.int8)
        else:
            positions, codes = np.packbits(w != 0).tobytes(), w[w != 0].astype("<f4")
        return pd.DataFrame({"variant": [variant], "layer": [int(pdf["layer"].iloc[0])], "n": [len(w)], "n_zero": [int((w == 0).sum())],
                             "codes": [codes.tobytes()], "positions": [positions], "scale": [scale], "zero": [zero]})

    return pruned.groupBy("layer").applyInPandas(run, _PACKED)  # a group is a layer of the model


def unpack(packed: DataFrame) -> DataFrame:
    """(variant, layer, at, value): the weights that a stored variant stands for."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                if r.variant.startswith("int8"):
                    w = (np.frombuffer(r.codes, np.int8) - r.zero) * r.scale
                elif r.variant == "pruned_70":
                    w = np.zeros(r.n)
                    w[np.unpackbits(np.frombuffer(r.positions, np.uint8))[:r.n] == 1] = np.frombuffer(r.codes, "<f4")
                else:
                    w = np.frombuffer(r.codes, "<f2" if r.variant == "float16" else "<f4").astype(np.float64)
                yield pd.DataFrame({"variant": r.variant, "layer": np.int32(r.layer), "at": np.arange(r.n), "value": w})

    return packed.mapInPandas(run, "variant string, layer int, at long, value double")


def stored_sizes(wt: DataFrame, variants=VARIANTS) -> DataFrame:
    """(variant, n_weights, n_zero, size_bytes) of the stored columns; scale and zero point
    count where the codes need them, those of the calibrated points included."""
    rows = None
    for v in variants:
        one = pack(wt, v)
        rows = one if rows is None else rows.unionByName(one)
    extra = F.when(F.col("variant") == "int8_dynamic", 8).when(F.col("variant") == "int8_full", 16).otherwise(0)
    size = F.octet_length("codes") + F.octet_length("positions") + extra
    points = F.when(F.col("variant") == "int8_full", 16 * (F.count("*") + 1)).otherwise(0)
    return rows.groupBy("variant").agg(F.sum("n").alias("n_weights"), F.sum("n_zero").alias("n_zero"),
                                       (F.sum(size) + points).cast("long").alias("size_bytes"))


def _matrices(rows) -> List[tuple]:
    layers = sorted({r["layer"] for r in rows})
    out = []
    for li in layers:
        lr = [r for r in rows if r["layer"] == li]
        n_out = max(r["row"] for r in lr) + 1
        n_in = max(r["col"] for r in lr) + 1
        W = np.zeros((n_in, n_out))
        b = np.zeros(n_out)
        for r in lr:
            if r["col"] < 0:
                b[r["row"]] = r["value"]
            else:
                W[r["col"], r["row"]] = r["value"]
        out.append((W, b))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def _affine(low: Column, high: Column) -> tuple[Column, Column]:
    """Scale and zero point of int8 codes over a range that holds 0; a range of 0 alone has scale 1."""
    scale = F.when(high > low, (high - low) / 255.0).otherwise(1.0)
    return scale, F.rint(F.lit(-128.0) - low / scale).cast("long")


def input_range(df: DataFrame, features: str) -> DataFrame:
    """(point 0, low, high, scale, zero) of all values of an array column; nulls and NaN are left out."""
    x = df.select(F.explode(features).alias("x")).select(F.col("x").cast("double").alias("x")).where(~F.isnan("x"))
    return _ranges(x.groupBy(F.lit(0).alias("point")).agg(F.min("x").alias("low"), F.max("x").alias("high")))


def _ranges(found: DataFrame) -> DataFrame:
    low, high = F.least("low", F.lit(0.0)), F.greatest("high", F.lit(0.0))
    scale, zero = _affine(low, high)
    return found.select("point", low.alias("low"), high.alias("high"), scale.alias("scale"), zero.alias("zero"))


def calibrate(df: DataFrame, wt: DataFrame, features: str) -> DataFrame:
    """(point, low, high, scale, zero): ranges that full int8 needs, over all rows of ``df``.

    Point 0 is the input, point i + 1 the sums of weight layer i.  Each task runs the network
    over its batches and sends one row a point; rows without features are left out."""
    bc = df.sparkSession.sparkContext.broadcast(_matrices(wt.collect()))  # bounded by the model size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers = bc.value
        low, high = np.full(len(layers) + 1, np.inf), np.full(len(layers) + 1, -np.inf)
        for pdf in batches:
            if pdf.empty:
                continue
            h = np.stack(pdf[features].to_numpy()).astype(np.float64)
            for point in range(len(layers) + 1):
                z = h if point == 0 else h @ layers[point - 1][0] + layers[point - 1][1]
                low[point], high[point] = np.fmin(low[point], np.nanmin(z)), np.fmax(high[point], np.nanmax(z))
                h = z if point == 0 else _sigmoid(z)
        seen = np.isfinite(low)
        yield pd.DataFrame({"point": np.arange(len(low), dtype=np.int32)[seen], "low": low[seen], "high": high[seen]})

    found = df.where(F.col(features).isNotNull()).select(features).mapInPandas(run, "point int, low double, high double")
    return _ranges(found.groupBy("point").agg(F.min("low").alias("low"), F.max("high").alias("high")))


def input_codes(x: Column, scale: float, zero: int) -> Column:
    """int8 codes of an array of values, clamped to the calibrated range."""
    code = lambda v: F.rint(v.cast("double") / F.lit(scale) + F.lit(zero))
    return F.transform(x, lambda v: F.least(F.greatest(code(v), F.lit(-128.0)), F.lit(127.0)).cast("tinyint"))


class IntegerNet:
    """A dense network on int8 codes: inputs, weights, sums and hidden units.

    Products of codes less their zero points are summed as whole numbers (in doubles, which
    hold them exactly and multiply fast), with biases in units of input scale x weight scale.
    Sums are brought to the int8 codes of their calibrated point; a hidden unit is a lookup of
    its sum's code in a table of 256 sigmoid codes (scale 1/256, zero point -128)."""

    UNIT = (1.0 / 256.0, -128)

    def __init__(self, layers: List[tuple], points: List[tuple]):
        """layers: (weight codes, bias codes, scale, zero); points: (scale, zero)."""
        if len(points) != len(layers) + 1:
            raise ValueError(f"{len(layers)} layers need {len(layers) + 1} calibrated points, got {len(points)}")
        self.layers, self.points = layers, points

    @staticmethod
    def _code(x: np.ndarray, scale: float, zero: int) -> np.ndarray:
        return np.clip(np.rint(x / scale + zero), -128, 127).astype(np.int8)

    def codes(self, X: np.ndarray) -> np.ndarray:
        """int8 codes of the output sums."""
        scale, zero = self.points[0]
        h = self._code(X, scale, zero)
        for i, (W, b, w_scale, w_zero) in enumerate(self.layers):
            bias = np.rint((b - w_zero) / scale)
            sums = (h.astype(np.float64) - zero) @ (W - w_zero) + bias
            z_scale, z_zero = self.points[i + 1]
            h = np.clip(np.rint(sums * (scale * w_scale / z_scale)) + z_zero, -128, 127).astype(np.int8)
            if i < len(self.layers) - 1:
                scale, zero = self.UNIT
                unit = self._code(_sigmoid((np.arange(-128, 128) - z_zero) * z_scale), scale, zero)
                h = unit[h.astype(np.int16) + 128]
        return h


def integer_net(wt: DataFrame, calibration: DataFrame) -> IntegerNet:
    """The full int8 network from its stored codes and the calibrated points (both bounded by
    the model)."""
    shapes = {r["layer"]: (r["rows"], r["cols"]) for r in wt.groupBy("layer").agg(
        (F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols")).collect()}
    layers = []
    for r in pack(wt, "int8_full").orderBy("layer").collect():
        n_out, n_in = shapes[r["layer"]]
        # codes lie by (row, col), the bias (col -1) first in its row
        codes = np.frombuffer(r["codes"], np.int8).astype(np.float64).reshape(n_out, n_in + 1)
        layers.append((codes[:, 1:].T.copy(), codes[:, 0].copy(), r["scale"], r["zero"]))
    return IntegerNet(layers, [(r["scale"], r["zero"]) for r in calibration.orderBy("point").collect()])


def score(df: DataFrame, variants: Dict[str, DataFrame | IntegerNet], features: str, key: str, label: str) -> DataFrame:
    """(variant, key, label, pred) for every variant and row; a variant is a weights table or
    a network in whole numbers."""
    spark = df.sparkSession
    whole_numbers = {v: isinstance(w, IntegerNet) for v, w in variants.items()}
    mats = {v: w if whole_numbers[v] else _matrices(w.collect()) for v, w in variants.items()}  # bounded by the model size
    bc = spark.sparkContext.broadcast(mats)

    def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ms = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            X = np.stack(pdf[features].to_numpy()).astype(np.float64)
            for v, layers in ms.items():
                whole = whole_numbers[v]
                h = layers.codes(X) if whole else X
                for i, (W, b) in enumerate([] if whole else layers):
                    z = h @ W + b
                    h = _sigmoid(z) if i < len(layers) - 1 else z
                yield pd.DataFrame({"variant": v, key: pdf[key].to_numpy(), label: pdf[label].to_numpy(),
                                    "pred": np.argmax(h, axis=1).astype(np.int32)})

    schema = f"variant string, {key} long, {label} int, pred int"
    return df.select(key, label, features).mapInPandas(forward, schema)


def report(spark, wt: DataFrame, variants: Dict[str, DataFrame], preds: DataFrame, times: Dict[str, float],
           n_rows: int) -> DataFrame:
    """(variant, accuracy, n_weights, n_zero, size_bytes, size_reduction_pct, accuracy_change_pts, ms_per_row)."""
    acc = V.accuracy(preds, "label", "pred", ["variant"])
    ms = spark.createDataFrame([(v, 1000.0 * times.get(v, 0.0) / max(n_rows, 1)) for v in variants], "variant string, ms_per_row double")
    sz = stored_sizes(wt, list(variants)).join(ms, "variant")
    out = acc.join(sz, "variant")
    base = out.where(F.col("variant") == "float32").select(F.col("accuracy").alias("_ba"),
                                                             F.col("size_bytes").alias("_bs")).first()
    return (out.withColumn("size_reduction_pct", 100.0 * (F.lit(base["_bs"]) - F.col("size_bytes")) / F.lit(base["_bs"]))
               .withColumn("accuracy_change_pts", 100.0 * (F.col("accuracy") - F.lit(base["_ba"]))))


def timed_scores(df, variants, features, key, label):
    times = {}
    for v, w in variants.items():
        t0 = time.perf_counter()
        score(df, {v: w}, features, key, label).write.format("noop").mode("overwrite").save()
        times[v] = time.perf_counter() - t0
    return times
