"""One cut value a group: the first rows of every group without a rank or a sort."""
import io
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.operators import compress as C
from sparkfeat.operators import group_select as G
from sparkfeat.operators import split as L


def flagged(df, keys, order, wanted, most=G.MOST):
    return G.first_rows(df, keys, order, wanted, "_in", most).toPandas()


def by_hand(pdf, keys, order, take):
    pdf = pdf.sort_values(order, kind="stable")
    rank = pdf.groupby(keys, dropna=False).cumcount() if keys else pd.Series(range(len(pdf)), index=pdf.index)
    return rank < (pdf[keys[0]].map(take) if keys else take)


@pytest.mark.parametrize("most", [G.MOST, 12])
def test_against_ranks(spark, monkeypatch, most):
    """Hot group, small groups, a null group, no and all rows wanted; brackets of 12 rows force rounds."""
    monkeypatch.setattr(G, "LEAST", 12)
    r = np.random.default_rng(3)
    g = np.where(r.random(6_000) < 0.4, 0, r.integers(1, 40, 6_000))
    pdf = pd.DataFrame({"id": np.arange(6_000), "g": g, "x": r.integers(0, 50, 6_000) * 1.0})
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != 7, F.col("g"))).repartition(5)
    n = pdf.groupby("g").size()
    take = {k: int(v * (k % 11) / 10) for k, v in n.items()}
    wanted = spark.createDataFrame([(None if k == 7 else int(k), int(v), take[k]) for k, v in n.items()], "g long, n long, take long")
    got = flagged(df, ["g"], [F.col("x"), F.col("id")], wanted, most).set_index("id")["_in"]
    want = by_hand(pdf, ["g"], ["x", "id"], take)
    assert (got.sort_index() == want.sort_index().to_numpy()).all()


def test_many_groups(spark):
    """1e5 groups at once, in few rounds; key and columns named as the operator might."""
    df = spark.range(400_000).select("id", (F.col("id") % 100_000).alias("k"), F.xxhash64("id").alias("x"), F.lit(1).alias("n"), F.lit(2).alias("cut"))
    wanted = G.group_sizes(df, ["k"]).withColumn("take", F.lit(1).cast("long"))
    out = G.first_rows(df, ["k"], [F.col("x")], wanted, "_in")
    per = out.groupBy("k").agg(F.count_if("_in").alias("m"), F.min(F.when(F.col("_in"), F.col("x"))).alias("a"), F.min("x").alias("b"))
    assert per.where("m = 1 AND a = b").count() == 100_000


def test_rows_equal_in_the_whole_order(spark):
    """A third of a group is one value without a tie-break: the count is still exact."""
    df = spark.range(3_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("x"), "id")
    wanted = spark.createDataFrame([(0, 1_500, 300), (1, 1_500, 2)], "g long, n long, take long")
    out = flagged(df, ["g"], [F.col("x")], wanted)
    assert len(out) == 3_000 and out["id"].is_unique
    assert out.groupby("g")["_in"].sum().to_dict() == {0: 300, 1: 2}
    assert out[out["_in"]]["x"].max() == 5


def test_pruning_equal_weights(spark):
    rows = [(g, 0.25 if i % 3 else float(i)) for g in ("a", "b", None) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, w double")
    out = C.prune(df, "w", "g", 0.5).toPandas()
    assert (out["w"] == 0).groupby(out["g"].fillna("-")).sum().to_dict() == {"a": 450, "b": 450, "-": 450}
    sweep = C.sparsity_sweep(df, "w", "g", [0.0, 0.5, 1.0]).toPandas()
    assert sorted(sweep["n_zero"]) == [1] * 3 + [450] * 3 + [900] * 3


def test_no_row_is_sorted_or_shuffled(spark):
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    for out in (L.stratified_split(emb, "label", "vec_id"), L.stratified_subset(events, "event_type", "event_id", 500),
                L.tail_holdout(events, ["ts", "event_id"]), C.prune(events, "value", "event_type", 0.7, "event_id")):
        text = io.StringIO()
        with redirect_stdout(text):
            out.explain()
        plan = text.getvalue()
        assert "rangepartitioning" not in plan and "hashpartitioning" not in plan and "Sort" not in plan, plan


def test_empty_table_and_extremes(spark):
    df = spark.createDataFrame([], "id long, g long, x double")
    assert flagged(df, ["g"], [F.col("x")], G.group_sizes(df, ["g"]).withColumn("take", F.lit(1).cast("long"))).empty
    assert L.tail_holdout(df, ["x", "id"]).count() == 0
    one = spark.createDataFrame([(1, 1, 2.0)], "id long, g long, x double")
    assert L.tail_holdout(one, ["x", "id"]).first()["split"] == "val"
    nulls = spark.createDataFrame([(i, None if i < 5 else i * 1.0) for i in range(10)], "id long, x double")
    got = L.tail_holdout(nulls, ["x", "id"], 0.5).toPandas().set_index("id")["split"]
    assert (got.sort_index() == ["train"] * 5 + ["val"] * 5).all()


def test_sparsity_sweep_follows_the_ramp(spark):
    import pandas as pd
    rows = [(g, float(i % 7) - 3.0 if i % 11 else None, i) for g in ("a", None) for i in range(2500)]
    df = spark.createDataFrame(rows, "g string, w double, id long")
    levels = C.sparsity_schedule(spark, 403, every=30)
    out = C.sparsity_sweep(df, "w", "g", levels, tie="id").toPandas()
    assert set(out["step"]) == set(range(0, 511, 30)) and len(out) == 2 * 18
    pdf = pd.DataFrame(rows, columns=["g", "w", "id"]).query("g == 'a'")
    pdf = pdf.assign(a=pdf["w"].abs()).sort_values(["a", "id"], na_position="last").reset_index(drop=True)
    for _, r in out.iterrows():
        target = 0.7 - 0.7 * (1 - r["step"] / 510) ** 3
        cut = 2500 - np.round(2500 * (1.0 - target))
        assert abs(r["target_sparsity"] - target) < 1e-12
        assert r["n"] == 2500 and r["n_zero"] == ((pdf.index < cut) | (pdf["w"] == 0)).sum()
