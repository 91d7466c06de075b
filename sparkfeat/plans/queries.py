"""The registered query set on the driver tables.

Stand-ins: numeric columns l_quantity, l_extendedprice, l_discount, l_tax of
``lineitem`` with label l_returnflag; the series ``events.value`` ordered by
(ts, event_id), key user_id; vectors ``embeddings``; classes ``labels``.
Every query reads whole tables.  Computed doubles are rounded to 9
significant digits (``sig``) so they compare across engines.
"""
from __future__ import annotations

import time
from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as FE
from ..functions import spectral as SP
from ..functions.exprs import clamp, half_round, sig, sig_columns
from ..operators import compress as C
from ..operators import encode as E
from ..operators import evaluate as V
from ..operators import knn as K
from ..operators import naive_bayes as NB
from ..operators import outliers as O
from ..operators import profile as P
from ..operators import rolling as R
from ..operators import split as L
from ..operators.scale import Scaler
from ..session import materialize, scratch_path
from ..sources import files as S

LCOLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER = ["ts", "event_id"]
WINDOWS = [10, 20, 50, 100]


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return S.read_table(spark, sf, name)


def _sig_cols(df: DataFrame, cols, digits: int = 9) -> DataFrame:
    return sig_columns(df, cols, digits)


# ------------------------------------------------------------------ sources
def q_csv_roundtrip(spark, sf):
    src = t(spark, sf, "nation")
    path = S.write_csv(src, scratch_path(spark, "csv-nation"))
    return S.read_csv(spark, path, src.schema)


def q_csv_roundtrip_orders(spark, sf):
    src = t(spark, sf, "orders")
    path = S.write_csv(src, scratch_path(spark, "csv-orders"))
    return S.read_csv(spark, path, src.schema)


def _emb_split(spark, sf) -> DataFrame:
    return L.stratified_split(t(spark, sf, "embeddings"), "label", "vec_id", 0.2, 42)


def q_split_roundtrip(spark, sf):
    path = S.write_split(_emb_split(spark, sf), scratch_path(spark, "split"))
    back = S.read_split(spark, path, "test")
    return back.select("vec_id", "label", "split", F.size("embedding").alias("dims"))


# ------------------------------------------------------------------ projections
def q_project_columns(spark, sf):
    li = t(spark, sf, "lineitem").drop("l_linestatus")
    return li.select(li.columns[1:-1])


def q_first_rows(spark, sf):
    return t(spark, sf, "events").orderBy(*ORDER).limit(10)


def q_cast_types(spark, sf):
    ev = t(spark, sf, "events")
    return ev.select("event_id", F.col("value").cast("float").alias("value_f32"),
                     clamp(F.rint("value"), -128, 127).cast("tinyint").alias("value_i8"),
                     (F.col("event_type") == "click").cast("int").alias("is_click"))


def q_label_names(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type")
    enc = E.LabelEncoder("event_type", "event_type_id").fit(ev)
    out = enc.decode(enc.transform(ev), "event_type_id", "event_type_name")
    return out.select("event_id", "event_type_id", "event_type_name")


# ------------------------------------------------------------------ profiling
def q_profile_counts(spark, sf):
    return P.shape(t(spark, sf, "lineitem"), label="l_returnflag")


def q_profile_schema(spark, sf):
    return P.schema_table(t(spark, sf, "lineitem"))


def q_describe_numeric(spark, sf):
    d = P.describe(t(spark, sf, "lineitem"), LCOLS)
    return _sig_cols(d, ["mean", "std", "min", "q25", "median", "q75", "max"])


def _orders_with_nulls(spark, sf):
    o = t(spark, sf, "orders")
    return (o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.lit(None))
                         .otherwise(F.col("o_totalprice")))
             .withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
                         .otherwise(F.col("o_orderpriority"))))


def q_null_counts(spark, sf):
    return P.null_counts(_orders_with_nulls(spark, sf))


def _docs(spark, sf):
    return t(spark, sf, "documents").drop("doc_id")


def q_duplicate_count(spark, sf):
    return P.duplicate_count(_docs(spark, sf))


def q_dedup_report(spark, sf):
    return P.dedup_report(_docs(spark, sf))


def q_dedup_rows(spark, sf):
    return P.dedup(_docs(spark, sf))


def q_distinct_classes(spark, sf):
    return P.distinct_values(t(spark, sf, "lineitem"), "l_returnflag")


def q_class_balance(spark, sf):
    return P.class_balance(t(spark, sf, "lineitem"), "l_returnflag", by="key")


def q_value_counts(spark, sf):
    return P.class_balance(t(spark, sf, "events"), "event_type", by="count")


def q_quantile_nearest(spark, sf):
    return _sig_cols(P.quantiles(t(spark, sf, "lineitem"), LCOLS, [0.25, 0.5, 0.75], "nearest"), ["value"])


def q_quantile_linear(spark, sf):
    return _sig_cols(P.quantiles(t(spark, sf, "events"), ["value"], [0.1, 0.25, 0.5, 0.75, 0.9], "linear"), ["value"])


def q_box_numbers(spark, sf):
    b = P.box_numbers(t(spark, sf, "lineitem"), LCOLS)
    return _sig_cols(b, ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"])


IQR_COLS = ["value", "user_id"]


def q_iqr_counts(spark, sf):
    return _sig_cols(P.iqr_counts(t(spark, sf, "events"), IQR_COLS), ["q1", "q3", "iqr", "lower", "upper"])


def q_iqr_cells(spark, sf):
    return P.iqr_cells(t(spark, sf, "events"), IQR_COLS)


def q_iqr_rows(spark, sf):
    return P.iqr_rows(t(spark, sf, "events"), ["value"]).select("event_id", "value", "n_outlier_cols")


def q_histogram_20(spark, sf):
    return _sig_cols(P.histogram(t(spark, sf, "events"), ["value"], 20), ["lower", "upper"])


def q_histogram_50(spark, sf):
    return _sig_cols(P.histogram(t(spark, sf, "lineitem"), LCOLS, 50), ["lower", "upper"])


def q_correlation_matrix(spark, sf):
    return _sig_cols(P.correlation(t(spark, sf, "lineitem"), LCOLS), ["corr"])


def q_size_estimate(spark, sf):
    ev = t(spark, sf, "events")
    return _sig_cols(P.size_estimate(ev, len(ev.columns) - 1), ["kb"])


def q_column_bytes(spark, sf):
    return P.column_bytes(t(spark, sf, "events"))


def q_union_tables(spark, sf):
    ev = t(spark, sf, "events")
    a = ev.where(F.col("event_type").isin("click", "view"))
    b = ev.where(~F.col("event_type").isin("click", "view"))
    return P.stack_tables(a, b)


def q_to_long(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LCOLS)
    return P.to_long(li, ["l_orderkey", "l_linenumber"], LCOLS).withColumn("value", F.col("value") + F.lit(0.0))


# ------------------------------------------------------------------ scaling
def _scaled(spark, sf, kind, ddof=1):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LCOLS)
    m = Scaler(kind, LCOLS, ddof).fit(li)
    return _sig_cols(m.transform(li), LCOLS)


def q_scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


def q_scale_minmax_safe(spark, sf):
    return _scaled(spark, sf, "minmax_safe")


def q_scale_standard_samp(spark, sf):
    return _scaled(spark, sf, "standard", 1)


def q_scale_standard_pop(spark, sf):
    return _scaled(spark, sf, "standard", 0)


def q_scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


def q_scale_maxabs(spark, sf):
    return _scaled(spark, sf, "maxabs")


# ------------------------------------------------------------------ encoding
def q_label_encode(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type")
    return E.LabelEncoder("event_type", "event_type_id").fit(ev).transform(ev)


def q_one_hot(spark, sf):
    return E.one_hot(t(spark, sf, "events").select("event_id", "event_type"), "event_type")


def q_frequency_encode(spark, sf):
    return E.frequency_encode(t(spark, sf, "events").select("event_id", "event_type"), "event_type")


def q_bool_to_int(spark, sf):
    ev = t(spark, sf, "events").select("event_id", (F.col("event_type") == "click").alias("is_click"),
                                       (F.col("event_type") == "error").alias("is_error"))
    return E.bool_to_int(ev, ["is_click", "is_error"])


# ------------------------------------------------------------------ outliers
def q_zscore_outliers(spark, sf):
    z = O.zscore_outliers(t(spark, sf, "events").select("event_id", "value"), ["value"], 3.0)
    return _sig_cols(z.where("is_outlier").drop("is_outlier"), ["max_abs_z"])


# ------------------------------------------------------------------ windows
def _series(spark, sf):
    return t(spark, sf, "events").select("event_id", "ts", "value")


def q_rolling_mean_3(spark, sf):
    r = R.rolling(_series(spark, sf), ["value"], ORDER, [3], ("mean",), min_periods=1)
    return _sig_cols(r.select("event_id", "value_MA_3"), ["value_MA_3"])


def q_rolling_mean(spark, sf):
    r = R.rolling(_series(spark, sf), ["value"], ORDER, WINDOWS, ("mean",))
    cols = [f"value_MA_{w}" for w in WINDOWS]
    return _sig_cols(r.select("event_id", *cols), cols)


def q_rolling_var(spark, sf):
    r = R.rolling(_series(spark, sf), ["value"], ORDER, WINDOWS, ("var",))
    cols = [f"value_VAR_{w}" for w in WINDOWS]
    # frame variances from different algorithms agree to ~1e-12 relative
    return _sig_cols(r.select("event_id", *cols), cols, 6)


def q_rolling_by_user(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    r = R.rolling(ev, ["value"], ORDER, [5], ("mean", "var"), partition_by="user_id")
    return _sig_cols(r.select("event_id", "user_id", "value_MA_5", "value_VAR_5"), ["value_MA_5", "value_VAR_5"], 6)


def q_rolling_null_key(spark, sf):
    """Rolling mean per key where a quarter of the rows have no key: they are one key."""
    ev = t(spark, sf, "events").select("event_id", "ts", "value", F.expr(
        "CASE WHEN event_id % 4 <> 0 THEN user_id END").alias("user_id"))
    r = R.rolling(ev, ["value"], ORDER, [5], ("mean",), partition_by="user_id")
    return _sig_cols(r.select("event_id", "user_id", "value_MA_5"), ["value_MA_5"], 6)


def q_ema_null_runs(spark, sf):
    """EMA over runs of nulls far longer than the spans remember."""
    ev = _series(spark, sf).withColumn("value", F.expr("CASE WHEN event_id % 1000 < 20 THEN value END"))
    r = R.ema(ev, ["value"], ORDER, [10, 50], chunk=300)
    return _sig_cols(r.select("event_id", "value_EMA_10", "value_EMA_50"), ["value_EMA_10", "value_EMA_50"])


def q_ema(spark, sf):
    r = R.ema(_series(spark, sf), ["value"], ORDER, WINDOWS)
    cols = [f"value_EMA_{w}" for w in WINDOWS]
    return _sig_cols(r.select("event_id", *cols), cols)


def q_sign_changes(spark, sf):
    return R.sign_changes(_series(spark, sf), ["value"], ORDER).select("event_id", "value_sign_change")


# ------------------------------------------------------------------ features
def q_features_statistical(spark, sf):
    f = FE.statistical_features(t(spark, sf, "lineitem"), LCOLS)
    return _sig_cols(f, ["mean", "median", "variance", "std", "rms", "energy", "entropy", "kurtosis", "skewness"])


def q_features_time(spark, sf):
    f = FE.time_features(_series(spark, sf), ["value"], ORDER)
    return _sig_cols(f, ["peak", "peak_to_peak", "zero_crossing_rate", "signal_magnitude_area"])


def q_features_spectral_closed(spark, sf):
    return _sig_cols(FE.spectral_closed_features(_series(spark, sf), ["value"]), ["spectral_energy", "mean_psd"])


def q_spectrum_framed(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    s = SP.spectrum_framed(ev, "value", ORDER, "user_id", 64)
    return _sig_cols(s.select("user_id", "frame", F.col("n").cast("long").alias("n"), "dominant_k",
                              "spectral_energy", "spectral_entropy"), ["spectral_energy", "spectral_entropy"], 6)


def q_spectrum_global(spark, sf):
    out = SP.spectrum_global(_series(spark, sf), "value", ORDER)
    return _sig_cols(out.select("column", "n", "dominant_k", "spectral_energy", "spectral_entropy"),
                     ["spectral_energy", "spectral_entropy"])


def q_spectrum_bins(spark, sf):
    """Chosen bins of the whole series by one aggregation."""
    out = SP.spectrum_at(_series(spark, sf), "value", ORDER, [0, 1, 2, 3, 5, 8, 13, 50, 100, 333, 1000])
    return _sig_cols(out.select("k", "mag"), ["mag"], 6)


# ------------------------------------------------------------------ splits
def q_stratified_split(spark, sf):
    return _emb_split(spark, sf).select("vec_id", "label", "split")


def q_stratified_subset(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type")
    return L.stratified_subset(ev, "event_type", "event_id", 5000, 42).select("event_id", "event_type")


def q_holdout_tail(spark, sf):
    return L.tail_holdout(_series(spark, sf), ORDER, 0.2).select("event_id", "split")


def q_stratified_folds(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", "quality")
    return L.stratified_folds(lab, "quality", "doc_id", 5, 42).select("doc_id", "quality", "fold")


def q_folds_null_class(spark, sf):
    """Folds where a quarter of the rows have no class: they are a class of their own."""
    lab = t(spark, sf, "labels").select("doc_id", F.expr("CASE WHEN doc_id % 4 <> 0 THEN quality END").alias("quality"))
    return L.stratified_folds(lab, "quality", "doc_id", 5, 42).select("doc_id", "quality", "fold")


# ------------------------------------------------------------------ models with an SQL form
def _gnb_pred(spark, sf) -> DataFrame:
    sp = _emb_split(spark, sf)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    model = NB.GaussianNB("embedding", "label", "vec_id").fit(train)
    return model.predict(test, keep=("label",))


def _knn_pred(spark, sf) -> DataFrame:
    sp = _emb_split(spark, sf)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    return K.knn_predict(train, test, 5, "vec_id", "label", "embedding")


def q_gnb_sql(spark, sf):
    return _gnb_pred(spark, sf).select("vec_id", "label", "pred", sig("p_true").alias("p_true"))


def q_knn_sql(spark, sf):
    return _knn_pred(spark, sf).select("vec_id", "label", "pred")


def q_accuracy(spark, sf):
    return _sig_cols(V.accuracy(_gnb_pred(spark, sf)), ["accuracy"])


def q_weighted_prf(spark, sf):
    return _sig_cols(V.weighted_prf(_gnb_pred(spark, sf)), ["accuracy", "precision", "recall", "f1"])


def q_confusion(spark, sf):
    return V.confusion(_gnb_pred(spark, sf))


def q_class_report(spark, sf):
    return _sig_cols(V.class_report(_gnb_pred(spark, sf)), ["precision", "recall", "f1"])


def q_log_loss(spark, sf):
    return _sig_cols(V.log_loss(_gnb_pred(spark, sf)), ["log_loss"])


def q_label_names_pred(spark, sf):
    """Predicted class ids back to class names (P11): names are 'class_<id>'."""
    p = _gnb_pred(spark, sf)
    return p.select("vec_id", "pred", F.concat(F.lit("class_"), F.col("pred").cast("string")).alias("pred_name"))


def _two_models(spark, sf) -> DataFrame:
    g = _gnb_pred(spark, sf).select("vec_id", "label", "pred").withColumn("model", F.lit("gaussian_nb"))
    k = _knn_pred(spark, sf).select("vec_id", "label", "pred").withColumn("model", F.lit("knn_5"))
    return g.unionByName(k)


def q_metric_table(spark, sf):
    return _sig_cols(V.metric_table(_two_models(spark, sf)), ["accuracy", "precision", "recall", "f1"])


def q_round_metrics(spark, sf):
    m = V.metric_table(_two_models(spark, sf))
    return V.unpivot_metrics(m, ["model"], ["accuracy", "precision", "recall", "f1"], 4)


def q_best_model(spark, sf):
    m = V.metric_table(_two_models(spark, sf))
    return _sig_cols(V.best_row(m, "accuracy", "model"), ["accuracy", "precision", "recall", "f1"])


def q_relative_change(spark, sf):
    m = V.metric_table(_two_models(spark, sf))
    r = V.relative_change(m, "model", "gaussian_nb", ["accuracy", "f1"])
    cols = ["accuracy_change_pct", "accuracy_change_pts", "f1_change_pct", "f1_change_pts"]
    return _sig_cols(r.select("model", *cols), cols)


def q_fit_limits(spark, sf):
    part = t(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") * F.col("p_size") / 16.0).alias("size_kb"))
    out = V.fit_limits(part, "size_kb")
    return _sig_cols(out.select("p_partkey", "size_kb", "device", "flash_kb", "status"), ["size_kb"])


def q_grid_knn(spark, sf):
    sp = _emb_split(spark, sf)
    train = L.stratified_folds(sp.where(F.col("split") == "train").drop("split"), "label", "vec_id", 3, 42)
    g = K.knn_grid(train, (3, 5, 7, 9), "fold", "vec_id", "label", "embedding")
    return _sig_cols(g, ["mean_accuracy", "std_accuracy"])


def q_grid_knn_test(spark, sf):
    """The grid's best k, refitted on all training rows and scored on the test rows."""
    sp = _emb_split(spark, sf)
    train = L.stratified_folds(sp.where(F.col("split") == "train").drop("split"), "label", "vec_id", 3, 42)
    g = K.knn_grid_test(train, sp.where(F.col("split") == "test"), (3, 5, 7, 9), "fold", "vec_id", "label", "embedding")
    return _sig_cols(g, ["cv_accuracy", "test_accuracy"])


# ------------------------------------------------------------------ compression
def _emb_long(spark, sf) -> DataFrame:
    e = t(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("dim", "w")) \
            .withColumn("w", F.col("w").cast("double")) \
            .withColumn("wid", F.col("vec_id") * 64 + F.col("dim"))


def q_quantize_symmetric(spark, sf):
    q = C.quantize_vectors(t(spark, sf, "embeddings"), "embedding")
    return q.select("vec_id", sig("scale").alias("scale"), F.posexplode("codes").alias("dim", "code"))


def q_half_precision(spark, sf):
    h = C.half(t(spark, sf, "embeddings"), "embedding", "half")
    return h.select("vec_id", F.posexplode("half").alias("dim", "half"))


def _affine_params(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LCOLS)
    return li, C.calibrate(li, LCOLS)


def q_quantize_affine(spark, sf):
    li, params = _affine_params(spark, sf)
    return C.quantize(li, params)


def q_dequantize_error(spark, sf):
    li, params = _affine_params(spark, sf)
    return _sig_cols(C.quantization_error(li, params), ["scale", "zero_point", "max_abs_error"])


def q_prune_magnitude(spark, sf):
    p = C.prune(_emb_long(spark, sf), "w", "label", 0.7, tie="wid", out="weight")
    return p.select("vec_id", "dim", "weight")


def q_sparsity(spark, sf):
    p = C.prune(_emb_long(spark, sf), "w", "label", 0.7, tie="wid", out="weight")
    return _sig_cols(C.sparsity(p, "weight", "label"), ["sparsity_pct"])


def q_sparsity_sweep(spark, sf):
    n_train = _emb_split(spark, sf).where(F.col("split") == "train").count()
    levels = C.sparsity_schedule(spark, n_train, 8, 10, 0.0, 0.7, 100)
    s = C.sparsity_sweep(_emb_long(spark, sf), "w", "label", levels, tie="wid")
    return _sig_cols(s, ["target_sparsity", "achieved_pct"])


def registry() -> Dict[str, Callable[[SparkSession, str], DataFrame]]:
    """name -> query(spark, sf_dir), in SURVEY 7.4 order."""
    return {k[2:]: v for k, v in globals().items() if k.startswith("q_") and callable(v)}


# ------------------------------------------------------------------ model zoo (rows-only checks)
from ..operators import models as M  # noqa: E402
from ..sources import bundle as B  # noqa: E402


def _train_test(spark, sf):
    # written once: nothing to unpersist when a query hands its result on
    sp = materialize(_emb_split(spark, sf), "train-test")
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


def _zoo_row(spark, sf, name: str, save: bool = True, split=None) -> DataFrame:
    train, test = split or _train_test(spark, sf)
    model, fit_s = M.fit_model(name, train, "embedding", "label")
    pred = M.predict(model, test, "embedding", "vec_id", "label", name)
    t0 = time.perf_counter()
    pred.write.format("noop").mode("overwrite").save()  # one full scoring pass
    pred_s = time.perf_counter() - t0
    n_test = test.count()
    size_kb = None
    if save:
        path = S.save_model(model, scratch_path(spark, f"model-{name}"))
        size_kb = S.stored_bytes(spark, path).first()["kb"]
    m = V.weighted_prf(pred)
    return m.select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1",
                    F.lit(M.n_params(model)).cast("long").alias("n_params"),
                    F.lit(size_kb).cast("double").alias("size_kb"),
                    F.lit(fit_s).alias("fit_seconds"), F.lit(pred_s).alias("predict_seconds"),
                    F.lit(1000.0 * pred_s / max(n_test, 1)).alias("ms_per_row"))


def q_logistic(spark, sf):
    return _zoo_row(spark, sf, "logistic")


def q_tree(spark, sf):
    return _zoo_row(spark, sf, "tree")


def q_forest(spark, sf):
    return _zoo_row(spark, sf, "forest")


def q_linear_svm(spark, sf):
    return _zoo_row(spark, sf, "linear_svm")


def q_rbf_svm(spark, sf):
    return _zoo_row(spark, sf, "rbf_svm")


def q_naive_bayes_ml(spark, sf):
    """The library's Gaussian model: what does not depend on the clock."""
    cols = ["accuracy", "precision", "recall", "f1"]
    return _sig_cols(_zoo_row(spark, sf, "naive_bayes", save=False).select("model", *cols, "n_params"), cols)


def q_mlp_small(spark, sf):
    return _zoo_row(spark, sf, "mlp_small")


def q_mlp_large(spark, sf):
    return _zoo_row(spark, sf, "mlp_large")


def _knn_row(spark, split) -> DataFrame:
    """The nearest-neighbour model's row: what it stores is its training rows."""
    train, test = split
    train = train.select("vec_id", "label", "embedding")
    t0 = time.perf_counter()
    path = scratch_path(spark, "model-knn")
    train.write.parquet(path)
    fit_s = time.perf_counter() - t0
    t0 = time.perf_counter()
    pred = K.knn_predict(spark.read.parquet(path), test, 5, "vec_id", "label", "embedding")
    pred.write.format("noop").mode("overwrite").save()
    pred_s = time.perf_counter() - t0
    values = spark.read.parquet(path).agg(F.sum(F.size("embedding"))).first()[0]
    return V.weighted_prf(pred).select(
        F.lit("knn_5").alias("model"), "accuracy", "precision", "recall", "f1", F.lit(values).cast("long").alias("n_params"),
        F.lit(S.stored_bytes(spark, path).first()["kb"]).cast("double").alias("size_kb"), F.lit(fit_s).alias("fit_seconds"),
        F.lit(pred_s).alias("predict_seconds"), F.lit(1000.0 * pred_s / max(test.count(), 1)).alias("ms_per_row"))


def q_model_comparison(spark, sf):
    """All models in one table with their stored sizes (V7, V12), the best one flagged (V8)."""
    split = _train_test(spark, sf)
    rows = materialize(_knn_row(spark, split), "model-comparison")  # a row a model, written before the next is fitted
    for name in M.MODELS:
        rows = rows.unionByName(materialize(_zoo_row(spark, sf, name, split=split), "model-comparison"))
    best = rows.orderBy(F.desc("accuracy"), F.asc("model")).first()["model"]
    return rows.withColumn("is_best", F.col("model") == F.lit(best))


def q_training_curve(spark, sf):
    """Loss, training and validation accuracy of the small network as it is fitted."""
    train, test = _train_test(spark, sf)
    return M.training_curve(train, test, "embedding", "label")


def q_training_history(spark, sf):
    """(model, iteration, loss) of the iterative fits, both networks among them."""
    train, _ = _train_test(spark, sf)
    rows = []
    for name in ("logistic", "mlp_small", "mlp_large"):
        model, _ = M.fit_model(name, train, "embedding", "label")
        rows += [(name, i, v) for i, v in enumerate(M.history(model))]
    return spark.createDataFrame(rows, "model string, iteration int, loss double")


def q_history_last(spark, sf):
    h = q_training_history(spark, sf)
    return h.groupBy("model").agg(F.max("iteration").alias("last_iteration"),
                                  F.max_by("loss", "iteration").alias("last_loss"))


def q_metrics_store(spark, sf):
    """One metric record per run in a parquet store, read back without its time stamp (S5);
    the first run is repeated, as by a retry."""
    path = scratch_path(spark, "metrics")
    gnb, knn = _gnb_pred(spark, sf), _knn_pred(spark, sf)
    for name, pred in (("gaussian_nb", gnb), ("knn_5", knn), ("gaussian_nb", gnb)):
        rec = V.weighted_prf(pred).select(F.lit(name).alias("model"), "*", F.current_timestamp().alias("recorded_at"))
        S.append_metrics(rec, path, name)
    cols = ["accuracy", "precision", "recall", "f1"]
    return _sig_cols(S.read_metrics(spark, path).select("run", "model", *cols), cols)


def q_model_roundtrip(spark, sf):
    """Save a fitted pipeline of each kind (linear, generative, network),
    load it back and score the test split with both: rows and equal predictions (S7, M10)."""
    train, test = _train_test(spark, sf)
    out = None
    for name in ("logistic", "naive_bayes", "mlp_small"):
        model, _ = M.fit_model(name, train, "embedding", "label")
        loaded = S.load_model(S.save_model(model, scratch_path(spark, f"model-{name}")))
        was, now = (M.predict(m, test, "embedding", "vec_id", "label").select("vec_id", F.col("pred").alias(c))
                    for m, c in ((model, "was"), (loaded, "now")))
        one = was.join(now, "vec_id").agg(F.lit(name).alias("model"), F.count("*").alias("n"),
                                          F.count_if(F.col("was") == F.col("now")).alias("n_equal"))
        out = one if out is None else out.unionByName(one)
    return out


def q_bundle_roundtrip(spark, sf):
    """A classifier of the return flag saved with its label dictionary and scaler, loaded and
    applied to the raw table: rows and equal answers a class (S7, E2, P11)."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = t(spark, sf, "lineitem").select("l_returnflag", *cols)
    bundle = B.fit_bundle(li, cols, "l_returnflag", "naive_bayes")
    loaded = B.ModelBundle.load(spark, bundle.save(scratch_path(spark, "bundle")))
    both = loaded.transform(bundle.transform(li, "was"), "now")
    per = both.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("was") == F.col("now")).alias("n_equal"))
    return per.join(loaded.labels.table, F.col("l_returnflag") == F.col("class_name")).select("class_id", "class_name", "n", "n_equal")


def q_model_size(spark, sf):
    """Stored size of a saved model folder (S8) and its fit against device flash."""
    train, _ = _train_test(spark, sf)
    model, _ = M.fit_model("naive_bayes", train, "embedding", "label")
    path = S.save_model(model, scratch_path(spark, "model-size"))
    size = S.stored_bytes(spark, path).withColumn("model", F.lit("naive_bayes"))
    return V.fit_limits(size, "kb")


# ------------------------------------------------------------------ grid search (rows-only)
from ..operators import tune as G  # noqa: E402
from ..operators.forest import Forest  # noqa: E402
from pyspark.ml.classification import MultilayerPerceptronClassifier  # noqa: E402


# candidates are fitted at the same time, so a fit needs few tasks of its own
GRID_ROWS_A_TASK = 50_000


def _cv_frames(spark, sf, folds: int):
    train, test = _train_test(spark, sf)
    tr = L.stratified_folds(train.drop("split"), "label", "vec_id", folds, 42)
    tr = materialize(M.with_vectors(tr, "embedding", "features", "label"), "fold-vectors")
    n, most = M.fullest_partition(tr)
    dims = len(tr.select("embedding").first()[0])
    return (M.spread(tr.drop("embedding"), n, most, dims, GRID_ROWS_A_TASK),
            M.with_vectors(test, "embedding", "features", "label"))


def _grid_forest(spark, sf):
    tr, te = _cv_frames(spark, sf, 3)
    est = Forest(featuresCol="features", labelCol="label_d", seed=42, cacheNodeIds=True)
    # "no depth limit" becomes Spark's maximum depth, 30
    return G.grid_search(est, {"numTrees": [20, 30, 50], "maxDepth": [10, 20, 30]}, tr), te


def q_grid_forest(spark, sf):
    (model, table), _ = _grid_forest(spark, sf)
    return table


def _grid_mlp(spark, sf):
    tr, te = _cv_frames(spark, sf, 5)
    d = len(tr.select("features").first()[0])
    k = int(tr.agg(F.max("label")).first()[0]) + 1
    est = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label_d", seed=42)
    layers = [[d, a, b, k] for a in (16, 32) for b in (8, 16)]
    return G.grid_search(est, {"layers": layers, "blockSize": [8, 16], "maxIter": [50, 75]}, tr), te


def q_grid_mlp(spark, sf):
    (model, table), _ = _grid_mlp(spark, sf)
    return table


def q_grid_mlp_table(spark, sf):
    """The network grid's best parameters, their score and the refitted model's test score."""
    (model, table), te = _grid_mlp(spark, sf)
    return G.summary(model, table, te)


def q_grid_table(spark, sf):
    (model, table), te = _grid_forest(spark, sf)
    return G.summary(model, table, te)


# ------------------------------------------------------------------ compressed network variants (rows-only)
from ..operators import variants as VA  # noqa: E402


def _variant_setup(spark, sf):
    train, test = _train_test(spark, sf)
    model, _ = M.fit_model("mlp_small", train, "embedding", "label")
    wt = VA.weights_table(spark, model)  # a local relation, no more rows than the model has weights
    variants = {v: VA.make_variant(wt, v) for v in VA.VARIANTS if v != "int8_full"}
    variants["int8_full"] = VA.integer_net(wt, VA.calibrate(train, wt, "embedding"))
    return model, wt, variants, test


def q_weights_table(spark, sf):
    """The trained network's weights as a table."""
    return _variant_setup(spark, sf)[1]


def q_score_variants(spark, sf):
    """Predictions of every compressed variant on the test split."""
    _, _, variants, test = _variant_setup(spark, sf)
    return VA.score(test, variants, "embedding", "vec_id", "label")


def q_int8_inputs(spark, sf):
    """Test vectors as int8 codes of the range calibrated on the train split (C10): sum of the
    codes and how many lie at the ends of the range."""
    train, test = _train_test(spark, sf)
    r = VA.input_range(train, "embedding").first()
    codes = test.select("vec_id", VA.input_codes(F.col("embedding"), r["scale"], r["zero"]).alias("codes"))
    total = F.aggregate("codes", F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    at_end = F.size(F.filter("codes", lambda x: (x == -128) | (x == 127))).cast("long")
    return codes.select("vec_id", total.alias("code_sum"), at_end.alias("n_at_end"))


def q_variant_sizes(spark, sf):
    """Weights, zeros and stored bytes of every variant of the small network (C11)."""
    train, _ = _train_test(spark, sf)
    model, _ = M.fit_model("mlp_small", train, "embedding", "label")
    sizes = VA.stored_sizes(VA.weights_table(spark, model))
    return sizes.select("variant", "n_weights", "size_bytes")


def q_variant_report(spark, sf):
    """Size, accuracy and time per variant against float32."""
    _, wt, variants, test = _variant_setup(spark, sf)
    preds = VA.score(test, variants, "embedding", "vec_id", "label")
    times = VA.timed_scores(test, variants, "embedding", "vec_id", "label")
    return VA.report(spark, wt, variants, preds, times, test.count())


# ------------------------------------------------------------------ isolation forest (rows-only)
from ..operators.isoforest import IsolationForest  # noqa: E402


def q_isolation_forest(spark, sf):
    """Rows and share of outliers of the isolation forest, contamination 0.02, seed 42 (O3)."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LCOLS)
    model = IsolationForest(LCOLS, trees=100, sample=256, contamination=0.02, seed=42).fit(li)
    flagged = model.transform(li)
    return flagged.agg(F.count(F.lit(1)).alias("n"),
                       F.round(F.avg(F.col("is_outlier").cast("double")), 3).alias("outlier_share"))


# ------------------------------------------------------------------ remaining inventory items
from ..functions.exprs import argmax_array  # noqa: E402


def q_correlation_all(spark, sf):
    """Correlation over all numeric and boolean columns."""
    ev = t(spark, sf, "events").select("event_id", "user_id", "value",
                                       (F.col("event_type") == "click").alias("is_click"), "event_type")
    return _sig_cols(P.correlation_all(ev), ["corr"])


def q_argmax_scores(spark, sf):
    """Arg max over each row's class-score vector (D7): first maximum on ties."""
    sp = _emb_split(spark, sf)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    model = NB.GaussianNB("embedding", "label", "vec_id").fit(train)
    sc = model.class_scores(test)
    return sc.select("vec_id", argmax_array("scores").alias("argmax"), F.size("scores").alias("n_scores"))


def q_class_ids(spark, sf):
    """Class id -> name table of the fitted label encoder (E5)."""
    li = t(spark, sf, "lineitem").select("l_returnflag")
    return E.LabelEncoder("l_returnflag", "class_id").fit(li).class_table(spark)


def q_smooth_3(spark, sf):
    """3-point rolling mean with partial frames replacing the column."""
    s = O.smooth(_series(spark, sf), ["value"], ORDER, 3)
    return _sig_cols(s.select("event_id", "value"), ["value"])


# ------------------------------------------------------------------ the feature-engineering lifecycle
def _engineered(spark, sf) -> DataFrame:
    """Dedup, order by (ts, event_id), rolling mean / var and EMA for every window,
    written as CSV (S3) and read back (S1)."""
    ev = P.dedup(_series(spark, sf))
    r = R.rolling(ev, ["value"], ORDER, WINDOWS, ("mean", "var"))
    e = R.ema(r, ["value"], ORDER, WINDOWS)
    path = S.write_csv(e, scratch_path(spark, "engineered"))
    return S.read_csv(spark, path, e.schema)


def q_engineered_features(spark, sf):
    e = _engineered(spark, sf)
    cols = [f"value_{k}_{w}" for k in ("MA", "VAR", "EMA") for w in WINDOWS]
    digits = {c: 6 if "_VAR_" in c else 9 for c in cols}
    out = e.select("event_id", *cols)
    out = _sig_cols(out, [c for c in cols if digits[c] == 9], 9)
    return _sig_cols(out, [c for c in cols if digits[c] == 6], 6)


def q_engineered_size(spark, sf):
    """Feature count and logical bytes before and after feature engineering."""
    before = _series(spark, sf)
    after = _engineered(spark, sf)
    b = P.column_bytes(before).agg(F.sum("bytes").alias("bytes")).withColumn("table", F.lit("original")) \
        .withColumn("n_features", F.lit(len(before.columns)))
    a = P.column_bytes(after).agg(F.sum("bytes").alias("bytes")).withColumn("table", F.lit("engineered")) \
        .withColumn("n_features", F.lit(len(after.columns)))
    return b.unionByName(a).withColumn("kb", F.col("bytes") / 1024.0)
