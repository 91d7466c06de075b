"""Driver contract: entry smoke and a DuckDB oracle check of fast queries at sf0.001."""
import math

import duckdb
import pandas as pd

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = ["class_balance", "describe_numeric", "iqr_counts", "histogram_20", "scale_robust", "one_hot",
        "rolling_mean", "ema", "features_statistical", "features_time", "spectrum_framed", "stratified_split",
        "gnb_sql", "knn_sql", "class_report", "quantize_affine", "prune_magnitude", "csv_roundtrip_orders"]


def _rows(df):
    cols = sorted(df.columns)
    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        return v.item() if hasattr(v, "item") else v
    return sorted((tuple(norm(r[c]) for c in cols) for _, r in df[cols].iterrows()), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 1
    assert "zero_crossing_rate" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_fast_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in ("nation orders lineitem events documents embeddings labels part").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in FAST:
        s = qs[name](spark, SF).toPandas()
        rel = con.execute(sql[name])
        d = pd.DataFrame(rel.fetchall(), columns=[c[0] for c in rel.description])
        assert sorted(s.columns) == sorted(d.columns), name
        assert _rows(s) == _rows(d), name
