"""Driver contract: entry runs, every oracle key is a query, and a sample of
queries matches its DuckDB oracle on the smallest tables."""

import math

import duckdb

import __spark_entry__ as entry
from paths import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"dimension", "value", "churn_rate", "customer_count"}


def test_oracle_keys_are_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60


def _norm(v):
    import pandas as pd
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    return v


def test_sample_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, o = entry.queries(), entry.oracle_sql()
    for name in ("olap_series", "threshold_sweep", "stratified_split", "embedding_silhouette", "policy_impact_top100",
                 "risk_ranking", "anomaly_feature_profile"):
        s = q[name](spark, SF_SMALL).toPandas()
        dd = con.sql(o[name]).df()
        cols = sorted(s.columns)
        assert cols == sorted(dd.columns), name
        a = sorted((tuple(_norm(x) for x in r) for r in s[cols].itertuples(index=False)), key=str)
        b = sorted((tuple(_norm(x) for x in r) for r in dd[cols].itertuples(index=False)), key=str)
        assert a == b, name
