"""OLAP operators: NULL semantics, one-scan grouping sets equal the per-dimension views."""

from churnkit.operators import olap
from churnkit.sources import adapters

from paths import SF_SMALL


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_null_label_counts_as_not_churned_and_null_key_dropped(spark):
    df = spark.createDataFrame([("a", "Yes"), ("a", None), ("a", "No"), (None, "Yes"), ("b", "Yes")],
                               "d string, churn string")
    got = {r["d"]: (r["churn_rate"], r["customer_count"]) for r in olap.churn_rate_by(df, "d").collect()}
    assert set(got) == {"a", "b"}
    assert abs(got["a"][0] - 100 / 3) < 1e-9 and got["a"][1] == 3 and got["b"] == (100.0, 1)


def test_grouping_sets_match_single_views(spark):
    raw = adapters.raw_customers(spark, SF_SMALL)
    series = olap.olap_series(raw)
    for dim in ("segment", "region", "priority"):
        single = olap.churn_rate_by(raw, dim)
        a = _rows(series.where(f"dimension = '{dim}'"), "value", "churn_rate", "customer_count")
        b = _rows(single, dim, "churn_rate", "customer_count")
        assert [(x[0], round(x[1], 9), x[2]) for x in a] == [(x[0], round(x[1], 9), x[2]) for x in b]
    total = series.where("dimension = 'all'").first()["customer_count"]
    assert total == raw.count()
    # every non-NULL dimension's counts sum to at most n; segment has no NULLs
    seg = sum(r["customer_count"] for r in series.where("dimension = 'segment'").collect())
    assert seg == total


def test_crosstab_empty_cell_is_null(spark):
    df = spark.createDataFrame([("x", "A", "Yes"), ("x", "B", "No"), ("y", "A", "No")], "r string, c string, churn string")
    out = {row["r"]: (row["A"], row["B"]) for row in olap.crosstab(df, "r", "c", ["A", "B"]).collect()}
    assert out == {"x": (100.0, 0.0), "y": (0.0, None)}


def test_kpi_empty_selection_gives_zero(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("Yes", 10.0, 5), ("No", 20.0, 7)], "churn string, monthly double, tenure int")
    r = olap.kpi_row(df, F.lit(False)).first()
    assert r["n"] == 0 and r["churn_rate"] == 0.0 and r["avg_charge"] == 0.0 and r["delta_n"] == -2
