"""Edge rows from FIXTURES.md section 4 against the column-expression builders."""

from pyspark.sql import functions as F

from churnkit.functions import (addon_encode, binary_encode, charge_cohort, impute_blank, lenient_double,
                                onehot_columns, pay_type, pct_deviation, service_count, tenure_cohort)


def test_blank_space_garbage_total(spark):
    df = spark.createDataFrame([("12.5", 3.0), ("", 4.0), ("   ", 5.0), ("abc", 6.0), (None, 7.0), (" 7 ", 1.0)],
                               "t string, m double")
    out = [r[0] for r in df.select(impute_blank("t", "m")).collect()]
    # blank -> fallback, garbage stays NULL, NULL stays NULL, spaces trimmed before parsing
    assert out == [12.5, 4.0, 5.0, None, None, 7.0]
    assert [r[0] for r in df.select(lenient_double("t")).collect()] == [12.5, None, None, None, None, 7.0]


def test_tenure_cohort_edges(spark):
    vals = [0, 12, 13, 24, 48, 72, 73, -1]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = [r[0] for r in df.select(tenure_cohort("x")).collect()]
    assert got == ["0-12 mo", "0-12 mo", "13-24 mo", "13-24 mo", "25-48 mo", "49-72 mo", None, None]


def test_charge_cohort_edges(spark):
    vals = [0.0, 35.0, 35.01, 90.0, 90.01, 1e9]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(charge_cohort("x")).collect()]
    # 0 has no cohort (lowest edge excluded), right-closed intervals
    assert got == [None, "$0-35", "$35-65", "$65-90", "$90+", "$90+"]


def test_encodings_unmapped_to_null(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Male",), ("Female",), ("Maybe",), (None,)], "v string")
    assert [r[0] for r in df.select(binary_encode("v")).collect()] == [1, 0, 1, 0, None, None]
    df2 = spark.createDataFrame([("Yes",), ("No",), ("No internet service",), ("No service",), ("x",)], "v string")
    assert [r[0] for r in df2.select(addon_encode("v")).collect()] == [1, 0, 0, 0, None]


def test_onehot_all_levels_null_row_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a c",), (None,)], "v string")
    out = df.select(*onehot_columns("v", ["b", "a c"])).collect()
    assert df.select(*onehot_columns("v", ["b", "a c"])).columns == ["v_a_c", "v_b"]
    assert [tuple(r) for r in out] == [(0, 1), (1, 0), (0, 0)]


def test_pay_type_and_service_count(spark):
    df = spark.createDataFrame([("Bank transfer (automatic)", "Yes", "No"), ("Mailed check", "Yes", "Yes"),
                                (None, "No service", "No")], "p string, a string, b string")
    r = df.select(pay_type("p"), service_count(["a", "b"])).collect()
    assert [tuple(x) for x in r] == [("Auto-pay", 1), ("Manual", 2), (None, 0)]


def test_pct_deviation_guard(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 0.0), (1.0, 1e-12), (-1.0, -2.0)], "v double, m double")
    got = [r[0] for r in df.select(pct_deviation("v", "m")).collect()]
    assert got[0] == 100.0 and got[1] is None and got[2] is None and got[3] == 50.0


def test_no_python_udf_in_expression_plan(spark):
    df = spark.createDataFrame([(5, "Yes")], "x int, v string")
    plan = df.select(tenure_cohort("x"), binary_encode("v"), F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
