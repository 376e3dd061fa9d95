import hashlib

import pytest

from churnkit.llm import exact_dedup as E

STRIP = {i: None for i in (32, 9, 10, 11, 12, 13)}


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(STRIP), []).append((-len(t or ""), d is None, d))
    out = []
    for d, t in rows:
        norm = (t or "").translate(STRIP)
        keep = min(groups[norm], key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))[2]
        out.append((d, keep, len(groups[norm]), d == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b"), (2, "ab"), (3, " a\tb "), (4, None), (5, ""), (6, " \n"), (None, "ab"), (8, "é x"), (9, "é x"), (2, "ab"),
        (11, "word " * 60_000), (12, "word" * 60_000), *[(100 + i, "same text") for i in range(70)]]


@pytest.mark.parametrize("runs,fan_in", [(1, 2), (7, 2), (64, 8), (9, 4)])
def test_against_brute_force(spark, docs, runs, fan_in):
    got = E.exact_dedup(spark, docs(ROWS), runs=runs, fan_in=fan_in)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_table_matches_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small("documents")]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted(map(tuple, E.exact_dedup(spark, df).collect()), key=str) == brute(rows)


def test_empty_and_clashing(spark, docs, clashing):
    assert E.exact_dedup(spark, docs([])).count() == 0
    got = E.drop_copies(spark, clashing([(1, "x y"), (2, "xy"), (3, "z"), (3, "z"), (3, "q")]))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, "x y"), (3, "q"), (3, "z")]
    assert got.columns == clashing([]).columns


def test_no_python_in_plan(spark, docs):
    plan = E.exact_dedup(spark, docs(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rejects_bad_fan_in(spark, docs):
    with pytest.raises(ValueError):
        E.exact_dedup(spark, docs([]), fan_in=3)
