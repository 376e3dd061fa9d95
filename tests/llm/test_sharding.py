import zlib

import numpy as np
import pytest

from churnkit.llm import sharding as S


def test_matrix_is_exact():
    m = S.communication_matrix([5, 0, 100, 1], 7, 3)
    assert m.sum(1).tolist() == [5, 0, 100, 1]
    assert set(m.sum(0).tolist()) <= {15, 16} and (m >= 0).all()
    assert (S.communication_matrix([5, 0, 100, 1], 7, 3) == m).all()


def test_large_hypergeometric():
    rng = np.random.default_rng(1)
    good, bad, n = 3_000_000_000, 9_000_000_000, 1_000_000
    draws = np.array([S._hypergeometric(rng, good, bad, n) for _ in range(400)])
    sd = (n * 0.25 * 0.75) ** 0.5
    assert abs(draws.mean() - n / 4) < 5 * sd / 20 and 0.8 < draws.std() / sd < 1.2


ROWS = [(i, f"text {i}") for i in range(200)] + [(7, "again")] * 30 + [(None, None), (None, ""), (500, "x" * 200_000), (501, "é")]


@pytest.mark.parametrize("shards,rows_per_task,most", [(24, 10_000, 100), (5, 4, 1000), (300, 20, 8)])
def test_exact_sizes_and_slots(spark, docs, shards, rows_per_task, most):
    got = S.shuffle_to_shards(spark, docs(ROWS), shards=shards, rows_per_task=rows_per_task, most_parts=most).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(ROWS, key=str)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_uniform(spark):
    """Neighbouring rows part: the shard of a row says nothing of its place."""
    got = S.shuffle_to_shards(spark, spark.range(6000).withColumnRenamed("id", "doc_id"), shards=4).toPandas()
    table = np.array([[((got.doc_id // 1500 == q) & (got.shard == s)).sum() for s in range(4)] for q in range(4)])
    assert ((table - 375) ** 2 / 375).sum() < 40  # chi square, 9 degrees
    assert abs(got.doc_id.corr(got.slot)) < 0.05


def test_digest_columns_and_edges(spark, docs, clashing):
    got = {r["doc_id"]: r for r in S.shard_documents(spark, docs([(1, "é"), (2, None)])).collect()}
    assert (got[1]["size"], got[1]["text_crc32"]) == (10, zlib.crc32("é".encode()))
    assert (got[2]["size"], got[2]["text_crc32"], got[2]["law"], got[2]["grown_shard"]) == (8, 0, "rows", None)
    assert S.shard_documents(spark, docs([])).count() == 0
    assert S.shard_documents(spark, clashing([(1, "a"), (1, "a")])).count() == 2
