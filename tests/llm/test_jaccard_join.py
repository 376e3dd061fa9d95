import random
from itertools import combinations

import numpy as np
import pytest

import brute
from churnkit.llm import jaccard_join as J
from churnkit.operators.components import components


def result(spark, df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(spark, df, **options).collect()}


def family(rng, words, copies, edits, start):
    """A text and near copies of it with a few words changed."""
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        out.append((start + i, " ".join(w)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for k, (words, copies, edits) in enumerate([(300, 60, 8), (40, 30, 2), (12, 25, 1), (9, 20, 1), (5, 10, 1), (100, 40, 5), (20, 40, 1)]):
        rows += family(rng, words, copies, edits, 1000 * (k + 1))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(9000 + i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))) for i in range(50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,percent,words", [(1, J.BLOCK, 85, 4), (2, 2000, 85, 4), (3, 600, 80, 5)])
def test_against_brute_force(spark, docs, seed, block, percent, words):
    rows = corpus(seed)
    got = result(spark, docs(rows), block=block, percent=percent, words=words)
    assert got == brute.jaccard(rows, words, percent)
    assert len({c for _, c in got.values()}) < len(rows)


def test_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small("documents")]
    assert result(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == brute.jaccard(rows)


def test_edges(spark, docs, clashing):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo"), (6, "one two x"), (7, "a"), (8, "A"), (9, "É"), (10, "é"),
            (20, "long " * 40_000), (21, "long " * 50_000), (22, "t u v w"), (22, "t u v w")]
    assert result(spark, docs(rows)) == brute.jaccard(rows)
    assert J.jaccard_components(spark, docs([]), ).count() == 0
    got = J.jaccard_components(spark, docs([(None, "a b c d"), (5, "a b c d"), (None, "z")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("5", "5"), ("None", "5"), ("None", "None")]
    odd = spark.createDataFrame([(1, "a b c d", "x", 1), (2, "a b c d", "y", 2)], "doc_id long, text string, __id string, _free0 int")
    assert [tuple(r) for r in J.one_of_each(spark, odd).collect()] == [(1, "a b c d", "x", 1)]
    kept = J.one_of_each(spark, clashing([(1, "a b c d"), (2, "a b c d"), (3, "q"), (4, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4] and "a b" in kept.columns


def test_links_share_a_list():
    """Any two sets with enough in common have a key in common: subsets when light, parts when heavy."""
    rng = random.Random(4)
    firsts, table = J.size_classes(2000), {}
    for _ in range(400):
        n = rng.choice([3, 8, 13, 20, 40, 100, 300])
        a = {rng.getrandbits(64) for _ in range(n)}
        b = set(rng.sample(sorted(a), n - rng.randrange(n // 6 + 1))) | {rng.getrandbits(64) for _ in range(rng.randrange(n // 6 + 1))}
        if 100 * len(a & b) < 85 * len(a | b):
            continue
        spaces = [J.spaces_of(len(s), firsts, 85, table) for s in (a, b)]
        keys = [dict(zip(sp, J.list_keys(np.array(sorted(s), np.uint64), sp), strict=True)) for s, sp in zip((a, b), spaces, strict=True)]
        both = set(keys[0]) & set(keys[1])
        shared = [len(set(keys[0][c][0].tolist()) & set(keys[1][c][0].tolist())) - max(keys[0][c][1], keys[1][c][1]) for c in both]
        assert max(shared) > 0  # more lists in common than either leaves out
        x = max(len(a), len(b))
        if x <= 13:
            sub = [{c for k in J.subset_sizes(len(s), x, 85) for c in combinations(sorted(s), k)} for s in (a, b)]
            assert sub[0] & sub[1]


def test_boundary_follows_the_cost():
    assert J.boundary({}, 85) == 0
    few, many = J.boundary({5: 10, 6: 10}, 85), J.boundary({24: 1000}, 85)
    assert few >= 6 and many < 24


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(500, 501), (501, 502), (502, 500), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 501: 500, 502: 500}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0
