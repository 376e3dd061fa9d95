import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from churnkit.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, queries, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in asked.items():
        scored = []
        for (d, bag), size in zip(bags, sizes):
            m = 50 + 50 * size * n // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 20 * m))
                    for t in ts if t in bag)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(spark, docs, queries, k=5, **sizes):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(queries, "item_id long, text string")
    return sorted(map(tuple, rs.search(spark, d, q, k, **sizes).collect()), key=str)


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{int(r.paretovariate(0.7))}" for _ in range(400)] + ["THE", "the", "Ärger", "naïve", "x9"]
    return [(i, r.choice([" ", ", ", "\x7f", "--"]).join(r.choices(vocabulary, k=r.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"shard_postings": 40}, {"block_pairs": 10}])
def test_equals_brute_force_with_ties(spark, sizes):
    docs = texts(1, 150)
    docs += [(1000 - i, docs[3][1]) for i in range(20)] + [(i % 4, docs[5][1]) for i in range(8)]  # copies, repeated ids
    queries = [(q, t[:200]) for q, t in texts(2, 12)] + [(3, "the W1")]
    assert found(spark, docs, queries, **sizes) == brute(docs, queries, 5)


def test_edges(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    docs = [(None, "alpha beta"), (None, "alpha beta"), (1, None), (2, ""), (3, "..."), (4, "alpha " * 300_000), (5, "alpha beta"), (6, "gamma")]
    queries = [(None, "ALPHA beta beta"), (1, None), (2, "!"), (3, "nowhere"), (4, "gamma")]
    assert found(spark, docs, queries) == brute(docs, queries, 5)
    clash = spark.createDataFrame([(5, "alpha", 1, "z", 2), (6, "beta alpha", 3, "y", 4)], "doc_id long, text string, rid long, term string, s long")
    asked = spark.createDataFrame([(1, "beta", 2, 7)], "item_id long, text string, doc_id long, rank int")
    assert [tuple(r) for r in rs.search(spark, clash, asked).collect()] == brute([(5, "alpha"), (6, "beta alpha")], [(1, "beta")], 50)


def test_reading_stops_before_the_lists_end():
    """A rare term settles the best documents; the frequent term's list is not read to its end for that."""
    n = 20_000
    rid = np.concatenate([np.arange(n), np.arange(100)])
    term = np.concatenate([np.zeros(n, np.int64), np.ones(100, np.int64)])
    score = np.concatenate([np.random.default_rng(1).integers(1, 1000, n), np.full(100, 10_000)])
    shard = rs.Shard(rid, term, score, rid)
    docs, scores, read = shard.nra([0, 1], 50)
    total = np.zeros(n, np.int64)
    np.add.at(total, rid, score)
    best = np.lexsort((np.arange(n), -total))[:50]
    assert list(docs) == list(best) and list(scores) == list(total[best])
    assert read < 1000
    for k in (1, 3, 200, 30_000):
        docs, scores, _ = shard.nra([0, 1, 7], k, first_read=1)
        best = np.lexsort((np.arange(n), -total))[:k]
        assert list(docs) == list(best) and list(scores) == list(total[best])
