import random

import numpy as np
import pytest

import brute
from churnkit.llm import substring_dedup as S


def result(spark, df, **options):
    got = S.remove_repeats(spark, df, **options).collect()
    for r in got:
        assert sum(s["hi"] - s["lo"] for s in r["spans"]) == r["n_removed"]
        assert all(a["hi"] < b["lo"] for a, b in zip(r["spans"], r["spans"][1:]))
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got}


def corpus(seed):
    rng = random.Random(seed)
    words = lambda n, v=500: [f"w{rng.randrange(v)}" for _ in range(n)]
    passages = [words(n) for n in (49, 50, 51, 75, 200, 400)] + [["same"] * 120, ["x", "y"] * 60]
    rows = []
    for d in rng.sample(range(1000), 120):
        text = []
        for _ in range(rng.randrange(4)):
            text += words(rng.randrange(60)) + rng.choice(passages)[rng.randrange(3):]
        if rng.random() < 0.3 and text:
            text[rng.randrange(len(text))] = "edited"
        rows.append((d, " ".join(text)))
    return rows + [(2000 + i, rows[i][1]) for i in range(30)]


@pytest.mark.parametrize("seed,length,k", [(1, 50, 10), (2, 50, 25), (3, 20, 3), (4, 5, 5 - 1), (5, 50, 1)])
def test_against_brute_force(spark, docs, seed, length, k):
    rows = corpus(seed)
    got = result(spark, docs(rows), length=length, k=k)
    want = brute.repeats(rows, length)
    assert got == want and sum(v[1] > 0 for v in want.values()) > 30


def test_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small("documents")]
    assert result(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == brute.repeats(rows)


def test_edges(spark, docs, clashing):
    fifty = " ".join(map(str, range(50)))
    rows = [(1, None), (2, ""), (3, fifty), (4, "x\n" + fifty.replace(" ", "\t")), (5, " ".join(map(str, range(49)))), (6, "é " * 60_000),
            (7, "é " * 60), (8, "a b " + fifty + " tail")]
    assert result(spark, docs(rows)) == brute.repeats(rows)
    assert S.remove_repeats(spark, docs([])).count() == 0
    got = S.remove_repeats(spark, clashing([(1, fifty), (1, fifty), (2, fifty), (None, fifty), (None, fifty)])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("1", 0), ("1", 0), ("2", 50), ("None", 50), ("None", 50)]
    with pytest.raises(ValueError):
        S.remove_repeats(spark, docs([]), length=5, k=5)


def test_argmin_takes_the_last_of_equals():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 16, 41):
        v = rng.integers(0, 5, 300)
        want = [i + width - 1 - int(np.argmin(v[i: i + width][::-1])) for i in range(300 - width + 1)]
        assert S._argmin(v, width).tolist() == want
