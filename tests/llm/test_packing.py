import zlib

import numpy as np

from churnkit.llm import packing as P
from churnkit.llm.queries import tokenizer_path

END = 2


def layout(rows, pieces):
    """Checks the pieces of ``rows`` and returns the tokens in each sequence."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    want = sorted(t.encode(x or "", add_special_tokens=False).ids + [END] for _, x in rows)
    sequences, got = {}, {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["length"] > 0
    for v in sequences.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 4096
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"]
        if r["start"] == 0:
            got.setdefault(r["doc_id"], []).append([])
        assert len(got[r["doc_id"]][-1]) == r["start"]
        got[r["doc_id"]][-1] += ids
        assert r["doc_tokens"] >= len(got[r["doc_id"]][-1])
    assert sorted(x for v in got.values() for x in v) == want
    return {s: sum(n for _, n in v) for s, v in sequences.items()}


ROWS = [(1, "Hello, World! it's 12%"), (2, None), (3, ""), (4, "a b\x1cc İstanbul ΣΑΣ 　x"), (5, "word " * 30_000), (6, "<|endoftext|> x"),
        (None, "no id"), (8, "é ́x"), (9, "don't we'll I'M"), (10, "日本語 русский"), (10, "日本語 русский")]


def test_edge_texts(spark, docs):
    fill = layout(ROWS, P.pack(spark, docs(ROWS), tokenizer_path()).collect())
    assert sorted(fill) == list(range(len(fill)))
    assert all(n == 4096 for s, n in fill.items() if s < max(fill))


def test_table_and_digests(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small("documents")]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fill = layout(rows, P.pack(spark, df, tokenizer_path()).collect())
    assert sum(n < 4096 for n in fill.values()) <= 1
    ids = P.crc32_of([5, 70_000])
    assert ids == zlib.crc32(bytes([5, 0, 0, 0, 112, 17, 1, 0]))


def test_hilbert_is_a_curve():
    """Every point once, and neighbours in key order are neighbours in space."""
    for dims, bits in ((2, 4), (3, 3)):
        axes = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = P.hilbert_key(axes, bits)
        assert sorted(key) == list(range(len(axes)))
        assert (np.abs(np.diff(axes[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_neighbours_share_a_language(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    at = P.tokenised(df, tokenizer_path()).select("doc_id", "key").join(df.select("doc_id", "lang"), "doc_id").orderBy("key").toPandas()
    same = (at.lang.to_numpy()[1:] == at.lang.to_numpy()[:-1]).mean()
    assert same > (at.lang.value_counts(normalize=True) ** 2).sum() + 0.1


def test_empty_and_clashing(spark, docs, clashing):
    assert P.packed_digests(spark, docs([]), tokenizer_path()).count() == 0
    got = P.packed_digests(spark, clashing([(1, "a"), (1, "a")]), tokenizer_path()).collect()
    assert [r["length"] for r in got] == [2, 2] and sorted(r["offset"] for r in got) == [0, 2]


def test_new_words_are_looked_up_not_subtracted():
    """A call's work doesn't grow with the words met before: they are never walked."""
    class Known(dict):
        def keys(self):
            raise AssertionError("all known words walked")

        __iter__ = keys

    path = tokenizer_path()
    t = P._tokenizer(path)
    before, t.ids = t.ids, Known()
    try:
        texts = ["one two. | x|y", "two one, é. a | b"]
        want = [t.full.encode(x, add_special_tokens=False).ids + [END] for x in texts]
        for _ in range(2):
            ids, kind = P.token_bytes(texts, path, END)
            assert [np.frombuffer(x, kind).tolist() for x in ids] == want
    finally:
        t.ids = before
