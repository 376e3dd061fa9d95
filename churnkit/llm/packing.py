"""Sequence packing along a space-filling curve.

Each document is tokenised once; the counts of its hashed token ids are projected
to a few dimensions and the Hilbert key of that point is its place on the curve.
Documents are range-sorted by key, laid end to end along the curve, and the line
is cut every ``length`` tokens: neighbouring documents share sequences, every
sequence but the last is full, and the last is padded to a power of two only.
Offsets are a prefix sum: sums per range partition reach the driver, rows don't.

Defined cases: null text is empty and is the end id alone; ties on the curve go
by doc_id, null ids first, and then by row; repeated rows are packed each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import CACHES, chunks, mix, stored

_CHARS = 2_000_000
_CACHED_WORDS = 1_200_000  # about 180 MB in each Python worker
#: New words that one call of the tokenizer gets.
_AT_ONCE = 500
#: Type codes of unsigned integers by size.
_CODE = {2: "H", 4: "I"}
_TAILS = (b".", b",")
_LOADED: dict[str, _Words] = {}
CACHES.append(lambda: [words.ids.clear() for words in _LOADED.values()])


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows x dimensions, ``bits`` bits each)."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections, level by level
        low = q - 1
        for i in range(dims):
            inside = (x[i] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(flip)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_key(counts: np.ndarray, dims: int, bits: int, seed: int) -> np.ndarray:
    """Hilbert key of hashed count vectors (documents x buckets)."""
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (counts.shape[1], dims))
    unit = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)
    spread = 0.5 + 0.5 * np.tanh(unit @ signs / 1.5)
    return hilbert_key(np.minimum((spread * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


@dataclass
class _Words:
    """A tokenizer, and for vocabularies that tokenise each word on its own the ids of words met so far."""

    full: object
    bare: object | None  # the same without normaliser; None: texts are tokenised whole
    bar: int | None  # the id of a word that is "|" alone, if it is one
    kind: np.dtype
    ids: dict[bytes, bytes]


def _tokenizer(path: str) -> _Words:
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        spec = json.loads(t.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        bare = bar = None
        # White space never joins two words, and the text is lower-cased: then a word's ids don't depend on its neighbours.
        if steps == ["NFC", "Replace", "Lowercase"] and first.get("behavior") == "Removed" and not spec["post_processor"]:
            bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None}))
            one = bare.encode("|", add_special_tokens=False).ids
            bar = one[0] if len(one) == 1 else None
        _LOADED[path] = _Words(t, bare, bar, np.dtype("<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"), {})
    return _LOADED[path]


def _plain(word: str) -> bool:
    """The normaliser leaves the word as it is: Latin-1 without capitals."""
    return word.isascii() or (max(word) < "\u0100" and word.lower() == word)


def token_bytes(texts: list[str | None], path: str, end: int) -> tuple[list[bytes], np.dtype]:
    """The ids of every text with the end id, as packed integers."""
    t = _tokenizer(path)
    last = np.array([end], t.kind).tobytes()
    packed = lambda e: array(_CODE[t.kind.itemsize], e.ids).tobytes()
    if t.bare is None:
        return [packed(e) + last for e in t.full.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)], t.kind
    if len(t.ids) > _CACHED_WORDS:
        t.ids.clear()
    # ASCII capitals are folded at once, but not where they might spell a special token.
    words = [(x if b"<|" in x else x.lower()).split() for x in ((x or "").encode() for x in texts)]
    found = [list(map(t.ids.get, x)) for x in words]  # one look-up a word; new words are looked up again
    new = [[i for i, ids in enumerate(f) if ids is None] for f in found]
    _learn(t, {x[i] for x, at in zip(words, new, strict=True) for i in at})
    for x, f, at in zip(words, found, new, strict=True):
        for i in at:
            f[i] = t.ids[x[i]]
    return [b"".join(f) + last for f in found], t.kind


def _learn(t: _Words, missing: set[bytes]) -> None:
    """Tokenise words not met so far."""
    # A point or comma after a letter or digit is a token of its own.
    tailed = {w: w[:-1] for w in missing if w[-1:] in _TAILS and w[-2:-1].isalnum()}
    needed = filterfalse(t.ids.__contains__, {*tailed.values(), *_TAILS}.union(missing.difference(tailed)))
    plain, rest = [], []
    for w in needed:
        (plain if t.bar is not None and b"|" not in w and (w.isascii() or _plain(w.decode())) else rest).append(w)
    # Many words in one call, told apart by the bars between them.
    groups = [plain[i: i + _AT_ONCE] for i in range(0, len(plain), _AT_ONCE)]
    size = t.kind.itemsize
    for some, e in zip(groups, t.bare.encode_batch_fast([b" | ".join(g).decode() for g in groups], add_special_tokens=False), strict=True):
        ids = array(_CODE[size], e.ids)
        raw, bars = ids.tobytes(), (np.flatnonzero(np.frombuffer(ids, t.kind) == t.bar) * size).tolist()
        t.ids.update(zip(some, [raw[i:j] for i, j in zip([0, *(b + size for b in bars)], [*bars, len(raw)], strict=True)], strict=True))
    for w, e in zip(rest, t.full.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False), strict=True):
        t.ids[w] = array(_CODE[size], e.ids).tobytes()
    for w, stem in tailed.items():
        t.ids[w] = t.ids[stem] + t.ids[w[-1:]]


def tokenised(docs: DataFrame, path: str, *, end: int = 2, buckets: int = 256, dims: int = 3, bits: int = 10,
              seed: int = 7) -> DataFrame:
    """doc_id, key, n (tokens with the end id) and ids (packed integers) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks([len(x or "") for x in texts], _CHARS):
                ids, kind = token_bytes(texts[i:j], path, end)
                bucket = (mix(np.arange(1 << 16 if kind.itemsize == 2 else 1 << 20, dtype=np.uint64)) % np.uint64(buckets)).astype(np.int64)
                counts = np.stack([np.bincount(bucket[np.frombuffer(x, kind) & (len(bucket) - 1)], minlength=buckets) for x in ids])
                yield pa.record_batch([batch.column(0)[i:j], pa.array(curve_key(counts, dims, bits, seed)),
                                       pa.array([len(x) // kind.itemsize for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                                      ["doc_id", "key", "n", "ids"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, key long, n long, ids binary")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid, part, tokens before the row in its partition."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        upto = before + np.cumsum(n)
        yield pa.record_batch([batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(upto - n), batch.column(1)],
                              ["uid", "part", "before", "n"])
        before = int(upto[-1]) if len(n) else before


def pack(spark: SparkSession, docs: DataFrame, path: str, *, length: int = 4096, **options) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and ids (unsigned little-endian 32-bit)."""
    tokens = stored(spark, tokenised(docs, path, **options).withColumn("uid", F.monotonically_increasing_id()), "packing-ids")
    line = (tokens.select("uid", "n", "key", "doc_id").repartitionByRange(_parts(spark), "key", "doc_id", "uid")
            .sortWithinPartitions("key", "doc_id", "uid").select("uid", "n")
            .mapInArrow(_running, "uid long, part int, before long, n long"))
    line = stored(spark, line, "packing-line")
    sums = {r["part"]: r["n"] for r in line.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a row per partition
    bases, total = [], 0
    for p in range(max(sums, default=0) + 1):
        bases.append(total)
        total += sums.get(p, 0)
    starts = line.select("uid", (F.col("before") + F.array(*[F.lit(b).cast("long") for b in bases])[F.col("part")]).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        kind = _tokenizer(path).kind
        for batch in batches:
            rows = []
            for doc, n, at, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, done = np.frombuffer(raw, kind), 0
                while done < n:
                    sequence, offset = divmod(at + done, length)
                    take = min(n - done, length - offset)
                    rows.append((doc, done, take, n, sequence, offset, ids[done: done + take].astype("<u4").tobytes()))
                    done += take
            cols = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 6 + [pa.binary()], strict=True)], names)

    return (tokens.join(starts, "uid").select("doc_id", "n", "at", "ids")
            .mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"))


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed_digests(spark: SparkSession, docs: DataFrame, path: str, **options) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pack(spark, docs, path, **options).select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def crc32_of(ids: list[int]) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
