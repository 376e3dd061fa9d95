"""Substring deduplication: winnowed seeds, extended both ways to maximal repeats.

Seeds.  In every window of ``length`` words the k-gram with the smallest hash is
the window's seed (the last of equals), so a window's seed depends on its words
alone: equal windows of two documents have equal seeds at equal places.

Extension.  The consecutive windows of a document that share one seed form a
block: the seed extended both ways as far as it stands for a window.  Blocks are
joined on (seed, block hash): where an equal block occurs in a document with a
smaller id, all its windows repeat.  Seeds that occur with several different
blocks (the ends of a repeat, or edits near it) are resolved window by window:
their open blocks are cut into windows, which are joined on (seed, place of the
seed, window hash).  Adjacent repeats merge to maximal ones of at least
``length`` words.  Groups are never expanded into pairs: each joins the smallest
id of its key, an aggregate.

Two independent 64-bit hashes must agree for a repeat.

Defined cases: null and empty texts have no words; a text shorter than a window
is kept whole; rows with the same doc_id never remove words from each other;
null doc_ids count as larger than all others and as equal to each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import chunks, mix, power_table, release, signed, stored, words_of

_BYTES = 2_000_000
_Q1, _Q2 = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_I1, _I2 = pow(_Q1, -1, 1 << 64), pow(_Q2, -1, 1 << 64)
_LAST = (1 << 63) - 1

#: A block of a document: its windows start at lo .. lo + span for each lo, the seed is at lo + place.
_BLOCK = [("seed", pa.int64()), ("block", pa.int64()), ("span", pa.int32()), ("place", pa.int32()), ("los", pa.list_(pa.int32()))]
_SPAN = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])


def _prefix(h: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power_table(base, len(h)), out=out[1:])
    return out


def _span(prefix: np.ndarray, inverse: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the words lo .. hi-1, wherever they stand."""
    return mix((prefix[hi] - prefix[lo]) * power_table(inverse, len(prefix))[lo])


def _argmin(value: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the smallest, the last of equals."""
    at, span = np.arange(len(value)), 1
    while span * 2 <= width:
        a, b = at[:-span], at[span:]
        at = np.where(value[b] <= value[a], b, a)
        span *= 2
    if span < width:
        a, b = at[: len(value) - width + 1], at[width - span:]
        at = np.where(value[b] <= value[a], b, a)
    return at


def seed_blocks(texts: list[bytes | None], length: int, k: int) -> tuple[np.ndarray, pa.StructArray]:
    """(text number, block) of each distinct block of the texts; words count from the text's first.

    A block that a text repeats (one word over and over) is one entry with all its places.
    """
    h, _, _, first, _ = words_of(texts)
    none = np.zeros(0, np.int64), pa.array([], pa.struct(_BLOCK))
    if len(h) < length:
        return none
    p1, p2 = _prefix(h, _Q1), _prefix(h, _Q2)
    place = np.arange(len(h) - k + 1)
    gram = _span(p1, _I1, place, place + k)
    at = _argmin(gram, length - k + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    s = np.arange(len(at))
    s = s[owner[s] == owner[s + length - 1]]
    if not len(s):
        return none
    seed_at = at[s]
    new = np.flatnonzero(np.diff(seed_at, prepend=-1))
    lo, hi, p = s[new], s[np.append(new[1:], len(s)) - 1], seed_at[new]
    own = owner[lo]
    block = signed(mix(_span(p2, _I2, lo, hi + length) + (p - lo).astype(np.uint64) * np.uint64(_Q1) + (hi - lo).astype(np.uint64)))
    seed = signed(gram[p])
    order = np.lexsort((lo, block, seed, own))
    own, seed, block, lo, hi, p = (x[order] for x in (own, seed, block, lo, hi, p))
    new = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(seed, prepend=~seed[:1]) != 0) | (np.diff(block, prepend=~block[:1]) != 0))
    los = pa.ListArray.from_arrays(pa.array(np.append(new, len(lo)).astype(np.int32)), pa.array((lo - first[own]).astype(np.int32)))
    columns = [seed[new], block[new], (hi - lo)[new], (p - lo)[new]]
    return own[new], pa.StructArray.from_arrays(
        [*(pa.array(c).cast(t) for c, (_, t) in zip(columns, _BLOCK, strict=False)), los], fields=[pa.field(*f) for f in _BLOCK])


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def repeats(spark: SparkSession, docs: DataFrame, *, length: int = 50, k: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, spans, texts of the documents with candidate spans).

    documents: doc_id, ord, tkey, n_words, kept_sha256 (of all words).
    spans: ord, tkey, lo, hi: the words lo .. hi-1 repeat in a document with a smaller id.
    """
    if not 0 < k < length:
        raise ValueError("k must be between 1 and length - 1")
    body = F.col("text").cast("binary")
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), F.xxhash64("text").alias("tkey"), body.alias("text"))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for i, j in chunks([len(t or b"") for t in texts], _BYTES):
                own, blocks = seed_blocks(texts[i:j], length, k)
                offsets = pa.array(np.searchsorted(own, np.arange(j - i + 1)).astype(np.int32))
                words = [(t or b"").split() for t in texts[i:j]]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[i:j] for c in range(3)), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([_sha(w) for w in words]), pa.ListArray.from_arrays(offsets, blocks)],
                    names=["doc_id", "ord", "tkey", "n_words", "kept_sha256", "blocks"])

    table = stored(spark, rows.mapInArrow(
        seeds, "doc_id long, ord long, tkey long, n_words long, kept_sha256 string, "
               "blocks array<struct<seed: long, block: long, span: int, place: int, los: array<int>>>"), "substring-seeds")
    occ = table.select("ord", "tkey", F.explode("blocks").alias("r")).select("ord", "tkey", "r.*")
    shared = stored(spark, occ.groupBy("seed").agg(F.min("ord").alias("o0"), F.max("ord").alias("o1"), F.min("block").alias("b0"),
                                                   F.max("block").alias("b1"))
                    .where("o0 < o1").select("seed", (F.col("b0") < F.col("b1")).alias("several")), "substring-shared")
    release(spark)
    occ = stored(spark, occ.join(shared, "seed"), "substring-occurrences")
    # Written, so that the join reads two plain shuffles and a block that many documents share can be split.
    first = stored(spark, occ.groupBy("seed", "block").agg(F.min("ord").alias("first")), "substring-first")
    occ = stored(spark, occ.join(first, ["seed", "block"]).withColumn("again", F.col("first") < F.col("ord"))
                 .where("again OR several").drop("several", "first", "block"), "substring-blocks")
    release(spark)
    whole = (occ.where("again").select("ord", "tkey", F.explode("los").alias("lo"), "span")
             .select("ord", "tkey", "lo", (F.col("lo") + F.col("span") + length).cast("int").alias("hi")))
    open_ = (occ.where("NOT again").groupBy("ord", "tkey")
             .agg(F.collect_set(F.struct("seed", "span", "place", "los")).alias("open")))  # at most a document's own blocks
    wanted = occ.select("ord", "tkey").distinct()
    texts = stored(spark, rows.select("ord", "tkey", "text").join(wanted, ["ord", "tkey"], "left_semi"), "substring-texts")
    release(spark)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ord", "tkey", "seed", "place", "window", "los"]
        for batch in batches:
            for order, tkey, text, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p2 = _prefix(words_of([text])[0], _Q2)
                first = np.array([b["los"][0] for b in blocks])
                count = np.array([b["span"] for b in blocks]) + 1
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                s = np.repeat(first, count) + step
                seed, place = (np.repeat(np.array([b[x] for b in blocks], np.int64), count) for x in ("seed", "place"))
                los = pa.array([b["los"] if not j else [x + j for x in b["los"]] for b in blocks for j in range(b["span"] + 1)],
                               pa.list_(pa.int32()))
                yield pa.record_batch([pa.array(np.full(len(s), order)), pa.array(np.full(len(s), tkey)), pa.array(seed),
                                       pa.array((place - step).astype(np.int32)), pa.array(signed(_span(p2, _I2, s, s + length))), los], names)

    cut = stored(spark, texts.dropDuplicates(["ord", "tkey"]).join(open_, ["ord", "tkey"]).select("ord", "tkey", "text", "open")
                 .mapInArrow(windows, "ord long, tkey long, seed long, place int, window long, los array<int>"), "substring-windows")
    release(spark)
    key = ["seed", "place", "window"]
    first = stored(spark, cut.groupBy(*key).agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last").drop("last"),
                   "substring-first")
    single = (cut.join(first, key).where("first < ord").select("ord", "tkey", F.explode("los").alias("lo"))
              .select("ord", "tkey", "lo", (F.col("lo") + length).cast("int").alias("hi")))
    return table.drop("blocks"), whole.unionByName(single), texts


def remove_repeats(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (the maximal repeats, lo .. hi-1) of every document."""
    table, spans, texts = repeats(spark, docs, **options)
    per_doc = spans.groupBy("ord", "tkey").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # a document's own

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas, spans = [], [], []
            for text, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = (text or b"").split()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [x["lo"] for x in found], 1)
                np.add.at(edge, [x["hi"] for x in found], -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                shas.append(_sha([words[i] for i in np.flatnonzero(~gone)]))
                ends = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
                spans.append([{"lo": int(lo), "hi": int(hi)} for lo, hi in ends])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas),
                                   pa.array(spans, pa.list_(_SPAN))], ["ord", "tkey", "n_removed", "sha", "removed"])

    changed = (texts.dropDuplicates(["ord", "tkey"]).join(per_doc, ["ord", "tkey"]).select("ord", "tkey", "text", "spans")
               .mapInArrow(remove, "ord long, tkey long, n_removed long, sha string, removed array<struct<lo: int, hi: int>>"))
    return table.join(changed, ["ord", "tkey"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("sha", "kept_sha256").alias("kept_sha256"),
        F.coalesce("removed", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))
