"""Ranked lexical search by NRA: the best documents of every query from impact-sorted lists, read in order only.

The documents are cut into shards of about ``SHARD_POSTINGS`` postings by a hash of the row, so that a
frequent word's list is spread over all shards and a shard fits in a task.  In a shard each query term has a
list (document, weight x impact) sorted by descending score.  For a query the lists are read in
blocks, each deeper than the last.  Every document met has an interval: what it was seen
to score, and that plus the next score of every list in which it was not seen.  A document that was not met
can score the sum of those next scores.  Reading goes on until no unmet document and none
outside the candidates can reach the k-th lower bound, ties included, and every candidate's interval is a point.  No
document is looked up directly, and none is left out by a cut of the lists.  The k best of all shards meet
in one ranking by query: k rows of a shard and query.

Scores are 64-bit integers, so the result doesn't depend on shards or order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.llm.common import plain_words, stored

#: Postings of query terms in a shard, about; a task's memory follows from it.
SHARD_POSTINGS = 1_000_000
#: (query, term) pairs that go to the tasks at once, about; more queries are searched in further blocks.
BLOCK_PAIRS = 200_000
#: Postings of each list in the first read; every read after it is twice as deep.
FIRST_READ = 64

COUNTS = "rid long, doc_id long, terms array<string>, tfs array<long>"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its distinct terms with their counts; the first entry, of the empty term, has the number of all terms."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for at in range(0, len(batch), 500):
            terms, tfs, ends = [], [], [0]
            for t in texts.slice(at, 500):
                words = plain_words(t.as_py())
                c = Counter(words)
                terms.append(b"")
                tfs.append(len(words))
                terms += c
                tfs += c.values()
                ends.append(len(terms))
            cut = batch.slice(at, 500)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [cut.column("rid"), cut.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=["rid", "doc_id", "terms", "tfs"])


def term_counts(table: DataFrame, key: str) -> DataFrame:
    """rid, doc_id (= ``key``), term, tf of every row of ``table``; term '' has the number of all its terms."""
    rows = table.select(F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_counts, COUNTS).select(
        "rid", "doc_id", F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select("rid", "doc_id", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf"))


class Shard:
    """Impact-sorted lists of the documents of one shard."""

    def __init__(self, rid: np.ndarray, term: np.ndarray, score: np.ndarray, order: np.ndarray):
        """``term`` are codes; ``order`` breaks ties between documents of equal score (ascending)."""
        ids, first, doc = np.unique(rid, return_index=True, return_inverse=True)
        self.first, self.n = first, len(ids)  # a row of each document
        self.tie = order[first]
        by = np.lexsort((doc, -score, term))
        self.doc, self.score = doc[by], score[by]
        codes, starts = np.unique(term[by], return_index=True)
        ends = np.append(starts[1:], len(by))
        self.lists = {int(c): (s, e) for c, s, e in zip(codes, starts, ends)}

    def nra(self, terms: list[int], k: int, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of the k best for the terms, best first, and the number of postings read
        before the documents were settled."""
        spans = [self.lists[t] for t in terms if t in self.lists]
        none = np.zeros(0, np.int64)
        if not spans:
            return none, none, 0
        at = np.array([s for s, _ in spans])
        end = np.array([e for _, e in spans])
        next_ = self.score[at]
        lower = np.zeros(self.n, np.int64)
        missing = np.full(self.n, next_.sum(), np.int64)  # what unseen lists may add
        unseen = np.ones((len(spans), self.n), bool)
        met = np.zeros(self.n, bool)
        out = np.zeros(self.n, bool)  # can't be among the best any more
        settled, read, depth = False, 0, first_read
        while True:
            for i in range(len(spans)):
                stop = min(at[i] + depth, end[i])
                if at[i] == stop:
                    continue
                docs, gain = self.doc[at[i]:stop], self.score[at[i]:stop]
                lower[docs] += gain  # a document is once in a list
                unseen[i, docs] = False
                met[docs] = True
                at[i] = stop
                read += 0 if settled else len(docs)
            next_ = np.where(at < end, self.score[np.minimum(at, end - 1)], 0)
            depth *= 2
            alive = np.flatnonzero(met & ~out)
            missing = next_ @ unseen[:, alive]
            low = lower[alive]
            best = np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else 0
            rest = int(next_.sum())
            settled = settled or rest < best or rest == 0
            if not settled:
                continue
            # From here on no document that was not met can come in: those out stay out.
            out[~met] = True
            late = low + missing < best
            out[alive[late]] = True
            alive, missing = alive[~late], missing[~late]
            if not missing.any():
                break
        score = lower[alive]
        rank = np.lexsort((self.tie[alive], -score))[:k]
        return alive[rank], score[rank], read


HITS = "item_id long, doc_id long, rid long, score long"


def _search(queries: list[tuple[int | None, list[str]]], k: int):
    def run(table: pa.Table) -> pa.Table:
        code = table.column("term").combine_chunks().dictionary_encode()
        if isinstance(code, pa.ChunkedArray):
            code = code.combine_chunks()
        names = {t: i for i, t in enumerate(code.dictionary.to_pylist())}
        doc_id = table.column("doc_id").combine_chunks()
        rid = table.column("rid").to_numpy()
        # ties by doc_id (null first), then by row
        ids = doc_id.fill_null(np.iinfo(np.int64).min).to_numpy()
        shard = Shard(rid, code.indices.to_numpy(), table.column("s").to_numpy(), _ranks(ids, rid))
        items, rows, scores = [], [], []
        for item, terms in queries:
            docs, score, _ = shard.nra([names[t] for t in terms if t in names], k)
            items += [item] * len(docs)
            rows.append(shard.first[docs])
            scores.append(score)
        at = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
        return pa.table([pa.array(items, pa.int64()), doc_id.take(at), table.column("rid").combine_chunks().take(at),
                         pa.array(np.concatenate(scores) if scores else np.zeros(0, np.int64))], names=["item_id", "doc_id", "rid", "score"])
    return run


def _ranks(ids: np.ndarray, rid: np.ndarray) -> np.ndarray:
    by = np.lexsort((rid, ids))
    out = np.empty(len(by), np.int64)
    out[by] = np.arange(len(by))
    return out


def search(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 50, shard_postings: int = SHARD_POSTINGS,
           block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of all ``docs`` (doc_id, text) for every query (item_id, text).

    Null texts have no terms.  Rows with one item_id are one query, with the terms of all of them; rows with one doc_id
    are documents of their own, both ranked.  Null ids are kept and come first in ties.
    """
    asked = stored(spark, term_counts(queries, "item_id").where("term <> ''").select(F.col("doc_id").alias("item_id"), "term").distinct(), "search-asked")
    wanted = asked.select("term").distinct().unionByName(spark.createDataFrame([("",)], "term string"))
    found = stored(spark, term_counts(docs, "doc_id").join(wanted, "term", "left_semi"), "search-counts")
    sizes = found.where("term = ''").agg(F.count(F.when(F.col("tf") > 0, 1)).alias("n"), F.sum("tf").alias("l")).first()
    n_docs, n_terms = sizes["n"], sizes["l"] or 0
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not n_terms:
        return empty
    weights = found.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", "df", F.floor(F.lit(1000) * F.ln(F.lit(2.0 * n_docs + 2) / (F.lit(2) * F.col("df") + F.lit(1)))).alias("w"))
    weights = stored(spark, weights, "search-weights")
    postings = weights.agg(F.sum("df")).first()[0] or 0
    shards = max(1, -(-postings // shard_postings))
    length = found.where("term = ''").select("rid", (F.lit(50) + F.expr(f"(50 * tf * {n_docs}L) div {n_terms}L")).alias("m"))
    impact = F.expr("w * ((1000000000 * tf) div (1000 * tf + 20 * m))")
    scored = (found.where("term <> ''").join(weights.where("w > 0"), "term").join(length, "rid")
              .select(F.pmod(F.xxhash64("rid"), F.lit(shards)).alias("shard"), "rid", "doc_id", "term", impact.alias("s")).where("s > 0"))
    n_blocks = -(-asked.count() // block_pairs)
    hits = None
    if n_blocks > 1:  # every block reads the same lists
        scored = stored(spark, scored, "search-lists")
    for b in range(n_blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).groupBy("item_id").agg(F.collect_list("term")).collect()
        part = scored.repartition(F.col("shard")).groupBy("shard").applyInArrow(_search([(r[0], sorted(r[1])) for r in mine], k), HITS)
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return empty
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "rid")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH words AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*) AS n, sum(len(ws))::BIGINT AS l FROM words WHERE len(ws) > 0),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS term FROM words)
       WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * total.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, total.n),
scores AS (SELECT item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * tf.n * total.n) // total.l))))::BIGINT AS score
           FROM asked JOIN tf USING (term) JOIN weight USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, rid) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
