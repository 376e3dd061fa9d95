"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are dealt to ``parts`` virtual partitions by a hash of the row, so a
recomputed task deals them alike.  With n_p rows in partition p and the shard
sizes fixed (N / shards, at most one apart), the matrix C[p, s] of how many rows
of p go to s is drawn exactly: row by row from the multivariate hypergeometric
law of what each shard still has to take.  Every partition then permutes its
rows (a seeded hash order), sends the first C[p, 0] to shard 0 and so on; every
shard permutes what it got (a second hash order) and numbers it without gaps.
Both permutations run over blocks of bounded size: only block counts, never
rows, are added up, so no task holds a whole shard.

Defined cases: null text has no bytes (crc32 of nothing, 0); null doc_ids are
dealt like any other; repeated rows tie in both orders and are interchangeable;
an empty table gives an empty result; with fewer rows than shards some shards
stay empty; other columns travel along, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnkit.llm.common import stored


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn are good.  Beyond numpy's limit of 1e9: inversion around the mode."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    mode = (n + 1) * (good + 1) // (good + bad + 2)
    share = good / (good + bad)
    reach = 40 * int((n * share * (1 - share)) ** 0.5 + 1)  # 40 standard deviations: less than any double
    low, high = max(0, n - bad, mode - reach), min(good, n, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (n - k) / ((k + 1) * (bad - n + k + 1)))
    log_p = np.concatenate([[0.0], np.cumsum(steps)])
    below = np.cumsum(np.exp(log_p - log_p.max()))
    return low + int(np.searchsorted(below, rng.random() * below[-1]))


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """C[p, s]: rows sent from partition p to shard s; row sums are ``rows``, column sums at most one apart."""
    rng = np.random.default_rng(seed)
    total = sum(rows)
    room = [total // shards] * shards
    for s in rng.permutation(shards)[: total % shards]:
        room[s] += 1
    out = np.zeros((len(rows), shards), np.int64)
    for p, n in enumerate(rows):
        others = sum(room)
        for s in range(shards):
            others -= room[s]
            out[p, s] = take = _hypergeometric(rng, room[s], others, n)
            room[s] -= take
            n -= take
    return out


def _row_key(df: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("__row"))


def shuffle_to_shards(spark: SparkSession, df: DataFrame, *, shards: int = 24, rows_per_task: int = 10_000, most_parts: int = 65_536,
                      seed: int = 1) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (0 .. size-1 within the shard).

    The number of virtual partitions and of blocks in a shard follows the table, so
    that each has about ``rows_per_task`` rows; ``most_parts`` bounds the matrix, and
    partitions grow (and sort on disk) beyond rows_per_task * most_parts rows.
    """
    rows = df.count()
    parts = max(1, min(most_parts, -(-rows // rows_per_task)))
    blocks = -(-parts // shards)
    names = df.columns
    data = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__data"))
    plain = [F.col(f"__data.`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    data = data.withColumn("__row", F.xxhash64(*plain))
    data = data.withColumn("__part", F.pmod(_row_key(data, seed), F.lit(parts)).cast("int"))

    counts = {r["__part"]: r["n"] for r in data.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}  # parts rows
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], shards, seed)
    upto = np.cumsum(matrix, axis=1)
    table = spark.createDataFrame([(p, upto[p].tolist()) for p in range(parts)], "__part int, __upto array<long>")

    # Local permutation, then the shard whose share of the partition holds the row's place.
    place = F.row_number().over(Window.partitionBy("__part").orderBy(F.xxhash64(F.lit(seed + 1), "__row"), "__row"))
    sent = (data.withColumn("__place", place).join(F.broadcast(table), "__part")  # parts x shards numbers
            .withColumn("shard", F.size(F.filter("__upto", lambda u: u < F.col("__place"))).cast("int"))
            .withColumn("__key", F.xxhash64(F.lit(seed + 2), "__row", "__part", "__place"))
            .withColumn("__block", F.pmod(F.shiftrightunsigned("__key", 32), F.lit(blocks)).cast("int"))
            .select("__data", "shard", "__key", "__block"))
    sent = stored(spark, sent, "sharding")

    sizes = sent.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("n"))
    before = (sizes.withColumn("__before", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("shard", "__block", "__before"))
    order = Window.partitionBy("shard", "__block").orderBy("__key")
    return (sent.withColumn("__rank", F.row_number().over(order))
            .join(F.broadcast(before), ["shard", "__block"])  # shards x blocks rows
            .select(*[F.col(f"__data.`{c}`").alias(c) for c in names], "shard",
                    (F.col("__before") + F.col("__rank") - 1).cast("long").alias("slot")))


def shard_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    out = shuffle_to_shards(spark, docs.select("doc_id", F.encode("text", "utf-8").alias("body")), **options)
    return out.select("doc_id", (F.coalesce(F.octet_length("body"), F.lit(0)) + 8).cast("long").alias("size"),
                      F.crc32(F.coalesce("body", F.lit(b""))).cast("long").alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
