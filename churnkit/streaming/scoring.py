"""Scoring a stream of curated rows with linear scorers (stateless)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from churnkit.operators.scoring import LinearScorer, consensus


def score_stream(rows: DataFrame, scorers: Sequence[LinearScorer], key: str) -> DataFrame:
    """p_<model>, pred_<model>, votes and consensus for each incoming row —
    the batch operators, unchanged, on a streaming DataFrame."""
    scored = rows.select(key, *[s.prob().alias(f"p_{s.name}") for s in scorers])
    return consensus(scored, {s.name: s.threshold for s in scorers})


def start_scoring_stream(spark: SparkSession, source_dir: str, schema, scorers: Sequence[LinearScorer], key: str,
                         out_dir: str, checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """Parquet files landing in ``source_dir`` -> scored rows in ``out_dir``.

    The file sink with a checkpoint location is exactly-once across restarts;
    ``available_now`` processes the backlog and stops (batch-like runs).
    """
    rows = spark.readStream.schema(schema).parquet(source_dir)
    w = (score_stream(rows, scorers, key).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_dir)
