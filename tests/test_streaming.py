"""Streaming scoring equals batch scoring on the same rows."""

import tempfile

from churnkit.operators.scoring import FIXED_SCORERS, consensus, score_table
from churnkit.plans import etl
from churnkit.sources import adapters
from churnkit.streaming import start_scoring_stream

from paths import SF_SMALL


def test_stream_matches_batch(spark):
    cur = etl.curated_from_raw(adapters.raw_customers(spark, SF_SMALL))
    base = tempfile.mkdtemp(prefix="churnkit-stream-", dir="/tmp")
    cur.write.mode("overwrite").parquet(f"{base}/in")
    q = start_scoring_stream(spark, f"{base}/in", cur.schema, FIXED_SCORERS, "customer_id", f"{base}/out",
                             f"{base}/ckpt")
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{base}/out")
    batch = consensus(score_table(cur, FIXED_SCORERS, "customer_id", "churn").drop("churn_actual"),
                      {s.name: s.threshold for s in FIXED_SCORERS})
    cols = sorted(batch.columns)
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert len(a) == cur.count() and a == b
