"""Structured Streaming entry points.

The reference has no streaming operators; what carries over is batch
scoring (M19/M20) applied to curated rows as they land.  The scoring is the
same stateless projection as in batch, so a stream needs no state store,
watermark or custom stateful operator.
"""

from churnkit.streaming.scoring import score_stream, start_scoring_stream

__all__ = ["score_stream", "start_scoring_stream"]
