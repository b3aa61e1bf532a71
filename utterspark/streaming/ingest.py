"""Incremental corpus ingest with exact de-duplication across micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.operators.corpus import UTTERANCE_KEY


def ingest_stream(stream: DataFrame, key: Sequence[str] = UTTERANCE_KEY,
                  event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Drop utterances already seen in any earlier micro-batch.

    Without ``event_time`` the dedup state keeps a digest of every key ever seen
    (exact, unbounded state). With ``event_time`` and ``delay`` the state is bounded by
    the watermark (``dropDuplicatesWithinWatermark``); duplicates later than
    the delay can pass. A TIMESTAMP_NTZ column is cast to TIMESTAMP first.
    """
    if event_time is None:
        # the state holds a digest of the key, not whole texts
        parts = F.struct(*[F.col(c) for c in key])
        return stream.withColumn("_key", F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)).dropDuplicates(["_key"]).drop("_key")
    ts = F.col(event_time).cast("timestamp")
    return (stream.withColumn(event_time, ts).withWatermark(event_time, delay or "1 hour")
                  .dropDuplicatesWithinWatermark(list(key)))
