"""Sessions over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_sessions(events: DataFrame, gap_s: int, watermark: str) -> DataFrame:
    """Closed sessions per user. ``events`` is a stream with ``user_id`` and ``ts``.

    Times are cut to whole seconds, like the batch rule, and an event exactly at the
    gap stays in the session. Partial sessions are merged map-side, so a busy user
    sends sessions, not events, through the shuffle.
    """
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return (
        events.withColumn("at", second)
        .withWatermark("at", watermark)
        .groupBy(F.session_window("at", f"{gap_s} seconds").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            "user_id",
            F.col("w.start").cast("timestamp_ntz").alias("session_start"),
            (F.col("w.end") - F.expr(f"interval {gap_s} seconds")).cast("timestamp_ntz").alias("session_end"),
            "event_count",
        )
    )
