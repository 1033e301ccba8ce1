"""Jobs over timestamped user events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scoring import clean_email
from millrace.functions.semantics import order_desc
from millrace.operators.ordered import find_hot, qualify_topn
from millrace.operators.semi import path
from millrace.operators.sessions import interval_join, sequence_match, session_metrics, sessionise
from millrace.operators.staging import stage
from millrace.plans.relational import since


def daily_user_metrics(events: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    """Counts per user and day, exact and approximate."""
    recent = events.where(F.col("event_ts") >= since(as_of, f"{days} days"))
    return recent.groupBy(F.col("ingestion_date").alias("event_date"), "user_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        # Grouped by type first, so no set of types is held.
        F.count_distinct("event_type").alias("distinct_event_types"),
        F.approx_count_distinct("event_id").alias("approx_unique_events"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
    )


def typed_user_events(events: DataFrame) -> DataFrame:
    p, g = F.parse_json("payload"), F.parse_json("geo")
    return events.select(
        "user_id",
        "event_id",
        "event_ts",
        "event_type",
        path(p, "$.device_type", "string").alias("device_type"),
        path(p, "$.utm.source", "string").alias("utm_source"),
        path(p, "$.order.total", "decimal(12,2)").alias("order_total"),
        path(g, "$.country", "string").alias("country"),
        path(g, "$.lat", "double").alias("lat"),
        path(g, "$.lon", "double").alias("lon"),
    )


def session_report(events: DataFrame, as_of: datetime, gap_s: int, days: int = 30) -> DataFrame:
    """Session metrics of the last ``days`` days of events."""
    recent = events.where(F.col("event_ts") >= since(as_of, f"{days} days"))
    busy = find_hot(recent, ["user_id"])
    sessions = sessionise(typed_user_events(recent), "user_id", "event_ts", "event_id", gap_s, busy)
    # Without a busy user there is no busy session.
    return session_metrics(sessions, busy if busy.keys is None else None)


def session_p95(sessions: DataFrame, last_n: int = 100) -> DataFrame:
    """The last ``last_n`` sessions per user that took time, with their country's 95th percentile.

    The percentile covers all sessions of the country. It is aggregated and joined
    back, because a window would sort a whole country in one task. The sessions are
    staged, so that building them is not repeated for the two sides.
    """
    columns = ["user_id", "session_no", "session_start", "country", "duration_s"]
    timed = stage(sessions.where(F.col("duration_s") > 0).select(*columns), "timed-sessions")
    # Whole seconds: the buffer holds one entry per distinct duration.
    p95 = timed.groupBy("country").agg(F.percentile("duration_s", F.lit(0.95)).alias("p95_duration_country"))
    last = qualify_topn(timed, ["user_id"], [order_desc("session_start"), order_desc("session_no")], last_n, "rn")
    joined = last.alias("s").join(p95.alias("p"), F.col("s.country").eqNullSafe(F.col("p.country")))
    return joined.select(
        "s.user_id", "s.session_no", "s.country", "s.duration_s", F.round("p95_duration_country", 6).alias("p95_duration_country")
    )


def enriched_events(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Events with the session they fall in and that session's cleaned address."""
    left = events.select("event_id", "user_id", "event_ts", "event_type", "payload")
    joined = interval_join(left, lookup, ["user_id"], "event_ts", "session_start", "session_end")
    return joined.select(
        "event_id",
        "user_id",
        "event_ts",
        "event_type",
        "session_id",
        clean_email(F.col("user_email")).alias("clean_email"),
        path(F.parse_json("payload"), "$.page", "string").alias("page"),
    )


def state_path(changes: DataFrame) -> DataFrame:
    """FREE, then TRIAL within 30 days, then PAID within 14."""
    return sequence_match(
        changes,
        "customer_id",
        "event_ts",
        "event_id",
        "new_state",
        ("FREE", "TRIAL", "PAID"),
        (30, 14),
        ("free_ts", "trial_ts", "paid_ts"),
    )
