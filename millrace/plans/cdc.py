"""Bronze to silver to gold, and the late-order alert."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semantics import datediff_boundary
from millrace.operators.changes import collapse_feed, last_change
from millrace.operators.partitions import PartitionedTable
from millrace.operators.staging import stage
from millrace.operators.writes import Matched, MergeResult, NotMatched, merge_into
from millrace.plans.relational import since
from millrace.sources.retail import ntz

HIGH_VALUE = 1000


def first_silver(bronze: DataFrame, as_of: datetime) -> DataFrame:
    """Silver after the first run, when every bronze row is new."""
    return bronze.select(
        "order_id",
        "customer_id",
        "order_ts",
        "order_status",
        "total_amount",
        (F.col("total_amount") > HIGH_VALUE).alias("is_high_value"),
        ntz(as_of).alias("inserted_at"),
        ntz(as_of).alias("updated_at"),
        F.lit(False).alias("is_deleted"),
    )


def silver_merge(silver: DataFrame, feed: DataFrame, as_of: datetime, batch: int | None = None) -> MergeResult:
    """Apply a change feed: deletes are soft, updates overwrite, new rows are added.

    With a ``batch`` number, ``silver`` has the column ``last_batch``: rows that this batch or a
    later one has changed already are left as they are.
    """
    source = collapse_feed(feed).withColumn("is_high_value", F.col("total_amount") > HIGH_VALUE)
    copied = ["customer_id", "order_ts", "order_status", "total_amount", "is_high_value"]
    values = {c: F.col(f"s.{c}") for c in copied}
    now = ntz(as_of)
    is_insert = F.col("s.action") == "INSERT"
    mark = {} if batch is None else {"last_batch": F.lit(batch)}
    fresh = F.lit(True) if batch is None else F.col("t.last_batch") < batch
    return merge_into(
        silver,
        source,
        ["order_id"],
        matched=[
            Matched("update", fresh & (F.col("s.action") == "DELETE"), {"is_deleted": F.lit(True), "updated_at": now, **mark}),
            Matched("update", fresh & is_insert & F.col("s.is_update"), {**values, "updated_at": now, **mark}),
        ],
        not_matched=[
            NotMatched(
                {
                    "order_id": F.col("s.order_id"),
                    **values,
                    "inserted_at": now,
                    "updated_at": now,
                    "is_deleted": F.lit(False),
                    **mark,
                },
                is_insert,
            )
        ],
        # A collapsed feed holds one row per key.
        source_is_unique=True,
    )


NO_BATCH = -1


def silver_table(silver: DataFrame, path: str) -> PartitionedTable:
    """Silver stored by month, with the number of the batch that changed a row last."""
    marked = silver.withColumn("last_batch", F.lit(NO_BATCH).cast("bigint"))
    return PartitionedTable(silver.sparkSession, path, marked.schema, F.trunc("order_ts", "month")).create(marked)


def apply_silver_batch(table: PartitionedTable, feed: DataFrame, batch: int, as_of: datetime, sequence: str) -> MergeResult:
    """Merge one batch of changes into the months it touches, exactly once.

    A batch that runs again, after success or after a stop half-way through the months, finds its
    number on the rows it has changed and leaves them. The feed has the old and the new rows of an
    update, so its dates name every month that can change. Batch numbers rise.
    """
    feed = stage(feed, "batch")
    months = table.touched(feed)
    merged = silver_merge(table.read(months), stage(last_change(feed, ["order_id"], sequence), "changes"), as_of, batch)
    result = MergeResult(stage(merged.log, "silver"))
    table.replace(result.rows, months)
    return result


def gold_rows(silver: DataFrame) -> DataFrame:
    return (
        silver.where(~F.col("is_deleted"))
        .groupBy("customer_id", F.to_date("order_ts").alias("order_date"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_amount").cast("decimal(14,2)").alias("revenue"),
            F.count_if("is_high_value").alias("high_value_cnt"),
        )
    )


def gold_merge(gold: DataFrame, silver: DataFrame, as_of: datetime, days: int = 7) -> MergeResult:
    """Re-aggregate the last ``days`` days and upsert them.

    A customer-day whose rows are all soft-deleted produces no source row, so its
    gold row stays as it was: the merge has no clause for rows missing at the source.
    """
    source = gold_rows(silver.where(F.col("order_ts") >= since(as_of, f"{days} days")))
    measures = {c: F.col(f"s.{c}") for c in ["order_count", "revenue", "high_value_cnt"]}
    keys = ["customer_id", "order_date"]
    return merge_into(
        gold,
        source,
        keys,
        matched=[Matched("update", None, {**measures, "updated_at": ntz(as_of)})],
        not_matched=[NotMatched({**{k: F.col(f"s.{k}") for k in keys}, **measures, "updated_at": ntz(as_of)})],
        source_is_unique=True,
    )


def late_orders(silver: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """One alert row when pending orders are past their time, none otherwise."""
    late = silver.where(
        (F.col("order_status") == "PENDING") & (datediff_boundary("hour", "order_ts", ntz(as_of)) > hours)
    ).agg(F.count(F.lit(1)).alias("n"))
    return late.where(F.col("n") > 0).select(
        ntz(as_of).alias("alert_ts"),
        F.lit("WARN").alias("level"),
        F.concat(F.lit("Late orders: "), F.col("n").cast("string"), F.lit(" rows past SLA")).alias("message"),
    )
