"""Round trips through files: the retail views are written out by Spark, then loaded.

Each function writes below the shared scratch folder, so the load reads as much data
as the tables hold.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from millrace.operators.keys import KeyMarks
from millrace.operators.staging import scratch_path, stage
from millrace.plans import audit, cdc
from millrace.plans import governance as gov
from millrace.plans import relational as rel
from millrace.plans.clickstream import daily_user_metrics
from millrace.plans.customer360 import customer_360, refresh_360
from millrace.plans.model import labelled_history, train_churn
from millrace.sources import files
from millrace.sources.history import BRIDGE_DAY, EARLIER, History
from millrace.sources.retail import AS_OF_EVENTS, AS_OF_ORDERS, SCHEMAS, SESSION_GAP_S
from millrace.streaming import ingest
from millrace.streaming.sessions import stream_sessions as session_stream

BRONZE = StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("total_amount", T.DecimalType(12, 2)),
    ]
)
EVENT_KEYS = StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
EVENT = StructType(
    [*EVENT_KEYS.fields, T.StructField("event_ts", T.TimestampNTZType()), T.StructField("event_type", T.StringType())]
)


def _bronze_text(orders: DataFrame) -> DataFrame:
    """Bronze orders as text columns, with NULL tokens and some amounts that are not numbers."""
    key = F.col("order_id")
    amount = (
        F.when(key % 100 == 3, F.lit("abc"))
        .when(key % 13 == 5, F.lit("NULL"))
        .otherwise(F.col("total_amount").cast("string"))
    )
    return orders.select(
        key.cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("order_ts"),
        F.when(key % 11 == 4, F.lit("")).otherwise(F.col("order_status")).alias("order_status"),
        amount.alias("total_amount"),
    )


def _write_delimited(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(sep="|", header="true", compression="gzip").csv(path)


def _load_bronze(r: History) -> files.Load:
    root = scratch_path(r.spark, "stage")
    _write_delimited(_bronze_text(r.bronze), f"{root}/orders_bronze")
    # A file the pattern must leave out.
    _write_delimited(_bronze_text(r.bronze_v2), f"{root}/other")
    return files.load_csv(r.spark, root, BRONZE, pattern=".*orders_.*[.]csv[.]gz")


def load_csv(r: History) -> DataFrame:
    return _load_bronze(r).good


def load_audit(r: History) -> DataFrame:
    """Three arrivals of bronze files, one of them empty of news, loaded into one table; the ledger by arrival."""
    root = scratch_path(r.spark, "arrivals")
    history = files.LoadHistory(r.spark, f"{root}/ledger")
    text = _bronze_text(r.bronze)
    start = datetime(2024, 5, 1)
    for run, arrival in enumerate([0, 1, None]):
        if arrival is not None:
            _write_delimited(text.where(F.col("order_id") % 2 == arrival), f"{root}/in/arrival={arrival}")
        history.load("bronze", f"{root}/bronze", f"{root}/in", BRONZE, start + timedelta(hours=20 * run))
    entries = history.rows()
    loaded = r.spark.read.schema(BRONZE).parquet(f"{root}/bronze").count()
    last_day = history.since("bronze", start + timedelta(hours=40 - 24)).select("file_name", F.lit(True).alias("last_day"))
    by_arrival = entries.join(last_day, "file_name", "left").groupBy(
        F.regexp_extract("file_name", "arrival=([0-9]+)", 1).cast("int").alias("arrival"), "load_time"
    )
    return by_arrival.agg(
        F.sum("row_count").alias("row_count"),
        F.sum("row_parsed").alias("row_parsed"),
        F.bool_and(F.coalesce("last_day", F.lit(False))).alias("last_day"),
        F.max("first_error_message").isNotNull().alias("has_errors"),
    ).withColumn("table_rows", F.lit(loaded))


def load_manifest(r: History) -> DataFrame:
    """Events of the files that a manifest lists: two of three folders, and one that is optional and missing."""
    root = scratch_path(r.spark, "manifest")
    rows = r.user_events.select("event_id", "user_id", "event_ts", "event_type")
    lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), (F.col("event_id") % 3).alias("third"))
    lines.write.option("compression", "gzip").partitionBy("third").text(f"{root}/events")
    entries = [{"url": f"{root}/events/third={k}", "mandatory": True} for k in (0, 2)] + [{"url": f"{root}/events/third=9", "mandatory": False}]
    r.spark.createDataFrame([(json.dumps({"entries": entries}),)], "value string").coalesce(1).write.text(f"{root}/files")
    return files.load_manifest(r.spark, f"{root}/files", EVENT).good


def load_json(r: History) -> DataFrame:
    path = scratch_path(r.spark, "events-json")
    rows = r.user_events.select("event_id", "user_id", "event_ts", "event_type")
    text = F.to_json(F.struct(*rows.columns))
    # A few bad rows, below the error budget whatever the size of the table.
    cut = F.when((F.col("event_id") % 997 == 3) & (F.col("event_id") < 50_000), F.left(text, F.lit(20))).otherwise(text)
    rows.select(cut.alias("value")).write.option("compression", "gzip").text(path)
    return files.load_json(r.spark, [path], EVENT, max_errors=100, lengths={"event_type": 6}).good


def load_json_array(r: History, size: int = 5_000) -> DataFrame:
    """One file per block of ``size`` consecutive event ids, each a single array."""
    path = scratch_path(r.spark, "events-array")
    rows = r.user_events.select("event_id", "user_id", "event_ts", "event_type")
    block = F.floor(F.col("event_id") / size)
    arrays = rows.groupBy(block.alias("b")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.load_json_array(r.spark, path, EVENT)


def filename_date(r: History) -> DataFrame:
    root = scratch_path(r.spark, "ext")
    rows = r.user_events.select("event_id", "user_id", F.col("ingestion_date").alias("event_date"))
    files.unload(rows, f"{root}/data", ["event_date"])
    return files.filename_date(r.spark, root, EVENT_KEYS)


def unload_parquet(r: History) -> DataFrame:
    path = scratch_path(r.spark, "unload")
    files.unload(daily_user_metrics(r.user_events, AS_OF_EVENTS), path, ["event_date"])
    return r.spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def table_profile(r: History) -> DataFrame:
    profile = files.table_profile({name: r.table(name) for name in SCHEMAS})
    return profile.select("table_name", "row_count", (F.col("bytes") > 0).alias("has_bytes"))


def auto_ingest(r: History) -> DataFrame:
    """Two arrivals, each ingested by its own run over the same checkpoint."""
    root = scratch_path(r.spark, "auto")
    text = _bronze_text(r.bronze)
    for arrival in (F.col("order_id") % 2 == 0, F.col("order_id") % 2 == 1):
        _write_delimited(text.where(arrival), f"{root}/in")
        ingest.auto_ingest(r.spark, f"{root}/in", f"{root}/bronze", f"{root}/checkpoint", BRONZE)
    return ingest.read_ingested(r.spark, f"{root}/bronze", BRONZE).select("order_id", "order_status", "total_amount")


def stream_silver(r: History, arrivals: int = 3) -> DataFrame:
    """The change feed arriving as files in several batches, merged into silver by months."""
    root = scratch_path(r.spark, "silver-stream")
    table = cdc.silver_table(r.silver_before, f"{root}/silver")
    feed = r.feed.withColumn("change_no", F.lit(0).cast("bigint"))
    for k in range(arrivals):
        feed.where(F.col("order_id") % arrivals == k).coalesce(1).write.parquet(f"{root}/in/{k}")
    ingest.stream_silver(r.spark, f"{root}/in/*", f"{root}/checkpoint", feed.schema, table, AS_OF_ORDERS, "change_no", files=1)
    return table.read().select("order_id", "order_status", "total_amount", "is_high_value", "is_deleted")


def append_feed(r: History) -> DataFrame:
    root = scratch_path(r.spark, "append")

    def consume(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for arrival in (F.col("order_id") % 2 == 0, F.col("order_id") % 2 == 1):
        r.bronze.where(arrival).write.mode("append").parquet(f"{root}/in")
        ingest.append_feed(r.spark, f"{root}/in", f"{root}/checkpoint", BRONZE, consume)
    return r.spark.read.schema(BRONZE).parquet(f"{root}/out").select("order_id", "order_status", "total_amount")


def stream_sessions(r: History) -> DataFrame:
    """Sessions the watermark has closed once the whole event table is read; ``all_stream_sessions`` has the open ones too."""
    root = scratch_path(r.spark, "sessions")
    source = f"{r.sf_dir}/{{events}}.parquet"  # a pattern: a stream reads folders or patterns, not one file
    events = r.spark.readStream.schema(SCHEMAS["events"]).parquet(source)
    closed = session_stream(events, SESSION_GAP_S, "10 minutes")
    query = (
        closed.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    return r.spark.read.schema(closed.schema).parquet(f"{root}/out")


def all_stream_sessions(r: History) -> DataFrame:
    """Every session of the event table: those the stream has closed, and those still open at its end.

    A user's open sessions lie after the closed ones, so they are made of the events
    after the last closed one.
    """
    closed = stream_sessions(r)
    last = closed.groupBy("user_id").agg(F.max("session_end").alias("last_end"))
    left = r.table("events").join(last, "user_id", "left").where("last_end IS NULL OR date_trunc('second', ts) > last_end")
    still = session_stream(left, SESSION_GAP_S, "10 minutes")
    return closed.withColumn("is_open", F.lit(False)).unionByName(still.withColumn("is_open", F.lit(True)))


def rebuild_partitions(r: History, days: int = 60) -> DataFrame:
    """The first bronze version by date, with the last 60 days rebuilt from the second."""
    path = scratch_path(r.spark, "by-date")

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("order_date", F.to_date("order_ts"))

    files.unload(dated(r.bronze_v1), path, ["order_date"])
    end = AS_OF_ORDERS.date()
    audit.rebuild_partitions(dated(r.bronze_v2), path, "order_date", end - timedelta(days=days), end)
    return r.spark.read.parquet(path).groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))


def rebuild_report(r: History, days: int = 60) -> DataFrame:
    """A checked rebuild of the last 60 days from the second bronze version, and the rows the dates have then.

    Orders of an unknown customer fail the check; their dates keep the rows of the first version.
    """
    path = scratch_path(r.spark, "by-date")
    root = scratch_path(r.spark, "audit")

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("order_date", F.to_date("order_ts"))

    files.unload(dated(r.bronze_v1), path, ["order_date"])
    end = AS_OF_ORDERS.date()
    reports = []

    def work(counts: audit.Counts) -> None:
        rules = {"UNKNOWN_CUSTOMER": F.col("customer_id") > 0, "NO_AMOUNT": F.col("total_amount").isNotNull()}
        reports.append(audit.rebuild_checked(dated(r.bronze_v2), path, "order_date", end - timedelta(days=days), end, rules, counts))

    audit.run_audit(r.spark, None, "rebuild_partitions", root, work)
    status = audit.latest_runs(audit.run_log(r.spark, root)).select("status", "rows_inserted", "rows_rejected")
    now = r.spark.read.parquet(path).groupBy("order_date").agg(F.count(F.lit(1)).alias("rows_now"))
    return (
        reports[0]
        .join(now, "order_date", "left")
        .withColumn("rows_now", F.coalesce("rows_now", F.lit(0)))
        .join(status, F.lit(True))  # one row
    )


def customer_audit_log(r: History) -> DataFrame:
    """The log after two runs, the second of them repeated."""
    path = scratch_path(r.spark, "audit-log")
    for as_of in (EARLIER, AS_OF_ORDERS, AS_OF_ORDERS):
        log = gov.append_audit_log(r.customers, path, as_of)
    return log


def channel_quantiles(r: History) -> DataFrame:
    """Median and 95th percentile per channel from stored daily sketches, each within two percent of its rank."""
    path = scratch_path(r.spark, "sketches")
    rel.quantile_sketches(r.orders).write.parquet(path)
    ranks = {"median": 0.5, "p95": 0.95}
    found = stage(rel.channel_quantiles(r.spark.read.parquet(path), ranks), "quantiles")
    return found.select("channel", "amount_count").join(rel.close_in_rank(r.orders, found, "channel", "total_amount", ranks, 0.02), "channel")


def approx_channel(r: History) -> DataFrame:
    """The approximate aggregates per channel with what SQL can check: exact counts, and whether the estimates are close."""
    ranks = {"approx_median": 0.5, "approx_p95": 0.95}
    found = stage(rel.approx_channel(r.orders), "approximate")
    exact = r.orders.groupBy("channel").agg(F.count_distinct("customer_id").alias("customers"))
    near = F.abs(F.col("approx_customers") - F.col("customers")) <= 0.08 * F.col("customers")
    counted = found.join(exact, "channel").select("channel", "customers", near.alias("approx_customers_close"))
    return counted.join(rel.close_in_rank(r.orders, found, "channel", "total_amount", ranks, 0.01), "channel")


def country_summary(r: History) -> DataFrame:
    """Countries' revenue, and whether the 95th percentile of their customers' is close to its rank."""
    lifetime = stage(rel.customer_lifetime(r.orders, r.customers), "lifetime")
    found = stage(rel.country_summary(lifetime), "summary")
    close = rel.close_in_rank(lifetime, found, "country", "lifetime_revenue", {"p95_revenue": 0.95}, 0.01)
    return found.drop("p95_revenue").join(close, "country")


AUDIT_COLUMNS = ["run_id", "proc_name", "status", "rows_processed", "rows_inserted", "rows_updated", "rows_rejected"]


def _audited(r: History, run_id: str, proc: str, work) -> DataFrame:
    path = scratch_path(r.spark, "audit")
    audit.run_audit(r.spark, run_id, proc, path, work)
    return audit.latest_runs(audit.run_log(r.spark, path)).select(*AUDIT_COLUMNS)


def run_audit(r: History) -> DataFrame:
    """The silver merge as an audited run."""

    def work(counts: audit.Counts) -> None:
        log = stage(cdc.silver_merge(r.silver_before, r.feed, AS_OF_ORDERS).log, "silver")
        done = audit.action_counts(log)
        counts.inserted, counts.updated = done.get("insert", 0), done.get("update", 0)
        counts.processed = counts.inserted + counts.updated

    return _audited(r, "silver-1", "silver_merge", work)


def dwh_refresh(r: History) -> DataFrame:
    """The complete warehouse refresh as an audited run."""

    def work(counts: audit.Counts) -> None:
        state = audit.Warehouse(r.dim_before, r.fact_before, r.bridge_before)
        marks = KeyMarks(r.spark, scratch_path(r.spark, "key-marks"))
        _, _, history = audit.refresh_dwh(
            state, r.feed, r.customers, r.order_items, r.products, AS_OF_ORDERS, BRIDGE_DAY, "dwh-1", counts, marks
        )
        stage(history, "vip-history")

    return _audited(r, "dwh-1", "refresh_dwh", work)


def _refreshed_360(r: History) -> tuple[DataFrame, DataFrame]:
    """(table, run log) after the first run of the snapshot job and a second one that finds nothing to do."""
    path = scratch_path(r.spark, "audit")
    model = train_churn(stage(labelled_history(r.orders, r.customers, AS_OF_ORDERS), "labelled"))
    tables = [r.c360_before]

    def work(counts: audit.Counts) -> None:
        tables.append(refresh_360(tables[-1], r.orders, r.order_items, r.customers, r.products, AS_OF_ORDERS, counts, model))

    for run in ("c360-1", "c360-2"):
        audit.run_audit(r.spark, run, "customer_360_refresh", path, work)
    return tables[-1], audit.latest_runs(audit.run_log(r.spark, path)).select(*AUDIT_COLUMNS)


def customer_360_refresh(r: History) -> DataFrame:
    rows = _refreshed_360(r)[0]
    scored = F.col("churn_score").between(0, 1)
    return rows.select("customer_id", "snapshot_date", "total_spend_30d", "order_count_30d", "top_category", "traits", F.coalesce(scored, F.lit(False)).alias("scored"))


def customer_360_runs(r: History) -> DataFrame:
    return _refreshed_360(r)[1]


def churn_model(r: History) -> DataFrame:
    """Fit on past snapshots, then score the present one inside the snapshot job."""
    history = stage(labelled_history(r.orders, r.customers, AS_OF_ORDERS), "labelled")
    model = train_churn(history)
    scored = customer_360(r.orders, r.order_items, r.customers, r.products, AS_OF_ORDERS, model)
    return scored.select("customer_id", F.col("churn_score").cast("double").alias("prediction"))

