"""The run log, audited partition rebuilds, and the complete warehouse refresh.

The log is append-only: a run writes a STARTED row before it does anything and a final row when
it ends. ``latest_runs`` folds them to one row a run, so a run that was killed stays visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.semantics import json_object
from millrace.operators.keys import KeyMarks
from millrace.operators.partitions import balanced, drop_partitions
from millrace.operators.staging import stage
from millrace.plans import warehouse as dwh
from millrace.sources.retail import day

AUDIT_SCHEMA = (
    "run_id string, proc_name string, started_at timestamp_ntz, finished_at timestamp_ntz, status string,"
    " rows_processed bigint, rows_inserted bigint, rows_updated bigint, rows_rejected bigint, payload string"
)


STARTED = "STARTED"


@dataclass
class Counts:
    """Rows a run touched; filled in while it runs. ``status`` is what a run that raises nothing ends with."""

    processed: int = 0
    inserted: int = 0
    updated: int = 0
    rejected: int = 0
    extra: dict[str, str] = field(default_factory=dict)
    status: str = "OK"


def new_run_id() -> str:
    return str(uuid.uuid4())


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def audit_row(
    spark: SparkSession, run_id: str, proc: str, started: datetime, status: str, counts: Counts, error: str | None = None
) -> DataFrame:
    columns = [
        run_id, proc, started, None if status == STARTED else now(), status, counts.processed, counts.inserted, counts.updated, counts.rejected, None,
    ]
    row = spark.createDataFrame([tuple(columns)], AUDIT_SCHEMA)
    if error is not None:
        payload = json_object(error=F.lit(error))
    else:
        names = ["run_id", "rows_processed", "rows_inserted", "rows_updated", "rows_rejected"]
        payload = json_object(
            **{c: F.col(c) for c in names}, **{k: F.lit(v) for k, v in counts.extra.items()}
        )
    return row.withColumn("payload", payload)


def run_audit(spark: SparkSession, run_id: str | None, proc: str, audit_path: str, work: Callable[[Counts], None]) -> str:
    """Log a start, run ``work``, and log its counts, or the error it raised, which is raised again.

    Rows are appended to the Parquet table at ``audit_path``. Without a ``run_id`` the run gets a
    UUID, which is returned.
    """
    run_id = run_id or new_run_id()
    started, counts = now(), Counts()

    def log(status: str, error: str | None = None) -> None:
        audit_row(spark, run_id, proc, started, status, counts, error).coalesce(1).write.mode("append").parquet(audit_path)

    log(STARTED)
    try:
        work(counts)
    except Exception as e:
        log("ERROR", str(e))
        raise
    log(counts.status)
    return run_id


def run_log(spark: SparkSession, audit_path: str) -> DataFrame:
    """Every row of the log."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)


def latest_runs(log: DataFrame) -> DataFrame:
    """The latest row of each run and procedure: its final row, or STARTED while there is none."""
    keys = ["run_id", "proc_name"]
    rest = [c for c in log.columns if c not in keys]
    order = F.struct("started_at", F.col("finished_at").isNotNull(), "finished_at")
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("last")).select(*keys, "last.*")


def action_counts(log: DataFrame) -> dict[str, int]:
    """Rows per merge action; one number per kind of action reaches the driver."""
    return {r["_action"]: r["count"] for r in log.groupBy("_action").count().collect()}


def rebuild_partitions(
    source: DataFrame,
    path: str,
    date_col: str,
    start: date,
    end: date,
    dry_run: bool = False,
    keep_outside: bool = True,
    max_records: int = 2_000_000,
) -> dict[str, object]:
    """Write the source rows of a date range over the table partitioned by ``date_col`` at ``path``.

    All dates are written in one job by a dynamic partition overwrite, which leaves
    other dates alone and replaces partitions only when the whole job succeeds. Dates
    of the range that have no source row any more are then removed. With
    ``keep_outside=False`` the table keeps nothing but the range, as the source
    system's swap does.
    """
    chosen = source.where(F.col(date_col).between(day(start), day(end)))
    report: dict[str, object] = {"status": "OK", "dry_run": dry_run, "partitions": (end - start).days + 1, "errors": 0}
    if dry_run:
        return report
    writer = balanced(chosen, [date_col]).write.option("maxRecordsPerFile", max_records).mode("overwrite").partitionBy(date_col)
    if not keep_outside:
        writer.parquet(path)
        return report
    # At most one value per day of the range reaches the driver.
    in_range = F.col(date_col).between(day(start), day(end))
    present = source.sparkSession.read.parquet(path).where(in_range).select(date_col).distinct()
    emptied = present.join(chosen.select(date_col).distinct(), date_col, "left_anti").collect()
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    drop_partitions(source.sparkSession, path, date_col, [row[date_col] for row in emptied])
    return report


def rebuild_checked(
    source: DataFrame,
    path: str,
    date_col: str,
    start: date,
    end: date,
    rules: dict[str, Column],
    counts: Counts,
    dry_run: bool = False,
    max_records: int = 2_000_000,
) -> DataFrame:
    """Rebuild the dates of a range that pass validation; returns the report, one row a date of the range.

    Rows are checked against ``rules`` (name to a condition that must be true) and staged. The
    dates whose rows all pass are published in one job; a date with a bad row keeps the rows it
    has, as does every date under ``dry_run``. A date without source rows is clean and empty.
    ``counts`` gets the rows published and refused, and the status: OK, PARTIAL_FAILURE when
    some dates were refused, ERROR when all were.
    """
    spark = source.sparkSession
    error = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()], F.lit(None).cast("string"))
    chosen = source.where(F.col(date_col).between(day(start), day(end))).withColumn("_error", error)
    staged = stage(balanced(chosen, [date_col]), "rebuild")
    days = spark.range((end - start).days + 1).select(F.date_add(day(start), F.col("id").cast("int")).alias(date_col))
    checked = staged.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("_error").alias("error_count"), F.min("_error").alias("first_error")
    )
    filled = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ["row_count", "error_count"]}
    clean = (F.col("error_count") == 0) & F.lit(not dry_run)
    report = days.join(checked, date_col, "left").select(date_col, *filled.values(), "first_error").withColumn("published", clean)
    report = stage(report, "rebuild-report")
    rows = report.collect()  # one row a date of the range
    bad = [r for r in rows if r["error_count"]]
    counts.processed = sum(r["row_count"] for r in rows)
    counts.inserted = sum(r["row_count"] for r in rows if r["published"])
    counts.rejected = sum(r["error_count"] for r in rows)
    counts.extra |= {"partitions": str(len(rows)), "errors": str(len(bad)), "dry_run": str(dry_run).lower()}
    counts.status = "OK" if not bad else "PARTIAL_FAILURE" if len(bad) < len(rows) else "ERROR"
    if dry_run:
        return report
    published = [r[date_col] for r in rows if r["published"]]
    good = staged.where(F.col(date_col).isin([r[date_col] for r in rows if r["published"] and r["row_count"]])).drop("_error")
    if any(r["published"] and r["row_count"] for r in rows):
        writer = balanced(good, [date_col]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("maxRecordsPerFile", max_records).partitionBy(date_col).parquet(path)
    with_rows = {r[date_col] for r in rows if r["row_count"]}
    drop_partitions(spark, path, date_col, [d for d in published if d not in with_rows])
    return report


@dataclass(frozen=True)
class Warehouse:
    """The tables a refresh reads and, in new versions, returns."""

    dim: DataFrame
    fact: DataFrame
    bridge: DataFrame


def refresh_dwh(
    state: Warehouse,
    feed: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    run_ts: datetime,
    run_day: date,
    run_id: str,
    counts: Counts,
    marks: KeyMarks,
    force_full: bool = False,
) -> tuple[Warehouse, DataFrame, DataFrame]:
    """(new tables, rejected rows, VIP history). ``feed`` is staged: three steps read it.

    Keys go on after the stored ``marks``, which are advanced before anything reads the new rows:
    a key of a row that is deleted later is not given out again.
    """
    source = dwh.dim_source(customers)
    scope = dwh.dim_scope(source, feed, run_ts, force_full)
    dim, dim_log = dwh.scd2_merge(state.dim, source, scope, run_ts, last_key=marks.last("dim"))
    dim = stage(dim, "dim")
    marks.advance("dim", dim, "customer_sk", run_id)
    changed = action_counts(dim_log)
    counts.updated = changed.get("update", 0)
    counts.inserted = changed.get("insert", 0)

    fact, fact_log = dwh.fact_merge(state.fact, feed, items, dim, run_ts, marks.last("fact"))
    fact = stage(fact, "fact")
    marks.advance("fact", fact, "order_sk", run_id)
    touched = action_counts(fact_log)
    counts.processed = sum(n for action, n in touched.items() if action != "keep")

    bridge = stage(dwh.bridge_rebuild(state.bridge, fact, items, products, run_day), "bridge")
    rejects = stage(dwh.orphan_rejects(feed, dim, run_id), "rejects")
    counts.rejected = rejects.count()
    counts.extra["force_full"] = str(force_full).lower()
    return Warehouse(dim, fact, bridge), rejects, dwh.vip_history(dim)
