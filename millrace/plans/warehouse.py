"""Customer dimension with history, order facts, category bridge, rejects."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scoring import full_name
from millrace.functions.semantics import div0, init_cap, json_object, order_asc
from millrace.operators.changes import collapse_feed
from millrace.operators.hierarchy import walk
from millrace.operators.keys import KeyMarks
from millrace.operators.ordered import global_row_number
from millrace.operators.partitions import PartitionedTable
from millrace.operators.semi import path
from millrace.operators.staging import stage
from millrace.operators.writes import Matched, MergeResult, NotMatched, merge_into
from millrace.plans.relational import since
from millrace.plans.semistructured import order_payloads, whole_payload
from millrace.sources.retail import day, ntz

DIM_DATA = ["full_name", "email_hash", "country", "segment", "attrs"]
DIM_COLUMNS = ["customer_sk", "customer_id", *DIM_DATA, "valid_from", "valid_to", "is_current"]
COMPARED = ["email_hash", "country", "segment"]


def dim_source(customers: DataFrame) -> DataFrame:
    """Customers in the shape of the dimension; the address only as a hash."""
    vip = path(F.try_parse_json("attributes"), "$.vip", "boolean")
    return customers.select(
        "customer_id",
        full_name(init_cap("first_name"), init_cap("last_name")).alias("full_name"),
        F.sha2(F.lower("email"), 256).alias("email_hash"),
        "country",
        F.when(vip, "VIP").otherwise("STANDARD").alias("segment"),
        F.col("attributes").alias("attrs"),
        "signup_ts",
    )


def dim_scope(source: DataFrame, feed: DataFrame, run_ts: datetime, force_full: bool = False) -> DataFrame:
    """Recent sign-ups and customers in the change feed; everybody when forced."""
    if force_full:
        return source
    touched = feed.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    marked = source.join(touched.withColumn("_hit", F.lit(True)), "customer_id", "left")
    recent = F.col("signup_ts") >= since(run_ts, "1 day")
    return marked.where(recent | F.col("_hit").isNotNull()).drop("_hit")


def next_key(df: DataFrame, key: str) -> int:
    """One more than the largest key; a single number reaches the driver."""
    return (df.agg(F.max(key)).first()[0] or 0) + 1


def number_new_rows(
    kept: DataFrame, fresh: DataFrame, key: str, order: list[Column], seen: DataFrame | None = None, last_key: int = 0
) -> DataFrame:
    """``kept`` plus ``fresh`` rows under the next keys, in ``order``. ``kept`` is staged.

    Keys are not used again: they go on after the largest key of ``seen`` (``kept`` and
    deleted rows) and after ``last_key``, the largest that earlier runs gave out.
    """
    start = max(next_key(kept if seen is None else seen, key), last_key + 1)
    numbered = global_row_number(fresh.drop(key), order, key, start)
    return kept.unionByName(numbered)


def scd2_merge(
    dim: DataFrame, source: DataFrame, scope: DataFrame, run_ts: datetime, null_safe: bool = False, last_key: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(new dimension, log of the current versions). Changed customers are expired and get a new version.

    A change is a difference in e-mail hash, country or segment. With the default
    test a change from or to NULL is not seen, as in the source system;
    ``null_safe=True`` sees it. ``run_ts`` is one literal for the whole run.
    """
    now = ntz(run_ts)

    def differs(column: str) -> Column:
        t, s = F.col(f"t.{column}"), F.col(f"s.{column}")
        return ~t.eqNullSafe(s) if null_safe else t != s

    changed = differs(COMPARED[0]) | differs(COMPARED[1]) | differs(COMPARED[2])
    new_values = {c: F.col(f"s.{c}") for c in ["customer_id", *DIM_DATA]}
    # Closed versions never change, so only current ones go through the merge and its log.
    current = F.coalesce("is_current", F.lit(False))
    merged = merge_into(
        dim.where(current),
        scope,
        ["customer_id"],
        matched=[Matched("update", changed, {"valid_to": now, "is_current": F.lit(False)})],
        not_matched=[NotMatched({**new_values, "valid_from": now, "is_current": F.lit(True)})],
    )
    log = stage(merged.log, "dim-merge")
    expired = log.where((F.col("_action") == "update") & (F.col("valid_to") == now)).select("customer_id")
    versions = source.join(expired, "customer_id", "left_semi").select(
        F.lit("insert").alias("_action"),
        F.lit(None).cast(dim.schema["customer_sk"].dataType).alias("customer_sk"),
        "customer_id",
        *DIM_DATA,
        now.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    has_key = F.col("customer_sk").isNotNull()
    full_log = log.unionByName(versions)
    kept = log.where(has_key).select(*DIM_COLUMNS).unionByName(dim.where(~current).select(*DIM_COLUMNS))
    fresh = full_log.where(~has_key).select(*DIM_COLUMNS)
    order = [order_asc("customer_id"), order_asc("valid_from")]
    return number_new_rows(kept, fresh, "customer_sk", order, dim, last_key), full_log


def fact_source(feed: DataFrame, items: DataFrame, dim: DataFrame) -> DataFrame:
    """Feed rows of known customers, with amounts, line count and item payload.

    The payload holds every item of the order, put together from the parts of
    ``order_payloads``; ``payload_parts`` says how many there were.
    """
    # A feed is small next to the items, so items of other orders are dropped first.
    touched = feed.select("order_id").distinct()
    payloads = order_payloads(items.join(touched, "order_id", "left_semi"))
    sizes = payloads.groupBy("order_id").agg(
        F.max("line_count").alias("line_count"),
        F.collect_list(F.struct("part_no", "payload")).alias("parts"),
    )
    sizes = sizes.select("order_id", "line_count", whole_payload("parts").alias("payload"), F.size("parts").alias("payload_parts"))
    current = dim.where("is_current").select("customer_id", "customer_sk")
    gross = F.col("total_amount")

    def share(rate: str) -> Column:
        return (gross * F.lit(rate).cast("decimal(3,2)")).cast("decimal(14,2)")

    return (
        collapse_feed(feed)
        .join(current, "customer_id")
        .join(sizes, "order_id", "left")
        .select(
            "order_id",
            "action",
            "customer_sk",
            F.to_date("order_ts").alias("order_date"),
            "order_status",
            gross.cast("decimal(14,2)").alias("gross_amount"),
            share("0.08").alias("tax_amount"),
            share("0.92").alias("net_amount"),
            F.coalesce("line_count", F.lit(0)).cast("bigint").alias("line_count"),
            "payload",
            F.coalesce("payload_parts", F.lit(0)).cast("bigint").alias("payload_parts"),
        )
    )


FACT_DATA = [
    "customer_sk", "order_date", "order_status", "gross_amount", "tax_amount", "net_amount",
    "line_count", "payload", "payload_parts",
]


def fact_merge(fact: DataFrame, feed: DataFrame, items: DataFrame, dim: DataFrame, run_ts: datetime, last_key: int = 0) -> tuple[DataFrame, DataFrame]:
    """(new facts, change log). Deletes in the feed drop the fact row; keys up to ``last_key`` were given out before."""
    now = ntz(run_ts)
    values = {c: F.col(f"s.{c}") for c in FACT_DATA}
    merged: MergeResult = merge_into(
        fact,
        fact_source(feed, items, dim),
        ["order_id"],
        matched=[
            Matched("delete", F.col("s.action") == "DELETE"),
            Matched("update", None, {**values, "loaded_at": now}),
        ],
        not_matched=[
            NotMatched({"order_id": F.col("s.order_id"), **values, "loaded_at": now}, F.col("s.action") == "INSERT")
        ],
        # One feed row per order and one current dimension row per customer.
        source_is_unique=True,
    )
    log = stage(merged.log, "fact-merge")
    rows = log.where(F.col("_action") != "delete").drop("_action")
    has_key = F.col("order_sk").isNotNull()
    return number_new_rows(rows.where(has_key), rows.where(~has_key), "order_sk", [order_asc("order_id")], log, last_key), log


def fact_table(fact: DataFrame, path: str) -> PartitionedTable:
    """Facts stored by month of the order."""
    return PartitionedTable(fact.sparkSession, path, fact.schema, F.trunc("order_date", "month")).create(fact)


def merge_facts(
    table: PartitionedTable, feed: DataFrame, items: DataFrame, dim: DataFrame, run_ts: datetime, marks: KeyMarks, run_id: str
) -> DataFrame:
    """Merge a feed into the stored months it touches; the log holds those months' rows.

    ``feed`` is staged and has the old and the new rows of an update, so its dates name every
    month that can change. Other months are neither read nor written. New keys go on after the
    stored mark, which is advanced before the rows are published.
    """
    months = table.touched(feed.select(F.to_date("order_ts").alias("order_date")))
    rows, log = fact_merge(table.read(months), feed, items, dim, run_ts, marks.last("fact"))
    marks.advance("fact", rows, "order_sk", run_id)
    table.replace(rows, months)
    return log


def bridge_rebuild(bridge: DataFrame, fact: DataFrame, items: DataFrame, products: DataFrame, run_day: date) -> DataFrame:
    """Category revenue shares of one day's orders: delete, then insert.

    Item revenue is divided by the order's gross amount, so an order's shares need
    not add up to one.
    """
    of_day = fact.where(F.col("order_date") == day(run_day)).select("order_sk", "order_id", "gross_amount")
    kept = bridge.join(of_day.select("order_sk"), "order_sk", "left_anti")
    revenue = F.sum((F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"))
    shares = (
        of_day.join(items.select("order_id", "sku", "quantity", "unit_price"), "order_id")
        .join(products.select("sku", "category"), "sku")
        .groupBy("order_sk", "category", "gross_amount")
        .agg(revenue.alias("revenue"))
        .select("order_sk", "category", div0(F.col("revenue"), F.col("gross_amount")).cast("decimal(14,4)").alias("revenue_share"))
    )
    return kept.select("order_sk", "category", "revenue_share").unionByName(shares)


def orphan_rejects(feed: DataFrame, dim: DataFrame, run_id: str) -> DataFrame:
    """Inserted feed rows whose customer has no current dimension row."""
    current = dim.where("is_current").select("customer_id")
    return (
        feed.where(F.col("action") == "INSERT")
        .join(current, "customer_id", "left_anti")
        .select(
            F.lit(run_id).alias("run_id"),
            F.lit("ORPHAN_CUSTOMER").alias("reason"),
            json_object(order_id=F.col("order_id"), customer_id=F.col("customer_id")).alias("raw"),
        )
    )


def vip_history(dim: DataFrame, max_depth: int = 20) -> DataFrame:
    """Versions of each current VIP, followed back over touching validity intervals."""
    versions = dim.select("customer_id", "customer_sk", "segment", "valid_from", "valid_to")
    anchor = dim.where(F.col("is_current") & (F.col("segment") == "VIP")).select(
        "customer_id", "customer_sk", "segment", "valid_from", "valid_to", F.lit(1).alias("depth")
    )

    def step(level: DataFrame) -> DataFrame:
        later = level.where(F.col("depth") < max_depth).select(
            F.col("customer_id"), F.col("valid_from").alias("valid_to"), F.col("depth").alias("_depth")
        )
        return versions.join(later, ["customer_id", "valid_to"]).withColumn("depth", F.col("_depth") + 1)

    return walk(anchor, step, max_depth)
