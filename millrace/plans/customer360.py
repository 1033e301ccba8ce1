"""Thirty-day customer snapshot, its upsert, and sketches of distinct orders."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.semantics import json_object, order_asc, order_desc
from millrace.operators.ordered import qualify_topn
from millrace.operators.staging import stage
from millrace.operators.writes import Matched, MergeResult, NotMatched, merge_into
from millrace.plans.audit import Counts
from millrace.plans.model import score
from millrace.plans.relational import since
from millrace.sources.retail import day, ntz

MEASURES = [
    "total_spend_30d", "order_count_30d", "last_order_ts", "top_category", "churn_score", "traits",
    "unique_sessions", "hll_sessions",
]


def top_category(orders: DataFrame, items: DataFrame, products: DataFrame, upper: datetime, days: int = 30) -> DataFrame:
    """Most bought category per customer since ``days`` before ``upper``, with no upper bound."""
    recent = orders.where(F.col("order_ts") >= since(upper, f"{days} days")).select("order_id", "customer_id")
    bought = (
        recent.join(items.select("order_id", "sku", "quantity"), "order_id")
        .join(products.select("sku", "category"), "sku")
        .groupBy("customer_id", "category")
        .agg(F.sum("quantity").cast("decimal(18,0)").alias("qty"))
    )
    best = qualify_topn(bought, ["customer_id"], [order_desc("qty"), order_asc("category")], 1, "rn")
    return best.select("customer_id", "category", "qty")


def customer_360(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    upper: datetime,
    model: PipelineModel | None = None,
) -> DataFrame:
    """One row per customer with an order in the 30 days before ``upper``.

    ``upper`` is the day after the run date and also the snapshot date. Countries
    without any active customer are left out; inactive customers of the other
    countries stay in. ``churn_score`` needs a fitted model and is NULL without one.
    """
    window = orders.where((F.col("order_ts") >= since(upper, "30 days")) & (F.col("order_ts") < ntz(upper)))
    spend = window.groupBy("customer_id").agg(
        F.sum("total_amount").cast("decimal(18,2)").alias("total_spend_30d"),
        F.count(F.lit(1)).cast("int").alias("order_count_30d"),
        F.max("order_ts").alias("last_order_ts"),
        F.hll_sketch_agg(F.col("order_id").cast("string")).alias("hll_sessions"),
    )
    served = customers.where("is_active").select("country").distinct()
    who = customers.join(served, "country", "left_semi").select("customer_id", "country", "signup_ts")
    best = top_category(orders, items, products, upper).select("customer_id", F.col("category").alias("top_category"))
    snapshot = (
        spend.join(who, "customer_id")
        .join(best, "customer_id", "left")
        .withColumn("snapshot_date", day(upper.date()))
        .withColumn("traits", json_object(country=F.col("country"), tier=F.lit("gold")))
        .withColumn("unique_sessions", F.hll_sketch_estimate("hll_sessions"))
    )
    if model is None:
        scored = snapshot.withColumn("churn_score", F.lit(None).cast("decimal(5,4)"))
    else:
        scored = score(model, snapshot)
    return scored.select("customer_id", "snapshot_date", *MEASURES)


def upsert_360(target: DataFrame, snapshot: DataFrame, now: datetime, when: Column | None = None) -> MergeResult:
    """Upsert by (customer, snapshot date); ``when`` limits the updates."""
    keys = ["customer_id", "snapshot_date"]
    measures = {c: F.col(f"s.{c}") for c in snapshot.columns if c not in keys}
    return merge_into(
        target,
        snapshot,
        keys,
        matched=[Matched("update", when, {**measures, "updated_at": ntz(now)})],
        not_matched=[NotMatched({**{k: F.col(f"s.{k}") for k in keys}, **measures, "created_at": ntz(now)})],
        source_is_unique=True,
    )


def refresh_360(
    target: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    run_ts: datetime,
    counts: Counts,
    model: PipelineModel | None = None,
) -> DataFrame:
    """One run of the snapshot: build and score it, stage it, upsert what differs, and count; returns the new table.

    Rows that are in the table as they should be are left alone, time stamps included, so a
    second run of the same day changes nothing and counts no row.
    """
    snapshot = stage(customer_360(orders, items, customers, products, run_ts, model), "snapshot")
    keys = ["customer_id", "snapshot_date"]
    # A sketch has no unique form, so its estimate stands for it.
    compared = [c for c in snapshot.columns if c not in [*keys, "hll_sessions"]]
    differs = reduce(lambda a, b: a | b, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in compared])
    log = stage(upsert_360(target, snapshot, run_ts, differs).log, "snapshot-merge")
    done = {r["_action"]: r["count"] for r in log.groupBy("_action").count().collect()}
    counts.processed = snapshot.count()
    counts.inserted, counts.updated = done.get("insert", 0), done.get("update", 0)
    return log.drop("_action")


def daily_sketches(orders: DataFrame) -> DataFrame:
    """One sketch of order ids per customer and day."""
    return orders.groupBy("customer_id", F.to_date("order_ts").alias("snapshot_date")).agg(
        F.hll_sketch_agg(F.col("order_id").cast("string")).alias("hll_sessions")
    )


def hll_rollup(sketches: DataFrame, upper: datetime, days: int = 30) -> DataFrame:
    """Distinct orders per day from the union of the customers' sketches."""
    until = day(upper.date())
    return (
        sketches.where(F.col("snapshot_date").between(F.date_sub(until, days), until))
        .groupBy("snapshot_date")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("hll_sessions")).alias("distinct_sessions_total"))
    )
