"""Every query by name, as a function of the retail views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.semantics import order_asc
from millrace.operators import hierarchy
from millrace.operators import writes as wr
from millrace.operators.changes import as_of_read
from millrace.operators.keys import KeyMarks
from millrace.operators.sessions import sessionise
from millrace.operators.staging import scratch_path
from millrace.plans import cdc
from millrace.plans import clickstream as click
from millrace.plans import customer360 as c360
from millrace.plans import fileflows as flow
from millrace.plans import governance as gov
from millrace.plans import relational as rel
from millrace.plans import semistructured as semi
from millrace.plans import warehouse as dwh
from millrace.session import prepare
from millrace.sources.history import BRIDGE_DAY, EARLIER, History
from millrace.sources.retail import AS_OF_EVENTS, AS_OF_ORDERS, SESSION_GAP_S, ntz

Query = Callable[[History], DataFrame]
SNAPSHOT = AS_OF_ORDERS.date()
AS_OF_MIDDLE = datetime(1999, 6, 1)


def _calendar(r: History) -> DataFrame:
    # Two dates reach the driver; they size the calendar.
    first, last = r.orders.agg(F.min("order_ts"), F.max("order_ts")).first()
    days = (last.date() - first.date()).days + 1
    return rel.calendar_orders(rel.date_dim(r.spark, first.date(), days), r.orders)


def _sessions(r: History) -> DataFrame:
    return click.session_report(r.user_events, AS_OF_EVENTS, SESSION_GAP_S)


RELATIONAL: dict[str, Query] = {
    "active_customers": lambda r: rel.active_customers(r.customers, ["NATION_1", "NATION_2"]),
    "recent_customers": lambda r: rel.recent_customers(r.customers, AS_OF_ORDERS, months=72),
    "country_counts": lambda r: rel.country_counts(r.customers),
    "country_segments": lambda r: rel.country_segments(r.customers, AS_OF_ORDERS, large=50),
    "active_countries": lambda r: rel.active_countries(r.customers),
    "clv": lambda r: rel.clv(r.orders, r.order_items, r.customers, AS_OF_ORDERS),
    "monthly_funnel": lambda r: rel.monthly_funnel(r.orders, AS_OF_ORDERS),
    "top_skus": lambda r: rel.top_skus(r.orders, r.order_items),
    "dormant_customers": lambda r: rel.dormant_customers(r.customers, r.orders, AS_OF_ORDERS),
    "topn_recent": lambda r: rel.topn_recent(r.orders, AS_OF_ORDERS),
    "null_ordering": lambda r: rel.null_ordering(r.customers),
    "datediff_units": lambda r: rel.datediff_units(r.orders, AS_OF_ORDERS),
    "bool_aggs": lambda r: rel.bool_aggs(r.customers),
    "approx_channel": flow.approx_channel,
    "pivot_channel": lambda r: rel.pivot_channel(r.orders, AS_OF_ORDERS),
    "unpivot_spend": lambda r: rel.unpivot_spend(r.daily_channel_metrics, AS_OF_ORDERS),
    "sample_orders": lambda r: rel.sample_orders(r.orders, AS_OF_ORDERS),
    "date_dim": _calendar,
    "grouping_sets_revenue": lambda r: rel.grouping_sets_revenue(
        r.orders, r.order_items, r.customers, r.products, AS_OF_ORDERS
    ),
    "rollup_revenue": lambda r: rel.rollup_revenue(r.orders, r.order_items, r.customers, r.products, AS_OF_ORDERS),
    "cube_revenue": lambda r: rel.rollup_revenue(
        r.orders, r.order_items, r.customers, r.products, AS_OF_ORDERS, cube=True
    ),
    "category_tree": lambda r: hierarchy.category_tree(r.categories),
    "customer_lifetime": lambda r: rel.customer_lifetime(r.orders, r.customers),
    "country_summary": flow.country_summary,
    "top_countries": lambda r: rel.top_countries(
        rel.refresh_layers(r.orders, r.customers, scratch_path(r.spark, "layers"))[1]
    ),
    "name_distance": lambda r: rel.name_distance(r.customers),
}

EVENTS: dict[str, Query] = {
    "json_typed": lambda r: semi.typed_events(r.raw_events),
    "json_items": lambda r: semi.json_items(r.raw_events),
    "json_profiles": lambda r: semi.json_profiles(r.raw_events),
    "json_purchases": lambda r: semi.json_purchases(r.raw_events),
    "json_corrupt": lambda r: semi.json_corrupt(r.raw_events),
    "json_keys": lambda r: semi.json_keys(r.raw_events),
    "split_kv": lambda r: semi.raw_log_pairs(r.raw_events),
    "topk_carts": lambda r: semi.topk_carts(r.user_events, AS_OF_EVENTS),
    "order_payloads": lambda r: semi.order_payloads(r.order_items),
    "daily_user_metrics": lambda r: click.daily_user_metrics(r.user_events, AS_OF_EVENTS).drop("approx_unique_events"),
    "sessionise": lambda r: sessionise(
        r.user_events.select("event_id", "user_id", "event_ts"), "user_id", "event_ts", "event_id", SESSION_GAP_S
    ),
    "session_metrics": lambda r: _sessions(r).withColumn("median_lat", F.round("median_lat", 6))
    .withColumn("median_lon", F.round("median_lon", 6)),
    "session_p95": lambda r: click.session_p95(_sessions(r)),
    "enriched_events": lambda r: click.enriched_events(r.user_events, r.session_lookup),
    "state_path": lambda r: click.state_path(r.user_state_changes),
}

GOVERNANCE: dict[str, Query] = {
    "secure_customers": lambda r: gov.role_views(
        r.customers, r.role_country_map, ["ACCOUNTADMIN", "SECURITY_ADMIN", "PII_ADMIN", "R0"]
    ),
    "pii_projection": lambda r: gov.pii_projection(r.customers),
    "order_risk": lambda r: gov.order_risk(r.orders, r.customers, AS_OF_ORDERS, days=30),
    "customer_audit_log": flow.customer_audit_log,
}

NEW_CUSTOMERS = [
    ("Mira", "Okafor", "mira@mail.test", date(2023, 11, 2), "NG"),
    ("Jon", "Petit", "jon@mail.test", date(2024, 4, 18), "FR"),
    ("Sana", "Ito", "sana@mail.test", date(2024, 6, 30), "JP"),
]


def _insert(r: History) -> DataFrame:
    """Insert rows that name neither key nor activity into the customer table."""
    table = r.customers.select(
        "customer_id", "first_name", "last_name", "email", F.to_date("signup_ts").alias("signup_date"), "country", "is_active"
    )
    rows = r.spark.createDataFrame(
        NEW_CUSTOMERS, "first_name string, last_name string, email string, signup_date date, country string"
    )
    keyed = wr.assign_surrogate_keys(
        rows, [order_asc("signup_date"), order_asc("email")], "customer_id", dwh.next_key(table, "customer_id")
    )
    return table.unionByName(wr.apply_defaults(keyed, table.schema, {"is_active": F.lit(True)}))


def _blank(r: History) -> DataFrame:
    blank = F.col("email").isNull() | (F.trim("email") == "")
    return wr.delete_where(r.customers.select("customer_id", "email"), blank)


def _inactive(r: History) -> DataFrame:
    old = F.col("signup_ts") < rel.since(AS_OF_ORDERS, "3 years")
    return wr.update_where(r.customers, old, {"is_active": F.lit(False)}).select("customer_id", "is_active")


def _upsert(r: History) -> wr.MergeResult:
    return c360.upsert_360(r.c360_before, r.snapshot, AS_OF_ORDERS)


def _restore(r: History) -> DataFrame:
    """Bring rows of an earlier version back into the present table; the earlier one had no currency."""
    extra = r.orders.select("order_id", "channel", F.lit("EUR").alias("currency"))
    present = r.bronze_v2.join(extra, "order_id").select("order_id", "total_amount", "order_status", "channel", "currency")
    present = wr.with_defaults(present, {"currency": "'USD'"})
    columns = ["order_id", "total_amount", "order_status", "channel"]
    earlier = r.bronze_v1.join(extra, "order_id").select(*columns)
    restored = {c: F.col(f"s.{c}") for c in ["total_amount", "order_status"]}
    return wr.merge_into(
        present,
        earlier,
        ["order_id"],
        matched=[wr.Matched("update", None, restored)],
        not_matched=[wr.NotMatched({c: F.col(f"s.{c}") for c in columns})],
    ).rows


def _silver(r: History) -> DataFrame:
    return cdc.silver_merge(r.silver_before, r.feed, AS_OF_ORDERS).rows


def _gold(r: History) -> DataFrame:
    before = cdc.gold_rows(r.silver_before).withColumn("updated_at", ntz(EARLIER))
    return cdc.gold_merge(before, _silver(r), AS_OF_ORDERS, days=30).rows.drop("updated_at")


def _dim(r: History) -> DataFrame:
    scope = dwh.dim_scope(r.dim_source, r.feed, AS_OF_ORDERS)
    return dwh.scd2_merge(r.dim_before, r.dim_source, scope, AS_OF_ORDERS)[0]


def _fact(r: History) -> DataFrame:
    """The facts as stored by month, after the feed was merged into the months it touches."""
    root = scratch_path(r.spark, "facts")
    table = dwh.fact_table(r.fact_before, f"{root}/fact")
    marks = KeyMarks(r.spark, f"{root}/marks")
    marks.advance("fact", r.fact_before, "order_sk", "before")
    dwh.merge_facts(table, r.feed, r.order_items, _dim(r), AS_OF_ORDERS, marks, "run")
    return table.read()


WRITES: dict[str, Query] = {
    "values_insert": _insert,
    "update_inactive": _inactive,
    "delete_blank_email": _blank,
    "surrogate_keys": lambda r: wr.assign_surrogate_keys(
        r.customers, [order_asc("signup_ts"), order_asc("customer_id")], "customer_sk"
    ).select("customer_id", "customer_sk"),
    "merge_upsert": lambda r: _upsert(r).log.select(
        "customer_id", "snapshot_date", "total_spend_30d", "order_count_30d", F.col("_action").alias("action")
    ),
    "merge_counts": lambda r: _upsert(r).counts,
    "merge_restore": _restore,
    "change_feed": lambda r: r.feed.select("order_id", "action", "is_update", "order_status", "total_amount"),
    "cdc_silver_merge": lambda r: _silver(r).select("order_id", "order_status", "total_amount", "is_high_value", "is_deleted"),
    "cdc_gold_daily": _gold,
    "late_orders_alert": lambda r: cdc.late_orders(_silver(r), AS_OF_ORDERS),
}

WAREHOUSE: dict[str, Query] = {
    "scd2_customers": lambda r: _dim(r).drop("customer_sk", "attrs"),
    "fact_merge": lambda r: _fact(r).drop("payload_parts", "loaded_at"),
    "bridge_rebuild": lambda r: dwh.bridge_rebuild(r.bridge_before, _fact(r), r.order_items, r.products, BRIDGE_DAY),
    "orphan_rejects": lambda r: dwh.orphan_rejects(r.feed, _dim(r), "run").drop("run_id"),
    "vip_history": lambda r: dwh.vip_history(_dim(r)),
    "as_of_read": lambda r: as_of_read(_dim(r), ntz(AS_OF_MIDDLE)).select("customer_id", "segment", "valid_from", "valid_to"),
    "customer_360": lambda r: r.snapshot.drop("churn_score", "unique_sessions", "hll_sessions"),
    "top_category": lambda r: c360.top_category(r.orders, r.order_items, r.products, AS_OF_ORDERS),
    "campaign_join": lambda r: rel.campaign_join(r.snapshot, r.customers, r.campaign_attribution, SNAPSHOT, AS_OF_EVENTS),
    "hll_rollup": lambda r: c360.hll_rollup(c360.daily_sketches(r.orders), AS_OF_ORDERS),
}

FLOWS: dict[str, Query] = {
    name: getattr(flow, name)
    for name in [
        "load_json", "load_csv", "load_json_array", "load_manifest", "filename_date", "load_audit", "unload_parquet", "table_profile",
        "auto_ingest", "append_feed", "stream_silver", "stream_sessions", "all_stream_sessions", "rebuild_partitions", "rebuild_report",
        "run_audit", "dwh_refresh", "customer_360_refresh", "customer_360_runs", "channel_quantiles", "churn_model",
    ]
}

QUERIES: dict[str, Query] = {**RELATIONAL, **EVENTS, **GOVERNANCE, **WRITES, **WAREHOUSE, **FLOWS}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](History(prepare(spark), sf_dir))
