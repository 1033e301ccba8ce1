"""Typed reads of JSON events: projections, item rows, profiles, carts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.semantics import json_object, order_asc, order_desc
from millrace.operators.ordered import Scan, ordered_scan
from millrace.operators.semi import array_size, flatten, object_entries, path, split_kv
from millrace.plans.relational import since


def parsed(raw: DataFrame) -> DataFrame:
    """JSON text to variant; text that does not parse becomes NULL.

    The variant comes out of a one-element generator: a filter on it is then not
    pushed below with a second copy of the parse, so each text is parsed once.
    """
    return raw.select("*", F.inline(F.array(F.struct(F.try_parse_json("payload").alias("v")))))


def typed_events(raw: DataFrame, types: tuple[str, ...] = ("purchase", "page_view")) -> DataFrame:
    v = F.col("v")
    kind = path(v, "$.type", "string")
    return (
        parsed(raw)
        .where(kind.isin(*types))
        .select(
            "event_id",
            kind.alias("event_type"),
            path(v, "$.user.id", "bigint").alias("user_id"),
            path(v, "$.user.country", "string").alias("country"),
            F.try_to_timestamp(path(v, "$.ts", "string")).cast("timestamp_ntz").alias("event_ts"),
            path(v, "$.order.total", "decimal(12,2)").alias("order_total"),
            array_size(v, "$.order.items").alias("item_count"),
        )
    )


def _purchase_items(raw: DataFrame) -> DataFrame:
    purchases = parsed(raw).where(path(F.col("v"), "$.type", "string") == "purchase")
    return flatten(purchases, "v", "$.order.items")


def _item(where: str, as_type: str):
    return path(F.col("item"), where, as_type)


def json_items(raw: DataFrame) -> DataFrame:
    """One row per purchased item with its line total."""
    price = _item("$.price", "decimal(10,2)")
    return _purchase_items(raw).select(
        "event_id",
        F.col("idx").alias("item_idx"),
        path(F.col("v"), "$.user.id", "bigint").alias("user_id"),
        _item("$.sku", "string").alias("sku"),
        _item("$.qty", "decimal(18,0)").alias("qty"),
        price.alias("unit_price"),
        (_item("$.qty", "decimal(18,0)") * price).cast("decimal(28,2)").alias("line_total"),
    )


def json_purchases(raw: DataFrame) -> DataFrame:
    """The typed view over raw purchases, one row per item."""
    v = F.col("v")
    return _purchase_items(raw).select(
        "event_id",
        "received_ts",
        path(v, "$.user.id", "bigint").alias("user_id"),
        path(v, "$.user.country", "string").alias("country"),
        path(v, "$.order.id", "string").alias("order_id"),
        path(v, "$.order.total", "decimal(12,2)").alias("order_total"),
        _item("$.sku", "string").alias("sku"),
        _item("$.qty", "decimal(18,0)").alias("qty"),
        _item("$.price", "decimal(10,2)").alias("unit_price"),
    )


def json_profiles(raw: DataFrame) -> DataFrame:
    """One profile object per user. The set of types is combined map-side, so it stays small."""
    v = F.col("v")
    events = parsed(raw).where(v.isNotNull())
    per_user = (
        events.select(
            path(v, "$.user.id", "bigint").alias("user_id"),
            path(v, "$.user.country", "string").alias("country"),
            path(v, "$.ts", "string").alias("ts"),
            path(v, "$.type", "string").alias("type"),
        )
        .groupBy("user_id")
        .agg(
            F.min("country").alias("country"),
            F.min("ts").alias("first_event"),
            F.max("ts").alias("last_event"),
            F.sort_array(F.collect_set("type")).alias("types"),
        )
    )
    profile = json_object(
        user_id=F.col("user_id").cast("string"),
        country=F.col("country"),
        first_event=F.col("first_event"),
        last_event=F.col("last_event"),
        types=F.col("types"),
    )
    return per_user.select(
        "user_id", "first_event", "last_event", F.array_join("types", ",").alias("types"), profile.alias("profile")
    )


def json_corrupt(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", F.try_parse_json("payload").isNull().alias("is_corrupt"))


def json_keys(raw: DataFrame) -> DataFrame:
    """One row per top-level key. Nested values come back as JSON text."""
    return object_entries(parsed(raw).select("event_id", "v"), "v", ["event_id"])


def raw_log_pairs(raw: DataFrame) -> DataFrame:
    logs = parsed(raw).select("event_id", path(F.col("v"), "$.raw_log", "string").alias("raw_log"))
    return split_kv(logs, "raw_log", ["event_id"])


def topk_carts(events: DataFrame, as_of: datetime, days: int = 7, min_price: str = "50.00", k: int = 5000) -> DataFrame:
    """Newest expensive cart items (a top-k report)."""
    recent = events.where((F.col("event_type") == "CART_VIEWED") & (F.col("event_ts") >= since(as_of, f"{days} days")))
    rows = flatten(recent.withColumn("v", F.try_parse_json("payload")), "v", "$.cart.items")
    price = _item("$.price.value", "decimal(12,2)")
    return (
        rows.where(price > F.lit(min_price).cast("decimal(12,2)"))
        .select(
            "event_id",
            "idx",
            "user_id",
            "event_ts",
            _item("$.product_id", "string").alias("product_id"),
            _item("$.quantity", "int").alias("quantity"),
            price.alias("price_value"),
            _item("$.price.currency", "string").alias("price_ccy"),
            path(F.col("v"), "$.context.campaign.id", "string").alias("campaign_id"),
        )
        .orderBy(order_desc("event_ts"), order_asc("event_id"), order_asc("idx"))
        .limit(k)
    )


def order_payloads(items: DataFrame, part_size: int = 10_000) -> DataFrame:
    """The items of each order as JSON arrays, in order of sku, quantity and price.

    Part ``part_no`` holds the items at positions ``part_no * part_size`` and following, for
    orders of every size. Equal items are counted before they are placed, so no task
    collects more than a part.
    """
    counted = items.groupBy("order_id", "sku", "quantity", "unit_price").agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col(c).asc_nulls_first() for c in ("sku", "quantity", "unit_price")]
    placed = ordered_scan(counted, ["order_id"], order, Scan(running_sums={"_upto": "copies"}))
    sizes = counted.groupBy("order_id").agg(F.sum("copies").alias("line_count"))
    size = F.lit(part_size).cast("bigint")
    first = F.col("_upto") - F.col("copies")
    parts = F.sequence(F.floor(first / size), F.floor((F.col("_upto") - 1) / size))
    runs = placed.select("*", F.explode(parts).alias("part_no"))
    begin = F.greatest(first, F.col("part_no") * size)
    n = F.least(F.col("_upto"), (F.col("part_no") + 1) * size) - begin
    entry = F.struct(F.col("sku"), F.col("quantity").cast("string").alias("qty"), F.col("unit_price").cast("string").alias("price"))
    element = F.struct(begin.alias("at"), F.array_repeat(entry, n.cast("int")).alias("e"))
    arrays = runs.groupBy("order_id", "part_no").agg(F.sort_array(F.collect_list(element)).alias("elements"))
    flat = F.flatten(F.transform("elements", lambda x: x["e"]))
    return arrays.join(sizes, "order_id").select("order_id", "part_no", "line_count", F.to_json(flat).alias("payload"))


def whole_payload(parts: str) -> Column:
    """One JSON array from a collected list of (part_no, payload)."""
    inner = F.transform(F.sort_array(parts), lambda x: F.substr(x["payload"], F.lit(2), F.length(x["payload"]) - 2))
    return F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]"))
