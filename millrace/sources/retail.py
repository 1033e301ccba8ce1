"""Retail and clickstream views over the driver's test tables.

Every view is a lazy DataFrame built from declared schemas. ``checks/oracle.py``
states the same views in SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.sessions import sessionise

# "Now" of the fixtures: one day after the last order / the last event.
AS_OF_ORDERS = datetime(2001, 8, 2)
AS_OF_EVENTS = datetime(2024, 1, 31)
SESSION_GAP_S = 6 * 3600

# Fixed schemas of the test tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Fixed values of the fixtures.
STATUS = {"F": "COMPLETED", "P": "REFUNDED", "O": "PENDING"}
CHANNEL = {
    "1-URGENT": "WEB",
    "2-HIGH": "MOBILE",
    "3-MEDIUM": "RETAIL",
    "4-NOT SPECIFIED": "PARTNER",
    "5-LOW": "CALLCENTER",
}
CHANNELS = tuple(CHANNEL.values())
DEVICES = ("mobile", "desktop", "tablet")
UTM_SOURCES = ("google", "email", "social", "direct", None)
STATES = {"signup": "FREE", "click": "TRIAL", "purchase": "PAID"}


def ntz(at: datetime) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def day(on: date) -> Column:
    return F.lit(on.isoformat()).cast("date")


def _lookup(column: Column, table: dict[str, str]) -> Column:
    chain = None
    for key, value in table.items():
        chain = F.when(column == key, value) if chain is None else chain.when(column == key, value)
    return chain


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


class Retail:
    """The fixture views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        first, last = F.split_part("c_name", F.lit("#"), F.lit(1)), F.split_part("c_name", F.lit("#"), F.lit(2))
        email = (
            F.when(key % 97 == 1, F.lit(None))
            .when(key % 101 == 2, F.lit("  "))
            .otherwise(F.concat(F.lower(first), last, F.lit("@example.com")))
        )
        attributes = F.to_json(F.struct((F.col("c_acctbal") > 9000).alias("vip"), F.col("c_mktsegment").alias("segment")))
        signup = F.date_add(day(date(1994, 1, 1)), (key % 2700).cast("int"))
        nation = self.table("nation").select("n_nationkey", "n_name")
        return self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            first.alias("first_name"),
            last.alias("last_name"),
            email.alias("email"),
            signup.cast("timestamp_ntz").alias("signup_ts"),
            F.col("n_name").alias("country"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
            attributes.alias("attributes"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        status = F.when(F.col("o_orderkey") % 20 == 0, "CANCELLED").otherwise(_lookup(F.col("o_orderstatus"), STATUS))
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            status.alias("order_status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.lit("USD").alias("currency"),
            _lookup(F.col("o_orderpriority"), CHANNEL).alias("channel"),
            F.lpad(F.col("o_orderkey").cast("string"), 16, "0").alias("card_pan"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """(order_id, line_no) is not unique here."""
        # Half-up division of whole cents, free of floating point.
        unit_cents = F.expr(
            "(2 * cast(round(l_extendedprice * 100) as bigint) + cast(round(l_quantity) as bigint))"
            " div (2 * cast(round(l_quantity) as bigint))"
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
            F.col("l_quantity").cast("decimal(8,0)").alias("quantity"),
            (unit_cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(10,2)").alias("unit_price"),
            F.round(F.abs("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("list_price"),
            F.date_add(day(date(1995, 1, 1)), (F.col("p_partkey") % 365).cast("int")).alias("launched_on"),
        )

    @cached_property
    def user_events(self) -> DataFrame:
        eid, uid = F.col("event_id"), F.col("user_id")
        in_cart = F.col("event_type") == "purchase"
        items = F.transform(
            F.sequence(F.lit(1).cast("bigint"), eid % 3 + 1),
            lambda i: F.struct(
                F.concat(F.lit("P"), ((eid * 7 + i) % 1000).cast("string")).alias("product_id"),
                ((eid + i) % 5 + 1).alias("quantity"),
                F.struct(
                    ((eid * 37 + i * 11) % 20000 / 100.0).alias("value"), F.lit("USD").alias("currency")
                ).alias("price"),
            ),
        )
        event_type = F.when(in_cart, "CART_VIEWED").otherwise(F.col("event_type"))
        payload = F.struct(
            _pick(DEVICES, eid % 3).alias("device_type"),
            F.struct(_pick(UTM_SOURCES, eid % 5).alias("source")).alias("utm"),
            F.when(in_cart, F.struct(F.col("value").alias("total"))).alias("order"),
            event_type.alias("page"),
            F.when(in_cart, F.struct(items.alias("items"))).alias("cart"),
            F.struct(F.struct(F.concat(F.lit("C"), (uid % 7).cast("string")).alias("id")).alias("campaign")).alias("context"),
        )
        geo = F.struct(
            F.concat(F.lit("NATION_"), (uid % 25).cast("string")).alias("country"),
            ((uid % 180) - 90 + (eid % 100) / 100.0).alias("lat"),
            ((uid % 360) - 180 + (eid % 50) / 50.0).alias("lon"),
        )
        return self.table("events").select(
            eid,
            uid,
            F.col("ts").alias("event_ts"),
            event_type.alias("event_type"),
            F.to_json(payload).alias("payload"),
            F.to_json(geo).alias("geo"),
            F.to_date("ts").alias("ingestion_date"),
        )

    @cached_property
    def raw_events(self) -> DataFrame:
        eid, uid = F.col("event_id"), F.col("user_id")
        items = F.transform(
            F.sequence(F.lit(1).cast("bigint"), eid % 3 + 1),
            lambda i: F.struct(
                F.concat(F.lit("S"), ((eid + i) % 500).cast("string")).alias("sku"),
                ((eid + i) % 4 + 1).alias("qty"),
                ((eid * 13 + i * 7) % 10000 / 100.0).alias("price"),
            ),
        )
        kind = F.when(F.col("event_type") == "view", "page_view").otherwise(F.col("event_type"))
        order = F.struct(
            F.concat(F.lit("o-"), eid.cast("string")).alias("id"), F.col("value").alias("total"), items.alias("items")
        )
        raw_log = F.concat(F.lit("k="), eid.cast("string"), F.lit(", src = "), kind, F.lit(",bad,x=1=2"))
        payload = F.to_json(
            F.struct(
                kind.alias("type"),
                F.struct(
                    uid.alias("id"), F.concat(F.lit("NATION_"), (uid % 25).cast("string")).alias("country")
                ).alias("user"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
                F.when(kind == "purchase", order).alias("order"),
                raw_log.alias("raw_log"),
            )
        )
        text = F.when(eid % 50 == 0, F.lit('{"type": "broken')).otherwise(payload)
        return self.table("events").select(eid, F.col("ts").alias("received_ts"), text.alias("payload"))

    @cached_property
    def categories(self) -> DataFrame:
        def node(prefix: str, column: str) -> Column:
            return F.concat(F.lit(prefix), F.col(column).cast("string"))

        roots = self.table("region").select(
            node("R", "r_regionkey").alias("category_id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name")
        )
        middle = self.table("nation").select(
            node("N", "n_nationkey").alias("category_id"), node("R", "n_regionkey").alias("parent_id"), F.col("n_name").alias("name")
        )
        leaves = self.table("supplier").select(
            node("S", "s_suppkey").alias("category_id"), node("N", "s_nationkey").alias("parent_id"), F.col("s_name").alias("name")
        )
        return roots.unionByName(middle).unionByName(leaves)

    @cached_property
    def user_state_changes(self) -> DataFrame:
        return (
            self.table("events")
            .where(F.col("event_type").isin(*STATES))
            .select(
                F.col("user_id").alias("customer_id"),
                "event_id",
                F.col("ts").alias("event_ts"),
                _lookup(F.col("event_type"), STATES).alias("new_state"),
            )
        )

    @cached_property
    def session_lookup(self) -> DataFrame:
        """Session bounds with an address; every fifth session is missing."""
        events = self.table("events").select("event_id", "user_id", "ts")
        bounds = (
            sessionise(events, "user_id", "ts", "event_id", SESSION_GAP_S)
            .groupBy("user_id", "session_no")
            .agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"))
        )
        user = F.col("user_id").cast("string")
        return bounds.where(F.col("session_no") % 5 != 0).select(
            F.concat(user, F.lit("-"), F.col("session_no").cast("string")).alias("session_id"),
            "user_id",
            F.when(F.col("user_id") % 11 == 3, F.concat(F.lit("user"), user))
            .otherwise(F.concat(F.lit(" User"), user, F.lit("@Example.com ")))
            .alias("user_email"),
            "session_start",
            "session_end",
        )

    @cached_property
    def daily_channel_metrics(self) -> DataFrame:
        amount, channel = F.col("total_amount"), F.col("channel")

        def spend(name: str) -> Column:
            return F.sum(F.when(channel == name, amount)).cast("decimal(12,2)")

        per_day = (
            self.orders.groupBy(F.to_date("order_ts").alias("day"))
            .agg(
                spend("WEB").alias("web_spend"),
                spend("MOBILE").alias("mobile_spend"),
                spend("RETAIL").alias("retail_spend"),
                spend("PARTNER").alias("partner_spend"),
            )
        )
        hidden = F.unix_date("day") % 4 == 0
        return per_day.withColumn("retail_spend", F.when(~hidden, F.col("retail_spend")))

    @cached_property
    def campaign_attribution(self) -> DataFrame:
        return (
            self.table("events")
            .where(F.col("event_type") == "click")
            .select(
                F.col("user_id").alias("customer_id"),
                F.concat(F.lit("C"), (F.col("user_id") % 7).cast("string")).alias("campaign_id"),
                F.col("ts").alias("last_touch_ts"),
                F.col("value").cast("decimal(12,2)").alias("attribution_pct"),
            )
        )

    @cached_property
    def role_country_map(self) -> DataFrame:
        """R0..R2 see every third nation each; PII_ADMIN sees those of R1."""
        nations = self.table("nation")
        rest = F.col("n_nationkey") % 3
        own = nations.select(F.concat(F.lit("R"), rest.cast("string")).alias("role_name"), F.col("n_name").alias("country"))
        admin = nations.where(rest == 1).select(F.lit("PII_ADMIN").alias("role_name"), F.col("n_name").alias("country"))
        return own.unionByName(admin)

    def _bronze(self, orders: DataFrame) -> DataFrame:
        return orders.select("order_id", "customer_id", "order_ts", "order_status", "total_amount")

    @cached_property
    def bronze(self) -> DataFrame:
        """All orders in the shape of bronze."""
        return self._bronze(self.orders)

    @cached_property
    def bronze_v1(self) -> DataFrame:
        """Bronze before the change: a tenth of the orders has not arrived."""
        return self._bronze(self.orders.where(F.col("order_id") % 10 != 9))

    @cached_property
    def bronze_v2(self) -> DataFrame:
        """Bronze after it: late rows in, some rows gone, some amounts and customers changed."""
        changed = self.orders.where(F.col("order_id") % 50 != 0)
        amount = F.when(F.col("order_id") % 10 == 3, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
        customer = F.when(F.col("order_id") % 500 == 7, F.lit(-1).cast("bigint")).otherwise(F.col("customer_id"))
        return self._bronze(
            changed.withColumn("total_amount", amount.cast("decimal(12,2)")).withColumn("customer_id", customer)
        )
