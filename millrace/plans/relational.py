"""Customer, order and revenue reports. ``as_of`` stands for "now" throughout."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.scoring import full_name
from millrace.functions.semantics import (
    DATEDIFF_UNITS,
    datediff_boundary,
    div0,
    dow0,
    init_cap,
    months_of_tenure,
    order_asc,
    order_desc,
    trunc_to_date,
)
from millrace.operators.ordered import global_row_number, qualify_topn
from millrace.operators.staging import stage
from millrace.sources.retail import CHANNELS, day, ntz


def since(as_of: datetime, interval: str) -> Column:
    """``as_of`` moved back by an interval such as ``2 years``."""
    return ntz(as_of) - F.expr(f"interval {interval}")


def active_customers(customers: DataFrame, countries: list[str], limit: int = 100) -> DataFrame:
    """Newest active customers of some countries (a top-k report)."""
    return (
        customers.where(F.col("is_active") & F.col("country").isin(*countries))
        .orderBy(order_desc("signup_ts"), order_asc("customer_id"))
        .limit(limit)
        .select(
            "customer_id",
            full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
            "email",
            F.to_date("signup_ts").alias("signup_date"),
        )
    )


def recent_customers(customers: DataFrame, as_of: datetime, months: int = 6, like: str = "%@example.com") -> DataFrame:
    return customers.where(
        F.col("is_active") & (F.col("signup_ts") >= since(as_of, f"{months} months")) & F.col("email").ilike(like)
    ).select(
        "customer_id",
        full_name(init_cap("first_name"), init_cap("last_name")).alias("full_name"),
        F.lower("email").alias("email"),
        "country",
        F.to_date("signup_ts").alias("signup_date"),
    )


def country_counts(customers: DataFrame) -> DataFrame:
    return customers.groupBy("country").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.min(F.to_date("signup_ts")).alias("first_signup"),
        F.max(F.to_date("signup_ts")).alias("last_signup"),
    )


def country_segments(customers: DataFrame, as_of: datetime, large: int = 100) -> DataFrame:
    tenure = F.avg(datediff_boundary("day", "signup_ts", ntz(as_of)))
    return (
        customers.groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.count_if("is_active").alias("active_count"),
            F.round(F.coalesce(tenure, F.lit(0.0)), 6).alias("avg_tenure_days"),
        )
        .where(F.col("customer_count") > 0)
        .withColumn("segment_size", F.when(F.col("customer_count") > large, "large").otherwise("small"))
    )


def active_countries(customers: DataFrame) -> DataFrame:
    return customers.where("is_active").select("country").distinct()


def order_facts(orders: DataFrame, items: DataFrame, as_of: datetime, years: int = 2) -> DataFrame:
    """One row per order that counts: net amount, quantity, distinct SKUs.

    Orders are filtered before the join, so items of other orders are dropped at the
    join. Rows are combined per (order, sku) and then per order, which counts the
    SKUs without expanding rows for DISTINCT.
    """
    wanted = orders.where(
        ~F.col("order_status").isin("CANCELLED", "FAILED", "RETURNED") & (F.col("order_ts") >= since(as_of, f"{years} years"))
    ).select("customer_id", "order_id", F.to_date("order_ts").alias("order_date"), "channel")
    kept = (100 - F.col("discount_pct")) * F.lit("0.01").cast("decimal(2,2)")
    amount = (F.col("quantity") * F.col("unit_price") * kept).cast("decimal(24,6)")
    order = ["order_id", "customer_id", "order_date", "channel"]
    lines = wanted.join(items.select("order_id", "sku", "quantity", amount.alias("amount")), "order_id")
    per_sku = lines.groupBy(*order, "sku").agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("qty"))
    return per_sku.groupBy(*order).agg(
        F.sum("amount").cast("decimal(24,6)").alias("order_total"),
        F.sum("qty").cast("decimal(18,0)").alias("total_qty"),
        F.count("sku").alias("distinct_skus"),
    )


def clv(orders: DataFrame, items: DataFrame, customers: DataFrame, as_of: datetime, first_n: int = 50) -> DataFrame:
    """Running lifetime value over each customer's first ``first_n`` orders.

    Rows beyond the first n influence nothing that is reported, so each customer is
    cut to n rows map-side first; the running windows then see at most n rows a key.
    """
    order = [order_asc("order_date"), order_asc("order_id")]
    facts = qualify_topn(order_facts(orders, items, as_of), ["customer_id"], order, first_n, "order_seq")
    window = Window.partitionBy("customer_id").orderBy(*order)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = facts.select(
        "*",
        F.sum("order_total").over(running).cast("decimal(28,6)").alias("running_ltv"),
        F.lag("order_date", 1).over(window).alias("prev_order_date"),
        F.first("channel").over(whole).alias("acquisition_channel"),
    )
    who = customers.select(
        "customer_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        months_of_tenure(ntz(as_of).cast("timestamp"), F.col("signup_ts").cast("timestamp")).alias("tenure_months"),
    )
    unit = div0(F.col("order_total"), F.nullifzero(F.col("total_qty")))
    return ranked.join(who, "customer_id").select(
        "customer_id",
        "order_seq",
        "customer_name",
        "order_date",
        "order_total",
        "running_ltv",
        datediff_boundary("day", "prev_order_date", "order_date").alias("days_since_prev"),
        F.coalesce("distinct_skus", F.lit(0)).cast("bigint").alias("distinct_skus"),
        unit.cast("decimal(24,6)").alias("avg_unit_price"),
        F.zeroifnull(F.col("total_qty")).cast("decimal(18,0)").alias("qty_safe"),
        "acquisition_channel",
        "tenure_months",
    )


def monthly_funnel(orders: DataFrame, as_of: datetime, months: int = 12) -> DataFrame:
    start = F.add_months(trunc_to_date("month", ntz(as_of)), -months)
    completed = F.col("order_status") == "COMPLETED"

    def revenue(status: str) -> Column:
        zero = F.lit("0").cast("decimal(12,2)")
        return F.sum(F.when(F.col("order_status") == status, F.col("total_amount")).otherwise(zero)).cast("decimal(18,2)")

    # Counting per customer first keeps COUNT(DISTINCT customer) exact with two
    # map-side combined aggregates.
    per_customer = (
        orders.where(F.col("order_ts") >= start.cast("timestamp_ntz"))
        .groupBy(trunc_to_date("month", "order_ts").alias("month_start"), "customer_id")
        .agg(
            revenue("COMPLETED").alias("rev_completed"),
            revenue("REFUNDED").alias("rev_refunded"),
            F.count_if(completed).alias("orders_completed"),
        )
    )
    monthly = per_customer.groupBy("month_start").agg(
        F.sum("rev_completed").cast("decimal(18,2)").alias("rev_completed"),
        F.sum("rev_refunded").cast("decimal(18,2)").alias("rev_refunded"),
        F.sum("orders_completed").alias("orders_completed"),
        F.count("customer_id").alias("active_customers"),
    )
    average = div0(F.col("rev_completed"), F.col("orders_completed"))
    return monthly.withColumn("avg_order_value", F.round(average.cast("double"), 6))


def top_skus(orders: DataFrame, items: DataFrame, n: int = 5) -> DataFrame:
    """Comma-separated best SKUs per customer, by quantity."""
    bought = (
        orders.select("order_id", "customer_id")
        .join(items.select("order_id", "sku", "quantity"), "order_id")
        .groupBy("customer_id", "sku")
        .agg(F.sum("quantity").alias("total_qty"))
    )
    best = qualify_topn(bought, ["customer_id"], [order_desc("total_qty"), order_asc("sku")], n, "rn")
    ordered = F.array_sort(F.collect_list(F.struct("rn", "sku")))
    return best.groupBy("customer_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["sku"]), ", ").alias("top_skus")
    )


def dormant_customers(customers: DataFrame, orders: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    recent = orders.where(F.col("order_ts") >= since(as_of, f"{days} days")).select("customer_id")
    return customers.join(recent, "customer_id", "left_anti").select("customer_id", "first_name", "last_name", "country")


def topn_recent(orders: DataFrame, as_of: datetime, n: int = 3) -> DataFrame:
    recent = orders.where(F.col("order_ts") >= since(as_of, "1 year")).select(
        "customer_id", "order_id", "order_ts", "total_amount"
    )
    return qualify_topn(recent, ["customer_id"], [order_desc("order_ts"), order_asc("order_id")], n, "recency_rank")


def null_ordering(customers: DataFrame) -> DataFrame:
    """Position of every customer by e-mail under the source's null order."""
    rows = customers.select("customer_id", "email")
    return global_row_number(rows, [order_asc("email"), order_asc("customer_id")], "ord")


def datediff_units(orders: DataFrame, as_of: datetime) -> DataFrame:
    """Boundaries crossed between each order and ``as_of``, one row per unit."""
    pairs = [
        F.struct(F.lit(unit).alias("unit"), datediff_boundary(unit, "order_ts", ntz(as_of)).alias("diff"))
        for unit in DATEDIFF_UNITS
    ]
    return orders.select("order_id", F.explode(F.array(*pairs)).alias("d")).select("order_id", "d.unit", "d.diff")


def bool_aggs(customers: DataFrame) -> DataFrame:
    return customers.groupBy("country").agg(
        F.bool_and("is_active").alias("all_active"),
        F.bool_or("is_active").alias("any_active"),
        F.sum(F.nvl2(F.col("email"), F.lit(1), F.lit(0))).cast("bigint").alias("nvl2_email"),
    )


def approx_channel(orders: DataFrame) -> DataFrame:
    return orders.groupBy("channel").agg(
        F.approx_count_distinct("customer_id", 0.02).alias("approx_customers"),
        F.approx_percentile("total_amount", 0.5, 10_000).alias("approx_median"),
        F.approx_percentile("total_amount", 0.95, 10_000).alias("approx_p95"),
    )


def quantile_sketches(orders: DataFrame) -> DataFrame:
    """One mergeable quantile sketch of the amounts per channel and day, to be stored."""
    return orders.groupBy("channel", F.to_date("order_ts").alias("order_date")).agg(
        F.kll_sketch_agg_double(F.col("total_amount").cast("double"), F.lit(SKETCH_SIZE)).alias("amounts")
    )


SKETCH_SIZE = 400  # ranks within 0.7 % or so


def channel_quantiles(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Amounts at some ranks per channel, from the union of its days' sketches; the orders are not read again."""
    merged = sketches.groupBy("channel").agg(F.kll_merge_agg_double("amounts").alias("amounts"))
    found = [F.kll_sketch_get_quantile_double("amounts", F.lit(p)).alias(name) for name, p in quantiles.items()]
    return merged.select("channel", F.kll_sketch_get_n_double("amounts").alias("amount_count"), *found)


def close_in_rank(rows: DataFrame, estimates: DataFrame, key: str, value: str, quantiles: dict[str, float], error: float) -> DataFrame:
    """Per key, whether each estimated quantile lies within ``error`` of its rank. Ties count on both sides."""
    met = rows.where(F.col(value).isNotNull()).select(key, value).join(estimates.select(key, *quantiles), key)
    tests = [
        (
            (F.count_if(F.col(value) < F.col(name)) <= (p + error) * F.count(F.lit(1)))
            & (F.count_if(F.col(value) <= F.col(name)) >= (p - error) * F.count(F.lit(1)))
        ).alias(f"{name}_close")
        for name, p in quantiles.items()
    ]
    return met.groupBy(key).agg(*tests)


def pivot_channel(orders: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    recent = orders.where(F.col("order_ts") >= since(as_of, f"{days} days"))
    wide = recent.groupBy(F.to_date("order_ts").alias("order_date")).pivot("channel", list(CHANNELS)).sum("total_amount")
    return wide.select("order_date", *[F.col(c).cast("decimal(18,2)").alias(c) for c in CHANNELS])


def unpivot_spend(metrics: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Wide spend columns to rows; empty cells give no row."""
    recent = metrics.where(F.col("day") >= F.date_sub(day(as_of.date()), days))
    spend = ["web_spend", "mobile_spend", "retail_spend", "partner_spend"]
    return recent.unpivot(["day"], spend, "channel", "spend").where(F.col("spend").isNotNull())


def sample_orders(orders: DataFrame, as_of: datetime, fraction: float = 0.05, seed: int = 7) -> DataFrame:
    """A share of the recent orders, drawn by a hash of the order and a seed, so reruns and other layouts agree."""
    recent = orders.where(F.col("order_ts") >= since(as_of, "3 months"))
    drawn = F.left(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("order_id").cast("string"))), F.lit(8))
    return recent.where(drawn < f"{int(fraction * 2**32):08x}").select("customer_id", "total_amount")


def date_dim(spark: SparkSession, start: date, days: int) -> DataFrame:
    """One row per calendar day."""
    d = F.date_add(day(start), F.col("id").cast("int"))
    return spark.range(days).select(d.alias("d_date")).select(
        "d_date",
        F.year("d_date").alias("d_year"),
        F.quarter("d_date").alias("d_quarter"),
        F.month("d_date").alias("d_month"),
        dow0("d_date").alias("d_dow"),
    )


def calendar_orders(calendar: DataFrame, orders: DataFrame) -> DataFrame:
    """Calendar days with the number of orders placed on each."""
    per_day = orders.groupBy(F.to_date("order_ts").alias("d_date")).agg(F.count(F.lit(1)).alias("order_count"))
    return calendar.join(per_day, "d_date", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)).cast("bigint"))


def _order_lines(orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, as_of: datetime) -> DataFrame:
    """Gross revenue per (order, category) of the last year, with its country and quarter."""
    recent = orders.where(F.col("order_ts") >= since(as_of, "1 year")).select(
        "order_id", "customer_id", trunc_to_date("quarter", "order_ts").alias("quarter")
    )
    gross = (F.col("quantity") * F.col("unit_price")).cast("decimal(20,2)")
    per_sku = (
        recent.join(items.select("order_id", "sku", gross.alias("gross")), "order_id")
        .join(products.select("sku", "category"), "sku")
        .groupBy("order_id", "customer_id", "quarter", "category")
        .agg(F.sum("gross").cast("decimal(24,2)").alias("gross"))
    )
    return per_sku.join(customers.select("customer_id", "country"), "customer_id")


def grouping_sets_revenue(
    orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, as_of: datetime
) -> DataFrame:
    """Revenue over five grouping sets, with distinct counts and each row's share of its quarter.

    An order has one customer, one country and one quarter, so DISTINCT counts are
    taken by nesting: rows are expanded once over the five sets, combined per
    (set, customer, order), then per (set, customer), then per set.

    The share's denominator holds the subtotal rows of the quarter too, so a quarter
    total shows a quarter of it; that is the report's definition. A NULL country
    prints as the subtotal mark; ``grp_id`` tells them apart.
    """
    lines = _order_lines(orders, items, customers, products, as_of)
    unit = ["customer_id", "order_id"]
    sets = [
        ["country", "category", "quarter", *unit],
        ["country", "quarter", *unit],
        ["category", "quarter", *unit],
        ["quarter", *unit],
        unit,
    ]
    group_id = F.grouping("country").cast("int") * 2 + F.grouping("category").cast("int")
    key = ["country", "category", "quarter", "grp_id", "no_quarter"]
    per_order = lines.groupingSets([[F.col(c) for c in s] for s in sets], "country", "category", "quarter", *unit).agg(
        group_id.alias("grp_id"), F.grouping("quarter").alias("no_quarter"), F.sum("gross").alias("gross")
    )
    per_customer = per_order.groupBy(*key, "customer_id").agg(F.sum("gross").alias("gross"), F.count(F.lit(1)).alias("orders"))
    total = per_customer.groupBy(*key).agg(
        F.sum("gross").cast("decimal(24,2)").alias("gross_revenue"),
        F.sum("orders").alias("order_count"),
        F.count(F.lit(1)).alias("customer_count"),
    )
    # The result of the aggregation is small: countries x categories x quarters.
    share = F.try_divide(
        F.col("gross_revenue").cast("double"),
        F.sum("gross_revenue").over(Window.partitionBy("quarter")).cast("double"),
    )
    average = F.try_divide(F.col("gross_revenue"), F.nullif(F.col("order_count"), F.lit(0)))
    return total.select(
        F.coalesce("country", F.lit("∑")).alias("country"),
        F.coalesce("category", F.lit("∑")).alias("category"),
        F.col("quarter").alias("quarter_start"),
        "grp_id",
        "gross_revenue",
        "order_count",
        "customer_count",
        F.round(average.cast("double"), 6).alias("avg_order_value"),
        F.round(share, 6).alias("pct_of_quarter"),
    )


def rollup_revenue(
    orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, as_of: datetime, cube: bool = False
) -> DataFrame:
    lines = _order_lines(orders, items, customers, products, as_of)
    grouped = lines.cube("country", "category") if cube else lines.rollup("country", "category")
    group_id = F.grouping("country").cast("int") * 2 + F.grouping("category").cast("int")
    return grouped.agg(group_id.alias("grp_id"), F.sum("gross").cast("decimal(24,2)").alias("gross_revenue")).select(
        "country", "category", "grp_id", "gross_revenue"
    )


def customer_lifetime(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Layer 1: one row per customer. Orders are combined before the join."""
    per_customer = (
        orders.where(F.col("order_status") == "COMPLETED")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("lifetime_orders"),
            F.sum("total_amount").cast("decimal(18,2)").alias("lifetime_revenue"),
            F.min("order_ts").alias("first_order_ts"),
            F.max("order_ts").alias("last_order_ts"),
        )
    )
    return per_customer.join(customers.select("customer_id", "country"), "customer_id").withColumn(
        "active_span_days", datediff_boundary("day", "first_order_ts", "last_order_ts")
    )


def country_summary(lifetime: DataFrame) -> DataFrame:
    """Layer 2: one row per country over layer 1."""
    return lifetime.groupBy("country").agg(
        F.sum("lifetime_revenue").cast("decimal(22,2)").alias("country_revenue"),
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg("lifetime_revenue").cast("double"), 4).alias("arpu"),
        F.approx_percentile("lifetime_revenue", 0.95, 10_000).alias("p95_revenue"),
    )


def refresh_layers(orders: DataFrame, customers: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Rewrite both stored layers below ``root``; layer 2 reads the stored layer 1."""
    spark = orders.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    lifetime = stored(customer_lifetime(orders, customers), "customer_lifetime")
    return lifetime, stored(country_summary(lifetime), "country_summary")


def top_countries(summary: DataFrame, n: int = 25) -> DataFrame:
    """Countries by revenue; ranks tie. The window sees one row per country."""
    ranked = summary.select(
        "country",
        "country_revenue",
        "customers",
        "arpu",
        F.rank().over(Window.orderBy(order_desc("country_revenue"))).cast("bigint").alias("revenue_rank"),
    )
    return ranked.where(F.col("revenue_rank") <= n)


def campaign_join(snapshot: DataFrame, customers: DataFrame, attribution: DataFrame, snapshot_date: date, as_of: datetime) -> DataFrame:
    """Touches of the last seven days for customers in one day's snapshot."""
    chosen = snapshot.where(F.col("snapshot_date") == day(snapshot_date)).select("customer_id")
    touched = attribution.where(F.col("last_touch_ts") >= since(as_of, "7 days"))
    return (
        touched.join(chosen, "customer_id", "left_semi")
        .join(customers.select("customer_id", "email"), "customer_id")
        .select("customer_id", "email", "campaign_id", "last_touch_ts", "attribution_pct")
    )


def name_distance(customers: DataFrame, max_distance: int = 2) -> DataFrame:
    """Customers of one country whose names are within two edits of each other.

    Blocked by country, first name and length of the last name, but never joined on the
    block itself. Copies of a name are first folded into their smallest id and reported as
    (copy, that id, 0). What all last names of a block begin and end with is cut off, which
    changes no distance. Two equally long names are within two edits if

    * they differ at one or two places: they meet where these are left out, and only there; or
    * they become equal when each loses one character, at different places: they meet at the
      name without it. Those that also differ at two places at most are left to the first rule.

    So two names meet about as often as they are within two edits, and each pair comes once.
    """
    if max_distance != 2:
        raise ValueError("the places left out are those of two edits")
    name = F.col("last_name")
    distinct = customers.where(name.isNotNull()).groupBy("country", "first_name", "last_name").agg(
        F.min("customer_id").alias("rep")
    )
    copies = (
        customers.select("customer_id", "country", "first_name", "last_name")
        .join(distinct, ["country", "first_name", "last_name"])
        .where(F.col("customer_id") != F.col("rep"))
        .select("customer_id", F.col("rep").alias("other_id"), F.lit(0).alias("distance"))
    )
    cores = _name_cores(distinct)
    return copies.unionByName(_differing_names(cores)).unionByName(_shifted_names(cores))


def _name_cores(names: DataFrame) -> DataFrame:
    """(block, rep, core, n): the last names without what their whole block begins and ends with, and their length."""
    name = F.col("last_name")

    def shared(least: str, most: str) -> Column:
        """Length of the common start, which is that of the first and the last in order."""
        same = F.filter(F.sequence(F.lit(1), F.length(least)), lambda i: F.substring(least, F.lit(1), i) == F.substring(most, F.lit(1), i))
        return F.size(same)

    keys = ["country", "first_name", "len"]
    names = names.withColumns({"len": F.length(name), "back": F.reverse(name)})
    ends = names.groupBy(*keys).agg(F.min(name).alias("a"), F.max(name).alias("z"), F.min("back").alias("back_a"), F.max("back").alias("back_z"))
    ends = ends.where(F.col("a") != F.col("z")).select(*keys, shared("a", "z").alias("before"), shared("back_a", "back_z").alias("after"))
    # Staged, so that a block keeps its number.
    blocks = stage(ends.withColumn("block", F.monotonically_increasing_id()), "name-blocks")
    n = F.col("len") - F.col("before") - F.col("after")
    return names.join(blocks, keys).select("block", "rep", F.substring(name, F.col("before") + 1, n).alias("core"), n.alias("n"))


def _meet(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of rows, as ``a`` and ``b``, that agree in all keys; ordered by a hash of them, which is quick to compare."""
    rows = rows.withColumn("hash", F.xxhash64(*keys))
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("hash", *keys)]
    return rows.alias("a").join(rows.alias("b"), on)


def _differing_names(cores: DataFrame) -> DataFrame:
    """Pairs that differ at one or two places ``i <= j``."""
    core, i, j = F.col("core"), F.col("i"), F.col("j")
    rows = cores.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).withColumn("j", F.explode(F.sequence("i", "n")))
    rest = F.concat(F.substring(core, F.lit(1), i - 1), F.substring(core, i + 1, j - i - 1), F.substr(core, j + 1))
    rows = rows.select("block", "rep", "core", "i", "j", rest.alias("rest"))

    def differ(place: str) -> Column:
        return F.substring("a.core", F.col(place), F.lit(1)) != F.substring("b.core", F.col(place), F.lit(1))

    pairs = _meet(rows, ["block", "i", "j", "rest"]).where(F.col("a.rep") < F.col("b.rep")).where(differ("a.i") & differ("a.j"))
    distance = F.when(F.col("a.i") == F.col("a.j"), 1).otherwise(2)
    return pairs.select(F.col("a.rep").alias("customer_id"), F.col("b.rep").alias("other_id"), distance.alias("distance"))


def _shifted_names(cores: DataFrame) -> DataFrame:
    """Pairs that differ at more than two places, and are equal when ``a`` loses a character and ``b`` a later one.

    Any character of a run of equal ones makes the same form, so a run stands for its characters.
    """
    core, last = F.col("core"), F.col("last")
    rows = cores.withColumn("last", F.explode(F.sequence(F.lit(1), "n"))).withColumn("lost", F.substring(core, last, F.lit(1)))
    rows = rows.where(F.col("lost") != F.substring(core, last + 1, F.lit(1)))  # nothing follows the last run
    first = F.length(F.rtrim(F.substring(core, F.lit(1), last), F.col("lost"))) + 1
    rest = F.concat(F.substring(core, F.lit(1), last - 1), F.substr(core, last + 1))
    rows = rows.select("block", "rep", "lost", first.alias("first"), "last", rest.alias("rest"))
    met = _meet(rows, ["block", "rest"]).where(F.col("a.last") < F.col("b.first"))
    length = F.col("b.first") - F.col("a.last")
    between = F.substring("a.rest", F.col("a.last"), length)  # ``a`` has it one place later than ``b``
    whole = F.concat("a.lost", between, "b.lost")
    # If only one character stands between, they differ at two places; if two take turns, they meet both ways round.
    turns = F.substring(whole, F.lit(1), length) == F.substr(whole, F.lit(3))
    met = met.where(F.substring(between, F.lit(1), length - 1) != F.substr(between, F.lit(2))).where(~turns | (F.col("a.rep") < F.col("b.rep")))
    low, high = F.least("a.rep", "b.rep"), F.greatest("a.rep", "b.rep")
    return met.where(F.col("a.rep") != F.col("b.rep")).select(low.alias("customer_id"), high.alias("other_id"), F.lit(2).alias("distance"))
