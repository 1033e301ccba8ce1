"""State that earlier runs would have left behind, derived from the retail views.

The merge jobs need a target that differs from their source. Which rows differ is
decided by arithmetic on the ids, the same in ``checks/views.py``.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.semantics import order_asc
from millrace.operators.changes import change_feed
from millrace.operators.staging import stage
from millrace.operators.writes import assign_surrogate_keys
from millrace.plans.cdc import first_silver
from millrace.plans.customer360 import customer_360
from millrace.plans.warehouse import DIM_COLUMNS, dim_source
from millrace.sources.retail import AS_OF_ORDERS, Retail, ntz

EARLIER = datetime(2000, 1, 1)
BRIDGE_DAY = date(2001, 7, 20)


class History(Retail):
    """Retail views plus the tables of earlier runs."""

    @cached_property
    def feed(self) -> DataFrame:
        """The bronze change feed, staged because several steps of a run read it."""
        return stage(change_feed(self.bronze_v1, self.bronze_v2, ["order_id"]), "feed")

    @cached_property
    def silver_before(self) -> DataFrame:
        return first_silver(self.bronze_v1, EARLIER)

    @cached_property
    def dim_source(self) -> DataFrame:
        return dim_source(self.customers)

    @cached_property
    def dim_before(self) -> DataFrame:
        """Three quarters of the customers; some with other countries or segments, some with two versions."""
        key = F.col("customer_id")
        known = self.dim_source.where(key % 4 != 3)
        flipped = F.when(F.col("segment") == "VIP", "STANDARD").otherwise("VIP")

        def version(df: DataFrame, start: Column, end: Column, current: bool) -> DataFrame:
            return df.withColumns({"valid_from": start, "valid_to": end, "is_current": F.lit(current)}).drop("signup_ts")

        first = ntz(datetime(1999, 1, 1))
        current = version(
            known.withColumn("country", F.when(key % 13 == 5, "NATION_OLD").otherwise(F.col("country"))).withColumn(
                "segment", F.when(key % 10 == 1, flipped).otherwise(F.col("segment"))
            ),
            F.when(key % 7 == 2, first).otherwise(ntz(EARLIER)),
            F.lit(None).cast("timestamp_ntz"),
            True,
        )
        previous = version(
            known.where(key % 7 == 2).withColumn("country", F.lit("NATION_OLD")).withColumn("segment", F.lit("STANDARD")),
            ntz(datetime(1998, 1, 1)),
            first,
            False,
        )
        rows = current.unionByName(previous)
        keyed = assign_surrogate_keys(rows, [order_asc("customer_id"), order_asc("valid_from")], "customer_sk")
        return keyed.select(*DIM_COLUMNS)

    @cached_property
    def fact_before(self) -> DataFrame:
        """Facts of a third of the first bronze version, without tax and items."""
        current = self.dim_before.where("is_current").select("customer_id", "customer_sk")
        gross = F.col("total_amount").cast("decimal(14,2)")
        facts = (
            self.bronze_v1.where(F.col("order_id") % 3 == 0)
            .join(current, "customer_id")
            .select(
                "order_id",
                "customer_sk",
                F.to_date("order_ts").alias("order_date"),
                "order_status",
                gross.alias("gross_amount"),
                F.lit(0).cast("decimal(14,2)").alias("tax_amount"),
                gross.alias("net_amount"),
                F.lit(0).cast("bigint").alias("line_count"),
                F.lit(None).cast("string").alias("payload"),
                F.lit(0).cast("bigint").alias("payload_parts"),
                ntz(EARLIER).alias("loaded_at"),
            )
        )
        return assign_surrogate_keys(facts, [order_asc("order_id")], "order_sk")

    @cached_property
    def bridge_before(self) -> DataFrame:
        return self.fact_before.select(
            "order_sk", F.lit("OLD").alias("category"), F.lit("1").cast("decimal(14,4)").alias("revenue_share")
        )

    @cached_property
    def snapshot(self) -> DataFrame:
        return customer_360(self.orders, self.order_items, self.customers, self.products, AS_OF_ORDERS)

    @cached_property
    def c360_before(self) -> DataFrame:
        """An earlier snapshot, and outdated rows of the present one for even customers."""
        shape = [f.name for f in self.snapshot.schema]
        earlier = customer_360(
            self.orders, self.order_items, self.customers, self.products, datetime(2001, 7, 1)
        )
        outdated = self.snapshot.where(F.col("customer_id") % 2 == 0).withColumn(
            "total_spend_30d", F.lit(0).cast("decimal(18,2)")
        )
        stamps = {"created_at": ntz(EARLIER), "updated_at": F.lit(None).cast("timestamp_ntz")}
        return earlier.unionByName(outdated).select(*shape).withColumns(stamps)
