from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import cdc
from millrace.plans import customer360 as c360
from millrace.plans import warehouse as dwh
from millrace.sources.retail import AS_OF_ORDERS, ntz

RUN1, RUN2 = datetime(2024, 5, 1), datetime(2024, 5, 2)
CUSTOMERS = "customer_id int, first_name string, last_name string, email string, country string, attributes string, signup_ts timestamp_ntz"


def customers(spark, *people):
    return spark.createDataFrame([(*p, datetime(2020, 1, 1)) for p in people], CUSTOMERS)


def empty_dim(spark, source):
    return source.limit(0).select(
        F.lit(None).cast("bigint").alias("customer_sk"),
        "customer_id",
        *dwh.DIM_DATA,
        ntz(RUN1).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def two_runs(spark, null_safe):
    vip, plain = '{"vip":true}', '{"vip":false}'
    first = customers(
        spark, (1, "ann", "o'neil", "a@x.y", "IN", plain), (2, "bob", "b", "b@x.y", "US", plain), (3, "cy", "c", None, "MX", vip)
    )
    second = customers(
        spark,
        (1, "ann", "o'neil", "a@x.y", "IN", vip),  # segment changes
        (2, "rob", "b", "b@x.y", "US", plain),  # a name alone is no change
        (3, "cy", "c", "c@x.y", "MX", vip),  # from NULL: seen only by the null-safe test
        (4, "di", "d", "d@x.y", "US", plain),
    )
    a, b = dwh.dim_source(first), dwh.dim_source(second)
    dim, _ = dwh.scd2_merge(empty_dim(spark, a), a, a, RUN1, null_safe)
    dim, log = dwh.scd2_merge(dim, b, b, RUN2, null_safe)
    return dim, log


@pytest.mark.parametrize("null_safe, changed", [(False, {1}), (True, {1, 3})])
def test_scd2_versions(spark, null_safe, changed):
    dim, log = two_runs(spark, null_safe)
    got = dim.orderBy("customer_id", "valid_from").collect()
    assert {r.customer_id for r in got if not r.is_current} == changed
    assert all(r.valid_to == RUN2 for r in got if not r.is_current)
    current = [r for r in got if r.is_current]
    assert [r.customer_id for r in current] == [1, 2, 3, 4] and all(r.valid_to is None for r in current)
    assert {r.customer_id for r in current if r.valid_from == RUN2} == changed | {4}
    assert sorted(r.customer_sk for r in got) == list(range(1, len(got) + 1))
    assert current[0].full_name == "Ann O'Neil" and current[0].segment == "VIP"
    assert log.where("_action = 'insert'").count() == len(changed) + 1


def test_vip_chain_walks_back_over_touching_intervals(spark):
    start = datetime(2000, 1, 1)

    def version(sk, i, current=False, gap=0):
        end = None if current else start + timedelta(days=i + 1)
        return (7, sk, "VIP" if current else "STANDARD", start + timedelta(days=i, hours=gap), end, current)

    schema = "customer_id int, customer_sk int, segment string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
    data = [version(1, 0), version(2, 1, gap=3), version(3, 2), version(4, 3, current=True)]
    dim = spark.createDataFrame(data, schema)
    assert [(r.customer_sk, r.depth) for r in dwh.vip_history(dim).orderBy("depth").collect()] == [(4, 1), (3, 2), (2, 3)]
    assert dwh.vip_history(dim, max_depth=2).count() == 2


def test_dimension_invariants_on_the_test_tables(retail):
    scope = dwh.dim_scope(retail.dim_source, retail.feed, AS_OF_ORDERS)
    dim, _ = dwh.scd2_merge(retail.dim_before, retail.dim_source, scope, AS_OF_ORDERS)
    assert dim.where("is_current").groupBy("customer_id").count().where("count > 1").isEmpty()
    overlapping = dim.alias("a").join(
        dim.alias("b"),
        F.expr("a.customer_id = b.customer_id and a.customer_sk < b.customer_sk"
               " and a.valid_from < coalesce(b.valid_to, timestamp_ntz'9999-01-01')"
               " and b.valid_from < coalesce(a.valid_to, timestamp_ntz'9999-01-01')"),
    )
    assert overlapping.isEmpty()
    assert dim.agg(F.count_distinct("customer_sk"), F.max("customer_sk")).first()[:] == (dim.count(), dim.count())


def test_a_fully_deleted_customer_day_stays_in_gold(spark):
    day = datetime(2024, 5, 1, 9)
    schema = "order_id int, customer_id int, order_ts timestamp_ntz, order_status string, total_amount decimal(12,2)"
    silver = cdc.first_silver(spark.createDataFrame([(1, 1, day, "PENDING", None), (2, 2, day, "PENDING", None)], schema), RUN1)
    gold = cdc.gold_rows(silver).withColumn("updated_at", ntz(RUN1))
    deleted = silver.withColumn("is_deleted", F.col("customer_id") == 1)
    merged = cdc.gold_merge(gold, deleted, RUN2)
    assert {r.customer_id: r.updated_at for r in merged.rows.collect()} == {1: RUN1, 2: RUN2}


def test_no_alert_without_late_orders(spark, retail):
    assert cdc.late_orders(retail.silver_before.where("order_status = 'COMPLETED'"), AS_OF_ORDERS).isEmpty()


def test_replaying_the_feed_changes_nothing(retail):
    once = cdc.silver_merge(retail.silver_before, retail.feed, AS_OF_ORDERS).rows
    twice = cdc.silver_merge(once, retail.feed, AS_OF_ORDERS).rows
    assert rows(once.drop("updated_at")) == rows(twice.drop("updated_at"))


def test_merged_sketches_estimate_the_whole(spark):
    n = 20_000
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), (F.col("id") % 37).alias("customer_id"), ntz(datetime(2024, 5, 1)).alias("order_ts")
    )
    got = c360.hll_rollup(c360.daily_sketches(orders), RUN2).first().distinct_sessions_total
    assert abs(got - n) / n < 0.05


def test_the_model_scores_within_bounds(retail):
    from millrace.plans.fileflows import churn_model

    got = churn_model(retail).collect()
    assert len(got) == retail.snapshot.count() and all(0 <= r.prediction <= 1 for r in got)
