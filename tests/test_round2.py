"""Faults found in review: each of these failed before."""

from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.semantics import order_asc
from millrace.operators.changes import initial_feed
from millrace.operators.staging import scratch_path, stage
from millrace.plans import model
from millrace.plans import relational as rel
from millrace.plans import semistructured as semi
from millrace.plans import warehouse as dwh
from millrace.sources import files


def test_keys_of_deleted_rows_are_not_given_out_again(spark):
    log = stage(spark.createDataFrame([(1, 10), (2, 11), (3, 12), (None, 13)], "order_sk long, order_id long"), "log")
    kept = log.where("order_sk < 3")
    out = dwh.number_new_rows(kept, log.where("order_sk is null"), "order_sk", [order_asc("order_id")], log)
    assert rows(out) == [(1, 10), (2, 11), (4, 13)]
    later = dwh.number_new_rows(kept, log.where("order_sk is null"), "order_sk", [order_asc("order_id")], last_key=7)
    assert (8, 13) in rows(later)


def test_an_order_of_many_items_comes_back_whole(spark):
    items = spark.range(25_000).select(F.lit(1).alias("order_id"), F.format_string("S%05d", "id").alias("sku"), F.lit(2).alias("quantity"), F.lit("1.00").alias("unit_price"))
    parts = semi.order_payloads(items)
    assert [r.part_no for r in parts.orderBy("part_no").collect()] == [0, 1, 2]
    whole = parts.groupBy("order_id").agg(F.collect_list(F.struct("part_no", "payload")).alias("p")).select(semi.whole_payload("p").alias("payload"))
    skus = whole.select(F.from_json("payload", "array<struct<sku:string>>").alias("a")).select("a.sku").first()[0]
    assert skus == [f"S{i:05d}" for i in range(25_000)]


def test_the_date_is_cut_below_the_root(spark):
    root = scratch_path(spark, "x") + "/ext"
    spark.createDataFrame([(1,)], "event_id long").write.parquet(f"{root}/text/2024-01-05")
    got = files.filename_date(spark, root, spark.createDataFrame([], "event_id long").schema, start=6).collect()
    assert [tuple(r) for r in got] == [(1, date(2024, 1, 5))]


def test_row_ids_tell_keys_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("c", None)], "k string, l string")
    assert initial_feed(df, ["k", "l"]).select("row_id").distinct().count() == 4


def test_the_model_takes_many_countries_and_unknown_sign_ups(spark):
    df = spark.range(240).select(
        F.col("id").alias("customer_id"), F.format_string("C%d", F.col("id") % 80).alias("country"),
        F.when(F.col("id") % 5 > 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("signup_ts"),
        F.col("id").cast("decimal(18,2)").alias("total_spend_30d"), F.lit(1).alias("order_count_30d"),
        F.lit("2024-05-01").cast("timestamp_ntz").alias("last_order_ts"), F.lit("2024-06-01").cast("date").alias("snapshot_date"),
        (F.col("id") % 2).cast("double").alias("target"),
    )
    fitted = model.train_churn(stage(df, "labelled"), trees=2)
    assert model.score(fitted, df).where("churn_score is null").isEmpty()


def test_a_sample_does_not_depend_on_the_layout(retail):
    from millrace.sources.retail import AS_OF_ORDERS

    assert rows(rel.sample_orders(retail.orders, AS_OF_ORDERS)) == rows(rel.sample_orders(retail.orders.repartition(7), AS_OF_ORDERS))
