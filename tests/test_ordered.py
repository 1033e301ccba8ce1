import random
import statistics
from decimal import Decimal

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.semantics import order_asc, order_desc
from millrace.operators.ordered import (
    Scan,
    exact_percentile,
    find_hot,
    global_row_number,
    ordered_scan,
    qualify_topn,
)


def skewed(spark, n=400):
    """A third of the rows under one key, some under NULL."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        key = 1 if i % 3 == 0 else None if i % 7 == 0 else rng.randrange(2, 40)
        value = None if rng.random() < 0.1 else Decimal(rng.randrange(1000)) / 100
        data.append((key, rng.randrange(50), i, value))
    return spark.createDataFrame(data, "k int, t int, id int, v decimal(10,2)").repartition(5)


SCAN = Scan(
    row_number="rn",
    running_sums={"total": "v"},
    lags={"v1": ("v", 1), "v2": ("v", 2), "t3": ("t", 3)},
    firsts={"v0": "v"},
)


def test_hot_keys_give_the_same_rows_as_a_plain_window(spark):
    df = skewed(spark)
    order = [order_asc("t"), order_asc("id")]
    plain = ordered_scan(df, ["k"], order, SCAN, find_hot(df, ["k"], 10_000))
    split = ordered_scan(df, ["k"], order, SCAN, find_hot(df, ["k"], 20))
    assert find_hot(df, ["k"], 20).keys.count() == 2
    assert split.dtypes == plain.dtypes
    assert rows(split) == rows(plain)


def test_every_key_hot(spark):
    df = skewed(spark, 120)
    order = [order_desc("t"), order_asc("id")]
    plain = ordered_scan(df, ["k"], order, SCAN, find_hot(df, ["k"], 10_000))
    assert rows(ordered_scan(df, ["k"], order, SCAN, find_hot(df, ["k"], 0))) == rows(plain)


def test_hot_split_keeps_the_running_window_out_of_one_task(spark):
    df = skewed(spark)
    hot = find_hot(df, ["k"], 20)
    out = ordered_scan(df, ["k"], [order_asc("t"), order_asc("id")], Scan(row_number="rn"), hot)
    sizes = out.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i, None if i % 9 == 0 else f"n{i % 50:03d}") for i in range(300)], "id int, s string")
    got = global_row_number(df.repartition(6), [order_asc("s"), order_asc("id")], "n", start=11).orderBy("n").collect()
    assert [r.n for r in got] == list(range(11, 311))
    want = sorted(((r.s is None, r.s or "", r.id) for r in got))
    assert [(r.s is None, r.s or "", r.id) for r in got] == want


def test_exact_percentile_of_hot_groups(spark):
    rng = random.Random(3)
    data = [("a" if i % 3 == 0 else f"k{i % 11}", rng.choice([None, 1.5, 2.0, rng.random() * 10])) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.m for r in exact_percentile(df, ["k"], {"m": "v"}, 0.5, find_hot(df, ["k"], 20)).collect()}
    p95 = {r.k: r.m for r in exact_percentile(df, ["k"], {"m": "v"}, 0.95, find_hot(df, ["k"], 20)).collect()}
    for key in {k for k, _ in data}:
        values = [v for k, v in data if k == key and v is not None]
        assert abs(got[key] - statistics.median(values)) < 1e-9
        assert abs(p95[key] - np.percentile(values, 95)) < 1e-9


def test_topn_limits_each_key_before_the_shuffle(spark):
    df = skewed(spark)
    top = qualify_topn(df, ["k"], [order_desc("t"), order_asc("id")], 2, "rn")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("WindowGroupLimit") < plan.rindex("Exchange")
    assert top.groupBy("k").count().where("count > 2").isEmpty()
