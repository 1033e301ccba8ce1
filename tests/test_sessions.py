import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.ordered import find_hot
from millrace.operators.sessions import interval_join, sequence_match, session_metrics, sessionise

T0 = datetime(2024, 1, 1)
EVENT = "user_id int, event_id int, ts timestamp_ntz"


def test_gap_of_exactly_the_limit_stays_in_the_session(spark):
    times = [0, 1799, 1799 + 1800, 1799 + 1800 + 1801]
    df = spark.createDataFrame([(1, i, T0 + timedelta(seconds=s)) for i, s in enumerate(times)], EVENT)
    got = sessionise(df, "user_id", "ts", "event_id", 1800).orderBy("event_id").collect()
    assert [r.is_session_start for r in got] == [1, 0, 0, 1]
    assert [r.session_no for r in got] == [1, 1, 1, 2]


def typed(spark, n=300):
    rng = random.Random(2)
    data, at = [], T0
    for i in range(n):
        user = 1 if i % 3 == 0 else rng.randrange(2, 30)
        at += timedelta(seconds=rng.randrange(1, 900))
        data.append((user, i, at, rng.choice(["a", "b", None]), float(rng.randrange(90)), float(rng.randrange(90))))
    schema = EVENT.replace("ts ", "event_ts ") + ", utm_source string, lat double, lon double"
    df = spark.createDataFrame(data, schema)
    return df.withColumns(
        {
            "order_total": F.lit("2.50").cast("decimal(12,2)"),
            "device_type": F.lit("mobile"),
            "country": F.lit("X"),
        }
    )


def test_busy_users_and_busy_sessions_give_the_same_result(spark):
    df = typed(spark)

    def run(limit):
        events = sessionise(df, "user_id", "event_ts", "event_id", 3600, find_hot(df, ["user_id"], limit))
        return session_metrics(events, find_hot(events, ["user_id", "session_no"], limit))

    assert rows(run(4)) == rows(run(10_000))


def test_interval_join_agrees_with_a_plain_range_join(spark):
    rng = random.Random(4)

    def at(hours):
        return T0 + timedelta(hours=hours)

    left = spark.createDataFrame(
        [(rng.choice([1, 1, 2, 3, None]), i, at(rng.random() * 100)) for i in range(200)], EVENT
    )
    spans = []
    for i in range(40):
        start = rng.random() * 100
        spans.append((rng.randrange(1, 4), at(start), at(start + rng.random() * 30), f"s{i}"))
    right = spark.createDataFrame(spans, "user_id int, start_ts timestamp_ntz, end_ts timestamp_ntz, name string")
    got = interval_join(left, right, ["user_id"], "ts", "start_ts", "end_ts", bucket_s=3600)
    plain = left.alias("l").join(
        right.alias("r"), F.expr("l.user_id = r.user_id and l.ts between r.start_ts and r.end_ts"), "left"
    ).select("l.*", "r.start_ts", "r.end_ts", "r.name")
    assert rows(got) == rows(plain)


def test_sequence_needs_adjacent_states_within_the_day_limits(spark):
    def row(who, i, state, days):
        return (who, i, T0 + timedelta(days=days), state)

    data = [
        row(1, 0, "FREE", 0), row(1, 1, "TRIAL", 30), row(1, 2, "PAID", 44),  # both limits met exactly
        row(2, 0, "FREE", 0), row(2, 1, "TRIAL", 31), row(2, 2, "PAID", 32),  # first step too long
        row(3, 0, "FREE", 0), row(3, 1, "TRIAL", 1), row(3, 2, "PAID", 16),  # second step too long
        row(4, 0, "FREE", 0), row(4, 1, "TRIAL", 1), row(4, 2, "FREE", 2), row(4, 3, "PAID", 3),  # interrupted
    ]
    df = spark.createDataFrame(data, "customer_id int, id int, ts timestamp_ntz, state string")
    args = ("customer_id", "ts", "id", "state", ("FREE", "TRIAL", "PAID"), (30, 14), ("f", "t", "p"))
    got = sequence_match(df, *args)
    assert [r.customer_id for r in got.collect()] == [1]
    assert rows(sequence_match(df, *args, find_hot(df, ["customer_id"], 1))) == rows(got)
