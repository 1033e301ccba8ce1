import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.semantics import order_asc
from millrace.operators.changes import as_of_read, change_feed, collapse_feed, initial_feed
from millrace.operators.writes import (
    KeyViolation,
    Matched,
    MergeError,
    NotMatched,
    apply_defaults,
    assign_surrogate_keys,
    check_keys,
    delete_in,
    delete_where,
    merge_into,
    update_where,
)

KEY = st.one_of(st.none(), st.integers(0, 6))
TARGET = st.dictionaries(KEY, st.integers(0, 99), max_size=7)
SOURCE = st.dictionaries(KEY, st.tuples(st.sampled_from(["set", "drop", "odd"]), st.integers(0, 99)), max_size=7)


def model(target, source):
    out, counts = [], {}

    def note(action):
        counts[action] = counts.get(action, 0) + 1

    for k, v in target.items():
        op, new = source.get(k, (None, None)) if k is not None else (None, None)
        if op == "drop":
            note("delete")
        elif op == "set":
            note("update")
            out.append((k, new))
        else:
            out.append((k, v))
    for k, (op, new) in source.items():
        if (k is None or k not in target) and op == "set":
            note("insert")
            out.append((k, new))
    return sorted(out, key=repr), counts


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=TARGET, source=SOURCE)
def test_merge_agrees_with_a_dictionary(spark, target, source):
    t = spark.createDataFrame([(k, v) for k, v in target.items()], "k int, v int")
    s = spark.createDataFrame([(k, op, v) for k, (op, v) in source.items()], "k int, op string, v int")
    merged = merge_into(
        t,
        s,
        ["k"],
        matched=[Matched("delete", F.col("s.op") == "drop"), Matched("update", F.col("s.op") == "set", {"v": F.col("s.v")})],
        not_matched=[NotMatched({"k": F.col("s.k"), "v": F.col("s.v")}, F.col("s.op") == "set")],
    )
    want, counts = model(target, source)
    assert rows(merged.rows) == want
    assert {r.action: r.n for r in merged.counts.collect()} == counts


def test_merge_first_clause_wins_and_untouched_columns_stay(spark):
    t = spark.createDataFrame([(1, "a", "keep")], "k int, v string, w string")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    merged = merge_into(
        t,
        s,
        ["k"],
        matched=[Matched("update", None, {"v": F.col("s.v")}), Matched("delete")],
        not_matched=[NotMatched({"k": F.col("s.k"), "v": F.col("s.v")})],
    )
    assert rows(merged.rows) == [(1, "b", "keep"), (2, "c", None)]


def test_merge_scope_leaves_other_rows_alone(spark):
    t = spark.createDataFrame([(1, "old", False), (1, "now", True)], "k int, v string, cur boolean")
    s = spark.createDataFrame([(1, "new")], "k int, v string")
    merged = merge_into(t, s, ["k"], [Matched("update", None, {"v": F.col("s.v")})], target_scope=F.col("cur"))
    assert rows(merged.rows) == [(1, "new", True), (1, "old", False)]


def test_merge_rejects_two_changes_of_one_row(spark):
    t = spark.createDataFrame([(1, 0), (2, 0)], "k int, v int")
    twice = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    change = Matched("update", F.col("s.v") > 4, {"v": F.col("s.v")})
    with pytest.raises(MergeError):
        merge_into(t, twice, ["k"], [change])
    # Only one of the two satisfies a clause, or neither matches: allowed.
    fine = spark.createDataFrame([(1, 5), (1, 4), (9, 7), (9, 8)], "k int, v int")
    merge_into(t, fine, ["k"], [change])


def test_feed_then_merge_reproduces_the_new_table(spark):
    rng = random.Random(1)
    old = {i: rng.choice([None, "x", "y"]) for i in range(40)}
    new = {i: rng.choice([None, "x", "y"]) for i in range(20, 60)}
    a = spark.createDataFrame(list(old.items()), "k int, v string")
    b = spark.createDataFrame(list(new.items()), "k int, v string")
    feed = change_feed(a, b, ["k"])
    merged = merge_into(
        a,
        collapse_feed(feed),
        ["k"],
        [Matched("delete", F.col("s.action") == "DELETE"), Matched("update", None, {"v": F.col("s.v")})],
        [NotMatched({"k": F.col("s.k"), "v": F.col("s.v")})],
    )
    assert rows(merged.rows) == rows(b)
    assert feed.where("is_update").count() == 2 * sum(old[k] != new[k] for k in old.keys() & new.keys())


def test_update_delete_defaults(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    assert rows(update_where(df, F.col("v") == "a", {"v": F.lit("z")})) == [(1, "z"), (2, None), (3, "c")]
    assert rows(delete_where(df, F.col("v") == "a")) == [(2, None), (3, "c")]
    assert rows(delete_in(df, df.where("k = 3"), ["k"])) == [(1, "a"), (2, None)]
    filled = apply_defaults(df.select("k"), df.schema, {"v": F.lit("d")})
    assert rows(filled) == [(1, "d"), (2, "d"), (3, "d")]


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_surrogate_keys_do_not_depend_on_partitions(spark, parts):
    df = spark.range(200).withColumn("g", F.col("id") % 7).repartition(parts)
    keyed = assign_surrogate_keys(df, [order_asc("g"), order_asc("id")], "sk", start=5)
    assert [(r.g, r.id) for r in keyed.orderBy("sk").collect()] == sorted((i % 7, i) for i in range(200))
    assert keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()[:] == (5, 204, 200)


def test_as_of_read_is_half_open(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2020-01-01', timestamp_ntz'2020-02-01'),"
        " (2, timestamp_ntz'2020-02-01', null) t(k, valid_from, valid_to)"
    )
    at = F.lit("2020-02-01").cast("timestamp_ntz")
    assert [r.k for r in as_of_read(df, at).collect()] == [2]


def test_keys_are_checked_before_a_write(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    check_keys(df, ["k"], ["k"])
    with pytest.raises(KeyViolation, match="1 rows with NULL"):
        check_keys(df, ["k", "v"], ["k"])
    with pytest.raises(KeyViolation, match="1 repeated"):
        check_keys(df.unionByName(df.where("k = 1")), ["k"], ["k"])


def test_keyless_and_closed_rows_stay_out_of_the_merge_join(spark):
    t = spark.createDataFrame([(None, 1, True), (1, 2, False), (1, 3, True)], "k int, v int, cur boolean")
    s = spark.createDataFrame([(None, 7), (None, 7), (1, 9)], "k int, v int")
    merged = merge_into(
        t,
        s,
        ["k"],
        [Matched("update", None, {"v": F.col("s.v")})],
        [NotMatched({"k": F.col("s.k"), "v": F.col("s.v"), "cur": F.lit(True)})],
        target_scope=F.col("cur"),
    )
    assert rows(merged.rows) == sorted(
        [(None, 1, True), (None, 7, True), (None, 7, True), (1, 2, False), (1, 9, True)], key=repr
    )


def test_a_feed_can_start_with_the_rows_already_there(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    feed = initial_feed(df, ["k"])
    assert feed.where("action = 'INSERT' and not is_update").count() == 2
    later = change_feed(df, df.withColumn("v", F.lit("a")), ["k"]).where("k = 2").select("row_id").distinct()
    assert rows(feed.where("k = 2").select("row_id")) == rows(later)


def test_merge_has_no_full_join(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "D")], "k int, v string")
    merged = merge_into(t, s, ["k"], [Matched("update", None, {"v": F.col("s.v")})], [NotMatched({"k": F.col("s.k"), "v": F.col("s.v")})])
    assert "FullOuter" not in merged.log._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["_action"], r["k"], r["v"]) for r in merged.log.collect()}
    assert found == {("keep", 1, "a"), ("update", 2, "B"), ("keep", None, "c"), ("insert", 3, "C"), ("insert", None, "D")}
