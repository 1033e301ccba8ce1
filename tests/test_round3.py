"""Touched-partition merges, streamed silver, run log, key marks, checked rebuilds, manifests, load history, dyadic joins."""

import gzip
import json
import os
import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changes import last_change
from millrace.operators.keys import KeyMarks
from millrace.operators.ordered import global_row_number
from millrace.operators.partitions import PartitionedTable, UntouchedPartition
from millrace.operators.sessions import interval_join
from millrace.operators.staging import scratch_path, stage
from millrace.operators.writes import Matched, NotMatched, apply_defaults, merge_into, with_defaults
from millrace.plans import audit, cdc
from millrace.plans import customer360 as c360
from millrace.plans import governance as gov
from millrace.plans import relational as rel
from millrace.plans import warehouse as dwh
from millrace.sources import files
from millrace.sources.retail import AS_OF_ORDERS
from millrace.streaming import ingest

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def modified(path):
    """Time of every data file below a path."""
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


# --- Tables by partition


@pytest.fixture
def table(spark, tmp_path):
    df = spark.sql(
        "select * from values (1, date'2024-01-05', 'a'), (2, date'2024-02-05', 'b'), (3, date'2024-03-05', 'c'), (4, null, 'd') t(k, d, v)"
    )
    return PartitionedTable(spark, f"{tmp_path}/t", df.schema, F.trunc("d", "month")).create(df)


def test_only_the_partitions_asked_for_are_scanned(spark, table):
    assert rows(table.read()) == [(1, date(2024, 1, 5), "a"), (2, date(2024, 2, 5), "b"), (3, date(2024, 3, 5), "c"), (4, None, "d")]
    feb = table.read([FEB])
    assert rows(feb) == [(2, date(2024, 2, 5), "b")]
    assert [f.split("/")[-2] for f in feb.inputFiles()] and "PartitionFilters: [" in plan_of(feb) and "part#" in plan_of(feb)
    assert feb.select(F.input_file_name()).distinct().count() == 1


def test_other_partitions_are_not_rewritten(spark, table):
    before = modified(table.path)
    new = stage(spark.sql("select 2 k, date'2024-02-09' d, 'B' v"), "new")
    table.replace(new, [FEB])
    after = modified(table.path)
    kept = {f for f in before if "2024-02-01" not in f}
    assert {f: before[f] for f in kept} == {f: t for f, t in after.items() if "2024-02-01" not in f}
    assert rows(table.read([FEB])) == [(2, date(2024, 2, 9), "B")]
    # A row that moves to another month: both months are given; the old one is gone.
    table.replace(stage(spark.sql("select 2 k, date'2024-03-09' d, 'B' v union all select 3, date'2024-03-05', 'c'"), "new"), [FEB, MAR])
    assert rows(table.read([FEB])) == [] and len(rows(table.read([MAR]))) == 2
    assert not os.path.exists(f"{table.path}/part=2024-02-01")
    with pytest.raises(UntouchedPartition):
        table.replace(stage(spark.sql("select 9 k, date'2024-01-09' d, 'x' v"), "new"), [FEB])


def test_where_keys_are_is_found_from_the_keys_alone(spark, table):
    keys = spark.createDataFrame([(1,), (3,), (77,)], "k int")
    assert table.holding(keys, ["k"]) == [JAN, MAR]


FEED = "order_id int, customer_id int, order_ts timestamp_ntz, order_status string, total_amount decimal(12,2), action string, is_update boolean, change_no long"


def order(key, month, action, is_update, seq, amount="10.00", status="PENDING"):
    from decimal import Decimal

    return (key, 1, datetime(2024, month, 3), status, Decimal(amount), action, is_update, seq)


@pytest.fixture
def silver(spark, tmp_path):
    bronze = spark.createDataFrame([order(k, 1 + k % 3, "", False, 0)[:5] for k in range(6)], FEED.split(", action")[0])
    return cdc.silver_table(cdc.first_silver(bronze, datetime(2024, 5, 1)), f"{tmp_path}/silver")


def test_a_repeated_silver_batch_changes_nothing(spark, silver):
    feed = spark.createDataFrame(
        [order(1, 2, "DELETE", True, 1), order(1, 2, "INSERT", True, 1, "99.00"), order(0, 1, "DELETE", False, 2), order(9, 2, "INSERT", False, 3)], FEED
    )
    untouched = {f: t for f, t in modified(silver.path).items() if "2024-03-01" in f}
    first = cdc.apply_silver_batch(silver, feed, 0, datetime(2024, 6, 1), "change_no")
    assert {r.action: r.n for r in first.counts.collect()} == {"update": 2, "insert": 1}
    once = rows(silver.read())
    again = cdc.apply_silver_batch(silver, feed, 0, datetime(2024, 7, 1), "change_no")
    assert again.counts.collect() == [] and rows(silver.read()) == once
    assert untouched == {f: t for f, t in modified(silver.path).items() if "2024-03-01" in f}
    got = {r.order_id: r for r in silver.read().collect()}
    assert got[0].is_deleted and str(got[1].total_amount) == "99.00" and got[9].last_batch == 0 and got[2].last_batch == cdc.NO_BATCH


def test_a_batch_that_stopped_between_months_is_finished(spark, silver):
    """Only one of two months was published before the stop; the repeated batch brings the other."""
    feed = spark.createDataFrame([order(k, 1 + k % 3, action, True, 1, amount) for k in (0, 1) for action, amount in [("DELETE", "10.00"), ("INSERT", "50.00")]], FEED)
    whole = cdc.silver_merge(silver.read(), last_change(feed, ["order_id"], "change_no"), datetime(2024, 6, 1), 4)
    silver.replace(stage(whole.rows.where("order_id % 3 = 0"), "half"), [JAN])
    cdc.apply_silver_batch(silver, feed, 4, datetime(2024, 7, 1), "change_no")
    got = {r.order_id: r for r in silver.read().collect()}
    assert (got[0].updated_at.month, got[1].updated_at.month) == (6, 7) and str(got[0].total_amount) == str(got[1].total_amount) == "50.00"


def test_several_changes_of_one_key_in_a_batch(spark):
    feed = spark.createDataFrame(
        [order(1, 1, "INSERT", False, 1), order(1, 1, "DELETE", True, 2), order(1, 1, "INSERT", True, 2, "20.00")]
        + [order(2, 1, "DELETE", True, 1), order(2, 1, "INSERT", True, 1, "5.00"), order(2, 1, "DELETE", False, 2)]
        + [order(3, 1, "DELETE", False, 1), order(3, 1, "INSERT", False, 2, "7.00")]
        + [order(4, 1, "INSERT", False, 1), order(4, 1, "DELETE", False, 2)],
        FEED,
    )
    got = {r.order_id: (r.action, r.is_update, str(r.total_amount)) for r in last_change(feed, ["order_id"], "change_no").collect()}
    assert got == {1: ("INSERT", False, "20.00"), 2: ("DELETE", False, "10.00"), 3: ("INSERT", True, "7.00"), 4: ("DELETE", False, "10.00")}


def test_the_stream_merges_files_that_arrive_later(spark, silver, tmp_path):
    src, mark = f"{tmp_path}/in", f"{tmp_path}/mark"

    def arrive(*changes):
        spark.createDataFrame(list(changes), FEED).coalesce(1).write.mode("append").parquet(src)
        ingest.stream_silver(spark, src, mark, spark.createDataFrame([], FEED).schema, silver, datetime(2024, 6, 1), "change_no")

    arrive(order(7, 2, "INSERT", False, 1))
    arrive(order(7, 2, "DELETE", True, 2), order(7, 2, "INSERT", True, 2, "3.00"))
    arrive(order(3, 1, "DELETE", False, 3))
    got = {r.order_id: r for r in silver.read().collect()}
    assert len(got) == 7 and str(got[7].total_amount) == "3.00" and got[3].is_deleted and got[3].last_batch == 2


def test_a_small_feed_reads_and_writes_its_months_of_the_facts(spark, retail, tmp_path):
    facts = dwh.fact_table(retail.fact_before, f"{tmp_path}/fact")
    marks = KeyMarks(spark, f"{tmp_path}/marks")
    marks.advance("fact", retail.fact_before, "order_sk", "r0")
    feed = stage(retail.feed.where("date_format(order_ts, 'yyyy-MM') = '2000-03'"), "feed")
    assert facts.touched(feed.select(F.to_date("order_ts").alias("order_date"))) == [date(2000, 3, 1)]
    before, want = modified(facts.path), dwh.fact_merge(retail.fact_before, feed, retail.order_items, retail.dim_before, AS_OF_ORDERS)[0]
    dwh.merge_facts(facts, feed, retail.order_items, retail.dim_before, AS_OF_ORDERS, marks, "r1")
    assert rows(facts.read()) == rows(want.select(*facts.schema.fieldNames()))
    changed = {f for f, t in modified(facts.path).items() if before.get(f) != t}
    assert changed and all("part=2000-03-01" in f for f in changed)


# --- Keys between runs


def test_numbers_need_one_shuffle(spark):
    numbered = global_row_number(spark.range(100).repartition(5), [F.col("id").desc()], "n")
    assert [r.id for r in numbered.orderBy("n").collect()] == list(range(99, -1, -1))
    assert numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 100, 100)


def test_the_largest_key_is_not_given_out_again(spark, retail, tmp_path):
    """The newest fact goes between two refreshes; the next one does not get its key."""
    marks = KeyMarks(spark, f"{tmp_path}/marks")
    assert marks.last("fact") == 0
    feed = stage(retail.feed.where("order_id % 2 = 0"), "feed")
    later = stage(retail.feed.where("order_id % 2 = 1"), "feed")

    def refresh(state, changes, run):
        args = (retail.customers, retail.order_items, retail.products, AS_OF_ORDERS, date(2001, 7, 20), run, audit.Counts(), marks)
        return audit.refresh_dwh(state, changes, *args)[0]

    first = refresh(audit.Warehouse(retail.dim_before, retail.fact_before, retail.bridge_before), feed, "r1")
    top = first.fact.agg(F.max("order_sk")).first()[0]
    assert marks.last("fact") == top
    gone = first.fact.where(F.col("order_sk") < top - 3)
    second = refresh(audit.Warehouse(first.dim, stage(gone, "fact"), first.bridge), later, "r2")
    fresh = second.fact.join(gone.select("order_sk"), "order_sk", "left_anti")
    assert fresh.count() > 0 and fresh.agg(F.min("order_sk")).first()[0] == top + 1


# --- Runs


def test_a_killed_run_stays_visible_and_ids_are_unique(spark, tmp_path):
    path = f"{tmp_path}/log"

    def killed(counts):
        raise KeyboardInterrupt  # like a kill, nothing more is written

    with pytest.raises(KeyboardInterrupt):
        audit.run_audit(spark, None, "p", path, killed)
    ids = [audit.run_audit(spark, None, "p", path, lambda counts: None) for _ in range(2)]
    assert len(set(ids)) == 2 and all(str(uuid.UUID(i)) == i for i in ids)
    folded = audit.latest_runs(audit.run_log(spark, path)).collect()
    assert sorted(r.status for r in folded) == ["OK", "OK", "STARTED"]
    assert audit.run_log(spark, path).count() == 5


def test_a_rebuild_publishes_the_clean_dates_only(spark, tmp_path):
    path, log = f"{tmp_path}/t", f"{tmp_path}/log"
    spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-01-02'), (3, date'2024-01-03'), (4, date'2024-01-04') t(v, d)").write.partitionBy("d").parquet(path)
    new = spark.sql("select * from values (20, date'2024-01-02'), (-1, date'2024-01-03'), (30, date'2024-01-03'), (null, date'2024-01-04') t(v, d)")
    reports = []

    def rebuild(source, dry_run=False):
        def work(counts):
            rules = {"POSITIVE": F.col("v") > 0}
            reports.append(audit.rebuild_checked(source, path, "d", date(2024, 1, 1), date(2024, 1, 4), rules, counts, dry_run))

        run = audit.run_audit(spark, None, "rebuild", log, work)
        return audit.latest_runs(audit.run_log(spark, log)).where(F.col("run_id") == run).first()

    assert rebuild(new, dry_run=True).status == "PARTIAL_FAILURE" and spark.read.parquet(path).count() == 4
    row = rebuild(new)
    assert (row.status, row.rows_processed, row.rows_inserted, row.rows_rejected) == ("PARTIAL_FAILURE", 4, 1, 2)
    assert json.loads(row.payload)["errors"] == "2"
    # The first had no row any more, the second was replaced, the third and fourth keep what they had.
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [3, 4, 20]
    report = {str(r.d): (r.row_count, r.error_count, r.first_error, r.published) for r in reports[-1].collect()}
    assert report["2024-01-03"] == (2, 1, "POSITIVE", False) and report["2024-01-01"] == (0, 0, None, True)
    assert rebuild(new.where("v > 0")).status == "OK"
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [20, 30]


def test_the_second_snapshot_run_changes_nothing(spark, retail):
    args = (retail.orders, retail.order_items, retail.customers, retail.products, AS_OF_ORDERS)
    first, second = audit.Counts(), audit.Counts()
    once = c360.refresh_360(retail.c360_before, *args, first)
    twice = c360.refresh_360(once, *args[:-1], AS_OF_ORDERS + timedelta(hours=1), second)
    assert first.inserted > 0 < first.updated and (second.inserted, second.updated) == (0, 0)
    drop = "hll_sessions"
    assert rows(once.drop(drop)) == rows(twice.drop(drop))


def test_a_repeated_audit_run_replaces_its_rows(spark, retail, tmp_path):
    one = datetime(2024, 1, 1)
    for as_of in (one, one, datetime(2024, 1, 2)):
        log = gov.append_audit_log(retail.customers, f"{tmp_path}/log", as_of)
    active = retail.customers.where("is_active").count()
    assert {r.audited_at.day: r["count"] for r in log.groupBy("audited_at").count().collect()} == {1: active, 2: active}


# --- Defaults


def test_inserts_get_the_declared_default(spark):
    target = with_defaults(spark.createDataFrame([(1, "EUR", 0)], "k int, currency string, n int"), {"currency": "'USD'", "n": "1 + 1"})
    feed = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    merged = merge_into(target, feed, ["k"], [Matched("update", None, {})], [NotMatched({"k": F.col("s.k")})])
    assert rows(merged.rows) == [(1, "EUR", 0), (2, "USD", 2)]
    # The declaration goes along: through the merge, a staged table and an insert of rows.
    kept = stage(merged.rows, "defaults")
    assert rows(apply_defaults(feed.select("k"), kept.schema)) == [(1, "USD", 2), (2, "USD", 2)]
    assert rows(apply_defaults(feed.select("k"), kept.schema, {"n": F.lit(7)})) == [(1, "USD", 7), (2, "USD", 7)]


# --- Files

LINES = T.StructType([T.StructField("id", T.LongType())])


def test_a_manifest_with_a_missing_file_reads_nothing(spark, tmp_path):
    def put(name, text):
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write(text)
        return f"{tmp_path}/{name}"

    here, broken = put("a.json", '{"id":1}\n'), put("b.json", "not json\n" * 500)

    def manifest(*entries):
        return put("m.json", json.dumps({"entries": [{"url": u, "mandatory": m} for u, m in entries]}))

    assert rows(files.load_manifest(spark, manifest((here, True), (f"{tmp_path}/none.json", False), (here, True)), LINES).good) == [(1,)]
    with pytest.raises(files.MissingFile, match="1 mandatory"):  # and not TooManyErrors: the broken file was not read
        files.load_manifest(spark, manifest((broken, True), (f"{tmp_path}/none.json", True)), LINES)
    assert rows(files.load_manifest(spark, manifest(), LINES).good) == []


@pytest.mark.parametrize("bad, fails", [(100, False), (101, True)])
def test_the_error_budget_at_its_limit(spark, tmp_path, bad, fails):
    with gzip.open(f"{tmp_path}/e.json.gz", "wt") as f:
        f.write('{"id":1}\n' + "{\n" * bad)
    if fails:
        with pytest.raises(files.TooManyErrors):
            files.load_json(spark, [f"{tmp_path}/e.json.gz"], LINES)
    else:
        assert rows(files.load_json(spark, [f"{tmp_path}/e.json.gz"], LINES).good) == [(1,)]


def test_a_file_is_loaded_once_and_its_time_is_kept(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in/deep")
    history = files.LoadHistory(spark, f"{tmp_path}/ledger")
    noon = datetime(2024, 5, 1, 12)

    def put(name, text):
        with open(f"{tmp_path}/in/{name}", "w") as f:
            f.write("id\n" + text)

    def load(hours):
        return history.load("t", f"{tmp_path}/t", f"{tmp_path}/in", LINES, noon + timedelta(hours=hours), pattern=".*[.]csv")

    put("a.csv", "1\n2\n")
    put("note.txt", "9\n")
    assert load(0) == 1 and load(1) == 0
    put("deep/b.csv", "3\nx\n")
    put("c.csv", "y\n")
    assert load(30) == 2
    assert sorted(r.id for r in spark.read.schema(LINES).parquet(f"{tmp_path}/t").collect()) == [1, 2, 3]
    got = {os.path.basename(r.file_name): r for r in history.rows().collect()}
    assert {n: (r.status, r.row_count, r.row_parsed) for n, r in got.items()} == {
        "a.csv": ("LOADED", 2, 2), "b.csv": ("PARTIALLY_LOADED", 1, 2), "c.csv": ("LOAD_FAILED", 0, 1),
    }
    assert {os.path.basename(r.file_name) for r in history.since("t", noon + timedelta(hours=24)).collect()} == {"b.csv", "c.csv"}
    assert history.since("other", noon).collect() == []
    # Another table keeps its own account of the same files.
    assert history.load("u", f"{tmp_path}/u", f"{tmp_path}/in", LINES, noon, pattern=".*a[.]csv") == 1


def test_a_relative_root_still_gives_dates(spark, tmp_path, monkeypatch):
    root = os.path.relpath(f"{tmp_path}/ext")
    spark.range(1).select(F.col("id")).write.parquet(f"{tmp_path}/ext/text/2024-01-05")
    got = files.filename_date(spark, root, LINES, start=6).collect()
    assert [tuple(r) for r in got] == [(0, date(2024, 1, 5))]


# --- Joins and sketches


def test_intervals_open_to_the_end_of_time(spark):
    """Intervals of a second up to 8,000 years against a plain range join, rows without a match included."""
    rng = random.Random(6)
    start = datetime(2024, 1, 1)

    def interval(k):
        a = start + timedelta(seconds=rng.randrange(-10**7, 10**7))
        b = rng.choice([a, a + timedelta(seconds=rng.randrange(10**6)), a + timedelta(days=rng.randrange(3000)), datetime(9999, 12, 31), a - timedelta(1), None])
        return (rng.randrange(3), k, a, b)

    intervals = [interval(k) for k in range(60)] + [(2, 98, datetime(1, 1, 1), datetime(9999, 12, 31)), (1, 99, None, start)]
    events = [(rng.randrange(4), k, start + timedelta(seconds=rng.randrange(-2 * 10**7, 2 * 10**7))) for k in range(300)] + [(2, 300, None), (3, 301, start)]
    left = spark.createDataFrame(events, "u int, e int, ts timestamp_ntz")
    right = spark.createDataFrame(intervals, "u int, i int, a timestamp_ntz, b timestamp_ntz")
    got = sorted((tuple(r)[:4] for r in interval_join(left, right, ["u"], "ts", "a", "b", bucket_s=3600).select("u", "e", "ts", "i").collect()), key=repr)
    want = []
    for u, e, ts in events:
        met = [i for v, i, a, b in intervals if v == u and ts and a and b and a <= ts <= b]
        want += [(u, e, ts, i) for i in met or [None]]
    assert got == sorted(want, key=repr)


def test_a_long_interval_has_few_cells(spark):
    from millrace.operators import sessions as s

    ends = spark.createDataFrame([(0, 11_600_000), (-7, 5), (3, 3), (1, 1 << 39)], "_from long, _to long")
    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(s.WIDTHS)), s._dyadic_cells)).alias("cells")
    for r in ends.select("*", cells).collect():
        covered = sorted((c.cell * 2**c.width, (c.cell + 1) * 2**c.width - 1) for c in r.cells)
        assert len(covered) <= 80 and covered[0][0] == r["_from"] and covered[-1][1] == r["_to"]
        assert all(a[1] + 1 == b[0] for a, b in zip(covered, covered[1:], strict=False))


def test_each_near_pair_comes_once(spark):
    rng = random.Random(9)
    names = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(60)] + ["", None]
    df = spark.createDataFrame([(k, "X", "F", n) for k, n in enumerate(names)], "customer_id int, country string, first_name string, last_name string")

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    first = {}
    for k, n in enumerate(names):
        if n is not None:
            first.setdefault(n, k)
    want = [(k, first[n], 0) for k, n in enumerate(names) if n is not None and first[n] != k]
    want += [(i, j, edits(a, b)) for a, i in first.items() for b, j in first.items() if i < j and len(a) == len(b) and edits(a, b) <= 2]
    assert rows(rel.name_distance(df)) == sorted(want, key=repr)


def test_merged_sketches_keep_the_ranks(spark):
    n = 30_000
    orders = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("channel"), F.timestamp_seconds(F.col("id") * 300).cast("timestamp_ntz").alias("order_ts"),
        F.pmod(F.hash("id"), F.lit(10_000)).cast("decimal(12,2)").alias("total_amount"),
    )
    daily = stage(rel.quantile_sketches(orders), "sketches")
    assert daily.count() > 100
    ranks = {"median": 0.5, "p95": 0.95}
    found = stage(rel.channel_quantiles(daily, ranks), "quantiles")
    assert {r.channel: r.amount_count for r in found.collect()} == {"A": n // 3, "B": n - n // 3}
    close = rel.close_in_rank(orders, found, "channel", "total_amount", ranks, 0.02)
    assert all(r.median_close and r.p95_close for r in close.collect())
    shifted = found.withColumn("median", F.col("p95"))
    assert not any(r.median_close for r in rel.close_in_rank(orders, shifted, "channel", "total_amount", ranks, 0.02).collect())
