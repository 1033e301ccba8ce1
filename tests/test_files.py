import gzip
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.staging import scratch_path
from millrace.plans.audit import Counts, latest_runs, rebuild_partitions, run_audit, run_log
from millrace.sources import files
from millrace.streaming import ingest

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("note", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)),
    ]
)
HEADER = "id|at|note|amount\n"


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text if isinstance(text, bytes) else text.encode(encoding)
    with gzip.open(path, "wb") if path.endswith(".gz") else open(path, "wb") as f:
        f.write(data)


def test_delimited_load_with_rejects_and_audit(spark, tmp_path):
    put(
        f"{tmp_path}/in/orders_1.csv.gz",
        HEADER + '1|2024-01-01 10:00:00.123|"a|b"|1.50\n2||NULL|\n3|2024-01-01 10:00:00.000|x|abc\n4|only\n',
    )
    put(f"{tmp_path}/in/orders_2.csv.gz", HEADER + "5|2024-01-01 10:00:00.000|y|2\n")
    put(f"{tmp_path}/in/orders_3.csv.gz", HEADER + "z|bad|y|2\n")
    put(f"{tmp_path}/in/other.csv.gz", HEADER + "9|2024-01-01 10:00:00.000|y|2\n")
    load = files.load_csv(spark, f"{tmp_path}/in", SCHEMA, pattern=".*orders_.*[.]csv[.]gz")
    good = {r.id: r for r in load.good.collect()}
    assert set(good) == {1, 2, 5}
    assert good[1].note == "a|b" and str(good[1]["at"]) == "2024-01-01 10:00:00.123000"
    assert good[2]["at"] is None and good[2].note is None and good[2].amount is None
    errors = sorted(r[files.ERROR] for r in load.rejects.collect())
    assert errors == [
        "amount: cannot read as decimal(10,2): abc",
        "id: cannot read as bigint: z",
        "wrong number of columns",
    ]
    audit = {os.path.basename(r.file_name): r for r in files.load_audit(load.raw).collect()}
    assert [audit[f"orders_{i}.csv.gz"].status for i in (1, 2, 3)] == ["PARTIALLY_LOADED", "LOADED", "LOAD_FAILED"]
    assert (audit["orders_1.csv.gz"].row_count, audit["orders_1.csv.gz"].row_parsed) == (2, 4)
    assert audit["orders_1.csv.gz"].first_error_message == "amount: cannot read as decimal(10,2): abc"


def test_json_load_has_an_error_budget(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
    bad_byte = b'{"id":3,"s":"a\xffb"}\n'
    put(f"{tmp_path}/e.json.gz", b'{"id":1,"s":"abcdef"}\n{"id":2\n' + bad_byte)
    load = files.load_json(spark, [f"{tmp_path}/e.json.gz"], schema, max_errors=1, lengths={"s": 3})
    assert rows(load.good) == [(1, "abc"), (3, "a?b")]
    assert [r[files.CORRUPT] for r in load.rejects.collect()] == ['{"id":2']
    with pytest.raises(files.TooManyErrors):
        files.load_json(spark, [f"{tmp_path}/e.json.gz"], schema, max_errors=0)


def test_json_array(spark, tmp_path):
    put(f"{tmp_path}/a.json", '[{"id":1},\n {"id":2}]')
    assert rows(files.load_json_array(spark, f"{tmp_path}/a.json", T.StructType([T.StructField("id", T.LongType())]))) == [(1,), (2,)]


def test_filename_date_sees_new_files(spark, tmp_path):
    root, schema = f"{tmp_path}/ext", T.StructType([T.StructField("id", T.LongType())])
    spark.range(2).write.parquet(f"{root}/clicks/landing/2024-01-05")
    assert rows(files.filename_date(spark, root, schema, start=16).select(F.col("file_date").cast("string")).distinct()) == [("2024-01-05",)]
    spark.range(1).write.parquet(f"{root}/clicks/landing/2024-01-06")
    assert files.filename_date(spark, root, schema, start=16).where("file_date = '2024-01-06'").count() == 1


def test_unload_splits_a_date_that_holds_most_rows(spark):
    path = scratch_path(spark, "unload")
    df = spark.range(1000).withColumn("d", F.when(F.col("id") < 600, "big").otherwise(F.concat(F.lit("d"), F.col("id") % 5)))
    files.unload(df, path, ["d"], max_records=100)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    per_file = back.groupBy(F.input_file_name().alias("f")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 100
    files.unload(df.where("d = 'big'"), path, ["d"])
    assert spark.read.parquet(path).select("d").distinct().count() == 1


def test_profile(spark, retail):
    from millrace.sources.retail import SCHEMAS

    got = {r.table_name: r for r in files.table_profile({n: retail.table(n) for n in SCHEMAS}).collect()}
    for name, r in got.items():
        assert r.row_count == retail.table(name).count()
        assert r.bytes == os.path.getsize(f"{retail.sf_dir}/{name}.parquet")


def test_auto_ingest_loads_each_file_once(spark, tmp_path):
    src, dst, mark = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/mark"
    put(f"{src}/a.csv", HEADER + "1|2024-01-01 10:00:00.000|x|1\n2|2024-01-01 10:00:00.000|x|oops\n")
    for _ in range(2):
        ingest.auto_ingest(spark, src, dst, mark, SCHEMA)
    put(f"{src}/b.csv", HEADER + "3|2024-01-01 10:00:00.000|x|1\n")
    ingest.auto_ingest(spark, src, dst, mark, SCHEMA)
    assert [r.id for r in ingest.read_ingested(spark, dst, SCHEMA).orderBy("id").collect()] == [1, 3]
    assert spark.read.parquet(f"{dst}_rejects").count() == 1


def test_append_feed_is_gated_on_data(spark, tmp_path):
    seen = []

    def run():
        return ingest.append_feed(spark, f"{tmp_path}/in", f"{tmp_path}/mark", spark.range(1).schema, lambda b, i: seen.append(b.count()))

    spark.range(3).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == 1 and run() == 0
    spark.range(2).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == 1 and seen == [3, 2]


def test_rebuild_keeps_or_drops_other_dates(spark, tmp_path):
    import datetime as dt

    path = f"{tmp_path}/t"
    old = spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-01-02'), (3, date'2024-01-03') t(v, d)")
    new = spark.sql("select * from values (20, date'2024-01-02'), (99, date'2024-01-09') t(v, d)")
    old.write.partitionBy("d").parquet(path)
    span = (dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert rebuild_partitions(new, path, "d", *span, dry_run=True)["partitions"] == 2
    assert spark.read.parquet(path).count() == 3
    rebuild_partitions(new, path, "d", *span)
    # The range has what the source has: the third of January has no row any more.
    assert [r.v for r in spark.read.parquet(path).orderBy("v").collect()] == [1, 20]
    rebuild_partitions(new, path, "d", *span, keep_outside=False)
    assert [r.v for r in spark.read.parquet(path).collect()] == [20]


def test_a_failed_run_leaves_an_error_row(spark, tmp_path):
    def good(counts: Counts):
        counts.inserted = 7

    def bad(counts: Counts):
        raise ValueError("no such table")

    path = f"{tmp_path}/audit"
    run_audit(spark, "r1", "p", path, good)
    with pytest.raises(ValueError):
        run_audit(spark, "r2", "p", path, bad)
    assert run_log(spark, path).where("status = 'STARTED' AND finished_at IS NULL").count() == 2
    got = {r.run_id: r for r in latest_runs(run_log(spark, path)).collect()}
    assert (got["r1"].status, got["r1"].rows_inserted) == ("OK", 7)
    assert got["r2"].status == "ERROR" and "no such table" in got["r2"].payload
    assert got["r2"].finished_at >= got["r2"].started_at
