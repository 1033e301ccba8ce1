from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.operators.sessions import sessionise
from millrace.streaming.sessions import stream_sessions

T0 = datetime(2024, 1, 1)


def test_closed_stream_sessions_equal_the_batch_ones(spark, tmp_path):
    data = []
    for user in (1, 2, 3):
        at = T0
        for i in range(30):
            at += timedelta(seconds=[60, 1800, 1801, 5000][(i * user) % 4])
            data.append((user, user * 100 + i, at))
    last = T0 + timedelta(days=3)
    events = spark.createDataFrame(data + [(9, 999, last)], "user_id int, event_id int, ts timestamp_ntz")
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    query = (
        stream_sessions(stream, 1800, "1 minute")
        .writeStream.format("memory")
        .queryName("closed_sessions")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = {tuple(r) for r in spark.table("closed_sessions").collect()}
    batch = sessionise(events.where("user_id < 9"), "user_id", "ts", "event_id", 1800).groupBy("user_id", "session_no")
    want = batch.agg(F.min("ts"), F.max("ts"), F.count("*")).drop("session_no").collect()
    assert got == {tuple(r) for r in want}


def test_open_sessions_are_not_lost(spark, retail):
    """Every event of the table is in one session, also where the watermark has not passed."""
    from millrace.plans import fileflows

    got = fileflows.all_stream_sessions(retail)
    assert got.agg(F.sum("event_count")).first()[0] == retail.table("events").count()
    assert got.where("is_open").count() > 0 < got.where("NOT is_open").count()
