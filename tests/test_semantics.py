from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import scoring
from millrace.functions import semantics as sem


def one(spark, expr, schema=None, row=None):
    df = spark.createDataFrame([row], schema) if schema else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "unit, start, end, want",
    [
        ("day", "2024-01-01 23:00:00", "2024-01-02 01:00:00", 1),
        ("day", "2024-01-02 01:00:00", "2024-01-01 23:00:00", -1),
        ("hour", "2024-01-01 10:59:59", "2024-01-01 11:00:00", 1),
        ("minute", "2024-01-01 10:59:59", "2024-01-01 11:00:01", 1),
        ("second", "2024-01-01 10:59:59.9", "2024-01-01 11:00:00.1", 1),
        ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
        ("quarter", "2024-03-31 00:00:00", "2024-04-01 00:00:00", 1),
        ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        ("week", "2024-01-07 00:00:00", "2024-01-08 00:00:00", 1),  # Sunday to Monday
        ("week", "2024-01-08 00:00:00", "2024-01-14 00:00:00", 0),  # Monday to Sunday
    ],
)
def test_datediff_counts_boundaries(spark, unit, start, end, want):
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    assert one(spark, sem.datediff_boundary(unit, a, b)) == want


@pytest.mark.parametrize("a, b, want", [(6, 3, 2.0), (6, 0, 0.0), (None, 0, None), (6, None, None), (None, 2, None)])
def test_div0(spark, a, b, want):
    got = one(spark, sem.div0("a", "b"), "a double, b double", (None if a is None else float(a), None if b is None else float(b)))
    assert got == want


def test_null_aware_extremes(spark):
    lit = [F.lit(1), F.lit(None).cast("int"), F.lit(3)]
    assert one(spark, sem.least_null(lit[0], lit[2])) == 1
    assert one(spark, sem.least_null(*lit)) is None
    assert one(spark, sem.greatest_null(*lit)) is None


@pytest.mark.parametrize("text, want", [("o'neil mc-DONALD", "O'Neil Mc-Donald"), ("éVA", "Éva"), ("", ""), (None, None), ("3rd way", "3rd Way")])
def test_init_cap_starts_words_at_punctuation(spark, text, want):
    assert one(spark, sem.init_cap("s"), "s string", (text,)) == want


def test_dates_and_truncation(spark):
    assert one(spark, sem.dow0(F.lit("2024-01-07").cast("date"))) == 0
    assert one(spark, sem.trunc0(F.lit(-2.7))) == -2
    assert one(spark, sem.trunc_to_date("quarter", F.lit("2024-05-17 10:00:00").cast("timestamp_ntz"))).isoformat() == "2024-04-01"
    tenure = sem.months_of_tenure(F.lit(datetime(2024, 3, 14)), F.lit(datetime(2024, 1, 15)))
    assert one(spark, tenure) == 1


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in df.orderBy(sem.order_asc("v")).collect()] == [1, 2, None]
    assert [r.v for r in df.orderBy(sem.order_desc("v")).collect()] == [None, 2, 1]


def test_json_object_leaves_nulls_out(spark):
    assert one(spark, sem.json_object(a=F.lit(1), b=F.lit(None).cast("string"), c=F.lit("x"))) == '{"a":1,"c":"x"}'


@pytest.mark.parametrize(
    "amount, want",
    [
        (None, "unknown"), ("24.99", "micro"), ("25", "small"), ("99.99", "small"), ("100", "medium"), ("499", "medium"),
        ("499.50", "whale"), ("500", "large"), ("1999", "large"), ("1999.50", "whale"),
    ],
)
def test_amount_bucket_edges(spark, amount, want):
    value = None if amount is None else Decimal(amount)
    assert one(spark, scoring.amount_bucket(F.col("a")), "a decimal(12,2)", (value,)) == want


@pytest.mark.parametrize("pan, want", [(None, None), ("", None), ("123", None), ("1234", "1234"), ("12345", "*2345")])
def test_mask_pan(spark, pan, want):
    assert one(spark, scoring.mask_pan(F.col("p")), "p string", (pan,)) == want


@pytest.mark.parametrize(
    "email, domain, clean, masked",
    [
        ("Ann@Example.COM", "example.com", "ann@example.com", "A***@Example.COM"),
        ("no-at", None, None, "no-at"),
        ("a@b@c.d", "b@c.d", None, "a***@c.d"),
        ("  \tx@y.z ", "y.z ", "x@y.z", None),
        ("", None, None, ""),
        (None, None, None, None),
    ],
)
def test_email_rules(spark, email, domain, clean, masked):
    assert one(spark, scoring.email_domain(F.col("e")), "e string", (email,)) == domain
    assert one(spark, scoring.clean_email(F.col("e")), "e string", (email,)) == clean
    if masked is not None or email is None:
        assert one(spark, scoring.mask_email(F.col("e")), "e string", (email,)) == masked


def test_fraud_score_is_clamped(spark):
    score = scoring.fraud_score(F.col("a"), F.col("c"), F.col("n"))
    schema = "a decimal(12,2), c string, n string"
    assert one(spark, score, schema, (Decimal("100.40"), "WEB", "IN")) == Decimal("0.3500")
    assert one(spark, score, schema, (Decimal("99999"), "WEB", "US")) == Decimal("1.0000")
    assert one(spark, score, schema, (Decimal("-5000"), "WEB", "US")) == Decimal("0.0000")
    assert one(spark, score, schema, (None, "WEB", "US")) is None
