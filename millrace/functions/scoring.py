"""Business rules expressed as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.semantics import greatest_null, least_null

# Results must agree with the source system's rules.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
CHANNEL_WEIGHT = {"WEB": "0.20", "CALLCENTER": "0.10"}
CHANNEL_DEFAULT = "0.05"
COUNTRY_WEIGHT = {"US": "0.00", "IN": "0.05"}
COUNTRY_DEFAULT = "0.15"
# (name, low, high), both ends included; what lies in no band is a whale.
AMOUNT_BANDS = (("small", "25", "99.99"), ("medium", "100", "499"), ("large", "500", "1999"))


def amount_bucket(amount: Column) -> Column:
    """Size class of an amount. The gaps between bands (499.01-499.99) are whales."""

    def dec(text: str) -> Column:
        return F.lit(text).cast("decimal(12,2)")

    bucket = F.when(amount.isNull(), F.lit("unknown")).when(amount < dec("25"), F.lit("micro"))
    for name, low, high in AMOUNT_BANDS:
        bucket = bucket.when(amount.between(dec(low), dec(high)), F.lit(name))
    return bucket.otherwise(F.lit("whale"))


def clean_email(email: Column) -> Column:
    """Trimmed, lower-cased address; NULL when it does not look like one."""
    text = F.lower(F.regexp_replace(email, r"^\s+|\s+$", ""))
    return F.when(text.rlike(EMAIL_PATTERN), text)


def email_domain(email: Column) -> Column:
    """Lower-cased text after the first ``@``; NULL without one."""
    at = F.instr(email, "@")
    return F.when(at > 0, F.lower(F.substr(email, at + 1)))


def mask_pan(pan: Column) -> Column:
    """Stars for all but the last four digits; NULL when shorter than four."""
    length = F.length(pan)
    return F.when(length >= 4, F.concat(F.repeat(F.lit("*"), length - 4), F.right(pan, F.lit(4))))


def mask_email(email: Column) -> Column:
    """First character, three stars, then the domain; text without ``@`` is unchanged."""
    return F.regexp_replace(email, "(.)(.*)(@.*)", "$1***$3")


def _weight(column: Column, table: dict[str, str], default: str) -> Column:
    chain = None
    for value, weight in table.items():
        term = F.lit(weight).cast("decimal(6,4)")
        chain = F.when(column == value, term) if chain is None else chain.when(column == value, term)
    return chain.otherwise(F.lit(default).cast("decimal(6,4)"))


def fraud_score(amount: Column, channel: Column, country: Column) -> Column:
    """0.001 x whole amount + channel weight + country weight, clamped to 0..1."""
    raw = (
        F.round(amount, 0).cast("decimal(18,0)") * F.lit("0.001").cast("decimal(4,3)")
        + _weight(channel, CHANNEL_WEIGHT, CHANNEL_DEFAULT)
        + _weight(country, COUNTRY_WEIGHT, COUNTRY_DEFAULT)
    )
    zero, one = F.lit("0").cast("decimal(2,1)"), F.lit("1").cast("decimal(2,1)")
    return least_null(one, greatest_null(zero, raw)).cast("decimal(6,4)")


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)
