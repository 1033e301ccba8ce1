"""Source-dialect semantics that differ from Spark's defaults.

Null order, boundary date differences, zero-safe division and the like live here
and nowhere else, so that every job agrees on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def order_asc(column: ColumnLike) -> Column:
    """Ascending, NULL last."""
    return _c(column).asc_nulls_last()


def order_desc(column: ColumnLike) -> Column:
    """Descending, NULL first."""
    return _c(column).desc_nulls_first()


def _hours(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def _minutes(ts: Column) -> Column:
    return _hours(ts) * 60 + F.minute(ts)


def _seconds(ts: Column) -> Column:
    return _minutes(ts) * 60 + F.second(ts)


def _days(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("bigint")


def _weeks(ts: Column) -> Column:
    # Weeks start on Monday; 1970-01-01 was a Thursday.
    return F.floor((_days(ts) + 3) / 7)


def _months(ts: Column) -> Column:
    return F.year(ts).cast("bigint") * 12 + F.month(ts)


def _quarters(ts: Column) -> Column:
    return F.year(ts).cast("bigint") * 4 + F.quarter(ts)


def _years(ts: Column) -> Column:
    return F.year(ts).cast("bigint")


# For each unit, the index of the calendar cell a timestamp falls in.
_CELL = {
    "second": _seconds,
    "minute": _minutes,
    "hour": _hours,
    "day": _days,
    "week": _weeks,
    "month": _months,
    "quarter": _quarters,
    "year": _years,
}
DATEDIFF_UNITS = tuple(_CELL)


def datediff_boundary(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Number of unit boundaries crossed from ``start`` to ``end`` (BIGINT).

    23:00 to 01:00 the next day is one day, although only two hours pass.
    """
    cell = _CELL[unit]
    return (cell(_c(end)) - cell(_c(start))).cast("bigint")


def trunc_to_date(unit: str, ts: ColumnLike) -> Column:
    """First day of the month, quarter or year holding ``ts``."""
    return F.trunc(_c(ts).cast("date"), unit)


def div0(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """0 when the denominator is 0, NULL when either side is NULL."""
    num, den = _c(numerator), _c(denominator)
    zero = F.when(num.isNotNull(), F.lit(0))
    return F.when(den == 0, zero).otherwise(F.try_divide(num, den))


def trunc0(number: ColumnLike) -> Column:
    """Drop the fraction, toward zero."""
    return _c(number).cast("bigint")


def dow0(day: ColumnLike) -> Column:
    """Day of week, Sunday = 0."""
    return F.dayofweek(_c(day)) - 1


def _null_if_any(columns: tuple[Column, ...], value: Column) -> Column:
    present = columns[0].isNotNull()
    for column in columns[1:]:
        present = present & column.isNotNull()
    return F.when(present, value)


def least_null(*columns: Column) -> Column:
    """LEAST that is NULL when any argument is NULL."""
    return _null_if_any(columns, F.least(*columns))


def greatest_null(*columns: Column) -> Column:
    """GREATEST that is NULL when any argument is NULL."""
    return _null_if_any(columns, F.greatest(*columns))


def json_object(**fields: Column) -> Column:
    """JSON text of an object; pairs whose value is NULL are left out."""
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


def init_cap(text: ColumnLike) -> Column:
    """Upper-case the first letter of each run of letters and digits, lower the rest.

    Spark's ``initcap`` only starts a word after white space; here punctuation
    starts one too. Each word start is marked with U+0001, then capitalised
    piece by piece.
    """
    marked = F.regexp_replace(F.lower(_c(text)), r"(?<![\p{L}\p{N}])(?=[\p{L}\p{N}])", "\u0001")
    pieces = F.split(marked, "\u0001")
    capitalised = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.array_join(capitalised, "")


def months_of_tenure(as_of: Column, since: ColumnLike) -> Column:
    """Whole months elapsed, fraction dropped."""
    return trunc0(F.months_between(as_of, _c(since), False))
