"""Sessions, interval joins and event sequences on timestamped rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scoring import amount_bucket
from millrace.functions.semantics import datediff_boundary, order_asc
from millrace.operators.ordered import Hot, Scan, exact_percentile, find_hot, match_keys, ordered_scan
from millrace.operators.staging import stage


def sessionise(
    df: DataFrame, key: str, ts: str, tiebreak: str, gap_s: int, hot: Hot | None = None
) -> DataFrame:
    """Add ``is_session_start`` and ``session_no``; a gap of more than ``gap_s`` opens a session.

    ``hot`` holds the users with very many events, looked for here when not given.
    """
    hot = hot or find_hot(df, [key])
    order = [order_asc(ts), order_asc(tiebreak)]
    seen = ordered_scan(df, [key], order, Scan(lags={"_prev_ts": (ts, 1)}), hot)
    opens = F.col("_prev_ts").isNull() | (datediff_boundary("second", "_prev_ts", ts) > gap_s)
    flagged = seen.withColumn("is_session_start", F.when(opens, 1).otherwise(0)).drop("_prev_ts")
    numbered = ordered_scan(flagged, [key], order, Scan(running_sums={"session_no": "is_session_start"}), hot)
    return numbered.withColumn("session_no", F.col("session_no").cast("bigint"))


def session_metrics(df: DataFrame, hot: Hot | None = None) -> DataFrame:
    """One row per session of typed, sessionised events.

    ``hot`` holds the sessions with very many events, looked for here when not given.
    ``country`` and ``device_type`` take the smallest value where the source takes
    any, so that reruns agree.
    """
    keys = ["user_id", "session_no"]
    gmv = F.sum(F.coalesce("order_total", F.lit(0).cast("decimal(12,2)"))).cast("decimal(12,2)")
    totals = [
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        gmv.alias("gmv"),
        # Distinct sources only, so the set stays small however long the session.
        F.array_join(F.sort_array(F.collect_set("utm_source")), "|").alias("_sources"),
        F.min("device_type").alias("device_type"),
        F.min("country").alias("country"),
    ]
    medians = {"median_lat": "lat", "median_lon": "lon"}
    hot = hot or find_hot(df, keys)
    if hot.keys is None:
        # One pass: the medians' buffers are bounded by the session's size.
        builtin = [F.percentile(F.col(source), F.lit(0.5)).alias(name) for name, source in medians.items()]
        sessions = df.groupBy(*keys).agg(*totals, *builtin)
    else:
        exact = exact_percentile(df, keys, medians, 0.5, hot).alias("m")
        sessions = df.groupBy(*keys).agg(*totals).alias("t").join(exact, match_keys("t", "m", keys), "left")
        sessions = sessions.select("t.*", *medians)
    return sessions.select(
        *keys,
        "session_start",
        "session_end",
        datediff_boundary("second", "session_start", "session_end").alias("duration_s"),
        "event_count",
        "gmv",
        amount_bucket(F.col("gmv")).alias("gmv_bucket"),
        F.nullif(F.col("_sources"), F.lit("")).alias("utm_sources"),
        *medians,
        "device_type",
        "country",
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    ts: str,
    start: str,
    end: str,
    bucket_s: int = 21_600,
) -> DataFrame:
    """Left join on equal keys and ``ts BETWEEN start AND end``.

    An interval of up to ``SHORT`` time buckets is repeated once per bucket and joined on
    (key, bucket), so the rows of one busy key are compared only with the intervals of their
    own bucket and spread over tasks by time. A longer one is cut into dyadic cells, two at most
    of each width of 1, 2, 4 ... buckets, so an interval open to the end of time has some fifty
    cells; rows look for it under every width in use. ``right`` columns are those of ``right``
    other than the keys.
    """

    def bucket(at: Column) -> Column:
        seconds = (
            F.unix_date(at.cast("date")).cast("bigint") * 86_400
            + F.hour(at) * 3_600
            + F.minute(at) * 60
            + F.second(at)
        )
        return F.floor(seconds / bucket_s)

    added = [c for c in right.columns if c not in keys]
    ends = right.where(F.col(start) <= F.col(end)).withColumns({"_from": bucket(F.col(start)), "_to": bucket(F.col(end))})
    ends = stage(ends, "intervals")

    def meet(rows: DataFrame, intervals: DataFrame, at: list[str], how: str) -> DataFrame:
        equal = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, *at]]
        inside = F.col(f"l.{ts}").between(F.col(f"r.{start}"), F.col(f"r.{end}"))
        joined = rows.alias("l").join(intervals.alias("r"), reduce(lambda a, b: a & b, [*equal, inside]), how)
        kept = [c for c in rows.columns if c not in at]
        return joined.select(*[F.col(f"l.{c}") for c in kept], *[F.col(f"r.{c}") for c in added])

    is_short = F.col("_to") - F.col("_from") < SHORT
    short = ends.where(is_short).withColumn("_cell", F.explode(F.sequence("_from", "_to")))
    cells = F.explode(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(WIDTHS)), _dyadic_cells)))
    long = ends.where(~is_short).select("*", cells.alias("_c")).select("*", F.col("_c.width").alias("_width"), F.col("_c.cell").alias("_cell"))
    widths = [r[0] for r in long.select("_width").distinct().collect()]  # at most WIDTHS + 1
    if not widths:
        return meet(left.withColumn("_cell", bucket(F.col(ts))), short, ["_cell"], "left")

    # A row may meet intervals of several widths, so the rows that meet none are found by number.
    numbered = stage(left.withColumn("_row", F.monotonically_increasing_id()), "interval-rows")
    near = meet(numbered.withColumn("_cell", bucket(F.col(ts))), short, ["_cell"], "inner")
    looking = numbered.withColumn("_width", F.explode(F.array(*[F.lit(w) for w in widths])))
    looking = looking.withColumn("_cell", F.floor(bucket(F.col(ts)) / F.pow(F.lit(2.0), F.col("_width"))))
    met = near.unionByName(meet(looking, long, ["_width", "_cell"], "inner"))
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added]
    alone = numbered.join(met.select("_row").distinct(), "_row", "left_anti").select(*numbered.columns, *nulls)
    return met.unionByName(alone).drop("_row")


SHORT = 16  # buckets that an interval may be repeated for
WIDTHS = 40  # doublings of the bucket; 2^40 buckets of a second are 35,000 years


def _dyadic_cells(width: Column) -> Column:
    """The cells of 2^width buckets in _from .. _to that no wider cell in there holds: two at most.

    An odd one that starts the range and an even one that ends it have parents reaching out of it.
    """
    size = F.pow(F.lit(2.0), width)
    first, last = F.ceil(F.col("_from") / size), F.floor((F.col("_to") + 1) / size) - 1
    inside = first <= last
    at_start = F.when(inside & (F.pmod(first, F.lit(2)) == 1), first)
    at_end = F.when(inside & (F.pmod(last, F.lit(2)) == 0), last)
    cells = F.array_distinct(F.filter(F.array(at_start, at_end), lambda c: c.isNotNull()))
    return F.transform(cells, lambda c: F.struct(width.alias("width"), c.alias("cell")))


def sequence_match(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: str,
    state: str,
    states: tuple[str, str, str],
    max_days: tuple[int, int],
    names: tuple[str, str, str],
    hot: Hot | None = None,
) -> DataFrame:
    """Three adjacent rows of a key in the given states, each step within its day limit.

    Only neighbouring rows are compared: any other state in between breaks the match.
    """
    scan = Scan(lags={"_s2": (state, 2), "_s1": (state, 1), "_t2": (ts, 2), "_t1": (ts, 1)})
    seen = ordered_scan(df, [key], [order_asc(ts), order_asc(tiebreak)], scan, hot)
    first, second, third = states
    return seen.where(
        (F.col("_s2") == first)
        & (F.col("_s1") == second)
        & (F.col(state) == third)
        & (datediff_boundary("day", "_t2", "_t1") <= max_days[0])
        & (datediff_boundary("day", "_t1", ts) <= max_days[1])
    ).select(key, F.col("_t2").alias(names[0]), F.col("_t1").alias(names[1]), F.col(ts).alias(names[2]))
