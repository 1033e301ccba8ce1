"""Ordered computations per key that stay balanced when one key is huge.

``Window.partitionBy(key)`` puts all rows of a key into one task. That is right
for ordinary keys and fatal for a key that holds a third of the table. The
functions here first count rows per key (a map-side combined aggregate over the
key columns only). Ordinary keys go through the plain window. Keys over the limit
are range-partitioned on (key, order), which splits a key over many tasks, and
each part then adds what the parts before it carry over: row count, running sums,
last rows, first row. The carried summaries number one per (key, part).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.staging import stage

# Rows of one key that a single task may sort (with spill).
HOT_KEY_ROWS = 5_000_000


@dataclass(frozen=True)
class Scan:
    """Columns to add, each computed in order within a key."""

    row_number: str | None = None
    running_sums: dict[str, str] = field(default_factory=dict)  # new column -> source column
    lags: dict[str, tuple[str, int]] = field(default_factory=dict)  # new column -> (source, offset)
    firsts: dict[str, str] = field(default_factory=dict)  # new column -> source column


def match_keys(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    )


def hot_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame | None:
    """Keys with more than ``limit`` rows, staged; None when there are none.

    At most (rows of ``df``) / ``limit`` keys can qualify.
    """
    limit = HOT_KEY_ROWS if limit is None else limit
    counted = df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys)
    if counted.isEmpty():
        return None
    return stage(counted, "hot-keys")


@dataclass(frozen=True)
class Hot:
    """The outcome of a look for hot keys, to share between steps over the same keys."""

    keys: DataFrame | None


def split_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    on = match_keys("d", "h", keys)
    return (
        df.alias("d").join(hot.alias("h"), on, "left_anti"),
        df.alias("d").join(hot.alias("h"), on, "left_semi"),
    )


def find_hot(df: DataFrame, keys: list[str], limit: int | None = None) -> Hot:
    return Hot(hot_keys(df.select(*keys), keys, limit))


def ordered_scan(
    df: DataFrame, keys: list[str], order: list[Column], scan: Scan, hot: Hot | None = None
) -> DataFrame:
    """Add the columns of ``scan``. ``order`` must be a total order within a key.

    Pass ``hot`` when the hot keys of these rows are known already.
    """
    hot = hot or find_hot(df, keys)
    if hot.keys is None:
        return _plain(df, keys, order, scan)
    ordinary, huge = split_hot(df, hot.keys, keys)
    plain = _plain(ordinary, keys, order, scan)
    carried = _in_parts(huge, keys, order, scan)
    same_types = [F.col(f.name).cast(f.dataType).alias(f.name) for f in plain.schema]
    return plain.unionByName(carried.select(*same_types))


def _plain(df: DataFrame, keys: list[str], order: list[Column], scan: Scan) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added: dict[str, Column] = {}
    if scan.row_number:
        added[scan.row_number] = F.row_number().over(window).cast("bigint")
    for name, source in scan.running_sums.items():
        added[name] = F.sum(source).over(running)
    for name, (source, offset) in scan.lags.items():
        added[name] = F.lag(source, offset).over(window)
    for name, source in scan.firsts.items():
        added[name] = F.first(source).over(running)
    return df.select("*", *[column.alias(name) for name, column in added.items()])


def _ranged(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows written in global (key, order) order, with the part each row is in.

    The table is written before use, so the part of a row cannot change between
    two reads or when a task is run again.
    """
    sort = [F.col(k).asc() for k in keys] + order
    # No number of parts: adaptive execution merges neighbouring ranges that are small.
    ordered = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    return stage(ordered.withColumn("_part", F.spark_partition_id()), "ranged")


def _in_parts(df: DataFrame, keys: list[str], order: list[Column], scan: Scan) -> DataFrame:
    rows = _ranged(df, keys, order)
    group = [*keys, "_part"]
    local = Window.partitionBy(*group).orderBy(*order)
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = max([offset for _, offset in scan.lags.values()], default=0)
    lag_sources = sorted({source for source, _ in scan.lags.values()})

    numbered = rows.withColumn("_rn", F.row_number().over(local).cast("bigint"))
    for name, source in scan.running_sums.items():
        numbered = numbered.withColumn(f"_sum_{name}", F.sum(source).over(running))
    for name, (source, offset) in scan.lags.items():
        numbered = numbered.withColumn(f"_lag_{name}", F.lag(source, offset).over(local))
    for name, source in scan.firsts.items():
        numbered = numbered.withColumn(f"_first_{name}", F.first(source).over(running))

    # One row per (key, part): totals, first values, and the last `depth` rows.
    totals = [F.count(F.lit(1)).alias("_n")]
    totals += [F.sum(source).alias(f"_t_{name}") for name, source in scan.running_sums.items()]
    totals += [
        F.max(F.when(F.col("_rn") == 1, F.struct(F.col(source).alias("v")))).alias(f"_f_{name}")
        for name, source in scan.firsts.items()
    ]
    summary = numbered.groupBy(*group).agg(*totals)
    if depth:
        backwards = Window.partitionBy(*group).orderBy(F.col("_rn").desc())
        ends = (
            numbered.select(*group, "_rn", *lag_sources)
            .withColumn("_back", F.row_number().over(backwards))
            .where(F.col("_back") <= depth)
            .groupBy(*group)
            .agg(F.sort_array(F.collect_list(F.struct("_back", *lag_sources))).alias("_tail"))
        )
        summary = _join_group(summary, ends, group, ["_tail"])

    before = Window.partitionBy(*keys).orderBy("_part")
    so_far = before.rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_c_n")]
    carry += [F.sum(f"_t_{name}").over(so_far).alias(f"_c_sum_{name}") for name in scan.running_sums]
    carry += [F.first(f"_f_{name}").over(so_far).alias(f"_c_first_{name}") for name in scan.firsts]
    if depth:
        tails = F.concat(*[F.coalesce(F.lag("_tail", i).over(before), F.array()) for i in range(1, depth + 1)])
        carry.append(tails.alias("_c_tail"))
    carried = summary.select(*group, *carry)

    joined = _join_group(numbered, carried, group, [c for c in carried.columns if c not in group])
    out: dict[str, Column] = {}
    if scan.row_number:
        out[scan.row_number] = F.col("_rn") + F.col("_c_n")
    for name in scan.running_sums:
        own, earlier = F.col(f"_sum_{name}"), F.col(f"_c_sum_{name}")
        out[name] = F.when(own.isNull(), earlier).when(earlier.isNull(), own).otherwise(own + earlier)
    for name, (source, offset) in scan.lags.items():
        reach = F.lit(offset).cast("bigint") - F.col("_rn")
        earlier = F.get(F.col("_c_tail"), reach.cast("int"))[source]
        out[name] = F.when(reach >= 0, earlier).otherwise(F.col(f"_lag_{name}"))
    for name in scan.firsts:
        earlier = F.col(f"_c_first_{name}")
        out[name] = F.when(F.col("_c_n") > 0, earlier["v"]).otherwise(F.col(f"_first_{name}"))
    return joined.select(*df.columns, *[column.alias(name) for name, column in out.items()])


def _join_group(left: DataFrame, right: DataFrame, group: list[str], keep: list[str]) -> DataFrame:
    on = match_keys("l", "r", group)
    return left.alias("l").join(right.alias("r"), on, "left").select("l.*", *[F.col(f"r.`{c}`") for c in keep])


def global_row_number(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Dense numbering of the whole table in ``order``, without a one-task window.

    ``order`` must be a total order.
    """
    # The rows are sorted and numbered within their part as they are written; the only
    # shuffle is the one by range.
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stage(ordered.withColumns({"_part": F.shiftright(place, 33), "_rn": place.bitwiseAND(F.lit((1 << 33) - 1)) + 1}), "numbered")
    # One row per range part, so the unpartitioned window below sees at most
    # spark.sql.shuffle.partitions rows.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return numbered.join(offsets, "_part").select(
        *df.columns, (F.col("_rn") + F.col("_offset") + (start - 1)).cast("bigint").alias(name)
    )


def qualify_topn(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """First ``n`` rows per key. Spark limits each key map-side before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n).withColumn(
        name, F.col(name).cast("bigint")
    )


def exact_percentile(
    df: DataFrame, keys: list[str], values: dict[str, str], p: float, hot: Hot | None = None
) -> DataFrame:
    """Interpolated percentile of each column of ``values`` (new name -> source) per key.

    Ordinary groups use the built-in aggregate. Its buffer holds the distinct
    values of a group, so groups over the limit are ranked with a partitioned scan
    instead and only the two middle rows are read.
    """
    hot = hot or find_hot(df, keys)
    builtin = [F.percentile(F.col(source), F.lit(p)).alias(name) for name, source in values.items()]
    if hot.keys is None:
        return df.groupBy(*keys).agg(*builtin)
    ordinary, huge = split_hot(df, hot.keys, keys)
    result = None
    for name, source in values.items():
        one = _ranked_percentile(huge.select(*keys, source), keys, source, p, name)
        result = one if result is None else _join_group(result, one, keys, [name])
    return ordinary.groupBy(*keys).agg(*builtin).unionByName(result)


def _ranked_percentile(df: DataFrame, keys: list[str], source: str, p: float, name: str) -> DataFrame:
    # Equal values are counted first, so copies of one value never meet in a sort.
    weights = df.groupBy(*keys, source).agg(F.count(source).alias("_w"))
    upto = _in_parts(weights, keys, [F.col(source).asc_nulls_last()], Scan(running_sums={"_cum": "_w"}))
    totals = weights.groupBy(*keys).agg(F.sum("_w").alias("_n"))
    position = (F.col("_n") - 1) * F.lit(p)
    low, high = F.floor(position), F.ceil(position)
    placed = _join_group(upto, totals, keys, ["_n"])

    def covers(rank: Column) -> Column:
        return (rank >= F.col("_cum") - F.col("_w")) & (rank < F.col("_cum"))

    ends = placed.groupBy(*keys).agg(
        F.max(F.when(covers(low), F.col(source))).alias("_lo"),
        F.max(F.when(covers(high), F.col(source))).alias("_hi"),
        F.max(position - low).alias("_f"),
    )
    value = F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))
    return ends.select(*keys, value.cast("double").alias(name))
