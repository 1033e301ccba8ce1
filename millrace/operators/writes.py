"""Row-level changes as pure DataFrame rewrites.

Parquet tables cannot be updated in place, so each function returns the complete
new table and the caller writes it to a new path.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.operators.ordered import global_row_number
from millrace.operators.staging import staged


DEFAULT = "default"  # key in a column's metadata: an SQL expression


def with_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Declare what a column gets when an INSERT does not name it; the table's schema carries it along."""
    return df.select(*[F.col(f.name).alias(f.name, metadata={**f.metadata, DEFAULT: defaults[f.name]}) if f.name in defaults else f.name for f in df.schema])


def default_of(f: StructField) -> Column:
    """A column's declared default, or NULL."""
    return F.expr(f.metadata[DEFAULT]) if DEFAULT in f.metadata else F.lit(None)


def apply_defaults(df: DataFrame, schema: StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Bring an INSERT's columns to the table schema; absent ones get the default given here, the declared one, or NULL."""
    present, given = set(df.columns), defaults or {}

    def column(f: StructField) -> Column:
        if f.name in present:
            return F.col(f.name)
        return given.get(f.name, default_of(f))

    return df.select(*[column(f).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])


def update_where(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE: rows for which the predicate is true get the new values."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.when(predicate, assignments[c]).otherwise(F.col(c)).cast(types[c]).alias(c)
            if c in assignments
            else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE: rows stay when the predicate is false or NULL."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_in(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """DELETE ... WHERE key IN (subquery)."""
    return df.join(keys_df.select(*on), on, "left_anti")


def assign_surrogate_keys(df: DataFrame, order: list[Column], key: str, start: int = 1) -> DataFrame:
    """Dense keys from ``start`` upward, in a total order, without a one-task window."""
    return global_row_number(df, order, key, start)


class KeyViolation(ValueError):
    """Rows break a table's declared keys."""


def check_keys(df: DataFrame, not_null: list[str], unique: list[str]) -> None:
    """Check declared NOT NULL columns and a primary key before a write; raise when rows break them.

    Spark does not enforce them. Only the two counts reach the driver.
    """
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null], F.lit(False))
    groups = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing"))
    found = groups.agg(F.sum("missing").alias("nulls"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    if found["nulls"] or found["repeated"]:
        raise KeyViolation(f"{found['nulls'] or 0} rows with NULL in {not_null}, {found['repeated']} repeated keys {unique}")


@dataclass(frozen=True)
class Matched:
    """WHEN MATCHED [AND when] THEN UPDATE SET ... | DELETE.

    Target columns are written ``t.x`` and source columns ``s.x``.
    """

    action: str  # "update" or "delete"
    when: Column | None = None
    set: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class NotMatched:
    """WHEN NOT MATCHED [AND when] THEN INSERT (columns) VALUES (...)."""

    values: dict[str, Column]
    when: Column | None = None


class MergeError(ValueError):
    """Two source rows would change the same target row."""


@dataclass(frozen=True)
class MergeResult:
    """``log`` holds every target and inserted row with its ``_action``."""

    log: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.log.where(F.col("_action") != "delete").drop("_action")

    @property
    def counts(self) -> DataFrame:
        return (
            self.log.where(F.col("_action") != "keep")
            .groupBy(F.col("_action").alias("action"))
            .agg(F.count(F.lit(1)).alias("n"))
        )


def _fires(clause: Matched | NotMatched) -> Column:
    return F.lit(True) if clause.when is None else F.coalesce(clause.when, F.lit(False))


def _joinable(keys: list[str], extra: Column | None) -> Column:
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return usable if extra is None else usable & F.coalesce(extra, F.lit(False))


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    matched: list[Matched] = (),
    not_matched: list[NotMatched] = (),
    target_scope: Column | None = None,
    source_is_unique: bool = False,
) -> MergeResult:
    """MERGE as a left join for the target's rows and an anti join for the new ones; the first clause that fires wins.

    * The feed is written once and read by both joins. Each of them has it, or keys
      found with it, on the side that the optimizer may broadcast, so a small feed does
      not shuffle the target.
    * Rows with a NULL key, and target rows outside ``target_scope``, never match.
      They stay out of the join: the target's pass through unshuffled and the
      source's can only be inserted.
    * Fails when two source rows would change the same target row.
      ``source_is_unique`` skips that check for a source grouped by the keys.
    * Columns not named by a clause keep the target's value; on insert they get their
      declared default, or NULL.
    """
    source = staged(source, "feed")
    if not source_is_unique and matched:
        _check_single_match(target, source, on, matched, target_scope)

    t_usable, s_usable = _joinable(on, target_scope), _joinable(on, None)
    t, s = target.where(t_usable).alias("t"), source.where(s_usable).withColumn("_here", F.lit(True)).alias("s")
    joined = t.join(s, reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on]), "left")

    # Number of the first clause that fires.
    tests = [F.col("s._here").isNotNull() & _fires(m) for m in matched]
    decided = joined.withColumn("_clause", _first_true(tests))
    action = F.when(F.col("_clause").isNull(), F.lit("keep"))
    for i, clause in enumerate(matched):
        action = action.when(F.col("_clause") == i, F.lit(clause.action))

    def column(f: StructField, otherwise: Column, numbered: list[tuple[int, dict[str, Column]]]) -> Column:
        value = otherwise
        for i, new in numbered:
            if f.name in new:
                value = F.when(F.col("_clause") == i, new[f.name]).otherwise(value)
        return value.cast(f.dataType).alias(f.name, metadata=f.metadata)

    changes = list(enumerate(m.set for m in matched))
    log = decided.select(action.alias("_action"), *[column(f, F.col(f"t.{f.name}"), changes) for f in target.schema])

    untouched = target.where(~t_usable).select(F.lit("keep").alias("_action"), *target.columns)
    log = log.unionByName(untouched)
    if not_matched:
        known = target.where(t_usable).select(*on).join(source.where(s_usable).select(*on), on, "left_semi")
        unmatched = source.where(s_usable).join(known, on, "left_anti").select(*source.columns).unionByName(source.where(~s_usable))
        decided = unmatched.alias("s").withColumn("_clause", _first_true([_fires(n) for n in not_matched]))
        inserts = list(enumerate(n.values for n in not_matched))
        added = decided.where(F.col("_clause").isNotNull()).select(
            F.lit("insert").alias("_action"), *[column(f, default_of(f), inserts) for f in target.schema]
        )
        log = log.unionByName(added)
    return MergeResult(log)


def _first_true(tests: list[Column]) -> Column:
    """Position of the first condition that holds, NULL when none does."""
    return F.coalesce(F.lit(None).cast("int"), *(F.when(test, F.lit(i)) for i, test in enumerate(tests)))


def _check_single_match(
    target: DataFrame, source: DataFrame, on: list[str], matched: list[Matched], target_scope: Column | None
) -> None:
    usable = source.where(_joinable(on, None))
    repeated = usable.groupBy(*on).count().where(F.col("count") > 1).select(*on)
    if repeated.isEmpty():
        return
    suspects = usable.join(repeated, on, "left_semi").alias("s")
    scoped = target.where(_joinable(on, target_scope)).withColumn("_row", F.monotonically_increasing_id()).alias("t")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])
    any_clause = reduce(lambda a, b: a | b, [_fires(m) for m in matched])
    clash = (
        scoped.join(suspects, same).where(any_clause).groupBy("t._row").count().where(F.col("count") > 1)
    )
    if not clash.isEmpty():
        raise MergeError(f"several source rows match one target row on {on}")
