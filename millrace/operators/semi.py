"""Semi-structured operators on JSON text, through Spark's variant type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path(variant: Column, where: str, as_type: str) -> Column:
    """Navigate and cast; NULL when the path is missing or the value does not cast."""
    return F.try_variant_get(variant, where, as_type)


def array_size(variant: Column, where: str) -> Column:
    """Length of a navigated array, NULL when there is none."""
    items = F.try_variant_get(variant, where, "array<variant>")
    return F.when(items.isNotNull(), F.size(items))


def flatten(df: DataFrame, column: str, where: str, outer: bool = False) -> DataFrame:
    """One row per element of the array at ``where``: adds ``idx`` and ``item``."""
    items = F.try_variant_get(F.col(column), where, "array<variant>")
    explode = F.posexplode_outer if outer else F.posexplode
    return df.select("*", explode(items).alias("idx", "item"))


def object_entries(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """One row per key of a JSON object: adds ``key_name`` and ``key_value`` (text)."""
    entries = df.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col(column).outer()).select(
            F.col("key").alias("key_name"), F.col("value").alias("_value")
        )
    )
    text = F.when(
        ~F.is_variant_null("_value"),
        F.coalesce(F.try_variant_get(F.col("_value"), "$", "string"), F.to_json(F.col("_value"))),
    )
    return entries.where(F.col("key_name").isNotNull()).select(*keep, "key_name", text.alias("key_value"))


def split_kv(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``a=1, b=2`` text to one row per pair; tokens without ``=`` are skipped."""
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    token = F.col("_token")
    at = F.instr(token, "=")
    return (
        df.select(*keep, F.explode(F.split(F.col(column), ",")).alias("_token"))
        .where(at > 0)
        .select(
            *keep,
            strip(F.substring(token, F.lit(1), at - 1)).alias("k"),
            strip(F.substr(token, at + 1)).alias("v"),
        )
    )
