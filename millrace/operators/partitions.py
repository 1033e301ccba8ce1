"""Tables partitioned by one column, changed partition by partition."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType


class UntouchedPartition(ValueError):
    """Rows for a partition that was not read, and would lose the rows it has."""


SMALL_TASK = 32 << 20  # bytes


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows laid out for a write partitioned by some columns, so that each value gives few files.

    Adaptive execution sizes the tasks: it splits a value that is large and joins small ones.
    Where the optimizer expects less than ``SMALL_TASK`` bytes a task whatever is done, opening
    files is the cost, and the values are dealt over all tasks. The input is not evaluated for this.
    """
    columns = [F.col(c) for c in partition_by]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    expected = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(tasks, *columns) if expected < tasks * SMALL_TASK else df.hint("rebalance", *columns)


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[Any]) -> None:
    """Remove some partition folders of a table."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for value in values:
        folder = hadoop.Path(f"{path}/{column}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class PartitionedTable:
    """Parquet at ``path`` in folders of ``column``, a date that ``value`` computes from a row's own columns.

    ``schema`` is that of the rows, without ``column``.
    """

    spark: SparkSession
    path: str
    schema: StructType
    value: Column
    column: str = "part"

    def create(self, rows: DataFrame) -> PartitionedTable:
        self._writer(rows).parquet(self.path)
        return self

    def read(self, values: list[Any] | None = None) -> DataFrame:
        """All rows, or those of some partitions; the files of others are not opened."""
        stored = StructType([*self.schema.fields, StructField(self.column, DateType())])
        rows = self.spark.read.schema(stored).parquet(self.path)
        if values is not None:
            rows = rows.where(F.col(self.column).isin(values))
        return rows.select(*self.schema.fieldNames())

    def touched(self, rows: DataFrame) -> list[Any]:
        """The partitions of some rows; one value a partition reaches the driver."""
        found = rows.select(self.value.alias("v")).where("v IS NOT NULL").distinct().collect()
        return sorted(r["v"] for r in found)

    def holding(self, keys: DataFrame, on: list[str]) -> list[Any]:
        """The partitions that hold some keys. Reads the key columns of the whole table, so it is for feeds without old dates."""
        stored = StructType([*[f for f in self.schema.fields if f.name in on], StructField(self.column, DateType())])
        found = self.spark.read.schema(stored).parquet(self.path).join(keys.select(*on), on, "left_semi").select(self.column).distinct()
        return sorted(r[0] for r in found.collect())

    def replace(self, rows: DataFrame, values: list[Any]) -> None:
        """Make ``rows`` the whole content of the partitions ``values``; others are left alone.

        ``rows`` must not read the table, since its files go. A partition is replaced when the
        whole job has succeeded; one without rows is removed.
        """
        filled = self.touched(rows)
        if not set(filled) <= set(values):
            raise UntouchedPartition(f"rows for {sorted(set(filled) - set(values))}")
        if filled:
            self._writer(rows).option("partitionOverwriteMode", "dynamic").parquet(self.path)
        drop_partitions(self.spark, self.path, self.column, [v for v in values if v not in set(filled)])

    def _writer(self, rows: DataFrame):
        placed = rows.select(*self.schema.fieldNames()).withColumn(self.column, self.value)
        return balanced(placed, [self.column]).write.mode("overwrite").partitionBy(self.column)
