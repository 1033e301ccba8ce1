"""Stored high-water marks of surrogate keys, so that no run gives out a key of an earlier one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "table_name string, last_key bigint, run_id string"


@dataclass(frozen=True)
class KeyMarks:
    """An append-only table at ``path``; the largest mark of a table counts, so a repeated row changes nothing."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        location = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not location.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(location):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def last(self, table: str) -> int:
        """The largest key given out so far, 0 when there is none."""
        return self.rows().where(F.col("table_name") == table).agg(F.max("last_key")).first()[0] or 0

    def advance(self, table: str, rows: DataFrame, key: str, run_id: str) -> int:
        """Note the largest key of ``rows``, before any later run looks. One number reaches the driver."""
        largest = max(self.last(table), rows.agg(F.max(key)).first()[0] or 0)
        self.spark.createDataFrame([(table, largest, run_id)], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return largest
