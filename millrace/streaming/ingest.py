"""Files that arrive over time: auto-ingest, append-only feeds, and the streamed silver merge."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.partitions import PartitionedTable
from millrace.operators.staging import stage
from millrace.plans.cdc import apply_silver_batch
from millrace.sources.files import CORRUPT, ERROR, FILE, Delimited, delimited_options, text_schema, typed_delimited


def auto_ingest(
    spark: SparkSession, src: str, dst: str, checkpoint: str, schema: StructType, fmt: Delimited = Delimited()
) -> None:
    """Load delimited files that arrived since the last call into Parquet at ``dst``.

    The checkpoint remembers which files are done, so each is loaded once. Rows that
    do not fit go to ``dst`` + ``_rejects``.
    """
    text = (
        spark.readStream.schema(text_schema(schema))
        .options(**delimited_options(fmt))
        .option("recursiveFileLookup", True)
        .csv(src)
        .select(*[f.name for f in schema.fields], CORRUPT, F.col("_metadata.file_path").alias(FILE))
    )
    names = [f.name for f in schema.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch number is a partition: a batch that runs again replaces itself.
        def replace(df: DataFrame, path: str) -> None:
            tagged = df.withColumn("_batch", F.lit(batch_id))
            tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)

        typed = stage(typed_delimited(batch, schema, fmt), "ingested")
        replace(typed.where(F.col(ERROR).isNull()).select(*names), dst)
        replace(typed.where(F.col(ERROR).isNotNull()).select(FILE, CORRUPT, ERROR), f"{dst}_rejects")

    text.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_ingested(spark: SparkSession, dst: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(dst)


def append_feed(
    spark: SparkSession, src: str, checkpoint: str, schema: StructType, consume: Callable[[DataFrame, int], None]
) -> int:
    """Hand rows appended to a Parquet folder since the last call to ``consume``.

    Returns the number of batches with data; a batch without any is not handed on.
    """
    handed = 0

    def gate(batch: DataFrame, batch_id: int) -> None:
        nonlocal handed
        if not batch.isEmpty():
            consume(batch, batch_id)
            handed += 1

    stream = spark.readStream.schema(schema).parquet(src)
    stream.writeStream.foreachBatch(gate).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return handed


def stream_silver(
    spark: SparkSession, src: str, checkpoint: str, schema: StructType, table: PartitionedTable, as_of: datetime, sequence: str, files: int = 1000
) -> None:
    """Merge the change files that arrived below ``src`` since the last call into silver, ``files`` at most in a batch.

    The checkpoint numbers the batches and the table remembers the number on each row, so a batch
    that is handed out again changes nothing. Checkpoint and table belong together.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_silver_batch(table, batch, batch_id, as_of, sequence)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
