"""Materialise an intermediate result where every executor can reach it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A folder of this machine is made up only for a local session that names none;
    on a cluster the setting is required, since a local path would be lost with
    its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table and return a reader over it.

    Cuts the lineage, fixes row order-dependent columns, and lets several
    consumers share one computation. Survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged = True
    return staged


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself when it is a staged table already, otherwise staged."""
    return df if getattr(df, "_staged", False) else stage(df, name)
