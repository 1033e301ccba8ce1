"""Audited file loads and unloads.

Readers return (good rows, rejected rows). Every row keeps the name of its file,
and rejected rows keep their text and the reason.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.operators.partitions import balanced
from millrace.operators.staging import stage

CORRUPT = "_corrupt"
FILE = "_file"
ERROR = "_error"


class TooManyErrors(ValueError):
    """More rejected rows than the load allows."""


class MissingFile(FileNotFoundError):
    """A file that the manifest calls mandatory is not there."""


@dataclass(frozen=True)
class Delimited:
    """How a delimited file is written."""

    sep: str = "|"
    header: bool = True
    quote: str = '"'
    null_tokens: tuple[str, ...] = ("", "NULL")
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSS"
    encoding: str = "UTF-8"


@dataclass(frozen=True)
class Load:
    """``raw`` holds all parsed rows, with ``_error`` NULL on the good ones."""

    raw: DataFrame
    columns: list[str] = field(default_factory=list)

    @property
    def good(self) -> DataFrame:
        return self.raw.where(F.col(ERROR).isNull()).select(*self.columns)

    @property
    def rejects(self) -> DataFrame:
        return self.raw.where(F.col(ERROR).isNotNull()).select(FILE, CORRUPT, ERROR)


def _file_name() -> Column:
    return F.col("_metadata.file_path").alias(FILE)


def load_json(
    spark: SparkSession,
    paths: Iterable[str],
    schema: StructType,
    max_errors: int = 100,
    lengths: dict[str, int] | None = None,
    invalid_char: str = "?",
) -> Load:
    """JSON lines from a list of files (gzip is recognised by name).

    Long strings are cut to ``lengths``; bytes that are not UTF-8 become
    ``invalid_char``; the load fails when more than ``max_errors`` rows do not parse.
    Parsing happens once: the result is staged.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    # Lines are read as text first: the JSON reader rejects a row for one bad byte.
    lines = spark.read.text(list(paths)).select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias(FILE))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = (
        lines.where(F.trim("value") != "")
        .select(FILE, F.from_json("value", with_corrupt, options).alias("r"))
        .select("r.*", FILE)
    )
    lengths = lengths or {}

    def column(f: StructField) -> Column:
        value = F.col(f.name)
        if isinstance(f.dataType, StringType):
            value = F.replace(value, F.lit("�"), F.lit(invalid_char))
            if f.name in lengths:
                value = F.substring(value, 1, lengths[f.name])
        return value.alias(f.name)

    error = F.when(F.col(CORRUPT).isNotNull(), F.lit("not valid JSON for the declared schema"))
    names = [f.name for f in schema.fields]
    raw = stage(rows.select(*[column(f) for f in schema.fields], FILE, CORRUPT, error.alias(ERROR)), "json-load")
    load = Load(raw, names)
    rejected = load.rejects.count()
    if rejected > max_errors:
        raise TooManyErrors(f"{rejected} rows rejected, {max_errors} allowed")
    return load


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """The files of a manifest, ``{"entries": [{"url": ..., "mandatory": ...}]}``, that are there.

    Raises when a mandatory one is missing, before anything is read; an entry that does not say
    is optional. The manifest itself is one small file.
    """
    text = spark.read.text(path, wholetext=True).first()
    entries = json.loads(text[0] if text else "{}").get("entries", [])
    found = {e["url"]: _exists(spark, e["url"]) for e in entries}
    missing = sorted(e["url"] for e in entries if e.get("mandatory") and not found[e["url"]])
    if missing:
        raise MissingFile(f"{len(missing)} mandatory files are missing, the first is {missing[0]}")
    return [url for url in found if found[url]]


def load_manifest(spark: SparkSession, path: str, schema: StructType, **how) -> Load:
    """JSON lines of the files that a manifest lists, each once; ``how`` is passed to ``load_json``."""
    paths = read_manifest(spark, path)
    if not paths:
        empty = spark.createDataFrame([], StructType([*schema.fields, *[StructField(c, StringType()) for c in (FILE, CORRUPT, ERROR)]]))
        return Load(empty, [f.name for f in schema.fields])
    return load_json(spark, paths, schema, **how)


def load_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that each hold one JSON array; every element is a row."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def typed_delimited(text: DataFrame, schema: StructType, fmt: Delimited) -> DataFrame:
    """Text columns to the declared types, with ``_error`` naming the first column that does not fit."""

    def cleaned(name: str) -> Column:
        return F.when(~F.col(name).isin(*fmt.null_tokens), F.col(name))

    def typed(f: StructField) -> Column:
        if f.dataType.typeName().startswith("timestamp"):
            return F.try_to_timestamp(cleaned(f.name), F.lit(fmt.timestamp_format)).cast(f.dataType)
        return cleaned(f.name).try_cast(f.dataType)

    error = F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of columns"))
    for f in schema.fields:
        bad = cleaned(f.name).isNotNull() & typed(f).isNull()
        error = error.when(bad, F.concat(F.lit(f"{f.name}: cannot read as {f.dataType.simpleString()}: "), F.col(f.name)))
    return text.select(*[typed(f).alias(f.name) for f in schema.fields], FILE, CORRUPT, error.alias(ERROR))


def text_schema(schema: StructType) -> StructType:
    return StructType([*[StructField(f.name, StringType()) for f in schema.fields], StructField(CORRUPT, StringType())])


def delimited_options(fmt: Delimited) -> dict[str, str]:
    return {
        "sep": fmt.sep,
        "header": str(fmt.header).lower(),
        "quote": fmt.quote,
        "encoding": fmt.encoding,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # Files are read by position, as the source system does.
        "enforceSchema": "true",
    }


def load_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, fmt: Delimited = Delimited(), pattern: str | None = None
) -> Load:
    """Delimited files below ``path`` (or of a list) whose full name matches ``pattern``; bad rows are set aside."""
    reader = spark.read.schema(text_schema(schema)).options(**delimited_options(fmt))
    rows = reader.option("recursiveFileLookup", True).csv(path)
    if pattern:
        rows = rows.where(F.col("_metadata.file_path").rlike(f"^(?:{pattern})$"))
    text = rows.select(*[f.name for f in schema.fields], CORRUPT, _file_name())
    return Load(typed_delimited(text, schema, fmt), [f.name for f in schema.fields])


def load_audit(raw: DataFrame) -> DataFrame:
    """One row per loaded file: status, rows loaded, rows parsed, first error."""
    ok = F.col(ERROR).isNull()
    numbered = raw.withColumn("_at", F.monotonically_increasing_id())
    per_file = numbered.groupBy(F.col(FILE).alias("file_name")).agg(
        F.count_if(ok).alias("row_count"),
        F.count(F.lit(1)).alias("row_parsed"),
        F.min_by(F.col(ERROR), F.when(~ok, F.col("_at"))).alias("first_error_message"),
    )
    status = (
        F.when(F.col("row_count") == F.col("row_parsed"), "LOADED")
        .when(F.col("row_count") > 0, "PARTIALLY_LOADED")
        .otherwise("LOAD_FAILED")
    )
    return per_file.select("file_name", status.alias("status"), "row_count", "row_parsed", "first_error_message")


LEDGER_SCHEMA = (
    "file_name string, status string, row_count bigint, row_parsed bigint, first_error_message string,"
    " table_name string, load_time timestamp_ntz"
)


@dataclass(frozen=True)
class LoadHistory:
    """A ledger at ``path`` of the files loaded into tables: their load time, rows and first error."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def since(self, table: str, at: datetime) -> DataFrame:
        """Files loaded into a table at or after a time."""
        return self.rows().where((F.col("table_name") == table) & (F.col("load_time") >= F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")))

    def load(
        self, table: str, dst: str, root: str, schema: StructType, load_time: datetime, fmt: Delimited = Delimited(), pattern: str | None = None
    ) -> int:
        """Load the delimited files below ``root`` that the ledger does not have into ``dst``; returns their number.

        Rows go into a folder of the load time before the files are noted. A load that stopped
        between the two is repeated under its own load time and replaces its folder, so it neither
        loses nor doubles a file. A file without a single good row is noted as failed and not tried again.
        """
        stamp = load_time.strftime("%Y-%m-%dT%H-%M-%S")
        # Only names are listed here; the reader is handed the new files' names by the driver in any case.
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.col("path").alias("file_name"))
        if pattern:
            listed = listed.where(F.col("file_name").rlike(f"^(?:{pattern})$"))
        known = self.rows().where(F.col("table_name") == table)
        new = [r[0] for r in listed.join(known, "file_name", "left_anti").collect()]
        if not new:
            return 0
        fresh = stage(load_csv(self.spark, new, schema, fmt).raw, "load")
        audit = load_audit(fresh)
        names = [f.name for f in schema.fields]
        fresh.where(F.col(ERROR).isNull()).select(*names).write.mode("overwrite").parquet(f"{dst}/load={stamp}")
        noted = audit.select("*", F.lit(table).alias("table_name"), F.lit(load_time.isoformat(sep=" ")).cast("timestamp_ntz").alias("load_time"))
        noted.coalesce(1).write.mode("append").parquet(self.path)
        return len(new)


def filename_date(spark: SparkSession, root: str, schema: StructType, pattern: str = r".*[.]parquet", start: int = 17) -> DataFrame:
    """Parquet files with a date cut from characters ``start`` .. ``start + 9`` of their path below ``root``.

    The folder is listed again on every call, so new files are seen. A relative root is taken from
    the working folder, as the reader does.
    """
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
    full = F.col("_metadata.file_path")
    # The part below the root is cut by the root's length, both without scheme and host.
    location = spark._jvm.org.apache.hadoop.fs.Path(root)
    location = location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location)
    base = location.toUri().getRawPath().rstrip("/")
    below = F.substr(F.regexp_replace(full, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit(len(base) + 2))
    return rows.where(full.rlike(f"^(?:{pattern})$")).select(
        "*", F.try_to_date(F.substring(below, start, 10), "yyyy-MM-dd").alias("file_date")
    )


def unload(df: DataFrame, path: str, partition_by: list[str], max_records: int = 2_000_000) -> None:
    """Replace ``path`` with Parquet files partitioned by some columns, cut by number of rows."""
    writer = balanced(df, partition_by).write.mode("overwrite")
    writer.option("maxRecordsPerFile", max_records).partitionBy(*partition_by).parquet(path)


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and bytes of file-backed tables, the largest first. Each file is counted before files are summed."""
    result = None
    for name, df in tables.items():
        per_file = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).groupBy("f", "b").count()
        one = per_file.agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")
        ).select(F.lit(name).alias("table_name"), "row_count", "bytes")
        result = one if result is None else result.unionByName(one)
    return result if result is None else result.orderBy(F.col("bytes").desc(), "table_name")  # one row a table
