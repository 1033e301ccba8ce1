"""Labelled rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no classifier learns from: crc32 of the id, as text, divisible by 5."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, y): about ``most`` labelled rows at most, chosen by a hash of the id; all of them if there are fewer.

    Rows without a label, and held-out rows, are left out. A document that is labelled
    more than once counts with its largest label.
    """
    known = labels.filter(F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    count = known.count()
    if count > most:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(most / count * (1 << 30)))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # bounded by ``most``
