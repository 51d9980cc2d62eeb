"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: labelled rows that a model is fitted on, at most; those with the smallest hash of their id
TRAINING_ROWS = 20_000


def crc_of(id: str) -> Column:
    """Unsigned CRC-32 of the id as text."""
    return F.crc32(F.col(id).cast("string").cast("binary"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int = TRAINING_ROWS, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, label, text) of at most `rows` labelled documents for which `train` (over column id) holds: the ids that are
    smallest by hash. Ids without a text, null ids and null labels are left out; an id labelled twice counts with the larger
    label, an id of several rows with the smallest text."""
    chosen = (labels.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
              .where(train).groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows))
    # the chosen ids are bounded by `rows`, so they may be broadcast
    found = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("text IS NOT NULL").join(F.broadcast(chosen), "id")
    return found.groupBy("id", "label").agg(F.min("text").alias("text"))
