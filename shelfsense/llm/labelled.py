"""The labelled rows classifiers may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: Column | str) -> Column:
    """True where crc32 of the id as text leaves no remainder modulo 5 (a null id: false)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, label: str, max_rows: int, per_class: bool = False) -> DataFrame:
    """At most ``max_rows`` (doc_id, y) of rows that are not held out, the lowest by a hash of the id.

    With ``per_class`` up to half of them come from each class. Several labels
    of one document count as their maximum; null labels and ids are left out.
    """
    rows = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
            .filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(~held_out("doc_id"))
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if not per_class:
        return rows.orderBy(*order).limit(max_rows)
    half = max_rows // 2
    return (rows.filter("y = 1").orderBy(*order).limit(half)
            .unionAll(rows.filter("y <> 1").orderBy(*order).limit(max_rows - half)))


def training_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text, y) of the sampled ids; the sample is bounded, so it is broadcast."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.join(F.broadcast(ids), "doc_id")
