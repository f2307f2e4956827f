"""Bounded, reproducible samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: tuple[int, int]) -> DataFrame:
    """``doc_id, text, y``: at most ``per_class[y]`` training documents of class ``y``.

    Rows held out never enter.  The choice is by a hash of the id, so reruns
    agree.  Only label rows are ranked; at most ``sum(per_class)`` ids are
    broadcast to fetch the texts.  Of several rows with one id the text first by
    hash is taken; an id labelled both ways counts as 1.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out).groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64("doc_id", F.lit(label))
    chosen = [known.filter(F.col("y") == y).orderBy(order, "doc_id").limit(per_class[y]) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y")
    return rows.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")).select("doc_id", "row.text", "y")
