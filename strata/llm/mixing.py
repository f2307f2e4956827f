"""Mix sources to target weights by hash-random order and exact word budgets.

Sources in code-point order (null last) weigh ``weights`` in rotation and
share the words of the whole table; a target stops at ``max_epochs`` times its
source's size and the excess goes to the others by weight.  Inside a source,
rows are ordered by a hash of their id; a distributed prefix sum of sizes over
ranges of that hash places each row, and the mix takes whole epochs plus the
rows (the last one in part) up to the exact budget.

Defined results: null text has size 0; rows without words take 0 words; rows
with a null id order first; repeated rows each count (rows equal in id and
size are interchangeable in the result); an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the sources, in rotation; epochs allowed.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hex digits of the hash that cut a source into ranges: 16**3 ranges.
RANGE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    return F.coalesce(F.expr(r"size(regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+', 0))".format(text)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    The reshared targets are ``min(cap, level * weight)`` with one level for
    all; sorted by ``cap / weight`` the level follows from running sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on: the windows order the sources, never the documents
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    )
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    level = (F.sum("source_size").over(Window.partitionBy()) - (F.sum("cap").over(order) - F.col("cap"))) / (
        F.sum("weight").over(Window.partitionBy()) - (F.sum("weight").over(order) - F.col("weight"))
    )
    per = per.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    chosen = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    first_open = F.min(F.when(F.col("open"), F.col("cap") / F.col("weight"))).over(Window.partitionBy())
    per = per.withColumn("chosen", chosen).withColumn("first_open", first_open)
    held = F.coalesce(F.col("cap") / F.col("weight") >= F.col("first_open"), F.lit(False))
    return per.select(
        "source",
        "source_size",
        F.when(held, F.col("chosen") * F.col("weight")).otherwise(F.col("cap")).cast("double").alias("target"),
    )


def mix_sources(
    sizes: DataFrame, id_col: str = "doc_id", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, range_digits: int = RANGE_DIGITS
) -> DataFrame:
    """``id, source, size`` rows -> the same rows with their share of the mix.

    ``sizes`` is read twice (totals, then rows), so pass a stored table.
    """
    rows = sizes.select(
        F.col(id_col).alias("id"),
        "source",
        "size",
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
    ).withColumn("range", F.substring("key", 1, range_digits))
    targets = source_targets(rows, weights, max_epochs)
    # totals per (source, range): partial sums in each task, then a prefix sum over at most 16**range_digits ranges a source
    totals = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("ahead", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)))
    totals = totals.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    totals = totals.withColumnsRenamed({"source": "t_source", "range": "t_range"})
    within = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    out = placed.join(totals, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("range") == F.col("t_range")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("ahead") - F.col("before")
    return out.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).cast("long").alias("taken"),
        "source",
    )


def documents_mix(spark, docs: DataFrame, store, **options) -> DataFrame:
    """Mix a documents table; ``store`` writes a DataFrame to shared storage and reads it back."""
    sizes = docs.select("doc_id", "source", word_count("text").alias("size"))
    return mix_sources(store(sizes, "mix_sizes"), **options)
