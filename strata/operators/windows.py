"""Running totals and trailing means over ordered rows.

By default both operators are one plain window: one exchange on the keys, one
pass.  That is the cheapest plan, and right as long as one task can hold the
rows of any key.  Building it starts no job.

A hot key (a handful of categories, one customer with a third of the rows)
would put its rows into a single task, and AQE splits joins only.  For that
case :func:`stage_pieces` stores the narrow input cut into contiguous *pieces*
along ``(keys, order)`` by Spark's own range exchange and keeps each row's
piece number.  With ``chunk`` naming that column (or any column that never
decreases along the ordering) the window runs per ``(key, chunk)``; a small
per-chunk summary (one row per chunk for the running total, at most ``rows -
1`` rows per chunk for the trailing mean) is carried across chunk borders and
joined back.

Ordering ties: pass enough ``order`` columns to make the order total, or at
least total up to rows that are equal in the output columns.  Rows equal in
every ordering column share a piece; nothing can cut them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import exact_sum
from strata.session import in_own_session

PIECE = "__piece"
_CH = "__chunk"

# Rows that one window task should hold at most.
DEFAULT_PIECE_ROWS = 2_000_000
# Ordering tuples the driver may hold while it chooses the range bounds.
_SAMPLED_TUPLES = 2_000_000
# Ranges that the driver chooses bounds for and starts tasks for; more only where one would hold too many rows.
_RANGES = 512
_RANGE_ROWS = 1_000_000
_SAMPLE_CONF = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def hottest_key(df: DataFrame, keys: Sequence[str]) -> int:
    """Exact row count of the key with most rows (partial counts in every task)."""
    top = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return int(top or 0)


def stage_pieces(
    stored: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, piece_rows: int = DEFAULT_PIECE_ROWS
) -> DataFrame:
    """Store ``stored`` at ``path`` in contiguous pieces along ``(keys, order)``.

    ``stored`` should be a stored table: it is counted, sampled for the range
    bounds and read once more.  There are about ``rows / piece_rows`` pieces,
    numbered in :data:`PIECE` along the ordering.

    Every range costs the driver a sample, a task and a file.  Small pieces
    therefore do not get a range each: beyond ``_RANGES`` the rows are dealt
    into fewer ranges, and each range is cut by its rows' ranks in the task
    that sorts it.  The sample per range shrinks as ranges grow in number, so
    the driver never holds more than about ``_SAMPLED_TUPLES`` ordering tuples;
    a coarse sample makes ranges less even, never wrong.
    """
    rows = stored.count()
    pieces = max(1, -(-rows // piece_rows))
    ranges = min(pieces, max(_RANGES, -(-rows // _RANGE_ROWS)))
    with in_own_session(stored) as (session, frame):  # the range exchange takes its sample size from its session when it runs
        sampled = min(int(session.conf.get(_SAMPLE_CONF)), _SAMPLED_TUPLES // ranges)
        session.conf.set(_SAMPLE_CONF, str(max(1, sampled)))
        cut = frame.repartitionByRange(ranges, *keys, *order).withColumn(PIECE, F.spark_partition_id().cast("long"))
        if ranges < pieces:  # a rank, not a row number: rows equal in every ordering column share a piece
            ahead = F.rank().over(Window.partitionBy(PIECE).orderBy(*keys, *order)) - 1
            ranked = cut.repartition(ranges, PIECE).withColumn("__ahead", ahead)
            number = F.shiftleft(PIECE, 32) + (F.col("__ahead") / piece_rows).cast("long")
            cut = ranked.withColumn(PIECE, number).drop("__ahead")
        cut.write.parquet(path)
    return stored.sparkSession.read.parquet(path)


_LOWEST_CHUNK = -(2**63)  # a NULL chunk number sorts first


def _partition_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Non-NULL stand-ins for nullable keys: (value or a type default, is-NULL flag).

    Window partitioning, the per-chunk summary and the join back all use the
    same plain columns, so the join finds the big side already partitioned
    and does not shuffle it again (a NULL-safe join condition would hash on
    different expressions and re-shuffle everything).
    """
    out_cols: list[str] = []
    added: list[str] = []
    for i, k in enumerate(keys):
        field = df.schema[k]
        dtype = field.dataType
        zero = None
        if isinstance(dtype, T.StringType):
            zero = F.lit("")
        elif isinstance(dtype, T.NumericType):
            zero = F.lit(0).cast(dtype)
        elif isinstance(dtype, T.BooleanType):
            zero = F.lit(False)
        elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            zero = F.lit("1970-01-01").cast(dtype)
        if not field.nullable or zero is None:  # no default for this type: NULLs join NULL-safely below
            out_cols.append(k)
            continue
        kz, kn = f"__kz{i}", f"__kn{i}"
        df = df.withColumns({kz: F.coalesce(F.col(k), zero), kn: F.col(k).isNull()})
        out_cols += [kz, kn]
        added += [kz, kn]
    return df, out_cols, added


def _join_back(big: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """LEFT join the per-chunk summary onto the rows on (partition keys, chunk)."""
    renamed = small.select(*[F.col(c).alias(f"__s{c}") for c in on], *[c for c in small.columns if c not in on])
    cond = None
    for c in on:
        term = big[c].eqNullSafe(renamed[f"__s{c}"]) if big.schema[c].nullable else big[c] == renamed[f"__s{c}"]
        cond = term if cond is None else cond & term
    return big.join(renamed, cond, "left").drop(*[f"__s{c}" for c in on])


def _chunked(df: DataFrame, keys: Sequence[str], chunk: str | Column) -> tuple[DataFrame, list[str], list[str]]:
    ch = F.col(chunk) if isinstance(chunk, str) else chunk
    return _partition_keys(df.withColumn(_CH, F.coalesce(ch.cast("long"), F.lit(_LOWEST_CHUNK))), keys)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "cumulative_sales",
    exact_scale: int | None = None,
    chunk: str | Column | None = None,
) -> DataFrame:
    """``sum(value)`` over ROWS UNBOUNDED PRECEDING .. CURRENT ROW per ``keys``.

    A plain sum by default; with ``exact_scale`` amounts on a decimal grid are
    summed as decimals, so the result does not depend on evaluation order.
    """
    keys, order = list(keys), list(order)

    def total(col: Column, over=None, precision: int = 18) -> Column:
        if exact_scale is not None:
            return exact_sum(col, exact_scale, over, precision)
        return F.sum(col) if over is None else F.sum(col).over(over)

    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, total(F.col(value), w))

    d, part, added = _chunked(df, keys, chunk)
    local_w = Window.partitionBy(*part, _CH).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.withColumn("__local", total(F.col(value), local_w))
    # Per-chunk totals come from a pruned, partially aggregated pass over the
    # input; the offset of a chunk is the sum of all earlier chunks of its key.
    totals = d.groupBy(*part, _CH).agg(total(F.col(value)).alias("__tot"))
    before = Window.partitionBy(*part).orderBy(_CH).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, _CH, total(F.col("__tot"), before, 38).alias("__off"))
    joined = _join_back(local, offsets, [*part, _CH])
    both = F.when(F.col("__local").isNull(), F.col("__off")).when(F.col("__off").isNull(), F.col("__local"))
    both = both.otherwise(F.col("__local") + F.col("__off"))
    if exact_scale is not None:  # the two parts lie on the grid; so must their sum
        both = F.when(F.abs(both) < F.lit(float("inf")), F.round(both, exact_scale)).otherwise(both)
    return joined.withColumn(out, both).drop("__local", "__off", _CH, *added)


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "rolling_avg",
    rows: int = 3,
    chunk: str | Column | None = None,
) -> DataFrame:
    """``avg(value)`` over ROWS BETWEEN ``rows - 1`` PRECEDING AND CURRENT ROW.

    Partial frames average what exists; NULL values are skipped like ``avg``.
    Result is ``double``.
    """
    if rows < 1:
        raise ValueError("rows must be >= 1")
    keys, order = list(keys), list(order)
    back = rows - 1
    if back == 0:  # a one-row frame is the row itself: no window, no shuffle
        return df.withColumn(out, F.col(value).cast("double"))
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-back, Window.currentRow)
        return df.withColumn(out, F.avg(F.col(value).cast("double")).over(w))

    d, part, added = _chunked(df, keys, chunk)
    w = Window.partitionBy(*part, _CH).orderBy(*order)
    frame = w.rowsBetween(-back, Window.currentRow)
    local = d.withColumns(
        {
            "__rn": F.row_number().over(w),
            "__s": F.sum(F.col(value)).over(frame),
            "__n": F.count(F.col(value)).over(frame),
        }
    )
    # The last `back` rows of every chunk; the `back` rows that precede any
    # chunk are always among them (earlier chunks contribute suffixes).  They
    # come straight from the input: a row_number limit lets Spark keep only
    # `back` rows per chunk in each map task (partial WindowGroupLimit), so
    # this branch shuffles a few rows per chunk, not the table.
    last_w = Window.partitionBy(*part, _CH).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tail = (
        d.select(*part, _CH, *order, value)
        .withColumn("__rd", F.row_number().over(last_w))
        .filter(F.col("__rd") <= back)
        .drop("__rd")
    )
    tw = Window.partitionBy(*part).orderBy(_CH, *order)
    lags = {f"__p{j}": F.lag(F.col(value), j).over(tw) for j in range(1, back + 1)}
    # the first tail row of a chunk is the one whose predecessor lies in another chunk
    prev_chunk = F.lag(_CH, 1).over(tw)
    carry = (
        tail.withColumns(lags)
        .withColumn("__first", prev_chunk.isNull() | (prev_chunk != F.col(_CH)))
        .filter(F.col("__first"))
        .select(*part, _CH, *lags.keys())
    )
    joined = _join_back(local, carry, [*part, _CH])

    extra_s = F.lit(0)
    extra_n = F.lit(0)
    for j in range(1, back + 1):
        p = F.col(f"__p{j}")
        needed = (F.col("__rn") <= rows - j) & p.isNotNull()
        extra_s = extra_s + F.when(needed, p).otherwise(F.lit(0))
        extra_n = extra_n + F.when(needed, F.lit(1)).otherwise(F.lit(0))
    total_s = F.coalesce(F.col("__s"), F.lit(0)) + extra_s
    total_n = F.col("__n") + extra_n
    mean = F.when(total_n > 0, total_s.cast("double") / total_n.cast("double"))
    return joined.withColumn(out, mean).drop("__rn", "__s", "__n", _CH, *lags.keys(), *added)
