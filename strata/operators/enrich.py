"""Star-style enrichment through left lookups.

Broadcast policy: a dimension is broadcast only behind a size check.  With
``broadcast="auto"`` (the default) no hint is given and Spark decides from
its size estimate against ``spark.sql.autoBroadcastJoinThreshold``; AQE also
turns a sort-merge join into a broadcast join at run time when the shuffled
side turns out small.  ``broadcast=True`` adds an explicit hint only when the
optimizer's size estimate is known and below ``max_broadcast_bytes``;
otherwise the join stays a shuffle join.  Nothing is broadcast on faith.

The estimate is that of compressed files.  In the hash table that the driver
builds a row may take fifty times as much, so tables that grow with the data
are held against a low limit, or counted (:func:`loaded_bytes`).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# The same for a table that grows with the data and whose rows nobody counted.
ESTIMATED_MAX_BROADCAST_BYTES = 4 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` in bytes, or None when unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        size = int(size) if isinstance(size, int) else int(size.toString())
    except Exception:
        return None
    # Spark reports an unknown size as Long.MaxValue (e.g. Python-local data)
    return None if size >= (1 << 63) - 1 else size


def can_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    size = estimated_size_bytes(df)
    return size is not None and size <= max_bytes


def loaded_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in the hash table of a broadcast join, about; counted in one job."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = sum(texts, F.lit(48 + 8 * len(df.columns)).cast("long"))
    return int(df.agg(F.sum(row)).first()[0] or 0)


def _one_per_key(dim: DataFrame, keys: list[str], aggs: Mapping[str, str]) -> DataFrame:
    exprs = [getattr(F, fn)(F.col(c)).alias(c) for c, fn in aggs.items()]
    return dim.groupBy(*keys).agg(*exprs)


def lookup(
    left: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    how: str = "left",
    cols: Sequence[str] | None = None,
    broadcast: bool | str = "auto",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    one_per_key: Mapping[str, str] | None = None,
) -> DataFrame:
    """Join ``dim`` onto ``left`` by key, keeping unmatched left rows by default.

    ``on`` is a column name or list (same name on both sides, USING form, key
    first in the output) or a mapping ``{left_col: dim_col}`` (dimension key
    dropped after the join).  ``cols`` narrows the dimension before the join.
    NULL keys never match but their rows stay (left join).  A dimension with
    repeated keys fans the left side out unless ``one_per_key`` (column ->
    aggregate function name, e.g. ``{"review_score": "max"}``) reduces it to
    one row per key first.
    """
    if isinstance(on, Mapping):
        left_keys, dim_keys = list(on.keys()), list(on.values())
    else:
        left_keys = [on] if isinstance(on, str) else list(on)
        dim_keys = left_keys
    if cols is not None:
        keep = list(dict.fromkeys(dim_keys + [c for c in cols if c not in dim_keys]))
        dim = dim.select(*keep)
    if one_per_key:
        dim = _one_per_key(dim, dim_keys, one_per_key)
    if broadcast is True and can_broadcast(dim, max_broadcast_bytes):
        dim = F.broadcast(dim)
    if left_keys == dim_keys:
        return left.join(dim, left_keys, how)
    renamed = dim
    tmp = []
    for lk, dk in zip(left_keys, dim_keys):
        t = f"__lk_{dk}"
        renamed = renamed.withColumnRenamed(dk, t)
        tmp.append((lk, t))
    cond = None
    for lk, t in tmp:
        term = left[lk] == renamed[t]
        cond = term if cond is None else cond & term
    return left.join(renamed, cond, how).drop(*[t for _, t in tmp])


def total_installments(
    payments: DataFrame, key: str = "order_id", value: str = "payment_installments", out: str = "payment_count"
) -> DataFrame:
    """Per-key sum of installments (A1).  The output is named like the reference
    table although it sums installments rather than counting payments."""
    return payments.groupBy(key).agg(F.sum(value).alias(out))


def enrich_orders(
    orders: DataFrame,
    customers: DataFrame,
    payments_agg: DataFrame,
    reviews: DataFrame,
    order_key: str = "order_id",
    customer_key: str = "customer_id",
    review_cols: Sequence[str] = ("review_score",),
    reviews_one_per_key: Mapping[str, str] | None = None,
) -> DataFrame:
    """orders LEFT customers LEFT payment totals LEFT reviews.

    Several reviews per order fan the order out (the reference's behaviour);
    pass ``reviews_one_per_key`` to reduce reviews to one row per order.
    """
    out = lookup(orders, customers, customer_key)
    out = lookup(out, payments_agg, order_key)
    return lookup(out, reviews, order_key, cols=list(review_cols), one_per_key=reviews_one_per_key)


def enrich_items(
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    translations: DataFrame,
    product_key: str = "product_id",
    seller_key: str = "seller_id",
    category_key: str = "product_category_name",
    small: Collection[str] | None = None,
) -> DataFrame:
    """items LEFT products LEFT sellers LEFT category dictionary.

    Each dimension gets a size-checked broadcast: a small one saves the items
    an exchange, a large one is joined by shuffle.  ``small`` names those that
    are known to be small (``"products"``, ``"sellers"``, ``"translations"``);
    the others are then not broadcast, whatever their estimate.
    """
    out = items
    for name, dim, key, most in (
        ("products", products, product_key, ESTIMATED_MAX_BROADCAST_BYTES),
        ("sellers", sellers, seller_key, ESTIMATED_MAX_BROADCAST_BYTES),
        ("translations", translations, category_key, DEFAULT_MAX_BROADCAST_BYTES),
    ):
        if small is None:
            out = lookup(out, dim, key, broadcast=True, max_broadcast_bytes=most)
        else:
            out = lookup(out, dim.hint("broadcast" if name in small else "merge"), key)
    return out
