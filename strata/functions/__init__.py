"""Column-expression helpers shared by the operators.

All helpers return plain ``Column`` expressions built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

#: Rounding errors that an amount may have gathered, in units of its last place, and as a share of it.
NOISE_ULPS = 8
NOISE = NOISE_ULPS * 2.0**-53


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: ColumnOrName) -> Column:
    """Neither NaN nor infinite (NULL stays NULL)."""
    v = as_col(c).cast("double")
    return ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def money(c: ColumnOrName, scale: int = 2, precision: int = 18) -> Column:
    """An amount as an exact decimal with ``scale`` places; NULL where it is NaN or infinite.

    The amount must lie on that grid up to binary noise (10.1 + 0.2 does for
    scale 2) and within ``precision`` digits; anything else raises rather than
    being rounded away.  Noise is at most ``NOISE_ULPS`` units in the last place
    of the amount, or a millionth of a grid step where amounts cancelled out.
    """
    v = as_col(c).cast("double")
    limit = 10.0 ** (precision - scale)
    fits = F.abs(v) < limit
    exact = F.when(is_finite(v) & fits, as_col(c)).cast(T.DecimalType(precision, scale))
    off = F.abs(exact.cast("double") - v) > F.lit(1e-6 * 10.0**-scale) + F.abs(v) * NOISE
    message = F.concat(F.lit("amount "), v.cast("string"), F.lit(f" cannot be held with {scale} decimal places"))
    failed = is_finite(v) & (~fits | off)
    return F.when(failed, F.raise_error(message).cast(T.DecimalType(precision, scale))).otherwise(exact)


def exact_sum(c: ColumnOrName, scale: int, over=None, precision: int = 18) -> Column:
    """Sum of amounts without binary noise, as ``double``, plain or over a window.

    It runs on decimals, so the result does not depend on row or partition
    order; NaN and infinities count as in a plain sum of doubles.
    """
    v = as_col(c).cast("double")
    total, odd = F.sum(money(c, scale, precision)), F.sum(F.when(~is_finite(v), v))
    if over is not None:
        total, odd = total.over(over), odd.over(over)
    return F.coalesce(odd, total.cast("double"))


def elapsed_days(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole calendar days from ``start`` to ``end``; NULL when ``end`` is NULL."""
    end_c = as_col(end)
    return F.when(end_c.isNotNull(), F.datediff(end_c, as_col(start)))


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def null_safe_join_cond(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on ``keys`` where NULL matches NULL (window-partition semantics)."""
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond
