"""Row cleaning: whole-row de-duplication and null-key removal.

De-duplication is a hash aggregate with a map-side partial step, so even a
group of identical copies holding a large share of the table is collapsed
inside each map task before it is shuffled: the reducer sees at most one
copy per map partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.windows import hottest_key


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicate rows; NULLs compare equal.  ``subset`` keeps one row per key."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DISTINCT over a projection, e.g. (order, seller) pairs."""
    return df.select(*cols).distinct()


def drop_null_keys(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``subset`` is NULL.

    Written as one ``isNotNull`` per column (not ``dropna``) so the predicate
    reaches the Parquet reader as pushed filters.
    """
    if not subset:
        return df
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in subset])
    return df.filter(cond)


def clean(df: DataFrame, subset: Sequence[str], join_key: Sequence[str] = ()) -> DataFrame:
    """Null-key removal then whole-row de-duplication.

    The two steps commute (a removed row has a NULL key, and so has every
    duplicate of it); filtering first lets the scan skip rows before the
    shuffle.

    ``join_key`` names the key a later join or aggregate uses.  Rows are then
    hashed on it first: copies meet there as well, and the next operator needs
    no exchange of its own.  For near-unique keys only; a hot key would meet
    in one task before its copies are dropped.  :func:`even_keys` tells from
    exact counts which keys are; without ``join_key`` copies shrink in the map
    tasks and what is left is dealt out by whole rows.
    """
    kept = drop_null_keys(df, subset)
    return dedupe(kept.repartition(*join_key) if join_key else kept)


def even_keys(
    stored: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], max_rows: int
) -> dict[str, Sequence[str]]:
    """The ``join_key`` of each table whose commonest key has at most ``max_rows`` rows.

    One column-pruned count per table, with partial counts in every task, so
    pass stored tables.
    """
    return {name: key for name, key in keys.items() if name in stored and hottest_key(stored[name], key) <= max_rows}
