"""Embedding whitening from a polarisation covariance.

Entries become integers ``x = floor(64 * c) + 1000000``.  With S the sums of
each dimension over the n vectors of the fit list (all valid ones),

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

so no products of two dimensions are needed: tasks add up exact squares of
centred values for every dimension and for the sum of every two dimensions.

1. One pass counts the vectors and adds up each dimension.
2. One pass squares.  Values are centred at the integer part of the mean
   before they are squared, which leaves small integers; the remainder r of
   ``S = n * m + r`` enters exactly afterwards, as
   ``n * sum((x - S/n)^2) = n * sum((x - m)^2) - r^2``.  A task adds in 64-bit
   integers where its blocks provably fit and in Python integers elsewhere, and
   sends d (d + 1) / 2 numbers; Spark adds them as 38-digit decimals.
3. The driver gets these d (d + 1) / 2 sums (a bound by dimensions, whatever
   the number of vectors), forms V as quotients of exact integers and takes
   its eigenvectors.
4. One pass adds up the products of the whitened values, for the identity
   error as measured on the data; the last one returns the rows.

Defined results: a vector that is null or holds a null, NaN or infinite entry
is dropped; shorter vectors (an empty one too) count as if filled with zeros up
to the longest; entries beyond ``LIMIT`` in x are set to it; equal rows each
count; rows without id stay; components without variance (their eigenvalue is
not above ``NO_VARIANCE`` of the trace) have no whitened value (null) and take
no part in the identity error; ``deviation`` is null where it exceeds a long
(``deviation_exact`` has it, as text); an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Bound of x (a square of n * x must stay within 38 digits for 10^6 vectors).
LIMIT = 1 << 40
#: Share of the trace below which a component counts as constant.
NO_VARIANCE = 1e-12
#: Vectors handled at once.
BLOCK = 2048
_LONG = (1 << 63) - 1
_SUM = pa.decimal128(38, 0)


@dataclass
class Whitening:
    """The fit: ``x - mean`` times ``axes`` gives whitened values."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: np.ndarray
    usable: np.ndarray
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return ((x - whole) - part) @ self.axes  # the integer difference first: nothing is rounded away


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: vectors without null or non-finite entries, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & finite)


def integers(column: pa.Array, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of x, one row per vector, shorter vectors filled as zeros are."""
    for at in range(0, len(column), BLOCK):
        part = column.slice(at, BLOCK)
        flat = part.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(part.offsets.to_numpy())
        c = np.zeros((len(part), d))
        c[np.arange(d) < sizes[:, None]] = flat
        yield at, (np.floor(np.clip(SCALE * c, -LIMIT, LIMIT)).astype(np.int64) + SHIFT)


def exact_sums(z: np.ndarray, power: int = 1) -> list[int]:
    """Column sums of z or of its squares, exact."""
    top = int(np.abs(z).max(initial=0)) ** power
    if top * max(len(z), 1) <= _LONG:
        return (z if power == 1 else z * z).sum(0).tolist()
    return (z.astype(object) ** power).sum(0).tolist()


def _sums(d: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            for _, x in integers(batch.column("v"), d):
                n += len(x)
                total = [a + b for a, b in zip(total, exact_sums(x), strict=True)]
        if n:
            yield _emit(list(range(-1, d)), [n, *total])

    return work


def pair_sums(z: np.ndarray) -> list[int]:
    """Sums of squares of every dimension, then of the sum of every two, in the order (0, 1), (0, 2), ..."""
    out = exact_sums(z, 2)
    for i in range(z.shape[1] - 1):
        out += exact_sums(z[:, i : i + 1] + z[:, i + 1 :], 2)
    return out


def _squares(centre: np.ndarray):
    d = len(centre)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in integers(batch.column("v"), d):
                mine = pair_sums(x - centre)
                total = mine if total is None else [a + b for a, b in zip(total, mine, strict=True)]
        if total is not None:
            yield _emit(list(range(len(total))), total)

    return work


def _emit(place: list[int], value: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array([Decimal(v) for v in value], _SUM)], ["place", "value"])


def _added(parts: DataFrame) -> dict[int, int]:
    """The tasks' sums added up; one row per dimension or pair."""
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return {r["place"]: int(r["value"]) for r in rows}


def covariance(n: int, sums: list[int], squares: list[int]) -> np.ndarray:
    """V from the squares around the integer parts of the means, by polarisation in exact integers."""
    d = len(sums)
    rest = [s % n for s in sums]
    var = [n * squares[i] - rest[i] ** 2 for i in range(d)]  # n^2 times the variance
    out, at = np.zeros((d, d)), d
    for i in range(d):
        out[i, i] = var[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[at] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - var[i] - var[j]) / (2 * n**2)
            at += 1
    return out


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on all valid vectors; None if there are none, or none has an entry."""
    rows = valid_vectors(vectors, id_col, vector_col).select("v")
    d = rows.agg(F.max(F.size("v"))).first()[0]
    if not d:
        return None
    first = _added(rows.mapInArrow(_sums(d), "place long, value decimal(38,0)"))
    n, sums = first[-1], [first[i] for i in range(d)]
    centre = np.array([s // n for s in sums], np.int64)
    squares = _added(rows.mapInArrow(_squares(centre), "place long, value decimal(38,0)"))
    v = covariance(n, sums, [squares[k] for k in range(d * (d + 1) // 2)])
    e, vectors_ = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[: min(components, d)]
    e, axes, trace = e[order], vectors_[:, order], float(np.trace(v))
    usable = e > NO_VARIANCE * trace
    axes = np.where(usable, axes / np.sqrt(np.where(usable, e, 1.0)), 0.0)
    fitted = Whitening(n, sums, axes, e / trace if trace > 0 else np.zeros(len(e)), usable)
    fitted.identity_error = _identity_error(rows, fitted)
    return fitted


def _products(fitted: Whitening):
    d, k = fitted.axes.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in integers(batch.column("v"), d):
                y = fitted.whiten(x)
                total[:k] += y.T @ y
                total[k] += y.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "value"])

    return work


def _identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity.

    The values are centred already; what their mean is off by is taken away.
    """
    k = fitted.axes.shape[1]
    found = rows.mapInArrow(_products(fitted), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) * k)
    for row in found:
        total[row["place"]] = row["value"]
    total = total.reshape(k + 1, k) / fitted.n
    off = total[:k] - np.outer(total[k], total[k]) - np.eye(k)
    off = off[fitted.usable][:, fitted.usable]
    return float(np.abs(off).max(initial=0.0))


def _rows(fitted: Whitening):
    d, k = fitted.axes.shape
    s = np.array(fitted.sums, object)
    low, high = min(fitted.sums), max(fitted.sums)

    def deviations(x: np.ndarray) -> list[int]:
        top = max(abs(fitted.n * int(v) - b) for v in (x.min(initial=0), x.max(initial=0)) for b in (low, high))
        if top * top * d <= _LONG:
            off = fitted.n * x - s.astype(np.int64)
            return (off * off).sum(1).tolist()
        return ((fitted.n * x.astype(object) - s) ** 2).sum(1).tolist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in integers(batch.column("v"), d):
                m = len(x)
                deviation = [v for v in deviations(x) for _ in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(at, m).take(np.repeat(np.arange(m), k)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, fitted.n)),
                        pa.array([v if v <= _LONG else None for v in deviation], pa.int64()),
                        pa.array([str(v) for v in deviation], pa.string()),
                        pa.array(fitted.whiten(x).ravel(), mask=~np.tile(fitted.usable, m)),
                        pa.array(np.tile(fitted.explained, m)),
                        pa.array(np.full(m * k, fitted.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"],
                )

    return work


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per valid vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error`` and ``deviation_exact``."""
    rows = valid_vectors(vectors, id_col, vector_col)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, deviation_exact string, whitened double, explained double, identity_error double"
    fitted = fit(vectors, id_col, vector_col, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_rows(fitted), schema)
