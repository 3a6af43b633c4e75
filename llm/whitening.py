"""Whitening of vectors by the eigenvectors of their covariance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored, summed

#: An entry c becomes the whole number floor(STEPS * c) + SHIFT.
STEPS, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Whole numbers up to here are exact as doubles; entries beyond it are no numbers.
LARGEST = 2.0**53
#: Entries that a task takes at a time.
ENTRIES = 1 << 20
LONG = 2**63


def whole_numbers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the usable vectors, some rows of one length at a time.

    A null vector, and one with an entry that is null, not finite or beyond
    ``LARGEST`` steps, is not usable.
    """
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == length)
        for part in np.array_split(rows, -(-len(rows) * max(int(length), 1) // ENTRIES)):
            with np.errstate(all="ignore"):
                x = np.floor(STEPS * entries[starts[part][:, None] + np.arange(length)])
            usable = (np.abs(x) < LARGEST).all(1)  # false for NaN
            if usable.any():
                yield part[usable], x[usable].astype(np.int64) + SHIFT


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns, as Python's numbers."""
    if len(x) * int(np.abs(x).max(initial=0)) < LONG:
        return x.sum(0).astype(object)
    return x.astype(object).sum(0)


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the columns of (n * x - sum)^2, exact; null where no long holds it."""
    if not x.size:
        return [0] * len(x)
    mean = np.array([s / n for s in sums])
    reach = n * (float(np.abs(x - mean).max()) + 1)
    if n * int(np.abs(x).max()) < LONG and x.shape[1] * reach**2 < LONG / 2:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    apart = n * x.astype(object) - np.array(sums, object)
    return [d if d < LONG else None for d in (apart * apart).sum(1)]


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with L @ L.T = a[order][:, order], L triangular with a column a rank.

    The largest diagonal entry that is left is next; the factor ends where that is
    nothing but rounding.
    """
    size = len(a)
    order, left = np.arange(size), np.diagonal(a).astype(float).copy()
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(size):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= least:
            return factor[:, :k], order
        for part in (order, left, factor):
            part[[k, p]] = part[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        below = a[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each pair of n columns once, in rounds of pairs that share no column."""
    seats = [*range(n), *([-1] if n % 2 else [])]
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [p for p in zip(seats[:half], seats[:half - 1:-1], strict=True) if -1 not in p]
        out.append((np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns, rotated by pairs until all are orthogonal."""
    columns = factor.copy()
    small = np.finfo(float).eps * max(len(columns), 1)
    plan = rounds(columns.shape[1])
    for _ in range(sweeps):
        turned = False
        for p, q in plan:
            first, second = columns[:, p], columns[:, q]
            a, b = (first * first).sum(0), (second * second).sum(0)
            ab = (first * second).sum(0)
            turn = np.abs(ab) > small * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            p, q, first, second = p[turn], q[turn], first[:, turn], second[:, turn]
            slope = (b[turn] - a[turn]) / (2 * ab[turn])
            sign = np.where(slope < 0, -1.0, 1.0)
            tangent = sign / (np.abs(slope) + np.hypot(1, slope))
            cosine = 1 / np.hypot(1, tangent)
            sine = cosine * tangent
            columns[:, p] = cosine * first - sine * second
            columns[:, q] = sine * first + cosine * second
        if not turned:
            break
    return columns


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of a scatter matrix by falling value, without zeros.

    The norms of the rotated factor's columns are the roots of the values. A vector's
    largest entry is positive.
    """
    factor, order = pivoted_cholesky(scatter)
    turned = jacobi(factor)
    norms = np.linalg.norm(turned, axis=0)
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned[:, by_size] / norms[by_size]
    if vectors.size:
        top = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
        vectors *= np.where(top < 0, -1.0, 1.0)
    return norms[by_size] ** 2, vectors


@dataclass
class Whitening:
    """What whitens vectors of ``len(sums)`` entries; without components if n is 0."""

    n: int
    sums: list[int]
    components: np.ndarray  # as columns, by falling eigenvalue
    values: np.ndarray  # eigenvalues of the covariance, divisor n
    explained: list[float]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        return (x - np.array(whole, np.int64)) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))


def _scatter(vectors: DataFrame, length: int, size: int, use) -> np.ndarray:
    """Sum of the outer products of the rows ``use`` makes of whole numbers."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in whole_numbers(batch.column(0)):
                if x.shape[1] == length:
                    rows = use(x)
                    total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"sum": [total.tobytes()]})

    found = summed(vectors.mapInArrow(of_task, "sum binary"), size * size)
    return found.reshape(size, size)


def _totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sums of the columns, of vectors of the most frequent length.

    Of lengths of equal frequency the longer one counts.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_numbers(batch.column(0)):
                length = x.shape[1]
                seen[length] = seen.get(length, 0) + len(x)
                totals[length] = totals.get(length, 0) + column_sums(x)
        # Place -1 counts the vectors, so that empty ones count too.
        rows = [(k, -1, n) for k, n in seen.items()]
        rows += [(k, i, s) for k, t in totals.items() for i, s in enumerate(t)]
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
        columns = zip(*((k, i, Decimal(int(s))) for k, i, s in rows), strict=True) if rows else [()] * 3
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["length", "place", "sum"])

    found = vectors.mapInArrow(of_task, "length int, place int, sum decimal(38,0)")
    found = stored(found.groupBy("length", "place").agg(F.sum("sum").alias("sum")))
    top = found.where("place < 0").orderBy(F.desc("sum"), F.desc("length")).first()
    if top is None:
        return 0, []
    own = found.where((F.col("length") == top["length"]) & (F.col("place") >= 0)).collect()
    sums = {r["place"]: int(r["sum"]) for r in own}  # as many as a vector has entries
    return int(top["sum"]), [sums[i] for i in range(top["length"])]


def _vectors(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).cast("array<double>").alias("vector"))


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The first ``components`` principal components of all usable vectors of ``rows``.

    Two passes: exact sums of the whole numbers, then the scatter of the centred
    ones. What the driver gets depends on the vectors' length alone. Components of
    no spread are left out, so equal vectors have none; an empty table has n = 0.
    """
    vectors = _vectors(rows, column)
    n, sums = _totals(vectors)
    size = len(sums)
    none = Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), [])
    if not n or not size:
        return none
    scatter = _scatter(vectors, size, size, none.centred)
    values, found = eigen(scatter)
    values, found = values[:components], found[:, :components]
    return Whitening(n, sums, found, values / n, (values / np.trace(scatter)).tolist())


def identity_error(rows: DataFrame, model: Whitening, column: str = "embedding") -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity.

    The whitened vectors are read and summed up anew; null without components. They
    are centred before they are multiplied, since they are made of centred ones.
    """
    size = len(model.values)
    if not size:
        return None

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(x), 1)), model.whitened(x)])

    sums = _scatter(_vectors(rows, column), len(model.sums), size + 1, with_one) / model.n
    covariance = sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:])
    return float(np.abs(covariance - np.eye(size)).max())


FOUND = "deviation long, whitened array<double>"


def whitened(model: Whitening, column: str = "embedding") -> Column:
    """Struct of ``deviation`` and ``whitened`` of each vector; null if not usable.

    deviation is the sum over entries of (n * x - S)^2, null beyond a long. Vectors
    that are null, hold null or non-finite entries or entries too large for whole
    numbers, or have another length than most, are not usable. Each row is worked
    out by itself, so repeated rows and other columns make no difference.
    """

    def of_vectors(vectors: pd.Series) -> pd.DataFrame:
        deviations: list[int | None] = [None] * len(vectors)
        rows: list[np.ndarray | None] = [None] * len(vectors)
        arrays = pa.array(vectors, pa.list_(pa.float64()), from_pandas=False)
        for places, x in whole_numbers(arrays):
            if x.shape[1] != len(model.sums) or not model.n:
                continue
            found = model.whitened(x)
            for place, d, row in zip(places, squared_deviations(x, model.n, model.sums), found, strict=True):
                deviations[place], rows[place] = d, row
        longs = pd.array(deviations, dtype="Int64")
        return pd.DataFrame({"deviation": longs, "whitened": pd.Series(rows, dtype=object)})

    return F.pandas_udf(of_vectors, FOUND)(F.col(column).cast("array<double>"))
