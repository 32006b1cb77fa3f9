"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Vectors are read as whole numbers, x = floor(256 c), and every distinct one is a row of the matrix X once its mean is
taken off. Starting from a unit vector v, a step multiplies p = X v - beta u and r = X' u - alpha v in turn; their
lengths alpha and beta are the bidiagonal. Its singular values and right vectors give the components.

A left vector has an entry per row and is never stored: u = X w for a short w that is known, so one pass over the rows
makes X w, its products with all earlier left vectors and X' X w. Left vectors are made orthogonal by those products,
right ones directly, both against all before. The driver holds vectors of the embedding's length, at most as many as
it has dimensions; rows stay in the tasks, and a lost executor costs the pass over its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import schema_of
from eventloom.session import cut_lineage, release

COMPONENTS = 4
# A length or singular value below this share of the largest is none: what rounding leaves.
NOTHING = 1e-11
# A component is found when its error, as an angle, is below this.
ANGLE = 1e-13
_LONG = 2**63


@dataclass
class Whitening:
    """Mean and components of the distinct vectors: ``axes`` has a column per component, ``variances`` falls."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_numbers(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with a usable vector, and its whole numbers as ``x``; beyond the range of a long they are its ends.

    A vector that is null, empty, or has null or non-finite entries is not usable, nor is one of another length than
    the commonest (of several, the longest): it cannot be a row of the same matrix.
    """
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    kept = kept.withColumn("x", F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double"))))
    per_length = kept.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = per_length.agg(F.max(F.struct("n", "size")).alias("m")).first().m
    return kept.where(F.size("x") == (common.size if common else 0))


def rows_of(batch: pa.RecordBatch, place: int = 0) -> np.ndarray:
    """Column ``place`` of a batch as a matrix."""
    column = batch.column(place)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def totals(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``measure`` over all blocks of ``rows``: as many numbers as it gives, whatever the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                part = measure(rows_of(batch))
                held = part if held is None else held + part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held)], names=["i", "v"])

    summed = rows.select("x").mapInArrow(run, schema_of("i bigint,v double")).groupBy("i").agg(F.sum("v").alias("v"))
    return np.array([r.v for r in sorted(summed.collect(), key=lambda r: r.i)])


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""
    whole = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = rows_of(batch)
            small = max(abs(int(x.min())), abs(int(x.max()))) < _LONG // (2 * len(x))
            part = (x if small else x.astype(object)).sum(0)
            held = [a + int(b) for a, b in zip(held or [0] * len(part), part, strict=True)]
            n += len(x)
        if held is not None:
            values = pa.array([Decimal(v) for v in [n, *held]], whole)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), values], names=["i", "v"])

    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", T.DecimalType(38, 0))])
    summed = rows.select("x").mapInArrow(run, schema).groupBy("i").agg(F.sum("v").alias("v"))
    found = [int(r.v) for r in sorted(summed.collect(), key=lambda r: r.i)]
    return (found[0], found[1:]) if found else (0, [])


class _Bidiagonal:
    """The factorisation so far: right vectors, short forms of left ones, X' u of each, and the small matrix."""

    def __init__(self, rows: DataFrame, mean: np.ndarray):
        self.rows, self.mean = rows, mean
        size = len(mean)
        self.rng = np.random.default_rng(20)
        self.right = np.empty((size, 0))
        self.short = np.empty((size, 0))
        self.back = np.empty((size, 0))
        self.entries: list[tuple[int, int, float]] = []
        self.square = 0.0

    def product(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
        """One pass: |X w|², U' X w, X' X w and |X|²."""
        mean, short = self.mean, self.short

        def measure(x: np.ndarray) -> np.ndarray:
            y = x - mean
            p = y @ w
            return np.concatenate([[p @ p, np.square(y).sum()], (y @ short).T @ p, y.T @ p])

        found = totals(self.rows, measure)
        k = short.shape[1]
        return found[0], found[2 : 2 + k], found[2 + k :], found[1]

    def fresh(self) -> np.ndarray:
        """A unit vector at right angles to all right vectors."""
        return self.unit(self.rng.standard_normal(len(self.mean)))[0]

    def unit(self, r: np.ndarray) -> tuple[np.ndarray, float]:
        for _ in range(2):
            r = r - self.right @ (self.right.T @ r)
        length = float(np.linalg.norm(r))
        return (r / length if length else r), length

    def step(self, v: np.ndarray, beta: float) -> tuple[np.ndarray, float, bool]:
        """Take ``v`` in; the next right vector with its beta, and whether ``v`` gave a left vector."""
        k = self.short.shape[1]
        col = self.right.shape[1]
        w = v
        if beta:
            w = v - beta * self.short[:, -1]
            self.entries.append((k - 1, col, beta))
        self.right = np.column_stack([self.right, v])
        for _ in range(3):
            length2, along, back, self.square = self.product(w)
            w, back = w - self.short @ along, back - self.back @ along
            shed = float(along @ along)
            # What was taken off is rounding, or one more pass makes it so.
            if shed <= 1e-8 * length2 or length2 <= NOTHING**2 * self.square:
                break
        alpha = float(np.sqrt(max(length2 - shed, 0.0)))
        if alpha <= NOTHING * np.sqrt(self.square):
            return v, 0.0, False
        self.entries.append((k, col, alpha))
        self.short = np.column_stack([self.short, w / alpha])
        self.back = np.column_stack([self.back, back / alpha])
        ahead, beta = self.unit(back / alpha - alpha * v)
        return ahead, beta, True

    def small(self) -> np.ndarray:
        made = np.zeros((max(self.short.shape[1], 1), self.right.shape[1]))
        for i, j, value in self.entries:
            made[i, j] = value
        return made


def bidiagonalise(rows: DataFrame, mean: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Right singular vectors and singular values of the centred rows, the largest first; |X|² and steps taken."""
    made = _Bidiagonal(rows, mean)
    size = len(mean)
    v, beta = made.fresh(), 0.0
    values, turned = np.empty(0), np.empty((0, 0))
    while made.right.shape[1] < size:
        started = beta == 0.0
        v, beta, grew = made.step(v, beta)
        left, values, turned = np.linalg.svd(made.small(), full_matrices=False)
        scale = np.sqrt(made.square)
        if started and not grew:
            break  # A vector at right angles to all others gives nothing: they span all there is.
        if beta <= NOTHING * scale:
            # The span is closed. Equal variances leave directions that it cannot see, so another start is needed.
            v, beta = made.fresh(), 0.0
        elif len(values) > components and _found(left[-1], values, beta, components):
            break
    return made.right @ turned.T, values, made.square, made.right.shape[1]


def _found(last: np.ndarray, values: np.ndarray, beta: float, components: int) -> bool:
    """Whether the first components no longer move: what is left over, by the distance to the next variance."""
    e = np.square(values)
    for i in range(components):
        gap = np.abs(np.delete(e, i) - e[i]).min()
        if abs(beta * last[i]) * values[i] > ANGLE * gap:
            return False
    return True


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Whitening of the distinct ``x`` of ``rows``; components without variance are left out."""
    distinct = cut_lineage(rows.select("x").distinct())
    n, sums = exact_sums(distinct)
    if not n:
        release(distinct)
        return Whitening(0, [], np.empty((0, 0)), np.empty(0), 0.0, 0.0, 0)
    mean = np.array([s / n for s in sums])
    axes, values, square, steps = bidiagonalise(distinct, mean, components)
    some = [i for i in range(min(components, len(values))) if values[i] > NOTHING * np.sqrt(square)] if square else []
    axes = axes[:, some]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(len(some))] < 0, -1, 1) if some else axes
    made = Whitening(n, sums, axes, np.square(values[some]) / n, square / n, 0.0, steps)
    if some:
        scale = made.axes / np.sqrt(made.variances)

        def measure(x: np.ndarray) -> np.ndarray:
            z = (x - mean) @ scale
            return np.concatenate([z.sum(0), (z.T @ z).ravel()])

        found = totals(distinct, measure) / n
        k = len(some)
        spread = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
        made.identity_error = float(np.abs(spread - np.eye(k)).max())
    release(distinct)
    return made


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)², exact; null where it does not fit a long."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if most * most * len(sums) < _LONG:
        return np.square(n * x - np.array(sums)).sum(1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [d if d < _LONG else None for d in exact]


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened vectors: ``key``, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows without a usable vector (see ``whole_numbers``) are dropped; null and repeated keys are kept as they are.
    There are as many components as the distinct vectors have dimensions with variance, ``components`` at most: none
    for an empty table or a single distinct vector, whose result is empty. Other columns are not looked at.
    """
    rows = whole_numbers(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector").select("key", "x")
    made = fit(rows, components)
    schema = T.StructType([df.schema[key], *schema_of(
        "component int,n bigint,deviation bigint,whitened double,explained double,identity_error double"
    )])
    if not len(made.variances):
        return df.sparkSession.createDataFrame([], schema)
    mean, scale, k = made.mean, made.axes / np.sqrt(made.variances), len(made.variances)
    explained = made.variances / made.trace
    n, sums, error = made.n, made.sums, made.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = rows_of(batch, 1)
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(each),
                    pa.array(((x - mean) @ scale).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
