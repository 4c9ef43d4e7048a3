"""Embedding whitening by Jacobi-Davidson, without ever forming the covariance.

The covariance V of the vectors is only known by its products with a few directions at a time, each one Spark job over
blocks of centred rows: every task adds up its share of C'(CU), the shares are summed by position, and the driver gets numbers in
proportion to dimensions x directions, never to rows. The driver keeps a search space of at most ``SEARCH_DIRECTIONS`` directions
and its image. Each round takes the Rayleigh-Ritz pairs of that space, locks the leading ones whose residual is at the rounding
of doubles, and widens the space by corrections t of the next ``BLOCK`` pairs (e, u): (I - QQ')(V - e)(I - QQ') t = -residual with Q the
locked directions and the present ones, solved roughly by a few steps of MINRES, all of the block in step, so that a step is
one job. A full space restarts from its best Ritz vectors.

Entries c become x = floor(64 c) + 1000000. Sums are exact (decimals), rows are centred as whole numbers before anything is
multiplied, so the large common offset costs no digits.

Defined cases: vectors that are null, empty or hold null or non-finite entries take no part, nor do vectors of another dimension
than the most frequent one (of equally frequent ones the largest); repeated rows and repeated or null ``vec_id`` count as often
as they come; equal eigenvalues give any unit vectors of their space; directions without variance (up to rounding) are no
components, so equal vectors, a single one or an empty table have none; extra columns are ignored. x must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartloom.llm.shared import stored
from cartloom.llm.topk import whole_numbers

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
BLOCK = 16
SEARCH_DIRECTIONS = 56
INNER_STEPS = 3
INNER_REDUCTION = 1e-3
# Residuals count as rounding below so many units in the last place of the trace.
RESIDUAL_UNITS = 4
MOST_ROUNDS = 500

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """n vectors with their sums by dimension; unit eigenvectors as columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]


def shifted(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the whole numbers of each usable vector."""
    x = F.transform("v", lambda c: c + F.lit(OFFSET).cast("long"))
    return whole_numbers(vectors, SCALE).select("vec_id", x.alias("x"))


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """x - S / n as doubles, and the exact n x - S (as long as that fits 64 bits, else Python integers)."""
    floors = [s // n for s in sums]
    rest = [s - n * f for s, f in zip(sums, floors)]
    near = x - np.array(floors, dtype=np.int64)
    largest = int(np.abs(near).max(initial=0)) + 1
    whole = near if (n * largest) ** 2 * len(sums) < 2**62 else near.astype(object)
    return near - np.array([r / n for r in rest]), whole * n - np.array(rest, dtype=whole.dtype)


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dimensions)


def centred_blocks(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """The centred vectors, as many in a row as a batch holds, as doubles one after the other."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c, _ = centred(matrix(batch.column(0), len(sums)), n, sums)
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary())], names=["block"])

    return rows.select("x").mapInArrow(blocks, "block binary")


def added_up(blocks: DataFrame, dimensions: int, share: Callable[[np.ndarray], np.ndarray], shape: tuple) -> np.ndarray:
    """The sum of ``share(block)`` over all blocks: each task adds up its own, the tasks' sums meet by position."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for block in batch.column(0):
                total += share(np.frombuffer(block.as_buffer()).reshape(-1, dimensions))
        arrays = [pa.array(np.arange(total.size)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, names=["position", "value"])

    sums = blocks.mapInArrow(partial, "position long, value double").groupBy("position").agg(F.sum("value").alias("value"))
    total = np.zeros(int(np.prod(shape)))
    for row in sums.collect():  # as many as the shape has places
        total[row["position"]] = row["value"]
    return total.reshape(shape)


def outside(z: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``z`` without its parts in the spaces of ``bases``; twice, so that rounding leaves none."""
    for _ in range(2):
        for q in bases:
            z = z - q @ (q.T @ z)
    return z


def orthonormal(z: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Unit directions of ``z`` outside ``bases``; what depends on others is left out."""
    z = outside(z, *bases)
    lengths = np.linalg.norm(z, axis=0)
    z = outside(z[:, lengths > 0] / lengths[lengths > 0], *bases)
    q, r = np.linalg.qr(z)
    q = outside(q[:, np.abs(np.diag(r)) > 1e-8], *bases)
    return np.linalg.qr(q)[0]


def corrections(product: Product, values: np.ndarray, known: np.ndarray, residuals: np.ndarray) -> np.ndarray:
    """Rough solutions t of the projected equations, one column a pair: the Lanczos recurrence of each, rotated to a triangle."""
    some = lambda x: np.maximum(x, 1e-300)
    v = outside(-residuals, known)
    start = left = beta = np.linalg.norm(v, axis=0)
    v, before = v / some(beta), np.zeros_like(v)
    t, step, step_before = (np.zeros_like(v) for _ in range(3))
    cos = cos_before = np.ones(len(values))
    sin = sin_before = beta = np.zeros(len(values))
    for _ in range(INNER_STEPS):
        image = outside(product(v) - v * values, known)
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - beta * before
        longer = np.linalg.norm(image, axis=0)
        # The new column of the tridiagonal matrix under the last two rotations, and the next one.
        far, near = sin_before * beta, cos_before * cos * beta + sin * alpha
        diagonal = cos * alpha - cos_before * sin * beta
        cos_before, sin_before, length = cos, sin, some(np.hypot(diagonal, longer))
        cos, sin = diagonal / length, longer / length
        step_before, step = step, (v - far * step_before - near * step) / length
        t = t + cos * left * step
        left = -sin * left
        before, v, beta = v, image / some(longer), longer
        if (np.abs(left) <= INNER_REDUCTION * start).all():
            break
    return t


def leading_pairs(product: Product, dimensions: int, count: int, trace: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as columns."""
    count = min(count, dimensions)
    tolerance = RESIDUAL_UNITS * np.finfo(float).eps * trace
    random = np.random.default_rng(0)
    locked = np.zeros((dimensions, 0))
    space = orthonormal(random.normal(size=(dimensions, min(BLOCK, dimensions))))
    image = product(space)
    for _ in range(MOST_ROUNDS):
        values, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residuals = outside(image - space * values, locked)
        small = np.linalg.norm(residuals, axis=0) <= tolerance
        done = len(small) if small.all() else int(np.argmin(small))
        locked, space, image = np.hstack([locked, space[:, :done]]), space[:, done:], image[:, done:]
        if locked.shape[1] >= count:
            break
        values, residuals = values[done:], residuals[:, done:]
        block = min(BLOCK, space.shape[1])
        if space.shape[1] + block > SEARCH_DIRECTIONS:
            space, image = space[:, : SEARCH_DIRECTIONS - 2 * BLOCK], image[:, : SEARCH_DIRECTIONS - 2 * BLOCK]
        wider = space[:, :0]
        if block:
            known = np.hstack([locked, space[:, :block]])
            wider = orthonormal(corrections(product, values[:block], known, residuals[:, :block]), locked, space)
        if not wider.shape[1]:
            free = dimensions - locked.shape[1] - space.shape[1]
            wider = orthonormal(random.normal(size=(dimensions, min(BLOCK, free))), locked, space)
        if not wider.shape[1]:  # the space is all there is: its pairs are exact up to rounding
            locked = np.hstack([locked, space])
            break
        space, image = np.hstack([space, wider]), np.hstack([image, product(wider)])
    else:
        raise RuntimeError(f"residuals above {tolerance} after {MOST_ROUNDS} rounds")
    # Once more over what is locked, with a fresh image: values in order, vectors at right angles to rounding.
    locked = np.linalg.qr(locked)[0]
    within = locked.T @ product(locked)
    values, turn = np.linalg.eigh((within + within.T) / 2)
    return values[::-1][:count], (locked @ turn)[:, ::-1][:, :count]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` (vec_id and x, of one dimension); None without rows."""
    sums = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(
        F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s")
    )
    found = sorted(sums.collect())  # one row a dimension
    if not found:
        return None
    n, totals, d = found[0]["n"], [int(r["s"]) for r in found], len(found)
    blocks = stored(centred_blocks(rows, n, totals), "whitening-blocks")
    trace = float(added_up(blocks, d, lambda c: np.array([(c * c).sum()]), (1,))[0]) / n
    values, vectors = np.zeros(0), np.zeros((d, 0))
    if trace > 0:
        product = lambda u: added_up(blocks, d, lambda c: c.T @ (c @ u), u.shape) / n
        values, vectors = leading_pairs(product, d, components, trace)
        real = values > RESIDUAL_UNITS * np.finfo(float).eps * trace
        values, vectors = values[real], vectors[:, real]
    error = 0.0
    if k := len(values):
        scaled = vectors / np.sqrt(values)
        mean = added_up(blocks, d, lambda c: (c @ scaled).sum(axis=0), (k,)) / n

        def share(c: np.ndarray) -> np.ndarray:
            y = c @ scaled - mean
            return y.T @ y

        error = float(np.abs(added_up(blocks, d, share, (k, k)) / n - np.eye(k)).max())
    return Whitening(n, totals, vectors, values, trace, error)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (exact sum of (n x - S)^2, decimal) and whitened, one number a component, of each row."""
    scaled = model.components / np.sqrt(model.eigenvalues)
    n, sums = model.n, model.sums

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, whole = centred(matrix(batch.column(1), len(sums)), n, sums)
            y = c @ scaled
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(y.ravel()))
            far = pa.array([str(s) for s in (whole * whole).sum(axis=1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), far, lists], names=["vec_id", "deviation", "whitened"])

    made = rows.select("vec_id", "x").mapInArrow(
        transform, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation string, whitened array<double>"
    )
    return made.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def usable_rows(vectors: DataFrame) -> DataFrame:
    """The rows that take part, stored: of the most frequent dimension, of equally frequent ones the largest."""
    rows = stored(shifted(vectors).withColumn("d", F.size("x")), "whitening-rows")
    top = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.col("d") == (top["d"] if top else 0)).drop("d")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, and for each component its whitened and explained number; identity_error.

    ``whitened`` and ``explained`` are arrays by falling eigenvalue, empty where nothing varies.
    """
    rows = usable_rows(vectors)
    model = fit(rows, components)
    if model is None:
        model = Whitening(1, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    return whitened(rows, model).select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*map(F.lit, model.explained)).cast("array<double>").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
