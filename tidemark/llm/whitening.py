"""Whitening of embeddings by a Jacobi-Davidson iteration over distributed products.

The covariance matrix is never built. The vectors are settled once as blocks of integers; each
product of the centred covariance with a few directions is one job over the blocks, of which only
partial products (dimensions times directions) reach the driver, summed in two levels. The driver
holds the search space, a few dozen directions.

One round is Rayleigh-Ritz on the search space, then a correction equation
``(I - QQ')(A - theta)(I - QQ') t = -r`` for each wanted pair that has not converged, with all wanted
Ritz vectors in ``Q``. The equations are solved by MINRES in step with each other, so that an inner
step of all of them is one job, too. Pairs whose residual is at rounding level are locked: they
stay in the space and get no further corrections.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import scratch_path, settle

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**42  # from here on, SCALE times an entry has no exact integer in a double
BLOCK_BYTES = 1 << 20
INNER_STEPS = 8
ROUNDS = 100
EPS = float(np.finfo(np.float64).eps)


def usable(frame: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has no null, non-finite or too large entry and the commonest length."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(entries, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    rows = frame.where(F.coalesce(fine, F.lit(False)) & (F.size(entries) > 0))
    lengths = rows.groupBy(F.size(entries).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size(entries) == F.lit(commonest["d"] if commonest else 0))


def _pack(id: str, vector: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(vector)
            d = len(lists[0])
            entries = lists.flatten().to_numpy(zero_copy_only=False)
            x = (np.floor(SCALE * entries).astype(np.int64) + SHIFT).reshape(-1, d)
            step = max(1, BLOCK_BYTES // (8 * d))
            for start in range(0, len(x), step):
                part = x[start : start + step]
                ids = batch.column(id).slice(start, len(part))
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids)
                data = pa.array([part.astype("<i8").tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, pa.array([d]), data], ["ids", "d", "data"])

    return run


def packed(frame: DataFrame, id: str, vector: str) -> DataFrame:
    """Blocks of rows: their identifiers, the dimensions and the integers, row after row."""
    rows = usable(frame, vector).select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    kind = T.StructType([
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        T.StructField("d", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ])
    return settle(rows.mapInArrow(_pack("id", "vector"), kind), scratch_path(frame.sparkSession))


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for d, data in zip(batch.column("d").to_pylist(), batch.column("data")):
        yield np.frombuffer(data.as_buffer(), "<i8").reshape(-1, d)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums = 0, None
    for batch in batches:
        for x in _matrices(batch):
            # The halves of the integers are summed apart, so no block can overflow.
            part = [(int(h) << 26) + int(l) for h, l in zip((x >> 26).sum(axis=0), (x & (1 << 26) - 1).sum(axis=0))]
            sums = part if sums is None else [a + b for a, b in zip(sums, part)]
            n += len(x)
    if n:
        values = [decimal.Decimal(v) for v in (n, *sums)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int64()), pa.array(values, pa.decimal128(38, 0))], ["place", "total"]
        )


@dataclass(frozen=True)
class Centre:
    """The number of rows and the exact mean per dimension, as ``base + rest / n``."""

    n: int
    base: np.ndarray
    rest: list[int]

    @classmethod
    def of(cls, blocks: DataFrame) -> Centre | None:
        partials = blocks.select("ids", "d", "data").mapInArrow(_totals, "place bigint, total decimal(38,0)")
        rows = partials.groupBy("place").agg(F.sum("total").alias("total")).collect()
        if not rows:
            return None
        n, *sums = [int(r["total"]) for r in sorted(rows, key=lambda r: r["place"])]
        return cls(n, np.array([s // n for s in sums], np.int64), [s % n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n*x - S)^2, which is (n*(x-base) - rest)^2."""
        z = x - self.base
        bound = max(int(np.abs(z).max(initial=0)), 1) * max(self.n, int(np.abs(z).max(initial=0))) * z.shape[1]
        rest = np.array(self.rest, object if bound >> 62 else np.int64)
        z = z.astype(rest.dtype)
        squares, mixed = (z * z).sum(axis=1).tolist(), (z * rest).sum(axis=1).tolist()
        last = sum(r * r for r in self.rest)
        return [self.n * self.n * s - 2 * self.n * m + last for s, m in zip(squares, mixed)]


def _sum_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for data in batch.column("sums"):
            part = np.frombuffer(data.as_buffer(), np.float64)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _summed(blocks: DataFrame, partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``partial`` over all blocks' matrices: per partition, then per group of partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _matrices(batch):
                part = partial(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    first = blocks.select("ids", "d", "data").mapInArrow(run, "sums binary")
    width = math.isqrt(blocks.rdd.getNumPartitions()) + 1
    parts = [np.frombuffer(r["sums"], np.float64) for r in first.repartition(width).mapInArrow(_sum_arrays, "sums binary").collect()]
    return np.array([math.fsum(column) for column in zip(*parts)])


def covariance_product(blocks: DataFrame, centre: Centre) -> Callable[[np.ndarray], np.ndarray]:
    """The product of the covariance (divisor n) with the columns of a matrix, one job each."""

    def product(directions: np.ndarray) -> np.ndarray:
        def partial(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return (c.T @ (c @ directions)).ravel()

        return _summed(blocks, partial).reshape(directions.shape) / centre.n

    return product


def _orthonormal(new: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Directions of ``new`` orthogonal to ``space`` and to each other; dependent ones go."""
    lengths = np.linalg.norm(new, axis=0)
    new = new[:, lengths > 0] / lengths[lengths > 0]
    kept: list[np.ndarray] = []
    for column in new.T:
        basis = np.column_stack([space, *kept])
        for _ in range(3):
            column = column - basis @ (basis.T @ column)
        length = np.linalg.norm(column)
        if length > 1e-8:
            column = column / length
            kept.append(column - basis @ (basis.T @ column))
    return np.column_stack(kept) if kept else np.empty((len(space), 0))


def corrections(
    product: Callable[[np.ndarray], np.ndarray],
    thetas: np.ndarray,
    residuals: np.ndarray,
    ritz: np.ndarray,
    steps: int = INNER_STEPS,
    tolerance: float = 1e-2,
) -> np.ndarray:
    """MINRES on the projected correction equations of several pairs, a job per common step."""

    def project(m: np.ndarray) -> np.ndarray:
        return m - ritz @ (ritz.T @ m)

    right = project(-residuals)
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    width = len(thetas)
    before, now = np.zeros_like(right), np.divide(right, beta, where=beta > 0, out=np.zeros_like(right))
    found = np.zeros_like(right)
    older, old = np.zeros_like(right), np.zeros_like(right)
    phi = beta.copy()
    cosine, sine = -np.ones(width), np.zeros(width)
    delta_bar, epsilon = np.zeros(width), np.zeros(width)
    going = beta > 0
    for number in range(steps):
        if not going.any():
            break
        image = project(product(now) - thetas * now)
        alpha = (now * image).sum(axis=0)
        ahead = project(image - alpha * now - (beta * before if number else 0.0))
        following = np.linalg.norm(ahead, axis=0)
        # One more column of the tridiagonal matrix, turned by the last two rotations.
        delta = cosine * delta_bar + sine * alpha
        gamma_bar = sine * delta_bar - cosine * alpha
        epsilon_next = sine * following
        delta_bar = -cosine * following
        gamma = np.hypot(gamma_bar, following)
        going &= gamma > EPS * np.abs(thetas).max(initial=1.0)
        safe_gamma = np.where(gamma > 0, gamma, 1.0)
        cosine, sine = np.where(going, gamma_bar / safe_gamma, cosine), np.where(going, following / safe_gamma, sine)
        step = (now - delta * old - epsilon * older) / safe_gamma
        found = np.where(going, found + cosine * phi * step, found)
        phi = np.where(going, sine * phi, phi)
        older, old, epsilon = old, step, epsilon_next
        before, now = now, np.divide(ahead, following, where=following > 0, out=np.zeros_like(ahead))
        beta = following
        going &= (np.abs(phi) > tolerance * start) & (following > 0)
    return project(found)


@dataclass(frozen=True)
class Eigen:
    values: np.ndarray
    vectors: np.ndarray
    residual: float  # the largest, relative to the largest eigenvalue
    rounds: int


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int = COMPONENTS, seed: int = 7
) -> Eigen:
    """The ``wanted`` largest eigenpairs of a symmetric matrix that is only known by its products.

    Goes on until all residuals are at rounding level, or the search space is the whole space and
    a fresh product cannot lower them.
    """
    wanted = min(wanted, d)
    most = min(d, max(4 * wanted, wanted + 24))
    rng = np.random.default_rng(seed)
    space = _orthonormal(rng.standard_normal((d, min(d, 2 * wanted))), np.empty((d, 0)))
    image = product(space)
    locked = np.zeros(wanted, bool)
    best, stalled = math.inf, 0
    for rounds in range(1, ROUNDS + 1):
        inner = space.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn[:, :wanted], image @ turn[:, :wanted]
        residuals = ritz_image - ritz * values[:wanted]
        lengths = np.linalg.norm(residuals, axis=0)
        scale = max(abs(values[0]), np.finfo(np.float64).tiny)
        locked = lengths <= 4 * EPS * math.sqrt(d) * scale
        worst = float(lengths.max() / scale)
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        # A space that is whole, or residuals that rounding no longer lets fall, end it as well.
        if locked.all() or space.shape[1] == d or (stalled >= 3 and best < 1e-13):
            break
        if space.shape[1] + (~locked).sum() > most:
            keep = min(space.shape[1], 2 * wanted)
            space = np.linalg.qr(space @ turn[:, :keep])[0]
            image = product(space)
        new = corrections(product, values[:wanted][~locked], residuals[:, ~locked], ritz)
        new = _orthonormal(new, space)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((d, 1)), space)
        space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
    order = np.argsort(-values[:wanted], kind="stable")
    vectors = np.linalg.qr(ritz[:, order])[0]
    return Eigen(values[:wanted][order], vectors, worst, rounds)


def _project(centre: Centre, basis: np.ndarray, explained: np.ndarray, error: float):
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _matrices(batch)):
                rows = len(x)
                repeat = pa.array(np.repeat(np.arange(rows), k))
                deviations = [decimal.Decimal(v) for v in centre.deviations(x)]
                columns = [
                    ids.values.take(repeat),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, centre.n, np.int64)),
                    pa.array(deviations, pa.decimal128(38, 0)).take(repeat),
                    pa.array((centre.centred(x) @ basis).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ]
                names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def whiten(frame: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each usable row and component: the row's whitened coordinate and what belongs to it.

    An entry c counts as the integer floor(1024*c) + 100000. Rows whose vector is null, empty or
    holds a null or non-finite entry (or one of 2^42 or more, which has no exact integer) give
    nothing; where lengths differ, only vectors of the commonest length do (of equally common ones the longest).
    Columns: ``id``, ``component`` (from 1), ``n``, ``deviation`` (decimal; up to 38 digits),
    ``whitened``, ``explained`` and ``identity_error``. There are as many components as asked for,
    dimensions, or eigenvalues above rounding level, whichever is least: equal vectors alone, or a
    single one, give no rows. Equal eigenvalues have some orthonormal vectors of their common space.
    Null and repeated identifiers are rows like all others; an empty table gives none; other columns
    are ignored.
    """
    spark = frame.sparkSession
    kind = frame.schema[id].dataType
    schema = T.StructType([
        T.StructField("id", kind),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ])
    blocks = packed(frame, id, vector)
    centre = Centre.of(blocks)
    if centre is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    product = covariance_product(blocks, centre)
    trace = float(_summed(blocks, lambda x: np.square(centre.centred(x)).sum(axis=0)).sum()) / centre.n
    found = jacobi_davidson(product, len(centre.base), components)
    above = found.values > EPS * len(centre.base) * max(trace, 0.0)
    if not above.any():
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    values, vectors = found.values[above], found.vectors[:, above]
    basis = vectors / np.sqrt(values)
    error = float(np.abs(basis.T @ product(basis) - np.eye(len(values))).max())
    rows = blocks.select("ids", "d", "data").mapInArrow(_project(centre, basis, values / trace, error), schema)
    return rows.withColumnRenamed("id", id)
