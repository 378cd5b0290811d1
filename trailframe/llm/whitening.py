"""Embedding whitening with eigenvectors refined in mixed precision.

Entries are scaled to integers. Their sums are exact, and so is the covariance: tasks multiply entries less the rounded mean, in
blocks whose products are exact in double precision, and add them as integers; the remainder of the mean is taken off exactly. The driver
holds one (dimension x dimension) matrix and nothing that grows with the rows.

Single-precision eigenvectors of that matrix are corrected by the iteration of Ogita and Aishima (2018), which is a few matrix products a
step in extended precision (sums of exact products of slices): with R = I - X'X and S = X'AX the correction of an entry is (S + e R) / (e_j - e_i) for separated eigenvalues and R / 2
for those closer than the error bound. Such clusters (Ogita and Aishima 2019) are then solved by themselves: the small matrix X_J'(A - m I)X_J is
scaled up before its eigenvectors turn the columns X_J, so that digits that the large eigenvalue drowned count again.
The steps end when the residual no longer shrinks.

Whitened rows are the centred entries projected on the components and divided by the root of the eigenvalue. Their covariance is measured over
all rows in one more pass.

Defined cases: rows whose vector is null, empty, or has null or non-finite entries are dropped; so are rows whose vector hasn't the commonest length
(the longer one of equally common ones). Ids may be null or repeated: every row counts and is returned. With fewer than ``COMPONENTS``
dimensions there are fewer components. A component without variance (constant or too few rows) has no whitened value (null) and takes no
part in the error; ``explained`` is then 0. A deviation beyond 64 bits is null; scaled entries beyond ``LARGEST`` are held at it. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailframe.session import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Scaled entries beyond this are held at it, so that sums of products fit 38 digits.
LARGEST = 1 << 52
#: Rows multiplied at once.
CHUNK = 4096
STEPS = 20
WIDE = np.longdouble


@dataclass
class Fit:
    """Exact sums of the integer vectors: n, S, and n * sum(xx') - SS' (which is n^2 times the covariance)."""

    n: int
    sums: list[int]
    scatter: list[list[int]]

    @property
    def covariance(self) -> np.ndarray:
        n2 = WIDE(self.n) * WIDE(self.n)
        return np.array([[WIDE(v) for v in row] for row in self.scatter], dtype=WIDE) / n2


def gram(x: np.ndarray) -> np.ndarray:
    """x'x of integers, exactly, as Python integers."""
    out = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for at in range(0, len(x), CHUNK):
        part = x[at:at + CHUNK]
        wide = part.astype(np.float64)
        if np.abs(wide).max(initial=0) ** 2 * len(part) < 2.0**53:
            out += (wide.T @ wide).astype(np.int64).astype(object)
        else:
            out += part.astype(object).T @ part.astype(object)
    return out


def matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, width)


def exact_fit(rows: DataFrame, width: int) -> Fit:
    """Two passes over column x: sums, then products of entries less the rounded mean."""
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    first = rows.agg(F.count(F.lit(1)), *[exact(F.col("x")[j]) for j in range(width)]).first()
    n, sums = first[0], [int(v) for v in first[1:]]
    middle = np.array([s // n for s in sums], dtype=object)
    names = ["i", *[f"v{j}" for j in range(width)]]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            x = matrix(batch, "x", width)
            total += gram(x - middle.astype(np.int64))
        columns = [pa.array(range(width), type=pa.int32())]
        columns += [pa.array([Decimal(int(v)) for v in total[:, j]], type=pa.decimal128(38, 0)) for j in range(width)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    summed = rows.select("x").mapInArrow(products, "i int, " + ", ".join(f"v{j} decimal(38,0)" for j in range(width)))
    summed = summed.groupBy("i").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(width)]).orderBy("i").collect()
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    scatter = [[n * int(row[j + 1]) - rest[row["i"]] * rest[j] for j in range(width)] for row in summed]
    return Fit(n, sums, scatter)


def slices(x: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """Three double matrices whose sum is ``x``; each has entries of few bits on one scale along ``axis``."""
    out = []
    for _ in range(3):
        top = np.maximum(np.abs(x).max(axis=axis, keepdims=True), WIDE(2.0) ** -1000)
        scale = WIDE(2.0) ** (np.ceil(np.log2(top)) - bits)
        part = np.rint(x / scale) * scale
        out.append(part.astype(np.float64))
        x = x - part
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in extended precision from double products of slices, each of which is exact."""
    bits = (51 - math.ceil(math.log2(max(2, a.shape[1])))) // 2
    left, right = slices(a, 1, bits), slices(b, 0, bits)
    out = np.zeros((a.shape[0], b.shape[1]), dtype=WIDE)
    for i, j in ((2, 0), (1, 1), (0, 2), (1, 0), (0, 1), (0, 0)):
        out += (left[i] @ right[j]).astype(WIDE)
    return out


def clusters(values: np.ndarray, bound: np.longdouble) -> Iterator[np.ndarray]:
    """Places of runs of sorted values whose neighbours are within ``bound``."""
    gaps = np.nonzero(np.diff(values) > bound)[0] + 1
    return (np.array(j) for j in np.split(np.arange(len(values)), gaps) if len(j) > 1)


def orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns that are nearly orthonormal, made so in extended precision."""
    for _ in range(6):
        r = np.eye(x.shape[1], dtype=WIDE) - times(x.T, x)
        x = x + times(x, r) / 2
        if np.abs(r).max() < 1e-10:  # the error left is its square
            break
    return x


def turned(a: np.ndarray, x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The columns ``places`` of ``x``, turned to the eigenvectors of ``a`` inside their span; the largest comes last."""
    own = x[:, places]
    middle = (own[:, 0] @ (a @ own[:, 0]))
    small = times(own.T, times(a, own) - middle * own)
    size = np.abs(small).max()
    if size == 0:
        return own
    small = (small + small.T) / (2 * size)
    return times(own, orthonormal(np.linalg.eigh(small.astype(np.float64))[1].astype(WIDE)))


def correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble, np.longdouble]:
    """Eigenvalues, the matrix E of the step x + xE, the bound under which eigenvalues can't be told apart, and the largest residual."""
    norm = lambda m: WIDE(np.linalg.norm(m.astype(np.float64), 2))
    r = np.eye(x.shape[1], dtype=WIDE) - times(x.T, x)
    s = times(x.T, times(a, x))
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    bound = 2 * (norm(off) + norm(a) * norm(r))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > bound
    return values, np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2), bound, np.abs(off).max()


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix in extended precision."""
    a = (a + a.T) / 2
    size = max(np.abs(a).max(), np.finfo(WIDE).tiny)
    a = a / size
    x = orthonormal(np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE))
    best, least = x, WIDE(math.inf)
    for _ in range(STEPS):
        values, e, bound, residual = correction(a, x)
        if residual >= least / 2:
            break
        best, least = x, residual
        x = orthonormal(x + times(x, e))
        values = np.diag(times(x.T, times(a, x)))
        order = np.argsort(values, kind="stable")
        x = x[:, order]
        for places in clusters(values[order], bound):
            x[:, places] = turned(a, x, places)
    values = np.diag(times(best.T, times(a, best))) * size
    order = np.argsort(-values, kind="stable")
    return values[order], best[:, order]


@dataclass
class Whitening:
    """What tasks need to whiten a row: ``turn`` has a column per component, with its scale."""

    n: int
    sums: list[int]
    turn: np.ndarray
    shown: np.ndarray
    explained: list[float]

    @classmethod
    def of(cls, fit: Fit, most: int) -> Whitening:
        values, vectors = eigenvectors(fit.covariance)
        trace = np.diag(fit.covariance).sum()
        k = min(most, len(values))
        shown = values[:k] > max(trace, 0) * np.finfo(np.float64).eps * len(values)
        scale = np.where(shown, 1 / np.sqrt(np.where(shown, values[:k], 1)), 0)
        return cls(fit.n, fit.sums, (vectors[:, :k] * scale).astype(np.float64), shown,
                   [float(v / trace) if s else 0.0 for v, s in zip(values[:k], shown, strict=True)])

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """n * x - S, and its squared length as an exact integer where 64 bits hold it."""
        top = float(np.abs(x.astype(np.float64)).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        own = x * np.int64(self.n) - np.array(self.sums, dtype=np.int64) if top < 2.0**62 else x.astype(object) * self.n - np.array(self.sums, dtype=object)
        reach = float(np.abs(own.astype(np.float64)).max(initial=0))
        if reach**2 * x.shape[1] >= 2.0**62:
            own = own.astype(object)
        squares = (own * own).sum(axis=1).tolist()
        return own.astype(np.float64), [v if v < 1 << 63 else None for v in squares]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, squares = self.deviations(matrix(batch, "x", len(self.sums)))
            z = (own / self.n) @ self.turn
            flat = pa.array(z.ravel(), mask=np.tile(~self.shown, len(z)))
            z = pa.FixedSizeListArray.from_arrays(flat, z.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(squares, type=pa.int64()), z], names=["id", "deviation", "z"])


def identity_error(white: DataFrame, shown: np.ndarray) -> float | None:
    """Largest absolute entry of the covariance of column z less the identity, over the components that have values."""
    use = [int(j) for j in np.nonzero(shown)[0]]
    if not use:
        return None
    both = [(i, j) for i in use for j in use if i <= j]
    means = white.agg(*[F.avg(F.col("z")[j]) for j in use]).first()
    at = dict(zip(use, means, strict=True))
    centred = lambda j: F.col("z")[j] - F.lit(at[j])
    found = white.agg(*[F.avg(centred(i) * centred(j)) for i, j in both]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, both, strict=True))


RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row; ``rows`` has id and x (an array of longs)."""
    fine = rows.filter("x is not null and size(x) > 0 and not exists(x, v -> v is null)").select(F.col("id").cast("long").alias("id"), "x")
    lengths = fine.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    width = lengths["w"]
    fine = fine.filter(F.size("x") == width)
    plan = Whitening.of(exact_fit(fine, width), components)
    white = materialize(fine.mapInArrow(plan, "id long, deviation long, z array<double>"), "whitened")
    return white.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "id", (F.col("at") + 1).alias("component"), F.lit(plan.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, plan.explained)), F.col("at") + 1).alias("explained"),
        F.lit(identity_error(white, plan.shown)).cast("double").alias("identity_error"))


def whitened_embeddings(embeddings: DataFrame) -> DataFrame:
    """The first components of every usable embedding."""
    fine = "embedding is not null and not exists(embedding, v -> v is null or isnan(v) or abs(v) = double('infinity'))"
    held = lambda v: F.greatest(F.least(v, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("embedding", lambda v: held(F.floor(F.lit(float(SCALE)) * v.cast("double"))) + F.lit(SHIFT))
    return whiten(embeddings.filter(fine).select(F.col("vec_id").alias("id"), x.alias("x"))).withColumnRenamed("id", "vec_id")
