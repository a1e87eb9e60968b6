"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Entries become whole numbers (`STEP` parts of a unit, plus `SHIFT`). Two passes over the vectors: count and sums (exact),
then the scatter around the rounded mean, as exact integers; the rest of a unit between the mean and its rounding is
taken off once. Partial sums leave each task as one row per dimension and are added by Spark.

What then remains is one matrix of dimension x dimension, bounded by `MAX_DIMENSION`, on the driver. P S P' = L L' with
the greatest remaining diagonal entry as pivot; rotating the columns of L until they are at right angles leaves columns
whose squared norms are the eigenvalues of S and whose directions are its eigenvectors, with no product L'L formed.

The third pass projects every vector; the covariance of what it wrote is then compared with the identity.

Defined cases: vectors that are null, hold nulls or non-finite entries, or entries beyond +-2^30, take no part; nor do
empty ones and those with another number of entries than most (ties: the fewer). Rows repeated with one id, and null
ids, are rows like others. Components whose eigenvalue is zero within rounding have no row; so a single vector, equal
vectors and an empty table give no rows. `deviation` is null where a long cannot hold it (`deviation_exact` can).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import saved, table

STEP, SHIFT = 1024, 100_000
COMPONENTS = 8
#: The scatter and the components are held by the driver and every task: 128 MB at this dimension.
MAX_DIMENSION = 4096
#: Entries beyond this are no sensible embedding and could leave the range of a long.
LARGEST = float(1 << 30)
#: Columns are at right angles when their cosine is below this.
ORTHOGONAL = 1e-15
SWEEPS = 60


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of long) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST)))
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size and size["size"] > MAX_DIMENSION:
        raise ValueError(f"vectors of {size['size']} entries, more than {MAX_DIMENSION}")
    return rows.where(F.size("v") == (size["size"] if size else 0)).select("vec_id", F.transform("v", lambda c: F.floor(c * STEP).cast("long") + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _decimals(values) -> pa.Array:
    """Whole numbers of any size as decimal(38,0); null beyond that."""
    return pa.array([None if abs(v) >= 10**38 else str(v) for v in values], pa.string()).cast(pa.decimal128(38, 0))


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                part = x.sum(axis=0).astype(object)
                n, s = n + len(x), part if s is None else s + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s), dtype="i4")), pa.array(np.full(len(s), n)), _decimals(s)], names=["dim", "n", "s"])

    parts = rows.select("x").mapInArrow(add, "dim int, n long, s decimal(38,0)")
    sums = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect()
    return (int(sums[0]["n"]) if sums else 0), [int(r["s"]) for r in sums]


def _products(y: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """y'y of whole numbers in parts, with the size their entries cannot exceed: float products of so few rows that every sum is exact."""
    top = max(1, int(np.abs(y).max(initial=0)))
    step = (1 << 53) // (top * top)
    if not step:  # too large for a float product: integers of any size
        wide = y.astype(object)
        yield wide.T @ wide, len(y) * top * top
        return
    f = y.astype(float)
    for k in range(0, len(f), step):
        part = f[k:k + step]
        yield (part.T @ part).astype(np.int64), len(part) * top * top


def scatter(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Sum over the vectors of (x - mean)(x - mean)', in double precision from exact integers."""
    middle = [(2 * s + n) // (2 * n) for s in sums]  # the mean, rounded

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(middle)
        i, j = np.triu_indices(d)
        wide, held, bound = np.zeros(len(i), object), np.zeros((d, d), np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for part, size in _products(_matrix(batch.column(0)) - np.array(middle)):
                if part.dtype == object:
                    wide += part[i, j]
                    continue
                if bound + size >= 1 << 62:
                    wide, held, bound = wide + held[i, j].astype(object), np.zeros((d, d), np.int64), 0
                held, bound = held + part, bound + size
        values = _decimals(wide + held[i, j].astype(object))
        for k in range(0, len(i), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(i[k:k + 50_000].astype("i4")), pa.array(j[k:k + 50_000].astype("i4")), values[k:k + 50_000]], names=["i", "j", "v"])

    # At most dimension^2 / 2 rows a task, summed in the task before they are shuffled, and as many in all.
    cells = rows.select("x").mapInArrow(add, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((len(sums), len(sums)))
    for r in cells.collect():
        rest = (sums[r["i"]] - n * middle[r["i"]]) * (sums[r["j"]] - n * middle[r["j"]])
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = (int(r["v"]) * n - rest) / n  # one rounding of the exact quotient
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (rows in pivot order, as many columns as the rank) and the order: a[order][:, order] = L L'."""
    a, d = a.copy(), len(a)
    order, rank = np.arange(d), d
    l = np.zeros((d, d))
    tiny = np.diag(a).max(initial=0) * d * np.finfo(float).eps
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= tiny:
            rank = k
            break
        if p != k:
            a[[k, p]], l[[k, p]], order[[k, p]] = a[[p, k]], l[[p, k]], order[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
        l[k, k] = np.sqrt(a[k, k])
        l[k + 1:, k] = a[k + 1:, k] / l[k, k]
        a[k + 1:, k + 1:] -= np.outer(l[k + 1:, k], l[k + 1:, k])
    return l[:, :rank], order


def _pairs(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of pairs that share no column."""
    ring = np.arange(n + n % 2)
    for _ in range(len(ring) - 1):
        a, b = ring[:len(ring) // 2], ring[len(ring) // 2:][::-1]
        keep = (a < n) & (b < n)
        yield np.minimum(a, b)[keep], np.maximum(a, b)[keep]
        ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))


def jacobi(l: np.ndarray) -> np.ndarray:
    """`l` with its columns rotated in pairs until all are at right angles."""
    c = l.T.copy()  # a column of l is a row here
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in _pairs(len(c)):
            x, y = c[i], c[j]
            xx, yy, xy = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            size = np.sqrt(xx * yy)
            turn = np.abs(xy) > ORTHOGONAL * size
            if not turn.any():
                continue
            worst = max(worst, float((np.abs(xy[turn]) / size[turn]).max()))
            i, j, x, y = i[turn], j[turn], x[turn], y[turn]
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = 1 / np.hypot(1, t)
            sin = cos * t
            c[i], c[j] = cos[:, None] * x - sin[:, None] * y, sin[:, None] * x + cos[:, None] * y
        if worst < 16 * ORTHOGONAL * max(1, len(c)):
            return c.T
    raise ArithmeticError(f"columns still {worst} from right angles after {SWEEPS} sweeps")


def principal(scattered: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of the covariance; the entry of greatest size is positive."""
    l, order = pivoted_cholesky(scattered)
    if not l.shape[1]:
        return np.zeros(0), np.zeros((len(scattered), 0))
    turned = jacobi(l)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.empty((len(scattered), len(by)))
    vectors[order] = turned[:, by] / norms[by]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(by))])
    return norms[by] ** 2 / n, vectors * sign


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, deviation_exact, whitened (an array), explained (an array) of each row that takes part; written once."""
    rows = usable(vectors)
    n, sums = totals(rows)
    scattered = scatter(rows, n, sums) if n else np.zeros((0, 0))
    values, axes = principal(scattered, max(1, n))
    values, axes = values[:components], axes[:, :components]
    explained = [float(v) for v in values / (np.trace(scattered) / n)] if len(values) else []
    schema = "vec_id long, deviation_exact decimal(38,0), whitened array<double>"

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [s // n for s in sums]
        part = np.array([(s - n * w) / n for s, w in zip(sums, whole)])
        scaled = axes / np.sqrt(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1)) - np.array(whole)  # exact; then less the mean's fraction
            rest = np.array([s - n * w for s, w in zip(sums, whole)], object)
            if (n * (int(np.abs(x).max()) + 1)) ** 2 * len(sums) < 1 << 63:
                gap = x * n - rest.astype(np.int64)
            else:
                gap = x.astype(object) * n - rest
            deviation = (gap * gap).sum(axis=1).tolist()
            w = (x - part) @ scaled
            yield pa.RecordBatch.from_arrays([
                batch.column(0), _decimals(deviation), pa.array(list(w), pa.list_(pa.float64())),
            ], names=["vec_id", "deviation_exact", "whitened"])

    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema).select("vec_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("deviation"), "deviation_exact", "whitened", F.array().cast("array<double>").alias("explained"))
    out = saved(rows.mapInArrow(project, schema), "whitened")
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), F.expr("try_cast(deviation_exact AS long)").alias("deviation"), "deviation_exact", "whitened", F.array(*[F.lit(e) for e in explained]).cast("array<double>").alias("explained"))


def identity_error(white: DataFrame, components: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity; centred sums, divisor n."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    at = lambda k: F.col("whitened")[k]
    found = white.agg(*[F.covar_pop(at(i), at(j)) for i, j in pairs]).first()
    return max((abs(v - (i == j)) for v, (i, j) in zip(found, pairs)), default=0.0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    first = white.select(F.size("whitened").alias("k")).first()
    error = identity_error(white, first["k"]) if first else 0.0
    each = white.select("vec_id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), F.lit(error).alias("identity_error"))
