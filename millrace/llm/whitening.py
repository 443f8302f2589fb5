"""Whitening of embeddings by a bidiagonal qd solver.

1. Vectors become integers; the fit list holds each distinct one once. Sums per
   dimension are exact, so rows can be centred exactly before anything is multiplied.
2. Blocks of centred rows are reduced to triangular factors, which are stacked and
   reduced again, level by level: R has the singular values of all rows.
3. Householder reflections make R bidiagonal, dqds finds its singular values to
   high relative accuracy, and twisted factorisations of the bidiagonal's normal
   matrix, by stationary and progressive qd transforms, give its singular vectors.
   Taken back through the reflections these are the whitening directions.

Only the factor R (dimensions squared) and the directions come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import read, written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: A scaled entry beyond this counts as this, so that sums fit 64 bits.
LARGEST = 1 << 31
#: Factors that one task stacks.
FAN_IN = 8
_EPS = float(np.finfo(np.float64).eps)
_TINY = 1e-290
#: Values nearer to each other than this share of them are a cluster.
_CLUSTER = 1e-7


# the small dense solver: R (dimensions x dimensions) to singular values and right singular vectors

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of ``r`` = U B V^T, by Householder reflections."""
    a = np.array(r, dtype=np.float64)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """w and the value that x is taken to: (I - 2 w w^T) x = (value, 0, ...)."""
        norm = np.linalg.norm(x)
        if norm == 0.0:
            return np.zeros_like(x), 0.0
        w = x / norm
        value = -norm if w[0] > 0 else norm
        w[0] += 1.0 if w[0] > 0 else -1.0
        return w / np.linalg.norm(w), value

    for k in range(n):
        w, value = reflector(a[k:, k])
        a[k:, k:] -= 2.0 * np.outer(w, w @ a[k:, k:])
        a[k, k], a[k + 1:, k] = value, 0.0
        if k < n - 2:
            w, value = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ w, w)
            a[k, k + 1], a[k, k + 2:] = value, 0.0
            v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by differential qd transforms with shifts.

    q and e are the squares of the entries. A shift below the least value keeps all
    q positive; one that was too large shows as a negative q and is taken back.
    Blocks end where e is negligible; a block's values are its shifts summed up.
    """
    q, e = (np.asarray(diagonal, float) ** 2).tolist(), (np.asarray(above, float) ** 2).tolist()
    n = len(q)
    largest = max([*q, *e], default=0.0)
    if n == 0 or largest == 0.0:
        return np.zeros(n)
    floor = largest * _EPS * _EPS * _EPS
    found: list[float] = []
    blocks, lo = [], 0
    for i in range(n - 1):  # the matrix falls apart where nothing couples
        if e[i] <= floor * _EPS:
            blocks.append((q[lo:i + 1], e[lo:i]))
            lo = i + 1
    blocks.append((q[lo:], e[lo:]))

    def transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
        nq, ne, d = [], [], q[0] - shift
        for i in range(len(e)):
            s = d + e[i]
            if d < 0.0 or not s > 0.0:
                if d < 0.0:
                    return None
                s = _TINY * largest
            t = q[i + 1] / s
            nq.append(s)
            ne.append(e[i] * t)
            d = d * t - shift
        if d < 0.0:
            return None
        nq.append(d)
        return nq, ne

    while blocks:
        q, e = blocks.pop()
        base = 0.0
        for _ in range(200 * (len(q) + 1)):
            while len(q) > 1 and e[-1] <= _EPS * _EPS * (base + q[-1]) + floor * _EPS:
                found.append(base + q.pop())
                e.pop()
            if len(q) == 1:
                found.append(base + q[0])
                break
            if len(q) == 2:  # both values of the last pair
                s, p = q[0] + q[1] + e[0], q[0] * q[1]
                high = 0.5 * (s + math.sqrt(max(0.0, (q[0] - q[1]) ** 2 + e[0] * (2.0 * (q[0] + q[1]) + e[0]))))
                found += [base + high, base + (p / high if high > 0.0 else 0.0)]
                break
            coupling = math.sqrt(q[-1] * e[-1])
            shift = max(0.0, q[-1] - coupling) if e[-1] < 0.25 * q[-1] else 0.0
            step = None
            while step is None:
                step = transform(q, e, shift)
                if step is None:
                    # a shift that failed is halved, a shift of zero cannot fail
                    shift = shift * 0.5 if shift > 1e-3 * q[-1] else 0.0
            q, e = step
            base += shift
            if q[0] < q[-1] and e[0] < e[-1]:  # the small values belong at the end: turn the matrix round
                q, e = _flipped(q, e)
        else:
            raise ArithmeticError("dqds did not converge")
    return np.array(sorted(found, reverse=True))


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The qd array of the reversed matrix: L^T L and L L^T have the same values."""
    return q[::-1], e[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """Unit vector z of B^T B z = value z, and what is left over (correction of ``value``).

    The normal matrix less ``value`` is factorised from the top (stationary qd) and
    from the bottom (progressive qd); the two meet at the place with the smallest
    pivot, from where the vector is read off in both directions.
    """
    d, e = np.asarray(diagonal) ** 2, np.asarray(above) ** 2
    off = (np.asarray(diagonal)[:-1] * np.asarray(above)).tolist()
    d, e = d.tolist(), e.tolist()
    n = len(d)
    tiny = _TINY + _EPS * _EPS * max(max(d), value)

    def safe(x: float) -> float:
        return x if abs(x) > tiny else (-tiny if x < 0 else tiny)

    s, up = [0.0] * n, [0.0] * n
    s[0] = -value
    for i in range(n - 1):
        up[i] = safe(s[i] + d[i])
        s[i + 1] = e[i] / up[i] * s[i] - value
    p, down = [0.0] * n, [0.0] * n
    p[n - 1] = d[n - 1] - value
    gamma = [0.0] * n
    gamma[n - 1] = s[n - 1] + d[n - 1]
    for i in range(n - 2, -1, -1):
        down[i + 1] = safe(e[i] + p[i + 1])
        t = d[i] / down[i + 1]
        gamma[i] = s[i] + t * p[i + 1]
        p[i] = t * p[i + 1] - value
    r = int(np.argmin(np.abs(gamma)))
    z = [0.0] * n
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -off[i] / up[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -off[i] / down[i + 1] * z[i]
    z = np.array(z)
    scale = np.abs(z).max()
    z = z / scale
    norm = float(z @ z)
    return z / math.sqrt(norm), gamma[r] / (norm * scale * scale)


def _blocks(diagonal: np.ndarray, above: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of a bidiagonal matrix that nothing couples."""
    limit = _EPS * _EPS * max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    lo = 0
    for k in np.flatnonzero(np.abs(above) <= limit).tolist():
        yield lo, k + 1
        lo = k + 1
    yield lo, len(diagonal)


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values of ``r``, falling, and their right vectors as columns.

    Values that rounding alone can make (below the largest times (size x eps) squared) are left out.
    """
    n = r.shape[1]
    if n == 0:
        return np.zeros(0), np.zeros((0, 0))
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, above, v = bidiagonalise(r / scale)
    parts = []
    for lo, hi in _blocks(diagonal, above):
        parts += [(x, lo, hi) for x in dqds_values(diagonal[lo:hi], above[lo:hi - 1])]
    parts.sort(key=lambda x: -x[0])
    least = parts[0][0] * (n * _EPS) ** 2
    parts = [p for p in parts if p[0] > least]
    columns: list[np.ndarray] = []
    k = 0
    while k < min(count, len(parts)):
        end = k + 1
        while end < len(parts) and parts[end - 1][0] - parts[end][0] <= _CLUSTER * parts[end - 1][0]:
            end += 1
        if end - k > 1:
            columns += list(_cluster(diagonal, above, [p[0] for p in parts[k:end]]).T)
        else:
            value, lo, hi = parts[k]
            z = np.zeros(n)
            part, change = twisted_vector(diagonal[lo:hi], above[lo:hi - 1], value)
            if abs(change) <= 1e-10 * value:  # one step of the quotient's correction
                part, _ = twisted_vector(diagonal[lo:hi], above[lo:hi - 1], value + change)
            z[lo:hi] = part
            for j in range(k):  # neighbours leave a trace of the rounding divided by their distance
                if parts[j][0] - value <= 1e-2 * value:
                    z -= (columns[j] @ z) * columns[j]
            columns.append(z / np.linalg.norm(z))
        k = end
    keep = min(count, len(columns))
    z = np.column_stack(columns[:keep]) if keep else np.zeros((n, 0))
    return np.array([p[0] for p in parts[:keep]]) * scale * scale, v @ z


def _cluster(diagonal: np.ndarray, above: np.ndarray, values: list[float]) -> np.ndarray:
    """Orthonormal vectors of values that lie too close for one factorisation each.

    Their common space is found by inverse iteration on all of them at once, and
    the vectors inside it by the small problem that it leaves.
    """
    n, k = len(diagonal), len(values)
    b = np.diag(diagonal) + np.diag(above, 1)
    normal = b.T @ b
    x = np.eye(n)
    if k < n:
        x = np.linalg.qr(np.random.default_rng(0).normal(size=(n, k)))[0]
        shifted = normal - np.eye(n) * (sum(values) / k * (1.0 + 16 * _EPS))
        for _ in range(3):
            try:
                x = np.linalg.qr(np.linalg.solve(shifted, x))[0]
            except np.linalg.LinAlgError:
                shifted = shifted + np.eye(n) * (64 * _EPS * values[0])
    y = b @ x
    return (x @ np.linalg.eigh(y.T @ y)[1])[:, ::-1]


# the distributed part

def _fold(blocks: Iterator[np.ndarray], dims: int) -> np.ndarray | None:
    """R of all rows of the blocks, one block at a time."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack((r, block)), mode="r")
    return r


def _rows(binary: pa.Array, dims: int) -> np.ndarray:
    """Integer vectors of an Arrow column of packed rows."""
    return np.frombuffer(b"".join(binary.to_pylist()), np.int64).reshape(-1, dims)


def integer_rows(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int, offset: int) -> DataFrame:
    """``id`` and ``x`` (packed 64-bit integers floor(scale * c) + offset); rows that take no part left out."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("x", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0]:offsets[-1]]
            length = np.diff(offsets)
            c = np.zeros((len(length), dims))
            row = np.repeat(np.arange(len(length)), length)
            c[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], length)] = flat
            x = np.clip(np.floor(c * scale), -LARGEST, LARGEST).astype(np.int64) + offset
            raw = x.tobytes()
            size = 8 * dims
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([raw[k:k + size] for k in range(0, len(raw), size)], pa.binary())], ["id", "x"])

    return _valid(df, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(pack, schema)


def _valid(df: DataFrame, vector_col: str) -> DataFrame:
    x = F.col(vector_col)
    return df.filter(x.isNotNull() & F.coalesce(
        F.forall(x, lambda c: F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False)))


def _sums(fit: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Rows of the fit list and exact sums per dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, np.int64)
        for batch in batches:
            x = _rows(batch.column("x"), dims)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims + 1, dtype=np.int32)), pa.array(np.append(total, n))], ["dim", "s"])

    found = dict(fit.mapInArrow(add, "dim int, s long").groupBy("dim").agg(F.sum("s")).collect())  # dims + 1 rows
    return int(found.get(dims, 0)), np.array([found.get(d, 0) for d in range(dims)], dtype=np.int64)


def triangular_factor(fit: DataFrame, dims: int, n: int, total: np.ndarray) -> np.ndarray:
    """R of the centred rows of the fit list: blockwise QR, and factors stacked level by level."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _fold(((_rows(b.column("x").slice(lo, 4096), dims) * n - total) / n
                   for b in batches for lo in range(0, b.num_rows, 4096)), dims)
        if r is not None:
            yield packed(r)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _fold((np.frombuffer(x.as_buffer(), np.float64).reshape(-1, dims) for b in batches for x in b.column("r")), dims)
        if r is not None:
            yield packed(r)

    def packed(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], ["r"])

    level = written(fit.mapInArrow(first, "r binary"), "factors")
    left = level.count()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        level = written(level.repartition(left).mapInArrow(again, "r binary"), "factors")
        left = level.count()
    last = [np.frombuffer(r["r"], np.float64).reshape(-1, dims) for r in level.collect()]  # FAN_IN factors at most
    r = _fold(iter(last), dims)
    return np.zeros((0, dims)) if r is None else r


def identity_error(fit: DataFrame, dims: int, n: int, total: np.ndarray, directions: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance less the identity.

    Every block is centred before it is multiplied; blocks are then combined by
    their counts, means and centred products.
    """
    k = directions.shape[1]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, product = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = (_rows(batch.column("x"), dims) * n - total) / n @ directions
            if len(w):
                count, mean, product = _joined((count, mean, product), (len(w), w.mean(axis=0), _centred(w)))
        if count:
            yield row(count, mean, product)

    def row(count: int, mean: np.ndarray, product: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([count], pa.int64()), pa.array([mean.tobytes()], pa.binary()),
                                           pa.array([product.tobytes()], pa.binary())], ["count", "mean", "product"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for c, m, p in zip(*(batch.column(x).to_pylist() for x in ("count", "mean", "product"))):
                one = (c, np.frombuffer(m), np.frombuffer(p).reshape(k, k))
                out = one if out is None else _joined(out, one)
        if out is not None:
            yield row(*out)

    schema = "count long, mean binary, product binary"
    level = written(fit.mapInArrow(moments, schema), "moments")
    left = level.count()
    while left > FAN_IN:
        level = written(level.repartition(-(-left // FAN_IN)).mapInArrow(combine, schema), "moments")
        left = level.count()
    out = None
    for r in level.collect():  # FAN_IN rows at most
        one = (r["count"], np.frombuffer(r["mean"]), np.frombuffer(r["product"]).reshape(k, k))
        out = one if out is None else _joined(out, one)
    return float(np.abs(out[2] / out[0] - np.eye(k)).max(initial=0.0)) if out else 0.0


def _centred(w: np.ndarray) -> np.ndarray:
    c = w - w.mean(axis=0)
    return c.T @ c


def _joined(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets of rows together."""
    n = a[0] + b[0]
    if not n:
        return a
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Whitened coordinates: ``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    One row for each row that takes part and each component (1 to ``components``,
    by falling eigenvalue; only those whose eigenvalue is not zero up to rounding,
    so a fit list of one vector has none and gives no rows). Rows with a null vector
    or a null or non-finite entry take no part. Entries become integers floor(scale *
    c) + offset; those that a shorter vector lacks are those of zero; a scaled entry
    beyond 2**31 counts as that. ``n`` counts the distinct integer vectors, over
    which all statistics are taken. ``deviation`` is null where it does not fit 64
    bits. Repeated and null ids keep their rows; vectors of equal integers have equal
    coordinates; other columns are not read; an empty table gives no rows.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    dims = _valid(df, vector_col).agg(F.max(F.size(vector_col))).first()[0] or 0
    if not dims:
        return spark.createDataFrame([], schema)
    rows = integer_rows(df, id_col, vector_col, dims, scale, offset)
    fit = written(rows.select("x").distinct(), "fit-list")
    n, total = _sums(fit, dims)
    r = triangular_factor(fit, dims, n, total)
    values, vectors = right_singular(r, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    directions = vectors / np.sqrt(values / n)
    explained = values / float((r * r).sum())
    error = identity_error(fit, dims, n, total, directions)
    model = spark.sparkContext.broadcast((total, directions, explained))  # dims x components

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, directions, explained = model.value
        k = directions.shape[1]
        for batch in batches:
            d = _rows(batch.column("x"), dims) * n - total
            w = d / n @ directions
            size = (d.astype(np.float64) ** 2).sum(axis=1)
            far = size >= 9.2e18
            deviation = np.where(far, 0, (d * d).sum(axis=1))
            rows = len(d)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(np.repeat(np.arange(rows), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)),
                 pa.array(np.repeat(deviation, k), pa.int64(), mask=np.repeat(far, k)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))], schema.names)

    return rows.mapInArrow(project, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen whitened coordinates of every embedding."""
    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
