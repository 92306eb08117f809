"""Operator 12, embedding whitening by spectrum slicing.

Entries become whole numbers (``numbers``); the fit list is every distinct vector of them once.  Its size, exact sums and
covariance are summed over the partitions: first the sums, then, with the mean known, the products of centred vectors.
The covariance has a fixed size, the square of the dimension, and goes to the driver alone.  There the leading
eigenvalues are found by slicing the spectrum: the inertia of V - s I, read from the block diagonal of its LDL'
factorisation (Bunch-Parlett pivots), counts the eigenvalues over s, so bisection isolates each one by its number.
Rayleigh quotient iteration, started inside the isolating interval, converges cubically to the eigenvector; counts just
below and above the eigenvalue certify its number.  Eigenvalues that can't be told apart in double precision share an
orthonormal basis of their space.  Every vector is then centred and projected in a further pass.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are rows of
another length than most of the rest have (of equally frequent lengths the longest counts); repeated rows count once in
the fit and keep a result each; entries of over 2^62 in size count as that; eigenvalues of at most ``RANK`` of the trace
count as zero and give no component, so a list of equal vectors has no rows; a deviation that no long can hold is null;
rows without an id are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import ship, stored

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
RANK = 1e-12
_PIVOT = (1 + 17 ** 0.5) / 8        # least ratio of a diagonal pivot to the largest entry beside it
_EPS = np.finfo(float).eps
_SAFE = 1 << 62


# --------------------------------------------------------------------------- eigenpairs of a symmetric matrix

def eigenvalues_over(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues over a shift: positive pivots of the LDL' factorisation of matrix - shift I."""
    a = matrix - shift * np.eye(len(matrix))
    over = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        beside = np.abs(a)
        np.fill_diagonal(beside, 0)
        at = int(beside.argmax())
        if diagonal[i] >= _PIVOT * beside.flat[at]:
            if diagonal[i] == 0:        # all that is left is zero: eigenvalues equal to the shift
                break
            rest = np.delete(np.arange(len(a)), i)
            over += a[i, i] > 0
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, i], a[rest, i] / a[i, i])
        else:                           # a pivot of two rows has one positive and one negative eigenvalue
            pair = np.array(divmod(at, len(a)))
            rest = np.delete(np.arange(len(a)), pair)
            over += 1
            side = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pair, pair)], side.T)
        a = (a + a.T) / 2
    return over


class Slicer:
    """Isolates eigenvalues by their number, counted from the largest; keeps all counts that it has made."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        reach = float(np.abs(matrix).sum(axis=1).max())
        self.unit = max(reach, np.finfo(float).tiny) * _EPS * 4 * len(matrix)      # what the factorisation can tell apart
        self.counts = {-reach - self.unit: len(matrix), reach + self.unit: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = eigenvalues_over(self.matrix, shift)
        return self.counts[shift]

    def around(self, k: int) -> tuple[float, float]:
        """Nearest known shifts with at least k and under k eigenvalues over them."""
        return max(s for s, n in self.counts.items() if n >= k), min(s for s, n in self.counts.items() if n < k)

    def isolate(self, k: int, narrower_than: float = np.inf) -> tuple[float, float, int, int]:
        """(low, high, first, last): the eigenvalues with these numbers lie between, only the k-th if they can be told apart."""
        while True:
            low, high = self.around(k)
            first, last = self.counts[high] + 1, self.counts[low]
            if high - low <= self.unit or (first == last and high - low < narrower_than):
                return low, high, first, last
            self.count((low + high) / 2)


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, unit: float) -> np.ndarray:
    """(matrix - shift I)^-1 x; a shift that is an eigenvalue to the last bit is moved by a rounding error."""
    for move in (0.0, unit, -unit, 16 * unit):
        try:
            y = np.linalg.solve(matrix - (shift + move) * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    raise ArithmeticError("no inverse near an eigenvalue")


def leading_pairs(matrix: np.ndarray, most: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the largest eigenvalues over ``least``, at most ``most``, certified by counts."""
    d = len(matrix)
    slicer = Slicer(matrix)
    wanted = min(most, slicer.count(least)) if d else 0
    values, vectors = np.zeros(wanted), np.zeros((d, wanted))
    rng = np.random.default_rng(12)
    k = 1
    while k <= wanted:
        low, high, first, last = slicer.isolate(k)
        if first == last:
            width = np.inf
            while True:
                x = rng.standard_normal(d)
                for _ in range(2):                          # inverse iteration inside the interval to start
                    x = _solve(matrix, (low + high) / 2, x / np.linalg.norm(x), slicer.unit)
                x /= np.linalg.norm(x)
                value = float(x @ matrix @ x)
                for _ in range(12):
                    x = _solve(matrix, value, x, slicer.unit)
                    x /= np.linalg.norm(x)
                    value = float(x @ matrix @ x)
                    if np.linalg.norm(matrix @ x - value * x) <= slicer.unit:
                        break
                if low - slicer.unit <= value <= high + slicer.unit:
                    break
                width = (high - low) / 4                    # it went to a neighbour: start nearer
                low, high, first, last = slicer.isolate(k, width)
                if first < last or high - low <= slicer.unit:
                    raise ArithmeticError(f"eigenvalue {k} can't be followed")
            for _ in range(2):                              # neighbours nearer than rounding allows share some of it
                x = x - vectors[:, :k - 1] @ (vectors[:, :k - 1].T @ x)
                x /= np.linalg.norm(x)
            values[k - 1], vectors[:, k - 1] = value, x
        else:                                               # not to be told apart: a basis of their common space
            x = rng.standard_normal((d, last - first + 1))
            for _ in range(4):
                x, _ = np.linalg.qr(_solve(matrix, (low + high) / 2, x, slicer.unit))
            quotients = np.einsum("ij,ij->j", x, matrix @ x)
            for i, j in zip(range(first, last + 1), np.argsort(-quotients), strict=True):
                if k <= i <= wanted:
                    values[i - 1], vectors[:, i - 1] = quotients[j], x[:, j]
        k = last + 1
    for k in range(1, wanted + 1):
        if not slicer.count(values[k - 1] - 4 * slicer.unit) >= k > slicer.count(values[k - 1] + 4 * slicer.unit):
            raise ArithmeticError(f"eigenvalue {k} is not certified")
    return values, vectors


# --------------------------------------------------------------------------- the fit list and its sums

def numbers(vector: Column) -> Column:
    """Whole numbers of a vector; null if the row is to be dropped."""
    entries = vector.cast("array<double>")
    bound = F.lit(float(_SAFE))
    whole = F.transform(entries, lambda c: F.floor(F.greatest(F.least(c * SCALE, bound), -bound)) + OFFSET)
    good = (F.size(entries) > 0) & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)), whole)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists of longs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def summed(rows: DataFrame, partial, height: int, width: int) -> np.ndarray:
    """Sum over all partitions of ``partial`` (matrix of a batch of vectors -> float matrix of that size).

    Every partition gives ``height`` rows; a row's numbers are summed where its index is dealt to, and one matrix goes
    to the driver.
    """

    def part(batches):
        total = np.zeros((height, width))
        for batch in batches:
            if batch.num_rows:
                total += partial(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(range(height), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "sums"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[i] = total.get(i, 0.0) + np.frombuffer(sums)
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([r.tobytes() for r in total.values()], pa.binary())], ["i", "sums"])

    schema = "i int, sums binary"
    out = np.zeros((height, width))
    for i, sums in rows.mapInArrow(part, schema).repartition(height, "i").mapInArrow(add, schema).collect():
        out[i] = np.frombuffer(sums)
    return out


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """(number of vectors, sum of each dimension), exactly: sums of a batch in Python's numbers where longs could overflow."""

    def part(batches):
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            small = int(np.abs(x).max()) * len(x) < _SAFE
            sums = x.sum(axis=0).tolist() if small else x.astype(object).sum(axis=0).tolist()
            n, total = n + len(x), sums if total is None else [a + b for a, b in zip(total, sums, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([str(s) for s in total], pa.string()),
                                              pa.array([n] * len(total), pa.int64())], ["i", "s", "n"])

    got = (rows.mapInArrow(part, "i int, s string, n long").groupBy("i")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect())      # a row per dimension
    sums = {r.i: r.s for r in got}
    return (got[0].n if got else 0), [int(sums[i]) for i in range(len(sums))]


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` distinct vectors with these sums: eigenvalues, eigenvectors as columns, and figures of the fit."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: of longs where they can hold its squares' sum, else of Python's numbers."""
        base = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=object)
        far = max((abs(int(v)) for v in (x.max(), x.min(), base.max(), base.min())), default=0)
        if far < _SAFE // 4:
            near = x - base
            most = self.n * (int(np.abs(near).max()) + 1)
            if most * most * x.shape[1] < _SAFE:
                return near * self.n - rest.astype(np.int64)
            x, base = near, np.zeros(x.shape[1], dtype=np.int64)
        return (x.astype(object) - base.astype(object)) * self.n - rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.differences(x) / self.n).astype(float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def prepared(embeddings: DataFrame, vector_col: str) -> DataFrame:
    """The rows that remain, with their whole numbers in a column ``x``."""
    rows = embeddings.withColumn("x", numbers(F.col(vector_col))).where("x is not null")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)
    found = lengths.collect()
    return rows.where(F.size("x") == (found[0].d if found else 0))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of a table whose column ``x`` holds whole numbers; None if it has no rows."""
    listed = stored(vectors.select("x").distinct(), "whitening")
    n, sums = exact_sums(listed)
    if not n:
        return None
    d = len(sums)
    known = Whitening(n, tuple(sums), np.zeros(0), np.zeros((d, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        c = known.centred(x)
        return c.T @ c

    covariance = summed(listed, products, d, d) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, basis = leading_pairs(covariance, components, RANK * trace)
    model = Whitening(n, tuple(sums), values, basis, trace)
    if not len(values):
        return model

    def squares(x: np.ndarray) -> np.ndarray:
        z = model.whitened(x)
        return z.T @ z

    off = summed(listed, squares, len(values), len(values)) / n - np.eye(len(values))
    return Whitening(n, tuple(sums), values, basis, trace, float(np.abs(off).max()))


_SCHEMA = "`{0}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component: see the contract of the query; components are numbered by falling eigenvalue."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = prepared(embeddings.select(F.col(id_col).cast("long").alias(id_col), F.col(vector_col).alias("vector")), "vector").select(id_col, "x")
    model = fit(rows, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], _SCHEMA.format(id_col))

    def run(batches):
        k = len(model.values)
        explained = model.values / model.trace
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            u = model.differences(x)
            far = (u * u).sum(axis=1).tolist()
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            deviation = pa.array([v if v < 1 << 63 else None for v in far], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), deviation.take(each),
                 pa.array(model.whitened(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _SCHEMA.format(id_col))
