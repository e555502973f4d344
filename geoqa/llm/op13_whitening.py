"""Operator 13 - whitening of embeddings by an exact characteristic polynomial.

1. Entries become whole numbers; the distinct vectors are the fit list.  Tasks add up their
   entries and products exactly (products of 20-bit limbs are exact in a double, sums go
   on as long integers and base-2^40 digits), Spark adds the digits; so the scatter matrix
   M = n * sum of y y' - S S' = n^2 * covariance is exact whatever the size of the table.
2. The characteristic polynomial of M modulo many primes, a Spark row for each prime, by
   Hessenberg reduction; its integer coefficients by Chinese remaindering.
3. The largest roots, isolated and refined exactly (``charpoly``), multiple ones with their
   multiplicity.
4. Components, a Spark row for each distinct root: the null space of M - root * I by inverse
   iteration with as many digits as the gaps between roots ask for, orthonormal.
5. Rows are projected in batches; the covariance of the whitened fit list is summed by Spark
   and compared with the identity.

Only d x d numbers, residues and roots come to the driver.
"""

from __future__ import annotations

import decimal
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import charpoly as C
from geoqa.llm.common import arrow_map, only, stored, table

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: Bits of a limb and rows of a block: limb products of a block add up exactly in a double.
LIMB, ROWS = 20, 4096
_DIGIT = 40
#: Significant bits of a root beyond those that its gap needs.
BITS = 160


# ---------------------------------------------------------------- vectors


def _sizes(col: pa.Array) -> np.ndarray:
    """Entries of each vector; none for null."""
    size = np.full(len(col), col.type.list_size) if pa.types.is_fixed_size_list(col.type) else np.diff(col.offsets.to_numpy())
    return np.where(col.is_valid().to_numpy(zero_copy_only=False), size, 0)


def whole_vectors(col: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that remain, their entries floor(SCALE * c), one after the other): no null, no null or non-finite
    entry, none of 2^62 or more after scaling; with ``dims``, only vectors of that length, as a matrix."""
    size = _sizes(col)
    value = col.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        value = np.floor(value * SCALE)
        bad = ~(np.abs(value) < 2.0 ** 62)
    row = np.repeat(np.arange(len(col)), size)
    stay = (size > 0 if dims is None else size == dims) & (np.bincount(row, bad, len(col)) == 0)
    entries = value[stay[row]].astype(np.int64)
    return np.flatnonzero(stay), entries if dims is None else entries.reshape(-1, dims)


def common_size(df: DataFrame, vector: str) -> int:
    """Entries of most of the vectors that remain (the larger number in a tie); 0 without any."""

    def run(batches):
        for b in batches:
            rows, _ = whole_vectors(b.column(0))
            key, n = np.unique(_sizes(b.column(0))[rows], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["size", "n"])

    got = arrow_map(df.select(vector), run, "size long, n long").groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return int(got["size"]) if got else 0


def packed(y: np.ndarray) -> list[bytes]:
    """Each row as bytes; equal rows are equal bytes: entries take 2, 4 or 8 bytes, as the row needs."""
    most = np.maximum(y.max(1), -1 - y.min(1)) if len(y) else np.zeros(0, np.int64)
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    out: list[bytes] = [b""] * len(y)
    for w in (2, 4, 8):
        which = np.flatnonzero(width == w)
        raw, size = y[which].astype(f"<i{w}").tobytes(), w * y.shape[1]
        for k, i in enumerate(which.tolist()):
            out[i] = bytes([w]) + raw[k * size:(k + 1) * size]
    return out


def unpacked(col: pa.Array, dims: int) -> np.ndarray:
    rows = [v.as_buffer() for v in col]
    out = np.empty((len(rows), dims), np.int64)
    for i, v in enumerate(rows):
        w = (len(v) - 1) // dims
        out[i] = np.frombuffer(v, f"<i{w}", dims, 1)
    return out


def fit_list(df: DataFrame, vector: str, dims: int) -> DataFrame:
    """``v``: each distinct whole vector once, packed."""

    def run(batches):
        for b in batches:
            _, y = whole_vectors(b.column(0), dims)
            yield pa.RecordBatch.from_arrays([pa.array(packed(y), pa.binary())], ["v"])

    return arrow_map(df.select(vector), run, "v binary").distinct()


# ---------------------------------------------------------------- exact scatter


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as sum of limb[k] * 2^(LIMB k); all but the last are not negative."""
    out = []
    while np.abs(y).max(initial=0) >= 1 << LIMB:
        out.append((y & (1 << LIMB) - 1).astype(np.float64))
        y = y >> LIMB
    return [*out, y.astype(np.float64)]


class _Exact:
    """Sums of entries and products, exact: 64-bit sums by power of the limb, whole numbers without bound in the end."""

    def __init__(self, dims: int):
        self.n, self.dims = 0, dims
        self.total = np.zeros((dims + 1, dims), object)  # last row: sums of entries
        self.held: dict[int, np.ndarray] = {}
        self.blocks = 0

    def add(self, y: np.ndarray) -> None:
        for lo in range(0, len(y), ROWS):
            part = y[lo:lo + ROWS]
            limbs = _limbs(part)
            self.n += len(part)
            for i, a in enumerate(limbs):
                for j, b in enumerate(limbs):
                    self._hold(i + j, (a.T @ b).astype(np.int64), slice(0, self.dims))
                self._hold(i, a.sum(0).astype(np.int64), self.dims)
            self.blocks += 1
            if self.blocks == 64:  # 64 blocks of some products of 2^52 at most
                self._flush()

    def _hold(self, power: int, value: np.ndarray, at) -> None:
        if power not in self.held:
            self.held[power] = np.zeros((self.dims + 1, self.dims), np.int64)
        self.held[power][at] += value

    def _flush(self) -> None:
        for power, value in self.held.items():
            self.total = self.total + value.astype(object) * (1 << LIMB * power)
        self.held, self.blocks = {}, 0

    def digits(self):
        """(row, column, place, digit) of all sums; row -1 is the number of vectors."""
        self._flush()
        for i in range(self.dims + 1):
            for j in range(i if i < self.dims else 0, self.dims):
                v = int(self.total[i, j])
                sign, v, k = (-1 if v < 0 else 1), abs(v), 0
                while v:
                    yield i, j, k, sign * (v & (1 << _DIGIT) - 1)
                    v, k = v >> _DIGIT, k + 1
        yield -1, 0, 0, self.n


def scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums S, sum of y y') over the fit list, exact."""

    def run(batches):
        sums = _Exact(dims)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                sums.add(unpacked(b.column(0).slice(lo, ROWS), dims))
        cols = list(zip(*sums.digits()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["i", "j", "k", "digit"])

    got = arrow_map(fit, run, "i int, j int, k int, digit long").groupBy("i", "j", "k").agg(F.sum("digit").alias("digit")).collect()
    n, total, products = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    for i, j, k, digit in got:  # some digits for each of d (d + 1) / 2 + d sums
        if i < 0:
            n = digit
        elif i == dims:
            total[j] += digit << _DIGIT * k
        else:
            products[i][j] += digit << _DIGIT * k
    for i in range(dims):
        for j in range(i):
            products[i][j] = products[j][i]
    return n, total, products


# ---------------------------------------------------------------- components


def polynomial(spark, m: list[list[int]]) -> list[int]:
    """Characteristic polynomial of a positive semidefinite integer matrix; a task takes some primes."""
    d = len(m)
    bound = C.coefficient_bound(d, sum(m[i][i] for i in range(d)))
    primes = C.primes_for(bound)
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        for b in batches:
            for p in b.column(0).to_pylist():
                r = C.charpoly_mod(np.array([[v % p for v in row] for row in shared.value], np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([r.tolist()], pa.list_(pa.int64()))], ["p", "residues"])

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 2 * spark.sparkContext.defaultParallelism))
    got = dict(map(tuple, arrow_map(rows, run, "p long, residues array<long>").collect()))
    return C.charpoly([got[p] for p in primes], primes, bound)


def null_vectors(m: list[list[int]], root: tuple[int, int], count: int, digits: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of m - root * I, rounded to doubles."""
    d = len(m)
    with decimal.localcontext() as ctx:
        ctx.prec, ctx.Emax, ctx.Emin = digits, decimal.MAX_EMAX, decimal.MIN_EMIN
        D = decimal.Decimal
        size = D(max(m[i][i] for i in range(d)))  # the matrix is scaled to entries of about one
        mu = D(root[0]) / D(1 << root[1]) / size
        a = np.array([[D(v) / size for v in row] for row in m], object)
        for i in range(d):
            a[i, i] -= mu
        order, tiny = list(range(d)), D(10) ** -(digits - 5)
        for k in range(d):  # LU with row pivots; a pivot that vanishes is set to the rounding error
            p = max(range(k, d), key=lambda i: abs(a[i, k]))
            if p != k:
                a[[k, p]] = a[[p, k]]
                order[k], order[p] = order[p], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            f = a[k + 1:, k] / a[k, k]
            a[k + 1:, k] = f
            a[k + 1:, k + 1:] -= f[:, None] * a[k, k + 1:]
        found: list[np.ndarray] = []
        rng = np.random.default_rng(13)
        while len(found) < count:
            v = np.array([D(int(x)) for x in rng.integers(-1000, 1000, d)], object)
            for _ in range(3):
                for u in found:
                    v = v - u * (u * v).sum()
                x = v[order]
                for k in range(d):
                    x[k + 1:] = x[k + 1:] - a[k + 1:, k] * x[k]
                for k in range(d - 1, -1, -1):
                    x[k] = x[k] / a[k, k]
                    x[:k] = x[:k] - a[:k, k] * x[k]
                v = x / (x * x).sum().sqrt()
            for u in found:
                v = v - u * (u * v).sum()
            v = v / (v * v).sum().sqrt()
            lead = max(range(d), key=lambda i: abs(v[i]))
            found.append(v if v[lead] > 0 else -v)
        return [[float(x) for x in v] for v in found]


@dataclass
class Whitening:
    """``x -> (x - sums / n) @ (vectors / sqrt(eigenvalues))`` in whole-number units without ``SHIFT``."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # of the covariance, falling
    vectors: np.ndarray      # a column for each
    explained: np.ndarray

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n y - S, exact (as Python numbers where 64 bits do not suffice)."""
        most = max([1, *(abs(s) for s in self.sums), self.n * max(int(y.max(initial=0)), -int(y.min(initial=0)))])
        if 2 * most < 1 << 62:
            return self.n * y - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) / self.n @ (self.vectors / np.sqrt(self.eigenvalues))


def deviations(centred: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row, exact; None where it does not fit 64 bits."""
    if centred.dtype != object and len(centred) and int(np.abs(centred).max()) ** 2 * centred.shape[1] < 1 << 62:
        return (centred * centred).sum(1).tolist()
    return [x if x < 1 << 63 else None for x in ((v.astype(object) ** 2).sum() for v in centred)]


def fit(spark, vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of a fit list; components with eigenvalue zero have none."""
    n, sums, products = scatter(vectors, dims)
    m = [[n * products[i][j] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    trace = sum(m[i][i] for i in range(dims))
    empty = Whitening(n, sums, np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    if n == 0 or trace == 0:
        return empty
    roots = C.top_eigenvalues(polynomial(spark, m), components)
    gaps = []
    for r in roots:
        r.refine(BITS)
    for i, r in enumerate(roots):  # bits between a root and its neighbours
        near = [abs((r.hi << s.shift) - (s.hi << r.shift)) >> min(r.shift, s.shift) for s in roots[max(0, i - 1):i + 2] if s is not r]
        gaps.append(max(0, (trace << max(r.shift, *(s.shift for s in roots))).bit_length() - min((g.bit_length() for g in near if g), default=0) - 1))
    todo, have = [], 0
    for r, g in zip(roots, gaps):
        if have >= components:
            break
        r.refine(BITS + g)
        todo.append((len(todo), *map(str, r.number()), min(r.multiplicity, components - have), 50 + int((BITS + 2 * g) * 0.302)))
        have += r.multiplicity
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        for b in batches:
            for k, top, shift, count, digits in zip(*(c.to_pylist() for c in b.columns)):
                v = null_vectors(shared.value, (int(top), int(shift)), count, digits)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v], pa.list_(pa.list_(pa.float64())))], ["k", "vectors"])

    rows = spark.createDataFrame(todo, "k int, top string, shift string, count int, digits int").repartition(len(todo))
    got = dict(map(tuple, arrow_map(rows, run, "k int, vectors array<array<double>>").collect()))
    vectors_, values, explained = [], [], []
    with decimal.localcontext() as ctx:
        ctx.prec = 60
        for k, top, shift, count, _ in todo:
            value = decimal.Decimal(int(top)) / decimal.Decimal(1 << int(shift))
            vectors_ += got[k]
            values += [float(value / (n * n))] * count
            explained += [float(value / trace)] * count
    return Whitening(n, sums, np.array(values), np.array(vectors_).T, np.array(explained))


def identity_error(vectors: DataFrame, w: Whitening, dims: int) -> float:
    """Largest entry of (covariance of the whitened fit list - identity), in size."""
    shared = vectors.sparkSession.sparkContext.broadcast(w)
    k = len(w.eigenvalues)

    def run(batches):
        w = shared.value
        total = np.zeros((k + 1, k))
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                z = w.whitened(w.centred(unpacked(b.column(0).slice(lo, ROWS), dims)))
                total[:k] += z.T @ z
                total[k] += z.sum(0)
        i, j = np.divmod(np.arange((k + 1) * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "x"])

    got = np.zeros((k + 1, k))
    for i, j, x in arrow_map(vectors, run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x")).collect():  # (k + 1) k numbers
        got[i, j] = x / w.n
    return float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max()) if k else 0.0


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: every remaining row by every component.

    Rows whose vector is null or empty, holds a null, a number that is not finite or one of 2^56 or more,
    or has another length than most vectors, do not remain.  Repeated and null ids are kept row by row.
    Equal vectors count once in the fit.  A component without variance (eigenvalue zero) has no rows: fewer
    than ``components`` for vectors of lower rank, none for a single distinct vector or an empty table.
    ``deviation`` is null where it is 2^63 or more.
    """
    spark = df.sparkSession
    rows = only(df, id=id_col, vector=vector_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dims = common_size(rows, "vector")
    if not dims:
        return spark.createDataFrame([], schema)
    vectors = stored(fit_list(rows, "vector", dims), "fit-list")
    w = fit(spark, vectors, dims, components)
    error, k = identity_error(vectors, w, dims), len(w.eigenvalues)
    shared = spark.sparkContext.broadcast(w)

    def run(batches):
        w = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                which, y = whole_vectors(pa.concat_arrays([part.column(1)]), dims)
                centred = w.centred(y)
                m = len(which)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(which, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, w.n)), pa.array(deviations(centred), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(w.whitened(centred).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return arrow_map(rows, run, schema)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
