"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Entries become whole numbers x = floor(256 c). The distinct vectors are the fit list: with n of
them, sums S and products P, the scatter M = n P - S S' is a matrix of integers, n^2 times the
covariance. Its characteristic polynomial is computed modulo many primes, by Hessenberg reduction, and put
together by Chinese remainders; all its roots are real and not negative, so Descartes' rule
counts those above any number exactly, and bisection isolates the largest to any precision. A
component is found by inverse iteration on the null space of M less its root, in as many decimal digits
as the roots needed to be told apart.

The vectors are only ever shuffled packed and distinct within a task, so that copies of a hot vector meet as one
row per task. Products are summed exactly (in pieces of 20 bits, so that double precision holds
every sum) and shuffled as one row per matrix cell. The driver sees the matrix, whose size
is the dimension's alone.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are
dropped, and so are vectors of another length than most have (the longer of equally frequent ones). Entries beyond 64 bits stop at
the ends of that range. Repeated rows and ids are rows like others; equal vectors count once in the fit.
Components whose eigenvalue is zero cannot be whitened and are left out, so a table with one distinct vector, like an empty
one, gives no rows. Where an eigenvalue occurs several times (or several agree in CLOSE bits after the point), its components are
some orthonormal ones of its space. A deviation beyond 64 bits is null. Other columns are not read.
"""

from __future__ import annotations

import decimal
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.llm.common import durable, map_arrow, quoted

SCALE = 256
#: Bits of a piece of a number while products are summed, and rows summed at once: 2^(20+20+13) = 2^53.
PIECE_BITS, BLOCK = 20, 1 << 13
#: Bits of a piece of a sum while it is shuffled.
LIMB = 40
#: Primes of a task, and bits after the point to which roots are told apart before they count as one.
PRIMES, CLOSE = 16, 512


# ---- the fit list -----------------------------------------------------------------------


def _entries(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of all vectors, null as NaN, and where each vector ends among them."""
    ends = np.cumsum(np.asarray(vectors.value_lengths().fill_null(0)))
    return np.asarray(vectors.flatten().cast(pa.float64()).fill_null(np.nan), np.float64), ends


def valid_lengths(vectors: pa.ListArray) -> np.ndarray:
    """The length of each vector, 0 for those that are dropped."""
    entries, ends = _entries(vectors)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    starts = np.concatenate([[0], ends])[:-1]
    return np.where(bad[ends] == bad[starts], ends - starts, 0)


def whole_numbers(vectors: pa.ListArray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that stay, and these as rows of whole numbers."""
    entries, ends = _entries(vectors)
    places = np.flatnonzero(valid_lengths(vectors) == dimension)
    scaled = np.floor(entries[(ends[places] - dimension)[:, None] + np.arange(dimension)] * SCALE)
    over, under = scaled >= 2.0**63, scaled < -(2.0**63)
    out = np.where(over | under, 0, scaled).astype(np.int64)
    out[over], out[under] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    return places, out


def _slices(part: pa.RecordBatch, dimension: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of a few million entries."""
    step = max(1, (1 << 22) // dimension)
    return (part.slice(at, step) for at in range(0, part.num_rows, step))


def common_dimension(df: DataFrame) -> int:
    """The length that most valid vectors have; 0 without any."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for part in parts:
            found.update(valid_lengths(part.column(0)).tolist())
        del found[0]
        columns = [list(found), list(found.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["length", "n"])

    counted = map_arrow(df.select("vector"), run, "length bigint, n bigint").groupBy("length").agg(F.sum("n").alias("n"))
    first = counted.orderBy(F.desc("n"), F.desc("length")).first()
    return first["length"] if first else 0


def _packed(row: np.ndarray) -> bytes:
    """A vector in as few bytes as its entries allow; equal vectors in equal bytes."""
    for kind in ("<i2", "<i4"):
        if np.array_equal(row.astype(kind), row):
            return row.astype(kind).tobytes()
    return row.astype("<i8").tobytes()


def _unpacked(data: bytes, dimension: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // dimension}").astype(np.int64)


def distinct_vectors(df: DataFrame, dimension: int) -> DataFrame:
    """The fit list: each distinct vector of whole numbers once, packed."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in _slices(part, dimension):
                rows = np.unique(whole_numbers(piece.column(0), dimension)[1], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([_packed(r) for r in rows], pa.binary())], ["x"])

    return map_arrow(df.select("vector"), run, "x binary").distinct()


def _pieces(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as doubles of PIECE_BITS bits each, the lowest first; the last has the sign."""
    out, rest = [], x
    while True:
        if np.abs(rest // 2).max(initial=0) < 1 << (PIECE_BITS - 2):
            return [*out, rest.astype(np.float64)]
        out.append((rest & ((1 << PIECE_BITS) - 1)).astype(np.float64))
        rest = rest >> PIECE_BITS


def products(x: np.ndarray) -> np.ndarray:
    """x' x in exact whole numbers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), BLOCK):
        pieces = _pieces(x[at : at + BLOCK])
        for i, a in enumerate(pieces):
            for j, b in enumerate(pieces):
                total += (a.T @ b).astype(np.int64).astype(object) << PIECE_BITS * (i + j)
    return total


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, piece) of a number's pieces of LIMB bits that are not zero, each with its sign."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if value & ((1 << LIMB) - 1):
            yield place, sign * (value & ((1 << LIMB) - 1))
        value, place = value >> LIMB, place + 1


@dataclass(frozen=True)
class Fit:
    """The distinct vectors' number, sums and products."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def scatter(self) -> list[list[int]]:
        s = self.sums
        return [[self.n * p - s[i] * s[j] for j, p in enumerate(row)] for i, row in enumerate(self.products)]


def fitted(distinct: DataFrame, dimension: int) -> Fit:
    """Sums over the fit list; what reaches the driver is one exact number per cell of the matrix."""
    d = dimension

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(d, object), np.zeros((d, d), object)
        for part in parts:
            for piece in _slices(part, d):
                x = np.stack([_unpacked(v.as_py(), d) for v in piece.column(0)])
                n, sums, total = n + len(x), sums + x.astype(object).sum(axis=0), total + products(x)
        cells = [n, *sums, *total[np.triu_indices(d)]]
        rows = [(cell, *piece) for cell, value in enumerate(cells) for piece in _limbs(int(value))]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cell", "place", "piece"])

    pieces = map_arrow(distinct, run, "cell bigint, place bigint, piece bigint")
    cells = [0] * (1 + d + d * (d + 1) // 2)
    for r in pieces.groupBy("cell", "place").agg(F.sum("piece").alias("piece")).collect():
        cells[r["cell"]] += r["piece"] << LIMB * r["place"]
    matrix = [[0] * d for _ in range(d)]
    for value, i, j in zip(cells[1 + d :], *np.triu_indices(d), strict=True):
        matrix[i][j] = matrix[j][i] = value
    return Fit(cells[0], cells[1 : 1 + d], matrix)


# ---- the characteristic polynomial ------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin, exact below 3.4e14 with these bases."""
    bases = (2, 3, 5, 7, 11, 13, 17)
    if n < 2 or any(n % b == 0 for b in bases):
        return n in bases
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    return all(
        pow(b, odd, n) == 1 or any(pow(b, odd << k, n) == n - 1 for k in range(twos)) for b in bases
    )


def primes_below(top: int, product: int) -> list[int]:
    """The largest primes below ``top`` whose product exceeds ``product``."""
    out, have, p = [], 1, top
    while have <= product:
        p -= 1
        if is_prime(p):
            out.append(p)
            have *= p
    return out


def polynomials_modulo(residues: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Coefficients, from that of 1 up, of det(t - A) for each matrix A modulo its prime below 2^31.

    Similar row and column operations bring each matrix to Hessenberg form, whose characteristic
    polynomial follows from those of its leading blocks. All primes advance together.
    """
    a, p = residues.astype(np.int64) % primes[:, None, None], primes.astype(np.int64)
    k, d = np.arange(len(p)), a.shape[1]
    inverse = lambda v: np.array([pow(int(x), -1, int(q)) if x else 0 for x, q in zip(v, p, strict=True)])
    for j in range(d - 2):
        pivot = j + 1 + np.argmax(a[:, j + 1 :, j] != 0, axis=1)
        rows = a[k, pivot].copy()
        a[k, pivot], a[:, j + 1] = a[:, j + 1].copy(), rows
        columns = a[k, :, pivot].copy()
        a[k, :, pivot], a[:, :, j + 1] = a[:, :, j + 1].copy(), columns
        u = a[:, j + 2 :, j] * inverse(a[:, j + 1, j])[:, None] % p[:, None]
        a[:, j + 2 :] = (a[:, j + 2 :] - u[:, :, None] * a[:, None, j + 1] % p[:, None, None]) % p[:, None, None]
        moved = (a[:, :, j + 2 :] * u[:, None] % p[:, None, None]).sum(axis=2)
        a[:, :, j + 1] = (a[:, :, j + 1] + moved) % p[:, None]
    leading = np.zeros((d + 1, len(p), d + 1), np.int64)
    leading[0, :, 0] = 1
    for m in range(1, d + 1):
        below = leading[m - 1]
        leading[m, :, 1:] = below[:, :-1]
        leading[m] = (leading[m] - a[:, m - 1, m - 1, None] * below % p[:, None]) % p[:, None]
        chain = np.ones(len(p), np.int64)
        for i in range(m - 1, 0, -1):
            chain = chain * a[:, i, i - 1] % p
            factor = chain * a[:, i - 1, m - 1] % p
            leading[m] = (leading[m] - factor[:, None] * leading[i - 1] % p[:, None]) % p[:, None]
    return leading[d]


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient is larger: by Maclaurin's inequality on roots that are not negative."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    return max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, from that of 1 up, of det(t - M) for a scatter M; primes are tasks."""
    d = len(matrix)
    primes = primes_below(1 << 31, 2 * coefficient_bound(matrix))
    sent = spark.sparkContext.broadcast(matrix)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sent.value, object)
        for part in parts:
            for at in range(0, part.num_rows, PRIMES):
                p = np.asarray(part.column(0))[at : at + PRIMES]
                residues = np.stack([(exact % int(q)).astype(np.int64) for q in p])
                found = polynomials_modulo(residues, p)
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(found.tolist())], ["p", "coefficients"])

    tasks = -(-len(primes) // PRIMES)
    frame = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    value, modulus = [0] * (d + 1), 1
    for r in map_arrow(frame, run, "p bigint, coefficients array<bigint>").collect():
        p = r["p"]
        step = pow(modulus, -1, p)
        value = [v + modulus * ((c - v) * step % p) for v, c in zip(value, r["coefficients"], strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


# ---- roots and components ---------------------------------------------------------------


def roots_above(polynomial: list[int], numerator: int, bits: int) -> int:
    """How many roots exceed numerator / 2^bits, each as often as it occurs.

    By Descartes' rule, which is exact as all roots are real, on the polynomial moved there.
    """
    d = len(polynomial) - 1
    moved = [c << bits * (d - k) for k, c in enumerate(polynomial)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            moved[k] += numerator * moved[k + 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


@dataclass
class Root:
    """A root in (low, low + 1] / 2^bits."""

    low: int
    bits: int
    rank: int

    def refine(self, polynomial: list[int], bits: int) -> None:
        while self.bits < bits:
            self.low, self.bits = 2 * self.low, self.bits + 1
            if roots_above(polynomial, self.low + 1, self.bits) >= self.rank:
                self.low += 1


def squarefree(polynomial: list[int], p: int = (1 << 31) - 1) -> bool:
    """Whether no root occurs twice, as seen modulo a prime; true is certain."""
    a = [c % p for c in reversed(polynomial)]
    d = len(a) - 1
    b = [c * (d - i) % p for i, c in enumerate(a[:-1])]
    strip = lambda f: f[next((i for i, c in enumerate(f) if c), len(f)) :]
    b = strip(b)
    while b:
        inverse, rest = pow(b[0], -1, p), a[:]
        for i in range(len(a) - len(b) + 1):
            factor = rest[i] * inverse % p
            for k, c in enumerate(b):
                rest[i + k] = (rest[i + k] - factor * c) % p
        a, b = b, strip(rest)
    return len(a) == 1


def largest_roots(polynomial: list[int], most: int, digits: int = 40) -> list[Root]:
    """The largest positive roots, the largest first, told apart where they differ."""
    positive = roots_above(polynomial, 0, 0)
    top = max(1, -polynomial[-2]).bit_length()
    roots = []
    for rank in range(1, min(most, positive) + 1):
        low = 0
        for bit in range(top, -1, -1):  # the largest whole number that the root exceeds
            if roots_above(polynomial, low + (1 << bit), 0) >= rank:
                low += 1 << bit
        roots.append(Root(low, 0, rank))
    bits = max(0, digits * 10 // 3 - top)
    limit = math.inf if squarefree(polynomial) else CLOSE
    while True:
        for r in roots:
            r.refine(polynomial, bits)
        if bits >= limit or all(a.low != b.low for a, b in zip(roots, roots[1:], strict=False)):
            return roots
        bits += 128


def _solver(matrix: list[list[int]], root: Root, one: decimal.Decimal):
    """Solves (M - root) y = b by elimination with pivots, in decimals of the context's precision."""
    d = len(matrix)
    shift = (decimal.Decimal(2 * root.low + 1) / decimal.Decimal(1 << (root.bits + 1))) * one
    a = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= shift
    order, tiny = list(range(d)), abs(shift) * one.scaleb(-2 * decimal.getcontext().prec)
    for j in range(d):
        pivot = max(range(j, d), key=lambda i: abs(a[i, j]))
        if pivot != j:
            a[[j, pivot]] = a[[pivot, j]]
            order[j], order[pivot] = order[pivot], order[j]
        if not a[j, j]:
            a[j, j] = tiny
        if j + 1 < d:
            a[j + 1 :, j] = a[j + 1 :, j] / a[j, j]
            a[j + 1 :, j + 1 :] -= np.outer(a[j + 1 :, j], a[j, j + 1 :])

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[order].copy()
        for i in range(1, d):
            y[i] -= a[i, :i] @ y[:i]
        for i in range(d - 1, -1, -1):
            y[i] = (y[i] - (a[i, i + 1 :] @ y[i + 1 :] if i + 1 < d else 0)) / a[i, i]
        return y

    return solve


def components(matrix: list[list[int]], roots: list[Root]) -> list[list[decimal.Decimal]]:
    """Unit vectors of the null spaces of M less each root, at right angles to each other."""
    d, found = len(matrix), []
    bits = max((r.bits + r.low.bit_length() for r in roots), default=0)
    with decimal.localcontext() as context:
        context.prec = 40 + bits * 3 // 10 + 10
        context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        one = decimal.Decimal(1)
        rng = np.random.default_rng(11)
        for root in roots:
            solve = _solver(matrix, root, one)
            y = np.array([decimal.Decimal(int(v)) for v in rng.integers(-999, 1000, d)], object)
            for _ in range(4):
                for v in found:
                    y = y - v * (v @ y)
                y = solve(y)
                y = y / (y @ y).sqrt()
            for v in found:
                y = y - v * (v @ y)
            found.append(y / (y @ y).sqrt())
        return [v.tolist() for v in found]


@dataclass(frozen=True)
class Whitening:
    """What the rows need: n, S, and per component its direction, root of M and share of the trace."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    roots: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def whitening(spark: SparkSession, fit: Fit, most: int) -> Whitening:
    matrix = fit.scatter()
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    roots = largest_roots(characteristic_polynomial(spark, matrix), most) if trace else []
    value = [(2 * r.low + 1, 1 << (r.bits + 1)) for r in roots]
    axes = np.array([[float(v) for v in c] for c in components(matrix, roots)]).reshape(-1, d)
    lengths = np.array([a / b for a, b in value])
    return Whitening(
        fit.n,
        np.array(fit.sums, object),
        axes,
        lengths,
        np.array([a / (b * trace) for a, b in value]),
        identity_error(matrix, axes, lengths),
    )


def identity_error(matrix: list[list[int]], axes: np.ndarray, roots: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity.

    It is A M A' over the roots, from the doubles that the rows are whitened with.
    """
    with decimal.localcontext() as context:
        context.prec = 60
        exact = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
        a = np.array([[decimal.Decimal(float(v)) for v in axis] for axis in axes], object).reshape(-1, len(matrix))
        size = [decimal.Decimal(float(r)).sqrt() for r in roots]
        product = a @ exact @ a.T if len(a) else []
        return max(
            (abs(float(product[i][j] / (size[i] * size[j])) - (i == j)) for i in range(len(a)) for j in range(len(a))),
            default=0.0,
        )


def deviations(centred: np.ndarray) -> list[int | None]:
    """Exact sums of squares of rows of whole numbers; null beyond 64 bits."""
    if np.abs(centred.astype(np.float64)).max(initial=0) < math.sqrt(2.0**62 / max(1, centred.shape[1])):
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in centred]
    return [v if v < 1 << 63 else None for v in found]


def whitened(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 4
) -> DataFrame:
    """Per valid row and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(vector_col)).cast("array<double>").alias("vector"))
    schema = T.StructType(
        [rows.schema["id"]]
        + T.StructType.fromDDL(
            "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        ).fields
    )
    dimension = common_dimension(rows)
    if not dimension:
        return spark.createDataFrame([], schema)
    fit = fitted(durable(distinct_vectors(rows, dimension), "whitening-vectors"), dimension)
    sent = spark.sparkContext.broadcast(whitening(spark, fit, most))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        w, arrow = sent.value, to_arrow_schema(schema)
        k = len(w.roots)
        for part in (piece for whole in parts for piece in _slices(whole, w.dimension)) if k else ():
            places, x = whole_numbers(part.column("vector"), w.dimension)
            if not len(places):
                continue
            if max(w.n * max(int(x.max()), -int(x.min())), *map(abs, w.sums)) < 1 << 52:
                centred = w.n * x - w.sums.astype(np.int64)
            else:
                centred = w.n * x.astype(object) - w.sums
            out = (centred.astype(np.float64) @ w.axes.T) / np.sqrt(w.roots)
            twice = lambda values, kind: pa.array(np.repeat(values, k), kind)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(np.repeat(places, k))).cast(arrow.field(0).type),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                    pa.array(np.full(k * len(places), w.n)),
                    pa.array([v for v in deviations(centred) for _ in range(k)], pa.int64()),
                    pa.array(out.ravel()),
                    pa.array(np.tile(w.explained, len(places))),
                    pa.array(np.full(k * len(places), w.identity_error)),
                ],
                schema=arrow,
            )

    return map_arrow(rows, run, schema)
