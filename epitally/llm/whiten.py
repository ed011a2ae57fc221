"""Whitening of embeddings by the exact characteristic polynomial of their scatter matrix.

Entries become whole numbers, so that the moments, and the scatter ``A = n * sum(y y') - T T'``
made of them, are exact: tasks multiply batches, in pieces whose sums stay below 2^53, and send
one row for each pair of dimensions; Spark adds these in limbs of 40 bits. ``A / n^2`` is the
covariance, whatever constant was added to all entries.

The polynomial ``det(t - A)`` is found modulo many primes of 31 bits, each by a reduction to
Hessenberg form in a task of its own, and put together by the Chinese remainder theorem; the
number of primes follows from a bound on its coefficients. All its roots are real and none is
negative, hence the sign changes of its coefficients, shifted to any place, are the number of
roots above it, multiple ones included. Halving isolates the greatest roots and narrows them to
2^-256 of the greatest. Inverse iteration on ``A - e`` in decimals of 120 digits gives the null
space of each, that is the components; a multiple root gets an orthonormal basis.

What passes through the driver has the size of the matrix, whatever the number of rows.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.workspace import written

COMPONENTS = 8
SCALE = 1024
# Entries from here on have no 64-bit whole number after scaling.
LARGEST = float(1 << 52)
LIMB, LIMBS = 40, 5
PART, PARTS = 20, 4
EXACT = 1 << 53
# Bits, below the greatest root, of the width of a root and of the distance that tells two apart.
WIDTH, TIE = 256, 160
DIGITS = 120


def usable(vector: Column) -> Column:
    """Whether a vector is not null nor empty and has only finite entries in the range of a long."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Scaled whole numbers of the vectors, a row each."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(-1, d)


def gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` in Python's whole numbers."""
    rows, largest = len(y), max(1, int(np.abs(y).max(initial=0)))
    out = np.zeros((y.shape[1], y.shape[1]), object)
    if largest * largest < EXACT // max(1, min(rows, 1 << 10)):
        step = max(1, min(rows, EXACT // (largest * largest)))
        for a in range(0, rows, step):
            part = y[a : a + step].astype(np.float64)
            out += (part.T @ part).astype(np.int64).astype(object)
        return out
    # Larger numbers in parts of 20 bits; sums of 2^12 products of two stay below 2^53.
    for a in range(0, rows, 1 << 12):
        piece, parts = y[a : a + (1 << 12)], []
        for _ in range(PARTS - 1):
            parts.append((piece & ((1 << PART) - 1)).astype(np.float64))
            piece = piece >> PART
        parts.append(piece.astype(np.float64))
        for i, u in enumerate(parts):
            for j, v in enumerate(parts):
                out += (u.T @ v).astype(np.int64).astype(object) << (PART * (i + j))
    return out


@dataclass(frozen=True)
class Moments:
    """Number of vectors, sums of their scaled entries and of the products of these, exact."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def scatter(self) -> list[list[int]]:
        """The covariance, times the square of ``n``."""
        t = self.sums
        return [
            [self.n * p - t[i] * t[j] for j, p in enumerate(row)]
            for i, row in enumerate(self.products)
        ]


def moments(rows: DataFrame, d: int) -> Moments:
    """Exact moments of ``vector``, whose length is ``d`` everywhere."""
    upper = np.triu_indices(d + 1)
    slots = np.arange(len(upper[0]), dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1), object)
        for batch in batches:
            y = _matrix(batch.column(0), d)
            if len(y):
                total[0, 0] += len(y)
                # Sums of up to 2^10 numbers below 2^62 in two halves.
                for a in range(0, len(y), 1 << 10):
                    part = y[a : a + (1 << 10)]
                    high, low = (part >> 32).sum(0), (part & 0xFFFFFFFF).sum(0)
                    total[0, 1:] += (high.astype(object) << 32) + low.astype(object)
                total[1:, 1:] += gram(y)
        values = total[upper].tolist()
        columns = []
        for i in range(LIMBS):
            last = i == LIMBS - 1
            columns.append(
                pa.array([v >> (LIMB * i) if last else v >> (LIMB * i) & ((1 << LIMB) - 1)
                          for v in values], pa.int64())
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots), *columns], names=["slot", *[f"l{i}" for i in range(LIMBS)]]
        )

    schema = "slot int, " + ", ".join(f"l{i} long" for i in range(LIMBS))
    limbs = rows.select("vector").mapInArrow(run, schema)
    # (d + 1) (d + 2) / 2 rows, however many vectors there are.
    added = limbs.groupBy("slot").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)])
    whole = np.zeros((d + 1, d + 1), object)
    for r in added.collect():
        i, j = int(upper[0][r.slot]), int(upper[1][r.slot])
        whole[i, j] = whole[j, i] = sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS))
    return Moments(whole[0, 0], whole[0, 1:].tolist(), whole[1:, 1:].tolist())


def is_prime(n: int) -> bool:
    """Miller and Rabin's test with the bases that decide all numbers of 64 bits."""
    bases = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
    if n < 2 or any(n % b == 0 for b in bases):
        return n in bases
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for b in bases:
        x = pow(b, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(product: int) -> list[int]:
    """The greatest primes below 2^31, as many as multiply to more than ``product``."""
    found, reached, n = [], 1, (1 << 31) - 1
    while reached <= product:
        if is_prime(n):
            found.append(n)
            reached *= n
        n -= 2
    return found


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of ``det(t - a)`` modulo the prime ``p`` below 2^31.

    Row and column operations that keep the polynomial clear what lies two or more below the
    diagonal; a recurrence over the leading blocks then gives it.
    """
    h, d = a % p, len(a)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(1)) % p
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        own = -h[k - 1, k - 1] * blocks[k - 1] % p
        own[1:] += blocks[k - 1, :-1]
        chain, weights = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = chain * int(h[i, k - 1]) % p
        own -= (weights[:, None] * blocks[: k - 1] % p).sum(0)
        blocks[k] = own % p
    return blocks[d]


def characteristic_polynomial(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Exact coefficients, constant first, of ``det(t - a)``; ``a`` has no negative eigenvalue."""
    d = len(a)
    trace = sum(a[i][i] for i in range(d))
    # Elementary symmetric sums are greatest when all eigenvalues are equal.
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_beyond(2 * bound)
    sent = spark.sparkContext.broadcast(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(sent.value, object)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_modulo((whole % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p]), pa.array([found.tolist()])], names=["p", "coefficients"]
                )

    tasks = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    asked = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    residues = asked.mapInArrow(run, "p long, coefficients array<long>").collect()
    whole = math.prod(primes)
    out = [0] * (d + 1)
    for r in residues:
        rest = whole // r.p
        unit = rest * pow(rest, -1, r.p)
        for i, c in enumerate(r.coefficients):
            out[i] += c * unit
    out = [c % whole for c in out]
    return [c - whole if c > whole // 2 else c for c in out]


def _scaled(p: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are those of ``p`` times 2^``bits``."""
    d = len(p) - 1
    return [c << (bits * (d - i)) for i, c in enumerate(p)]


def roots_above(p: list[int], m: int, bits: int) -> int:
    """How many roots of the real-rooted ``p`` are greater than ``m / 2^bits``."""
    c = _scaled(p, bits)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += m * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(p: list[int], m: int, bits: int) -> int:
    value = reduce(lambda v, c: v * m + c, reversed(_scaled(p, bits)), 0)
    return (value > 0) - (value < 0)


def greatest_roots(p: list[int], wanted: int) -> list[tuple[int, int, int]]:
    """``(m, bits, count)`` of the greatest positive roots of ``p``, in falling order.

    A root lies less than 2^-bits below ``m / 2^bits``. Roots too close to be told apart come as
    one with their count. ``p`` has real roots only, none of them negative.
    """
    d = len(p) - 1
    zero = next(i for i, c in enumerate(p) if c)
    p, positive = p[zero:], d - zero
    wanted = min(wanted, positive)
    if not wanted:
        return []
    top = -p[-2]  # the sum of all roots
    out: list[tuple[int, int, int]] = []
    # Intervals (low, high] over 2^bits with the number of roots above either end.
    waiting = [(0, top, 0, positive, 0)]
    while waiting and sum(count for *_, count in out) < wanted:
        low, high, bits, above_low, above_high = waiting.pop()
        count = above_low - above_high
        if count == 0:
            continue
        narrow = (high - low) << TIE <= top << bits and (high - low) << 80 <= high
        if count == 1 or narrow:
            out.append((*_narrowed(p, low, high, bits, top, count), count))
            continue
        if high - low < 2:
            low, high, bits = low << 16, high << 16, bits + 16
        middle = (low + high) // 2
        above = roots_above(p, middle, bits)
        waiting.append((low, middle, bits, above_low, above))
        waiting.append((middle, high, bits, above, above_high))
    return out


def _narrowed(p: list[int], low: int, high: int, bits: int, top: int, count: int) -> tuple[int, int]:
    """Upper end of the last interval around a root alone, or as it is for several."""
    if count > 1:
        return high, bits
    # Above the root the sign is that of the right end; no other root is in between.
    right = _sign(p, high, bits)
    if right == 0:
        return high, bits
    while (high - low) << WIDTH > top << bits or (high - low) << 80 > high:
        if high - low < 2:
            low, high, bits = low << 16, high << 16, bits + 16
        middle = (low + high) // 2
        sign = _sign(p, middle, bits)
        if sign == 0:
            return middle, bits
        if sign == right:
            high = middle
        else:
            low = middle
    return high, bits


def null_space(a: list[list[int]], m: int, bits: int, count: int) -> np.ndarray:
    """``count`` orthonormal vectors, one a column, that ``a`` multiplies by ``m / 2^bits``."""
    d = len(a)
    with decimal.localcontext(prec=DIGITS) as context:
        context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        root = decimal.Decimal(m) / (1 << bits)
        whole = np.array([[decimal.Decimal(v) for v in row] for row in a], object)
        largest = max(abs(v) for v in whole.flat)
        # Triangular factors, with rows in the order of the pivots.
        u, order = whole.copy(), np.arange(d)
        for i in range(d):
            u[i, i] -= root
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(u[k + i, k]))
            u[[k, pivot]], order[[k, pivot]] = u[[pivot, k]], order[[pivot, k]]
            if abs(u[k, k]) < largest.scaleb(-DIGITS):
                u[k, k] = largest.scaleb(-DIGITS)
            if k + 1 < d:
                u[k + 1 :, k] = u[k + 1 :, k] / u[k, k]
                u[k + 1 :, k + 1 :] = u[k + 1 :, k + 1 :] - np.outer(u[k + 1 :, k], u[k, k + 1 :])

        def solved(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(d):
                x[k + 1 :] = x[k + 1 :] - u[k + 1 :, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / u[k, k]
                x[:k] = x[:k] - u[:k, k] * x[k]
            return x

        # Any start will do that is not orthogonal to what is sought.
        random = np.random.default_rng(7).integers(1, 1 << 30, (count, d))
        found = [np.array([decimal.Decimal(int(v)) for v in row], object) for row in random]
        for _ in range(4):
            basis: list[np.ndarray] = []
            for x in found:
                x = solved(x / max(abs(v) for v in x))
                for _ in range(2):
                    x = x / (x @ x).sqrt()
                    for other in basis:
                        x = x - (x @ other) * other
                basis.append(x / (x @ x).sqrt())
            found = basis
        out = np.array([[float(v) for v in x] for x in found]).T
    # Either sign would be right; the greatest entry is made positive.
    return out * np.sign(out[np.abs(out).argmax(0), np.arange(count)])


def components_of(
    spark: SparkSession, a: list[list[int]], roots: list[tuple[int, int, int]]
) -> np.ndarray:
    """The :func:`null_space` of each root side by side; a task for each root."""
    d = len(a)
    if not roots:
        return np.zeros((d, 0))
    sent = spark.sparkContext.broadcast(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = null_space(sent.value, int(r["m"]), r["bits"], r["many"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["place"]]), pa.array([found.T.ravel().tolist()])],
                    names=["place", "vectors"],
                )

    # Whole numbers of any length go as text.
    rows = [(i, str(m), bits, many) for i, (m, bits, many) in enumerate(roots)]
    asked = spark.createDataFrame(rows, "place long, m string, bits int, many int")
    asked = asked.repartitionById(len(rows), F.col("place").cast("int"))
    found = asked.mapInArrow(run, "place long, vectors array<double>").collect()
    ordered = sorted(found, key=lambda r: r.place)
    return np.concatenate([np.reshape(r.vectors, (-1, d)) for r in ordered]).T


@dataclass(frozen=True)
class Whitening:
    """Exact sums, and the components with the eigenvalues of the covariance, greatest first."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``vector``, whose length is ``d`` everywhere, from all rows."""
    found = moments(rows, d)
    a, square = found.scatter(), found.n**2
    trace = sum(a[i][i] for i in range(d))
    spark, roots = rows.sparkSession, []
    if trace:
        roots = greatest_roots(characteristic_polynomial(spark, a), components)
    # Whole numbers divide to the nearest double, however large they are.
    values = [m / (square << bits) for m, bits, many in roots for _ in range(many)]
    vectors = components_of(spark, a, roots)
    return Whitening(
        found.n,
        found.sums,
        np.array(values[:components]),
        vectors[:, :components],
        trace / square if square else 0.0,
    )


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """``n * y - sums`` over ``n``, and the exact sum of its squares before the division."""
    reach = n * int(np.abs(y).max(initial=0)) + max(abs(s) for s in sums)
    if reach < 1 << 62 and reach * reach * y.shape[1] < 1 << 63:
        away = n * y - np.array(sums, np.int64)
        return away / n, (away * away).sum(1).tolist()
    away = y.astype(object) * n - np.array(sums, object)
    total = [sum(v * v for v in row) for row in away]
    shares = np.array([[v / n for v in row] for row in away], np.float64).reshape(y.shape)
    return shares, [t if t < 1 << 63 else None for t in total]


def apply(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """``id``, ``deviation`` and ``whitened`` (an array) of all rows ``(id, vector)``."""
    sent = rows.sparkSession.sparkContext.broadcast(fitted)
    d = len(fitted.sums)
    id_field = rows.schema["id"]
    schema = T.StructType(
        [id_field, T.StructField("deviation", T.LongType()),
         T.StructField("whitened", T.ArrayType(T.DoubleType(), False))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        turn = own.vectors / np.sqrt(own.eigenvalues)
        for batch in batches:
            y = _matrix(batch.column("vector"), d)
            if not len(y):
                continue
            away, total = _deviations(y, own.n, own.sums)
            white = away @ turn
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(total, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                names=schema.names,
            )

    return rows.select("id", "vector").mapInArrow(run, schema)


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest entry, in absolute value, of the covariance of ``whitened`` minus the identity."""
    w = [F.col("whitened")[i] for i in range(k)]
    means = white.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(w)]).first()
    away = [c - F.lit(means[i]) for i, c in enumerate(w)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = white.agg(*[F.sum(away[i] * away[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs))


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``, a row each component.

    Entries become ``floor(1024 * c)``; the contract's constant is added to no effect, as all
    that is returned is free of it. ``deviation`` is the sum over dimensions of the squares of
    ``n * x - S``, exact, and null where no long holds it. ``explained`` is the component's share
    of the whole variance, ``identity_error`` one number for the table.

    Vectors that are null or empty, or hold a null, an entry that is not finite or one of 2^52
    and more, are left out; so are those of another length than most (of the longest, if several
    lengths are as common). Repeated rows count each; keys may repeat or be null. Components
    without variance cannot be scaled and are left out, hence a table of equal vectors, a single
    one or none gives no rows. Further columns are ignored.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector].dataType.elementType
    kind = "array<float>" if isinstance(element, T.FloatType) else "array<double>"
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast(kind).alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    schema = T.StructType(
        [T.StructField(key, vectors.schema[key].dataType),
         *T._parse_datatype_string(
             "component int, n long, deviation long, whitened double, explained double, identity_error double"
         ).fields]
    )
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == common.d)
    fitted = fit(rows, common.d, components)
    k = len(fitted.eigenvalues)
    if not k:
        return spark.createDataFrame([], schema)
    white = written(apply(rows, fitted), "whitened")
    error = identity_error(white, fitted.n, k)
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues])
    return white.select(
        F.col("id").alias(key), "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        key,
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
