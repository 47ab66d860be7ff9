"""Embedding whitening: components from the exact characteristic polynomial of the integer scatter.

Everything that grows with the rows is summed, projected and checked in Spark; what the driver holds is bounded by the
square of the number of dimensions.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.llm.common import map_arrow
from groundmill.llm.vectors import matrix

#: Roots are isolated to 2^-ROOT_BITS of their size; roots nearer than 2^-SAME_BITS share one space of components.
ROOT_BITS, SAME_BITS = 120, 100
#: Fraction bits of the elimination, and rounds of inverse iteration.
FRACTION, ROUNDS = 384, 5
#: Entries are held to this size, so that what follows from them fits in exact integers.
LIMIT = 1 << 62
#: Integer entries are multiplied in limbs of so many bits and blocks of so many rows: exact in doubles.
LIMB, ROWS = 21, 1024


def finite(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` as doubles, without rows that are null or hold a null or non-finite entry."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & fine)


def integers(column: pa.Array, scale: int, width: int | None = None) -> np.ndarray:
    """``floor(scale * c)`` of each entry, held to +-LIMIT; shorter rows are padded with zeros."""
    width = width or int(np.diff(column.offsets.to_numpy()).max(initial=0))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(matrix(column, width) * scale), -float(LIMIT), float(LIMIT)).astype(np.int64)


def exact_scatter(x: np.ndarray) -> np.ndarray:
    """``x^T x`` in whole numbers of any size."""
    limbs = 1 if np.abs(x).max(initial=0) < 1 << LIMB else 3
    parts, rest = [], x
    for _ in range(limbs - 1):
        parts.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB
    parts.append(rest.astype(np.float64))
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            part = np.zeros(total.shape, np.int64)
            for at in range(0, len(x), ROWS):
                part += (a[at : at + ROWS].T @ b[at : at + ROWS]).astype(np.int64)
            total += part.astype(object) << (LIMB * (i + j))
    return total


def _sums(rows: DataFrame, scale: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, and sums and sums of products of their integer entries: exact, one partial result a task."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, products = 0, np.zeros(0, object), np.zeros((0, 0), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(batch["embedding"], scale)
            d, have = x.shape[1], len(total)
            if d > have:
                wider, square = np.zeros(d, object), np.zeros((d, d), object)
                wider[:have], square[:have, :have] = total, products
                total, products = wider, square
            count += len(x)
            total[:d] += x.astype(object).sum(axis=0) if np.abs(x).max(initial=0) > 1 << 40 else x.sum(axis=0).astype(object)
            products[:d, :d] += exact_scatter(x)
        i, j = np.triu_indices(len(total))
        value = [int(v) for v in (count, *total, *products[i, j])]
        at_i, at_j = [-1, *range(len(total)), *i.tolist()], [-1, *[-1] * len(total), *j.tolist()]
        kind = pa.decimal128(38, 0)
        high, low = [Decimal(v >> 64) for v in value], [Decimal(v & ((1 << 64) - 1)) for v in value]
        for cut in range(0, len(value), 100_000):
            part = slice(cut, cut + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(at_i[part], pa.int32()), pa.array(at_j[part], pa.int32()), pa.array(high[part], kind), pa.array(low[part], kind)], ["i", "j", "high", "low"])

    parts = map_arrow(rows.select("embedding"), body, "i int, j int, high decimal(38,0), low decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow().to_pylist()
    value = {(r["i"], r["j"]): (int(r["high"]) << 64) + int(r["low"]) for r in found}
    d = 1 + max((i for i, _ in value), default=-1)
    return value.get((-1, -1), 0), [value[i, -1] for i in range(d)], [[value[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``, by Fermat-like tests that are certain below 2^32."""

    def prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, n)
            if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
                return False
        return True

    found, n = [], (top - 1) | 1
    while len(found) < count:
        n -= 2
        if prime(n):
            found.append(n)
    return found


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of ``det(x - a)`` modulo the prime ``p`` below 2^31: Hessenberg form, then its recurrence."""
    h, d = a % p, len(a)
    for m in range(1, d - 1):
        some = np.flatnonzero(h[m:, m - 1])
        if not len(some):
            continue
        if some[0]:
            h[[m, m + some[0]]] = h[[m + some[0], m]]
            h[:, [m, m + some[0]]] = h[:, [m + some[0], m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, d + 1):
        weights, below = np.zeros(m, np.int64), 1
        weights[m - 1] = h[m - 1, m - 1]
        for i in range(m - 2, -1, -1):
            below = below * int(h[i + 1, i]) % p
            weights[i] = below * int(h[i, m - 1]) % p
        polys[m, 1:] = polys[m - 1, :-1]
        polys[m] = (polys[m] - (weights[:, None] * polys[:m] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, scatter: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of ``det(x - scatter)`` for a positive semidefinite whole-number matrix.

    Primes are dealt out to tasks; each coefficient's residues meet in one row and are joined by Chinese remaindering.
    No coefficient exceeds the elementary symmetric means of equal roots, C(d, k) (trace / d)^k.
    """
    d = len(scatter)
    mean = max(Fraction(sum(scatter[i][i] for i in range(d)), d), Fraction(1, 2))
    size = math.log2(mean.numerator) - math.log2(mean.denominator)
    bits = max((math.lgamma(d + 1) - math.lgamma(k + 1) - math.lgamma(d - k + 1)) / math.log(2) + k * size for k in range(d + 1))
    primes = primes_below(1 << 31, int(bits + 4) // 30 + 1)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(scatter, object).reshape(d, d)
        for batch in batches:
            for at in batch["id"].to_pylist():
                p = primes[at]
                found = polynomial_modulo((whole % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(np.full(d + 1, p)), pa.array(found)], ["k", "p", "r"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch["at"].to_pylist():
                value, modulus = 0, 1
                for x in row:
                    value += modulus * ((x["r"] - value) * pow(modulus, -1, x["p"]) % x["p"])
                    modulus *= x["p"]
                out.append(f"{value - modulus if 2 * value > modulus else value:x}")
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(out, pa.string())], ["k", "value"])

    found = map_arrow(spark.range(0, len(primes), 1, min(len(primes), 64)), residues, "k long, p long, r long")
    rows = found.groupBy("k").agg(F.collect_list(F.struct("p", "r")).alias("at"))
    value = {r["k"]: int(r["value"], 16) for r in map_arrow(rows, joined, "k long, value string").toArrow().to_pylist()}
    return [value[k] for k in range(d + 1)]


def roots_above(poly: list[int], at: int, bits: int = 0) -> int:
    """How many roots, repeats counted, exceed ``at / 2^bits``: sign changes of the shifted polynomial.

    Descartes' rule is exact where all roots are real, as they are for a symmetric matrix.
    """
    d = len(poly) - 1
    c = [v << (bits * (d - i)) for i, v in enumerate(poly)]
    if at:
        for i in range(d):
            for k in range(d - 1, i - 1, -1):
                c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


@dataclass(frozen=True)
class Root:
    """The roots numbered ``first`` to ``last`` by falling size lie in (low, low + 1] / 2^bits."""

    first: int
    last: int
    low: int
    bits: int

    @property
    def value(self) -> Fraction:
        return Fraction(2 * self.low + 1, 2 << self.bits)


def isolate_root(poly: list[int], k: int) -> Root:
    """The ``k``-th largest root, which must be positive; bisection by exact counts, then by exact signs."""
    d, bits = len(poly) - 1, 0
    low, high = 0, 1 << max(1, (-poly[d - 1]).bit_length())
    above_low, above_high = roots_above(poly, 0), 0
    while not (high - low == 1 and low >> ROOT_BITS):
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        if above_low - above_high > 1:
            above = roots_above(poly, middle, bits)
        else:
            value, scale = 0, 0
            for c in reversed(poly):
                value, scale = value * middle + (c << scale), scale + bits
            above = above_high + (value != 0 and (value < 0) == (above_high % 2 == 0))
        if above >= k:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return Root(above_high + 1, above_low, low, bits)


def null_vectors(scatter: list[list[int]], shift: Fraction, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors next to the null space of ``scatter - shift``: block inverse iteration.

    One elimination in whole numbers of FRACTION bits serves all rounds. Each vector's largest entry is positive.
    """
    d = len(scatter)
    a = [[v * shift.denominator - (shift.numerator if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(scatter)]
    up = FRACTION - max(abs(v) for row in a for v in row).bit_length()
    a = [[v << up if up >= 0 else v >> -up for v in row] for row in a]
    order, factors = list(range(d)), [[0] * d for _ in range(d)]
    for c in range(d):
        best = max(range(c, d), key=lambda i: abs(a[i][c]))
        for rows in (a, order, factors):
            rows[c], rows[best] = rows[best], rows[c]
        a[c][c] = a[c][c] or 1
        tail = a[c][c + 1 :]
        for i in range(c + 1, d):
            factors[i][c] = f = (a[i][c] << FRACTION) // a[c][c]
            if f:
                a[i][c + 1 :] = [x - (f * y >> FRACTION) for x, y in zip(a[i][c + 1 :], tail, strict=True)]

    def solve(b: list[int]) -> list[int]:
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum(f * v for f, v in zip(factors[i][:i], y, strict=False)) >> FRACTION
        for i in range(d - 1, -1, -1):
            y[i] = ((y[i] << FRACTION) - sum(u * v for u, v in zip(a[i][i + 1 :], y[i + 1 :], strict=True))) // a[i][i]
        return y

    def unit(x: list[int]) -> list[int]:
        length = math.isqrt(sum(v * v for v in x)) or 1
        return [(v << FRACTION) // length for v in x]

    draw = random.Random(20240611)
    block = [unit([draw.getrandbits(64) - (1 << 63) for _ in range(d)]) for _ in range(count)]
    for _ in range(ROUNDS):
        done: list[list[int]] = []
        for x in block:
            x = unit(solve(x))
            for _ in range(2):
                for q in done:
                    dot = sum(u * v for u, v in zip(q, x, strict=True)) >> FRACTION
                    x = [v - (dot * u >> FRACTION) for u, v in zip(q, x, strict=True)]
                x = unit(x)
            done.append(x)
        block = done
    out = []
    for x in block:
        sign = -1 if max(x, key=abs) < 0 else 1
        out.append([sign * float(Fraction(v, 1 << FRACTION)) for v in x])
    return out


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: count and sums of the fit list, components as columns, their eigenvalues, their shares."""

    scale: int
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def deviations(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``n * x - S`` of each row in whole numbers, and whitened rows."""
        x = integers(column, self.scale, len(self.sums))
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        z = x * np.int64(self.n) - np.array(self.sums, np.int64) if most < 1 << 62 else x.astype(object) * self.n - np.array(self.sums, object)
        return z, z.astype(np.float64) @ self.components / (self.n * np.sqrt(self.eigenvalues))


def fit_whitening(vectors: DataFrame, components: int = 32, scale: int = 64) -> Whitening | None:
    """Components of the covariance of ``floor(scale * c)`` over all rows of ``finite(vectors)``; None without rows.

    1. Tasks sum integer entries and their products exactly; n^2 times the covariance is a whole-number matrix, which
       is divided by the largest common divisor of its entries.
    2. Its characteristic polynomial, exactly (``characteristic_polynomial``).
    3. Its ``components`` largest roots, each a row of a job: sign changes count the roots above a point exactly, so
       bisection isolates each root to ROOT_BITS bits, repeated roots with their number of repeats.
    4. Inverse iteration next to the null space at each root, again a row each, gives the components; those of a
       repeated root are an orthonormal basis of its space.
    Components whose eigenvalue is zero are left out, since nothing can be divided by it.
    """
    spark = vectors.sparkSession
    n, sums, products = _sums(finite(vectors), scale)
    if not n:
        return None
    d = len(sums)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    divisor = math.gcd(*(v for row in scatter for v in row)) if d else 0
    if not divisor:
        return Whitening(scale, n, sums, np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    scatter = [[v // divisor for v in row] for row in scatter]
    poly = characteristic_polynomial(spark, scatter)
    wanted = min(components, roots_above(poly, 0))

    def isolate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [isolate_root(poly, k + 1) for k in batch["id"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.first for r in found], pa.int32()), pa.array([r.last for r in found], pa.int32()), pa.array([f"{r.low:x}" for r in found], pa.string()), pa.array([r.bits for r in found], pa.int32())], ["first", "last", "low", "bits"])

    rows = map_arrow(spark.range(0, wanted, 1, wanted), isolate, "first int, last int, low string, bits int").toArrow().to_pylist()
    spaces: list[tuple[Fraction, int, int]] = []
    for root in sorted({Root(r["first"], r["last"], int(r["low"], 16), r["bits"]) for r in rows}, key=lambda r: r.first):
        if spaces and (spaces[-1][0] - root.value) * (1 << SAME_BITS) < spaces[-1][0]:
            spaces[-1] = (spaces[-1][0], spaces[-1][1], root.last)
        else:
            spaces.append((root.value, root.first, root.last))

    def nulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch["id"].to_pylist():
                value, first, last = spaces[at]
                found = null_vectors(scatter, value, min(last, wanted) - first + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + len(found), dtype=np.int32)), pa.array(found, pa.list_(pa.float64()))], ["component", "entries"])

    found = {r["component"]: r["entries"] for r in map_arrow(spark.range(0, len(spaces), 1, len(spaces)), nulls, "component int, entries array<double>").toArrow().to_pylist()}
    values = [next(v for v, first, last in spaces if first <= k <= last) * divisor for k in range(1, wanted + 1)]
    trace = sum(scatter[i][i] for i in range(d)) * divisor
    return Whitening(scale, n, sums, np.array([found[k] for k in range(1, wanted + 1)]).T, np.array([float(v / n**2) for v in values]), np.array([float(v / trace) for v in values]))


def apply_whitening(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened)`` of each row of ``finite(vectors)``; ``deviation`` is the sum of ``(n x - S)^2``,
    null where a decimal(38,0) cannot hold it."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z, white = model.deviations(batch["embedding"])
            if z.dtype == object or len(model.sums) * int(np.abs(z).max(initial=0)) ** 2 >= 1 << 63:
                z = z.astype(object)
            square = (z * z).sum(axis=1) if z.shape[1] else np.zeros(len(z), np.int64)
            told = pa.array(square, pa.int64()).cast(pa.decimal128(38, 0)) if square.dtype != object else pa.array([Decimal(v) if v < 10**38 else None for v in square.tolist()], pa.decimal128(38, 0))
            ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_arrays([batch["vec_id"], told, pa.ListArray.from_arrays(ends, pa.array(white.ravel()))], ["vec_id", "deviation", "whitened"])

    return map_arrow(finite(vectors).withColumn("vec_id", F.col("vec_id").cast("long")), body, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, summed over all rows in Spark."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                white = model.deviations(batch["embedding"])[1]
                total += white.sum(axis=0)
                products += white.T @ white
        flat = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "value"])

    parts = map_arrow(finite(vectors).select("embedding"), body, "i int, value double")
    rows = parts.groupBy("i").agg(F.sum("value").alias("value")).orderBy("i").toArrow()
    flat = rows["value"].to_numpy() / model.n
    return float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64) -> DataFrame:
    """``(vec_id, n, deviation, whitened, explained, identity_error)``, a row per vector, fitted on all of them.

    ``whitened`` and ``explained`` are arrays in the order of components, at most ``components``; fewer where the
    vectors span fewer dimensions. Rows whose vector is null or holds a null or non-finite entry are dropped; zero
    vectors, repeated rows and rows without vec_id count and are returned. Shorter vectors count as padded with zeros;
    entries beyond +-2^62 / ``scale`` count as that. Extra columns are left aside. Empty tables give no rows.
    """
    model = fit_whitening(vectors, components, scale)
    if model is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")
    share = F.array(*(F.lit(float(v)) for v in model.explained)) if len(model.explained) else F.array().cast("array<double>")
    return apply_whitening(vectors, model).select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(identity_error(vectors, model)).alias("identity_error"))


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error")
