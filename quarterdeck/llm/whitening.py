"""Whitening of embeddings by spectrum slicing.

Vectors become integers, so their sums and the products of their centred entries are exact and do not depend on how rows
lie in tasks. The covariance, as large as the square of the dimension, is all that reaches the driver. There LDLᵀ
factorisations of the shifted covariance count the eigenvalues above a shift (Sylvester's law of inertia), bisection on
the counts isolates each leading eigenvalue, Rayleigh quotient iteration converges inside its interval, and counts on
both sides certify its number. Rows are then projected where they lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import landed

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this count as non-finite: products of their integers would leave 38 digits.
LARGEST = 2.0**30
_EPS = float(np.finfo(float).eps)
_DIGITS = pa.decimal128(38, 0)
_LIMB = 14  # bits; products of two limbs, summed over a batch, stay exact in doubles


# --- eigenvalues of a symmetric matrix, on the driver -------------------------------------------------------------------


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues greater than `shift`: positive ones in D of the factorisation LDLᵀ of matrix - shift, with 1 x 1 and 2 x 2
    pivots chosen so that the factors stay bounded."""
    a = matrix - shift * np.eye(len(matrix))
    bound, size, at, positive = (1 + 17**0.5) / 8, len(matrix), 0, 0
    while at < size:
        below = np.abs(a[at + 1 :, at])
        largest = below.max(initial=0.0)
        pivot, width = at, 1
        if abs(a[at, at]) < bound * largest:
            r = at + 1 + int(below.argmax())
            row = np.abs(a[r, at:])
            row[r - at] = 0.0
            if abs(a[at, at]) * row.max() < bound * largest**2:
                pivot, width = r, 1 if abs(a[r, r]) >= bound * row.max() else 2
        if largest == 0 and a[at, at] == 0:
            at += 1
            continue
        target = at + width - 1
        if pivot != target:
            a[[target, pivot]] = a[[pivot, target]]
            a[:, [target, pivot]] = a[:, [pivot, target]]
        rest = at + width
        if width == 1:
            positive += int(a[at, at] > 0)
            a[rest:, rest:] -= np.outer(a[rest:, at], a[rest:, at] / a[at, at])
        else:  # its determinant is negative: one eigenvalue of either sign
            positive += 1
            sides = a[rest:, at:rest]
            a[rest:, rest:] -= sides @ np.linalg.solve(a[at:rest, at:rest], sides.T)
        at = rest
    return positive


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, scale: float) -> np.ndarray:
    while True:
        try:
            return np.linalg.solve(matrix - shift * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            shift += 2 * _EPS * scale


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues of a positive semidefinite matrix, falling, and their unit eigenvectors as rows.

    The largest entry of a vector is positive. Equal eigenvalues get an orthonormal basis of their space.
    """
    size = len(matrix)
    scale = float(np.trace(matrix))
    values, vectors = np.zeros(count), np.zeros((count, size))
    if scale <= 0:
        return values, np.eye(count, size)
    narrow = 8 * size * _EPS * scale
    known: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = eigenvalues_above(matrix, shift)
        return known[shift]

    def halved(low: float, high: float, number: int) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if above(middle) >= number else (low, middle)

    def free_of_found(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - found.T @ (found @ vector)
        return vector / np.linalg.norm(vector)

    random = np.random.default_rng(0)
    for k in range(count):
        low, high = -narrow, scale + narrow
        while not (above(low) == k + 1 and above(high) == k) and high - low > narrow:
            low, high = halved(low, high, k + 1)
        while True:
            vector = free_of_found(random.standard_normal(size), vectors[:k])
            shift = (low + high) / 2
            for step in range(40):
                vector = free_of_found(_solved(matrix, shift, vector, scale), vectors[:k])
                quotient = float(vector @ matrix @ vector)
                if step >= 2 and np.linalg.norm(matrix @ vector - quotient * vector) <= 4 * _EPS * scale and abs(quotient - shift) <= narrow:
                    break
                shift = quotient if step >= 2 else shift
            if low - narrow <= quotient <= high + narrow or high - low <= narrow:
                break
            for _ in range(4):  # it ran off to another eigenvalue
                low, high = halved(low, high, k + 1)
        values[k] = quotient
        vectors[k] = vector * np.sign(vector[np.abs(vector).argmax()])
        if not above(quotient - 2 * narrow) >= k + 1 > above(quotient + 2 * narrow):
            raise ArithmeticError(f"eigenvalue {k + 1} is not certified")
    return values, vectors


# --- exact sums over all rows -------------------------------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    entries = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * entries).astype(np.int64).reshape(-1, dimension) + SHIFT


def exact_products(y: np.ndarray) -> np.ndarray:
    """yᵀy as Python integers, from products of limbs small enough to be exact in doubles."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 2**53:
        doubles = y.astype(float)
        return (doubles.T @ doubles).astype(np.int64).astype(object)
    limbs = []
    while most:
        limbs.append((y & (2**_LIMB - 1)).astype(float) if most >= 2**_LIMB else y.astype(float))
        y, most = y >> _LIMB, most >> _LIMB if most >= 2**_LIMB else 0
    total = np.zeros((y.shape[1],) * 2, dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def _totals(vectors: DataFrame, dimension: int, of: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], int]:
    """Sums over all rows of `of` a batch's integers, a table (i, j) no larger than the square of the dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for first in range(0, batch.num_rows, 8192):
                part = of(_matrix(batch.slice(first, 8192), dimension))
                total = part if total is None else total + part
        if total is not None:
            at = np.argwhere(np.triu(np.ones(total.shape, dtype=bool)) if total.shape[0] > 1 else np.ones(total.shape, dtype=bool))
            columns = [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array([int(total[i, j]) for i, j in at], _DIGITS)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])

    parts = vectors.select("embedding").mapInArrow(add, "i int, j int, total decimal(38,0)")
    return {(r["i"], r["j"]): int(r["total"]) for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}


def _finite(vector: str) -> Column:
    return F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))  # false for NaN, the largest of all


@dataclass
class Whitening:
    """n rows, their integers' rounded means and what is left of the sums, eigenvalues, unit eigenvectors (rows), trace."""

    n: int
    means: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def known(self) -> np.ndarray:
        """Components with a variance beyond rounding."""
        return self.values > self.vectors.shape[1] * _EPS * self.trace


def usable(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows with a whole, finite vector of the table's dimension, the number of such rows, and the dimension.

    The dimension is the most frequent length of a whole vector, of equally frequent ones the largest.
    """
    whole = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(_finite("embedding"))
    lengths = whole.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    n, dimension = (lengths["n"], lengths["d"]) if lengths else (0, 0)
    return whole.filter(F.size("embedding") == dimension), n, dimension


def fit(whole: DataFrame, n: int, dimension: int, components: int = COMPONENTS) -> Whitening:
    """Two passes: the sums, then the products of entries centred on the rounded means; both exact."""
    sums = _totals(whole, dimension, lambda x: x.sum(axis=0, keepdims=True).astype(object))
    s = [sums[0, j] for j in range(dimension)]
    means = np.array([(2 * t + n) // (2 * n) for t in s], dtype=np.int64)
    rest = [t - n * int(m) for t, m in zip(s, means, strict=True)]
    products = _totals(whole, dimension, lambda x: exact_products(x - means))
    covariance = np.zeros((dimension, dimension))
    for (i, j), total in products.items():  # integers over integers, rounded once
        covariance[i, j] = covariance[j, i] = (n * total - rest[i] * rest[j]) / (n * n)
    trace = sum(n * products[i, i] - rest[i] ** 2 for i in range(dimension)) / (n * n)
    values, axes = leading_eigenpairs(covariance, min(components, dimension))
    return Whitening(n, means, np.array(rest, dtype=object), values, axes, trace)


def squared_norms(t: np.ndarray) -> list[int]:
    """Sums of squares of each row of integers, exact."""
    if t.dtype != object:
        most = int(np.abs(t).max(initial=0))
        if most**2 * t.shape[1] < 2**62:
            return [int(v) for v in (t * t).sum(axis=1)]
        if most < 2**52 and t.shape[1] < 2**10:
            high, low = np.abs(t) >> 26, np.abs(t) & (2**26 - 1)
            parts = ((high * high).sum(axis=1), (2 * high * low).sum(axis=1), (low * low).sum(axis=1))
            return [(int(a) << 52) + (int(b) << 26) + int(c) for a, b, c in zip(*parts, strict=True)]
        t = t.astype(object)
    return [int(v) for v in (t * t).sum(axis=1)]


def project(whole: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id, deviation (decimal; null beyond 38 digits) and whitened (an entry per component, null without variance)."""
    n, means, rest, dimension = fitted.n, fitted.means, fitted.rest, len(fitted.means)
    known = fitted.known
    axes = np.where(known[:, None], fitted.vectors / np.sqrt(np.where(known, fitted.values, 1.0))[:, None], 0.0)
    offset = np.array([int(r) / n for r in rest])
    vec_id = whole.schema["vec_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch, dimension) - means
            small = (int(np.abs(y).max(initial=0)) + 1) * n < 2**62
            t = y * n - rest.astype(np.int64) if small else y.astype(object) * n - rest
            norms = [v if v < 10**38 else None for v in squared_norms(t)]
            whitened = ((y - offset) @ axes.T).reshape(-1)
            lists = pa.array(whitened, mask=np.tile(~known, len(y)))
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * len(known))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(norms, _DIGITS), pa.ListArray.from_arrays(ends, lists)],
                names=["vec_id", "deviation", "whitened"],
            )

    return whole.mapInArrow(rows, f"vec_id {vec_id}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error per row and component.

    Rows whose vector is null or holds null, non-finite or huge entries (LARGEST) are dropped, and so are those of another
    length than the table's dimension. Repeated rows and null ids stay. With fewer dimensions than components there are that
    many components. A component without variance, as where all vectors are equal, has a null `whitened` and explains 0;
    `explained` is null if nothing varies at all, `identity_error` if no component varies. An empty table gives no rows.
    The input is read four times; columns beside vec_id and embedding are not read.
    """
    whole, n, dimension = usable(vectors)
    if not dimension:
        empty = whole.select("vec_id").limit(0)
        types = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double"}
        return empty.withColumns({c: F.lit(None).cast(t) for c, t in (types | {"explained": "double", "identity_error": "double"}).items()})
    fitted = fit(whole, n, dimension, components)
    rows = landed(project(whole, fitted), "whitened")
    known = np.flatnonzero(fitted.known)
    pairs = [(int(i), int(j)) for i in known for j in known if i <= j]
    error = None
    if pairs:  # covar_pop centres before it multiplies
        spread = rows.agg(*(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) for i, j in pairs)).first()
        error = max(abs(v - (i == j)) for (i, j), v in zip(pairs, spread, strict=True))
    parts = np.where(fitted.known, fitted.values, 0.0)
    shares = F.array(*(F.lit(float(v) / fitted.trace if fitted.trace > 0 else None).cast("double") for v in parts))
    listed = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return listed.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def whiten_embeddings(vectors: DataFrame) -> DataFrame:
    """The rows of `whiten`, deviation as a long; null where it does not fit one."""
    return whiten(vectors).withColumn("deviation", F.col("deviation").try_cast("long"))
