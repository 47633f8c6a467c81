"""Whitening of embeddings by their leading components.

Entries become whole numbers, so counts, sums and products over all vectors are
exact whatever their order: tasks multiply vectors less a whole-number centre and Spark
adds the products of each pair of dimensions. What the driver holds is one square
matrix over the dimensions, however many vectors there are.

The leading eigenvalues of that covariance are found by slicing its spectrum. An
LDL' factorisation of the matrix less a shift has as many positive pivots as there are
eigenvalues above the shift; halving by these counts gives each of the leading
eigenvalues an interval of its own, Rayleigh quotient iteration converges in it, and
counts on both sides of the value found certify its number. Values that no
double tells apart share an interval; their vectors are chosen orthogonal.

Rows whose vector is null, or has null or non-finite entries, are left out; so are
vectors of another length than the commonest (of equally common ones the longest). A repeated row
counts once in the fit and is answered as often as it comes. There are no
components of zero variance (beside the first one, within rounding): no rows for them, nor for
an empty table. Entries beyond 2**62 count as that; ``deviation`` is null where it passes 64 bits. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Passed

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Of the largest eigenvalue: what counts as zero, and how exact a value must be before it is certified.
ZERO, EXACT = 1e-12, 1e-13
# Bunch and Parlett's bound, which keeps the growth of pivots least.
ALPHA = (1 + math.sqrt(17)) / 8
MOST_LONG = 2**63
# Entries beyond this count as this, so that 64 bits hold them.
LARGEST = 2**62
# Whole sums go through Spark in two parts, which 38 digits hold however many there are.
LIMB = 10**30


def whole_numbers(vector: Column) -> Column:
    def whole(c: Column) -> Column:
        scaled = F.floor(F.lit(float(SCALE)) * c.cast("double"))
        return F.least(F.greatest(scaled, F.lit(-LARGEST)), F.lit(LARGEST)) + F.lit(SHIFT)

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


# --- the driver's part: one matrix over the dimensions ----------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: positive pivots of LDL' with pivots of one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    found = 0
    while len(a):
        diagonal = np.abs(a.diagonal())
        off = np.abs(a - np.diag(a.diagonal()))
        i, (r, s) = int(diagonal.argmax()), np.unravel_index(int(off.argmax()), off.shape)
        if max(diagonal[i], off[r, s]) == 0:
            break
        pivot = [i] if diagonal[i] >= ALPHA * off[r, s] else [r, s]
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block = a[np.ix_(pivot, pivot)]
        # Two rows are taken only where their determinant is negative: one value of either sign.
        found += int(block[0, 0] > 0) if len(pivot) == 1 else 1
        across = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - across @ np.linalg.solve(block, across.T)
        a = (a + a.T) / 2
    return found


def isolate(matrix: np.ndarray, k: int, low: float, high: float, exact: float, counts: dict[float, int]) -> tuple[float, float]:
    """An interval that holds eigenvalue ``k`` (from 1, falling) and no other, or only some that are closer than ``exact``."""

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(matrix, shift)
        return counts[shift]

    for shift in sorted(counts):
        if counts[shift] >= k:
            low = max(low, shift)
        else:
            high = min(high, shift)
    while high - low > exact and not (count(low) == k and count(high) == k - 1):
        middle = (low + high) / 2
        if count(middle) >= k:
            low = middle
        else:
            high = middle
    return low, high


def rayleigh(matrix: np.ndarray, low: float, high: float, found: np.ndarray, exact: float) -> tuple[float, np.ndarray] | None:
    """Value and unit vector in the interval, orthogonal to those found; None if the iteration left it."""
    d = len(matrix)

    def cleaned(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found @ (found.T @ v)
        return v / np.linalg.norm(v)

    def solved(shift: float, v: np.ndarray) -> np.ndarray:
        step = exact
        while True:
            try:
                w = np.linalg.solve(matrix - shift * np.eye(d), v)
                if np.isfinite(w).all():
                    return w
            except np.linalg.LinAlgError:
                pass
            shift, step = shift + step, 2 * step

    value = (low + high) / 2
    vector = cleaned(np.random.default_rng(d).standard_normal(d))
    for _ in range(3):
        vector = cleaned(solved(value, vector))
    residual = math.inf
    while True:
        value = vector @ matrix @ vector
        left = np.linalg.norm(matrix @ vector - value * vector)
        if not low - exact <= value <= high + exact:
            return None
        # Convergence is cubic: a step that does not halve the residual has met the rounding, or started too far off.
        if left == 0 or left > residual / 2:
            return (float(value), vector) if left <= exact else None
        residual = left
        vector = cleaned(solved(value, vector))


def leading(matrix: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; zero ones are left out."""
    matrix = (matrix + matrix.T) / 2
    d = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    if not top:
        return np.empty(0), np.empty((d, 0))
    exact = EXACT * top * d
    counts = {0.0 - exact: d, top + exact: 0}
    positive = above(matrix, ZERO * top * d)
    values, vectors = [], np.empty((d, 0))
    for k in range(1, min(components, positive) + 1):
        low, high = isolate(matrix, k, -exact, top + exact, exact, counts)
        while (pair := rayleigh(matrix, low, high, vectors, exact)) is None:
            # A narrower interval: the start lies closer to its value than to any other.
            middle = (low + high) / 2
            if high - low <= exact:
                raise ArithmeticError(f"no vector for eigenvalue {k} in {low} to {high}")
            counts[middle] = above(matrix, middle)
            low, high = (middle, high) if counts[middle] >= k else (low, middle)
        value, vector = pair
        # Certified: fewer than k values lie above it, and at least k above what is just below.
        slack = 4 * exact
        if not above(matrix, value + slack) < k <= above(matrix, value - slack):
            raise ArithmeticError(f"eigenvalue {k} could not be certified at {value}")
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    return np.array(values), vectors


# --- over all vectors --------------------------------------------------------


def exact_products(y: np.ndarray) -> list[list[int]]:
    """Sums of the products of all pairs of columns, in whole numbers.

    Products of small numbers are added as doubles while their sums stay exact, larger ones as Python's numbers.
    """
    most = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    if most >= 2**26:
        big = y.astype(object)
        return (big.T @ big).tolist()
    rows = max(1, 2**53 // max(1, most * most))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for start in range(0, len(y), rows):
        part = y[start : start + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total.tolist()


@dataclass(frozen=True)
class Whitening:
    """What the vectors have in common: ``x - centre`` sums to ``sums`` over ``n`` different vectors."""

    n: int
    centre: list[int]
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]
    identity_error: float


def _centre(rows: DataFrame) -> list[int] | None:
    """A whole number near the mean of each dimension, for vectors of the commonest length."""
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return None
    d = sizes[0]["d"]
    means = (
        rows.where(F.size("x") == d)
        .select(F.posexplode("x").alias("i", "v"))
        .groupBy("i")
        .agg(F.round(F.avg(F.col("v").cast("double"))).cast("bigint").alias("m"))
        .orderBy("i")
        .collect()
    )
    return [r["m"] for r in means]


def _moments(rows: DataFrame, centre: list[int]) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and products of the different vectors less the centre, all exact."""
    d, middle = len(centre), np.array(centre, dtype=np.int64)

    def add(frames):
        n, sums, products = 0, [0] * d, None
        for frame in frames:
            if not len(frame):
                continue
            y = np.stack(frame["x"].to_numpy()).astype(np.int64) - middle
            n += len(y)
            sums = [a + int(b) for a, b in zip(sums, y.astype(object).sum(axis=0))]
            part = np.array(exact_products(y), dtype=object)
            products = part if products is None else products + part
        if n:
            yield limbs(-1, [-1], [n])
            yield limbs(-1, range(d), sums)
            for i in range(d):
                yield limbs(i, range(i, d), products[i, i:])

    def limbs(i, j, values):
        both = [divmod(int(v), LIMB) for v in values]
        return pd.DataFrame({"i": i, "j": list(j), "high": [str(h) for h, _ in both], "low": [str(r) for _, r in both]})

    parts = rows.select("x").distinct().mapInPandas(add, "i int, j int, high string, low string")
    summed = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("high", "low")]
    n, sums, products = 0, [0] * d, [[0] * d for _ in range(d)]
    for i, j, high, low in parts.groupBy("i", "j").agg(*summed).collect():
        v = int(high) * LIMB + int(low)
        if j < 0:
            n = v
        elif i < 0:
            sums[j] = v
        else:
            products[i][j] = products[j][i] = v
    return n, sums, products


def covariance(n: int, sums: list[int], products: list[list[int]]) -> np.ndarray:
    """Covariance with divisor ``n``: whole numbers until the one division."""
    square = n * n
    return np.array([[(n * p - a * b) / square for p, b in zip(row, sums)] for row, a in zip(products, sums)])


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all different vectors, or None where there is none."""
    rows = vectors.where(usable(F.col(vector))).select(whole_numbers(F.col(vector)).alias("x"))
    centre = _centre(rows)
    if centre is None:
        return None
    n, sums, products = _moments(rows.where(F.size("x") == len(centre)), centre)
    matrix = covariance(n, sums, products)
    values, found = leading(matrix, components)
    trace = float(np.trace(matrix))
    axes = found / np.sqrt(values)
    error = float(np.abs(axes.T @ matrix @ axes - np.eye(len(values))).max(initial=0.0))
    return Whitening(n, centre, sums, values, found, [float(v) / trace for v in values], error)


def whiten(vectors: DataFrame, keep: list[str] = ("vec_id",), vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``keep``, the fit's ``n``, the exact ``deviation``, ``whitened`` and ``explained`` as arrays, and ``identity_error``."""
    found = fit(vectors, vector, components)
    passed = Passed(vectors, list(keep))
    schema = f"{passed.schema}, deviation long, whitened array<double>"
    rows = vectors.where(usable(F.col(vector))).select(*passed.out, whole_numbers(F.col(vector)).alias("_x"))
    if found is None:
        rows = rows.where("false").select(*keep, F.lit(None).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        n, explained, error = 0, [], 0.0
    else:
        n, explained, error = found.n, found.explained, found.identity_error
        middle, sums = np.array(found.centre, dtype=np.int64), np.array(found.sums, dtype=object)
        offset = np.array([s / n for s in found.sums])
        wrapped = np.array([s % 2**64 for s in found.sums], dtype=np.uint64).view(np.int64)
        axes = found.vectors / np.sqrt(found.values)

        def project(frames):
            for frame in frames:
                if not len(frame):
                    continue
                y = np.stack(frame["_x"].to_numpy()).astype(np.int64) - middle
                # Whole numbers modulo 2**64: exact where the true sum of squares fits.
                t = np.int64(n) * y - wrapped
                exact = (t * t).sum(axis=1)
                fits = ((n * (y - offset)) ** 2).sum(axis=1) < MOST_LONG * (1 - 1e-9)
                out = frame.drop(columns="_x")
                out["deviation"] = [int(v) if ok else None for v, ok in zip(exact, fits)]
                out["deviation"] = out["deviation"].astype("Int64")
                out["whitened"] = list((y - offset) @ axes)
                yield out

        rows = rows.where(F.size("_x") == len(found.centre)).mapInPandas(project, schema)
        rows = rows.select(*passed.back, "deviation", "whitened")
    return rows.select(
        *keep,
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in explained]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(white: DataFrame, keep: list[str] = ("vec_id",)) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    others = [c for c in white.columns if c not in ("whitened", "explained")]
    each = white.select(*others, F.posexplode(F.arrays_zip("whitened", "explained")).alias("_i", "_c"))
    return each.select(
        *keep,
        (F.col("_i") + 1).alias("component"),
        "n",
        "deviation",
        F.col("_c.whitened").alias("whitened"),
        F.col("_c.explained").alias("explained"),
        "identity_error",
    )
