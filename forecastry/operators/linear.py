"""M5 for any features: least squares from one aggregate, whatever their rank.

:func:`gram` sums the products of all pairs of features (a constant 1 among them)
and of each with the label, in decimals: the sums, and so the coefficients, do
not depend on the order of rows.  They are all that reaches the driver: 45 and 9
numbers for 8 features.  There the sums are centred exactly, and a pivoted
Cholesky factorisation of the correlations takes the features one by one, each
time the one that the chosen ones explain least; those that nothing is left of
(constant, or a combination of others) are named and get the coefficient 0.

Rows with a null or NaN feature or label take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from itertools import combinations_with_replacement
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastry.schema import FEATURE_COLUMNS

CONSTANT, LABEL = "intercept", "label"
PRODUCT = "decimal(36,12)"
LARGEST = 1e24
#: Rows whose integers add up in 64 bits, whatever their values.
SUMMED_AT_ONCE = 8192
#: A feature is dropped if the chosen ones leave less than this share of its
#: variance, or if its variance is less than this share of its mean square.
LEAST_SHARE = 1e-10


class LeastSquares(NamedTuple):
    """``coefficients`` by feature (0 for ``dropped`` ones), fitted to ``n`` rows."""

    coefficients: dict[str, float]
    intercept: float
    dropped: list[str]
    n: int


def _pairs(features) -> list[tuple[str, str]]:
    columns = [CONSTANT, *features]
    return [*combinations_with_replacement(columns, 2), *[(c, LABEL) for c in columns]]


def _value(name: str, label: str) -> Column:
    return F.lit(1.0) if name == CONSTANT else F.col(label if name == LABEL else name).cast("double")


def complete_rows(df: DataFrame, features=FEATURE_COLUMNS, label: str = "sales") -> DataFrame:
    """Rows of which every feature and the label is a number."""
    ok = F.lit(True)
    for c in (*features, label):
        x = F.col(c).cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(x)
    return df.where(ok)


def _sums_of_products(batches: Iterator[pa.RecordBatch], pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Per pair of columns, the exact sum of a task's products, each rounded to
    12 decimals: a product is its multiple of 2**32, the whole rest and the
    fraction in units of 1e-12, which are summed as integers."""
    sums = [0] * len(pairs)
    for batch in (b.slice(at, SUMMED_AT_ONCE) for b in batches for at in range(0, b.num_rows, SUMMED_AT_ONCE)):
        columns = [np.asarray(c) for c in batch.columns]
        for k, (i, j) in enumerate(pairs):
            with np.errstate(over="ignore", invalid="ignore"):
                p = columns[i] * columns[j]
            if not np.isfinite(p).all():
                p = p[np.isfinite(p)]
            if len(p) and np.abs(p).max() >= LARGEST:
                raise OverflowError(f"a product of 1e24 or more does not fit into {PRODUCT}")
            high = np.trunc(p / 2.0**32)
            p = p - high * 2.0**32
            low = np.trunc(p)
            units = np.rint((p - low) * 1e12)
            for part, unit in ((high, 10**12 << 32), (low, 10**12), (units, 1)):
                sums[k] += int(part.astype(np.int64).sum()) * unit
    with localcontext(prec=60):
        values = [pa.array([Decimal(s).scaleb(-12)], pa.decimal128(38, 12)) for s in sums]
    yield pa.RecordBatch.from_arrays(values, names=[f"s{k}" for k in range(len(sums))])


def gram(df: DataFrame, features=FEATURE_COLUMNS, label: str = "sales") -> DataFrame:
    """One (a, b, total) row per pair: the sum of the products of two features,
    or of a feature and the label; no row's order or partition matters.

    A task adds up its rows by arrays and gives one row of exact sums."""
    pairs = _pairs(features)
    names = [CONSTANT, *features, LABEL]
    places = [(names.index(a), names.index(b)) for a, b in pairs]
    values = complete_rows(df, features, label).select(*[_value(c, label).alias(f"v{i}") for i, c in enumerate(names)])
    of_tasks = values.mapInArrow(
        lambda batches: _sums_of_products(batches, places), ", ".join(f"s{k} decimal(38,12)" for k in range(len(pairs)))
    )
    sums = of_tasks.agg(*[
        F.coalesce(F.sum(f"s{k}"), F.lit(0)).cast("decimal(38,12)").alias(f"s{k}") for k in range(len(pairs))
    ])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"s{k}").alias("total")) for k, (a, b) in enumerate(pairs)]
    return sums.select(F.inline(F.array(*rows)))


def pivoted_cholesky(correlations: np.ndarray, least: float = LEAST_SHARE) -> list[int]:
    """Columns in the order taken, until ``least`` of the variance of any is left."""
    left = correlations.astype(float).copy()
    taken: list[int] = []
    while len(taken) < len(left):
        rest = [i for i in range(len(left)) if i not in taken]
        i = max(rest, key=lambda c: (left[c, c], -c))
        if left[i, i] <= least:
            break
        column = left[:, i] / np.sqrt(left[i, i])
        left -= np.outer(column, column)
        taken.append(i)
    return taken


def solve(sums: dict[tuple[str, str], Fraction], features) -> LeastSquares:
    """Least squares from the sums of products."""
    n = sums[CONSTANT, CONSTANT]
    if not n:
        raise ValueError("no row has all features and a label")

    def of(a: str, b: str) -> Fraction:
        return sums[a, b] if (a, b) in sums else sums[b, a]

    def covariance(a: str, b: str) -> Fraction:
        return of(a, b) / n - of(CONSTANT, a) * of(CONSTANT, b) / (n * n)

    varied = [f for f in features if float(covariance(f, f)) > LEAST_SHARE * float(of(f, f) / n)]
    scale = {f: float(covariance(f, f)) ** 0.5 for f in varied}
    matrix = np.array([[float(covariance(a, b)) / (scale[a] * scale[b]) for b in varied] for a in varied]).reshape(len(varied), len(varied))
    taken = sorted(pivoted_cholesky(matrix))
    with_label = np.array([float(covariance(varied[i], LABEL)) / scale[varied[i]] for i in taken])
    weights = np.linalg.solve(matrix[np.ix_(taken, taken)], with_label) if taken else with_label
    coefficients = dict.fromkeys(features, 0.0)
    for i, w in zip(taken, weights, strict=True):
        coefficients[varied[i]] = float(w) / scale[varied[i]]
    mean = sum((Fraction(c) * of(CONSTANT, f) for f, c in coefficients.items()), Fraction(0)) / n
    kept = {varied[i] for i in taken}
    return LeastSquares(coefficients, float(of(CONSTANT, LABEL) / n - mean), [f for f in features if f not in kept], int(n))


def fit(df: DataFrame, features=FEATURE_COLUMNS, label: str = "sales") -> LeastSquares:
    """Ordinary least squares with an intercept, by one aggregate."""
    return solve({(r["a"], r["b"]): Fraction(r["total"]) for r in gram(df, features, label).collect()}, features)


def predict(df: DataFrame, fitted: LeastSquares, out: str = "prediction") -> DataFrame:
    """``df`` and the prediction, a plain expression."""
    total = F.lit(fitted.intercept)
    for f, c in fitted.coefficients.items():
        if c:
            total = total + F.col(f).cast("double") * F.lit(c)
    return df.withColumn(out, total)
