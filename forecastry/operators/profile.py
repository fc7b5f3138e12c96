"""Profiling: A2, A3, A7, A8 (+ N4) with the correlation null rule X4.

Everything a job prints about its input comes out of ONE aggregate pass
(:func:`profile`), instead of one Spark job per statistic.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CORR_COLUMNS = ("store", "item", "sales")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """A3 parity: ``DataFrame.describe`` (string-valued summary table)."""
    return df.describe(columns)


def stats_columns(column: str, prefix: str = "") -> list[Column]:
    """A3 typed: count, mean, stddev (sample), min, max of one column."""
    c = F.col(column)
    return [
        F.count(c).alias(f"{prefix}count"),
        F.avg(c).alias(f"{prefix}mean"),
        F.stddev_samp(c).alias(f"{prefix}stddev"),
        F.min(c).alias(f"{prefix}min"),
        F.max(c).alias(f"{prefix}max"),
    ]


def describe_typed(df: DataFrame, column: str = "sales") -> DataFrame:
    """A2 + A3: one row with ``n_rows`` and the typed stats of ``column``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *stats_columns(column))


def corr_column(a: str, b: str, null_as_zero: bool = False) -> Column:
    """Pearson correlation of two columns as an aggregate expression.

    ``null_as_zero=False`` skips pairs with a null (``functions.corr`` rule);
    ``True`` counts null as 0 (the ``DataFrame.stat.corr`` rule, X4).  A
    constant column gives null instead of ANSI DIVIDE_BY_ZERO.
    """
    x, y = F.col(a).try_cast("double"), F.col(b).try_cast("double")
    if null_as_zero:
        x, y = F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))
    else:
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(
    df: DataFrame,
    columns=DEFAULT_CORR_COLUMNS,
    null_as_zero: bool = False,
) -> DataFrame:
    """Every pairwise correlation of ``columns`` in one pass, one row out.

    Output columns are named ``corr_<a>_<b>``.
    """
    return df.agg(
        *[corr_column(a, b, null_as_zero).alias(f"corr_{a}_{b}") for a, b in combinations(columns, 2)]
    )


def min_max(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    """Min and max of a column; one scalar pair to the driver."""
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def profile_columns(
    df: DataFrame,
    stats_of=("sales", "store", "item"),
    corr_of=DEFAULT_CORR_COLUMNS,
    null_as_zero: bool = True,
) -> list[Column]:
    """The aggregate expressions of :func:`profile`: row count, null count per
    column, typed stats and correlations.  Usable with ``agg`` or ``observe``."""
    exprs = [F.count(F.lit(1)).alias("n_rows")]
    exprs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    for c in stats_of:
        exprs += stats_columns(c, prefix=f"{c}_")
    exprs += [
        corr_column(a, b, null_as_zero).alias(f"corr_{a}_{b}") for a, b in combinations(corr_of, 2)
    ]
    return exprs


def profile(
    df: DataFrame,
    stats_of=("sales", "store", "item"),
    corr_of=DEFAULT_CORR_COLUMNS,
    null_as_zero: bool = True,
) -> DataFrame:
    """One-pass profile: row count, null count per column, typed stats and
    correlations, all in a single aggregate (partial + final on Catalyst)."""
    return df.agg(*profile_columns(df, stats_of, corr_of, null_as_zero))
