"""Typing and missing-value operators: P1, P4, P6, N1-N4 (rules X1-X3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastry.functions.casts import nan_to_null, typed_column
from forecastry.schema import HISTORY_COLUMNS, TYPED_TYPES, require_columns


def typed_sales(raw: DataFrame, types: dict[str, str] = TYPED_TYPES) -> DataFrame:
    """Cast text columns in one ``select``.

    Unparsable text becomes null (X1) and NaN becomes null (X2); columns not
    named in ``types`` pass through unchanged, in their original order.
    """
    require_columns(raw, list(types), what="sales")
    return raw.select(*[typed_column(c, types[c]) if c in types else F.col(c) for c in raw.columns])


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column (or in ``subset``).

    On floating columns Spark also drops NaN here (X2).
    """
    return df.dropna(how="any", subset=subset)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count of every column in ONE aggregate pass (one row out).

    The reference ran one filtered count job per column.
    """
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def column_mean(df: DataFrame, column: str = "sales") -> float:
    """A1: global mean of ``column`` (NaN counted as missing).

    A single scalar comes back to the driver, like ``Imputer`` does.  All-null
    input raises (X3) instead of a NullPointerException deep in ``fillna``.
    """
    row = df.agg(F.avg(nan_to_null(F.col(column))).alias("m")).first()
    mean = None if row is None else row["m"]
    if mean is None:
        raise ValueError(f"cannot impute {column!r}: it has no non-null values")
    return float(mean)


def column_statistics(df: DataFrame, column: str = "sales") -> Column:
    """mean, lo, hi and missing (NaN counted as missing) of ``column``, as one
    scalar-subquery struct; evaluating it on an all-null column raises (X3)."""
    c = nan_to_null(F.col(column)) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else F.col(column)
    mean = F.coalesce(F.avg(c), F.raise_error(F.lit(f"cannot impute {column!r}: it has no non-null values")).cast("double"))
    return df.agg(
        F.struct(mean.alias("mean"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                 F.count_if(c.isNull()).alias("missing")).alias("s")
    ).scalar()


def impute_mean(df: DataFrame, column: str = "sales", mean: float | None = None) -> DataFrame:
    """Fill null/NaN in ``column`` with its global mean, cast back to the column type."""
    if mean is None:
        mean = column_mean(df, column)
    return _filled(df, column, F.lit(mean))


def impute_mean_inline(df: DataFrame, column: str = "sales") -> DataFrame:
    """N2 with the mean as a scalar subquery of the same plan: nothing is
    collected or written before the result is, and the input's exchange is
    reused.  All-null input raises (X3) when the result is computed."""
    return _filled(df, column, column_statistics(df, column)["mean"])


def _filled(df: DataFrame, column: str, fill: Column) -> DataFrame:
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = nan_to_null(c)
    return df.withColumn(column, F.coalesce(c, fill.cast(dtype)))


def fill_zero(df: DataFrame, columns=HISTORY_COLUMNS) -> DataFrame:
    """Null (and NaN) history features become 0."""
    return df.na.fill(0, subset=list(columns))
