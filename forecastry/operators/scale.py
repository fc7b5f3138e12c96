"""Min-max scaling: M1, M3, M4, M7, F4, A8.

``method="expr"`` (default) is one aggregate for min/max plus a plain
projection: no vector column, no UDF.  ``method="ml"`` is the parity route,
``Pipeline([VectorAssembler, MinMaxScaler])`` then vector -> scalar with
``vector_to_array`` (JVM-side, unlike a Python row UDF).  Both give the
same values, including 0.5 for a constant column (X9).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastry.functions.vectors import first_element
from forecastry.operators.clean import column_statistics, impute_mean_inline
from forecastry.operators.profile import min_max
from forecastry.schema import SCALED_COLUMN


def scale_expr(
    df: DataFrame,
    column: str = "sales",
    out: str = SCALED_COLUMN,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """``bounds`` = (min, max) when a profile pass already produced them."""
    lo, hi = bounds if bounds is not None else min_max(df, column)
    if lo is None:
        raise ValueError(f"cannot scale {column!r}: it has no non-null values")
    lo, hi = float(lo), float(hi)
    x = F.col(column).cast("double")
    if hi == lo:
        scaled = F.when(x.isNotNull(), F.lit(0.5))
    else:
        scaled = (x - F.lit(lo)) / F.lit(hi - lo)
    return df.withColumn(out, scaled.cast("float"))


def scale_ml(df: DataFrame, column: str = "sales", out: str = SCALED_COLUMN) -> DataFrame:
    vec, scaled = f"{column}_vector", f"{column}_scaled"
    stages = [
        VectorAssembler(inputCols=[column], outputCol=vec),  # M1
        MinMaxScaler(inputCol=vec, outputCol=scaled),  # M3
    ]
    model = Pipeline(stages=stages).fit(df)  # M4
    return (
        model.transform(df)
        .withColumn(out, first_element(scaled, "float"))  # F4
        .drop(vec, scaled)  # M7 / P4
    )


def minmax_scale(df: DataFrame, column: str = "sales", out: str = SCALED_COLUMN, method: str = "expr") -> DataFrame:
    if method == "expr":
        return scale_expr(df, column, out)
    if method == "ml":
        return scale_ml(df, column, out)
    raise ValueError(f"unknown scaling method {method!r}")


def impute_then_scale(df: DataFrame, column: str = "sales", out: str = SCALED_COLUMN) -> DataFrame:
    """N2 + M3 with ONE statistics pass, inside the plan.

    Mean, min, max and the missing count are one scalar subquery; the bounds of
    the imputed column follow from them (the fill value joins the range only
    when something was filled), so no second pass over the data is needed.
    """
    st, dtype = column_statistics(df, column), df.schema[column].dataType
    fill, lo, hi = st["mean"].cast(dtype).cast("double"), st["lo"].cast("double"), st["hi"].cast("double")
    lo = F.when(st["missing"] > 0, F.least(lo, fill)).otherwise(lo)
    hi = F.when(st["missing"] > 0, F.greatest(hi, fill)).otherwise(hi)
    imputed = impute_mean_inline(df, column)
    x = F.col(column).cast("double")
    return imputed.withColumn(out, F.when(hi == lo, 0.5).otherwise(F.try_divide(x - lo, hi - lo)).cast("float"))


def imputed_bounds(lo, hi, mean: float, missing: int, dtype) -> tuple[float, float]:
    """Min/max of a column after mean imputation, from its pre-imputation
    min/max: the fill value (the mean, in the column's type) joins the range
    only when something was filled."""
    filled = float(np.float32(mean)) if isinstance(dtype, T.FloatType) else mean
    lo, hi = float(lo), float(hi)
    if missing:
        lo, hi = min(lo, filled), max(hi, filled)
    return lo, hi
