"""Column-level helpers (JVM-side expressions only; no Python UDFs)."""

from forecastry.functions.calendar import calendar_columns, day_of_week, month_start
from forecastry.functions.casts import nan_to_null, typed_column
from forecastry.functions.vectors import first_element, vector_to_list

__all__ = [
    "calendar_columns",
    "day_of_week",
    "month_start",
    "nan_to_null",
    "typed_column",
    "first_element",
    "vector_to_list",
]
