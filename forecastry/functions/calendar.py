"""Calendar functions F1-F3 and the chart time axis of C1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(date_col: str | Column) -> Column:
    """day of week with 1 = Sunday ... 7 = Saturday (Spark's ``dayofweek``)."""
    return F.dayofweek(date_col)


def calendar_columns(date_col: str = "date", dow_name: str = "day_of_week") -> dict[str, Column]:
    """F1-F3 as a ``withColumns`` mapping.

    The exploratory job names the weekday column ``dayofweek``, the feature
    job ``day_of_week``; pass ``dow_name`` to pick.
    """
    return {
        "year": F.year(date_col),
        "month": F.month(date_col),
        dow_name: day_of_week(date_col),
    }


def month_start(year_col: str | Column = "year", month_col: str | Column = "month") -> Column:
    """First day of the month, so monthly totals sit on a real time axis."""
    return F.make_date(F.col(year_col), F.col(month_col), F.lit(1))
