"""Exploratory summaries: A4-A6, O1-O5, F5, C1.

Each summary is one hash aggregate (partial on the map side, so the shuffle
carries one row per group per task, whatever the skew).  For a job that needs
all three, :func:`sales_cube` computes them as grouping sets of one pass and
:func:`summaries_from_cube` picks each summary's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecastry.functions.calendar import month_start
from forecastry.schema import TOP_ITEMS


def with_year_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


def monthly_sales(df: DataFrame) -> DataFrame:
    """A4 + O1: total sales per (year, month), in calendar order."""
    return (
        with_year_month(df)
        .groupBy("year", "month")
        .agg(F.sum("sales").alias("total_sales"))
        .orderBy("year", "month")
    )


def store_avg(df: DataFrame) -> DataFrame:
    """A5 + O2/O4: average sales per store, highest first (store breaks ties)."""
    return (
        df.groupBy("store")
        .agg(F.avg("sales").alias("avg_sales"))
        .orderBy(F.desc("avg_sales"), "store")
    )


def item_sales(df: DataFrame) -> DataFrame:
    """A6 + O2: total sales per item, highest first (item breaks ties)."""
    return (
        df.groupBy("item")
        .agg(F.sum("sales").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "item")
    )


def top_items(df: DataFrame, k: int = TOP_ITEMS) -> DataFrame:
    """O3 + F5: the k best-selling items, item id as a text label.

    Sort and limit stay adjacent so Spark plans ``TakeOrderedAndProject``
    (a per-task top-k, then a k-row merge) instead of a full sort.
    """
    return item_sales(df).limit(k).select(F.col("item").cast("string").alias("item"), "total_sales")


def monthly_series(df: DataFrame) -> DataFrame:
    """Monthly totals on a real time axis (first day of each month)."""
    return monthly_sales(df).withColumn("month_start", month_start()).orderBy("month_start")


def monthly_spine(df: DataFrame, key: str | None = None) -> DataFrame:
    """C1 with no gaps: every month from the first to the last with a date (of
    each ``key``, if given), total 0 where nothing was sold.

    The totals are sorted in ranges of ``key``; each month gives itself and the
    empty months up to the next one, in order.  So no task sorts or holds more
    than totals, whatever the gaps.  Undated rows take no part; a month with rows
    but no sales known is 0, too."""
    by = [key] if key else []
    dated = df.where(F.col("date").isNotNull()).withColumn("_month", F.trunc("date", "month"))
    totals = dated.groupBy(*by, "_month").agg((F.coalesce(F.sum("sales"), F.lit(0)) + F.lit(0.0)).alias("_total"))
    if by:
        totals = totals.repartitionByRange(key).sortWithinPartitions(key, "_month")
    following = F.lead("_month").over(Window.partitionBy(*by).orderBy("_month"))
    until = F.coalesce(F.add_months(following, -1), F.col("_month"))
    spine = totals.withColumn("_until", until).select(
        *by, "_month", "_total", F.explode(F.sequence("_month", "_until", F.expr("interval 1 month"))).alias("month_start")
    )
    return spine.select(
        *by, F.year("month_start").alias("year"), F.month("month_start").alias("month"), "month_start",
        F.when(F.col("month_start") == F.col("_month"), F.col("_total")).otherwise(F.lit(0.0)).alias("total_sales"),
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows for inspection, by date, store and item."""
    return df.orderBy("date", "store", "item").limit(n)


# grouping ids of the three sets
MONTHS, STORES, ITEMS = 0b0011, 0b1101, 0b1110


def sales_cube(df: DataFrame) -> DataFrame:
    """One pass over the sales for all summaries: grouping sets by month, store
    and item.  The shuffle carries one row per group and task, and the result
    one row per month, store and item."""
    sets = [["year", "month"], ["store"], ["item"]]
    return with_year_month(df).groupingSets(sets, "year", "month", "store", "item").agg(
        F.grouping_id().alias("part"), F.sum("sales").alias("total_sales"), F.avg("sales").alias("avg_sales")
    )


def summaries_from_cube(cube: DataFrame) -> dict[str, DataFrame]:
    """A4, A5, A6 from :func:`sales_cube`: same values as the direct forms."""
    return {
        "monthly_sales": cube.where(F.col("part") == MONTHS).select("year", "month", "total_sales").orderBy("year", "month"),
        "store_avg": cube.where(F.col("part") == STORES).select("store", "avg_sales").orderBy(F.desc("avg_sales"), "store"),
        "item_sales": cube.where(F.col("part") == ITEMS).select("item", "total_sales").orderBy(F.desc("total_sales"), "item"),
    }
