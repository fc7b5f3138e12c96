"""Adapter from the supplied test tables to the sales data model.

The supplied tables stand in for the pipeline's inputs:

* ``lineitem`` -> daily sales (store, item, date, sales): the panel, keyed by
  supplier and part, has many short series; the history, keyed by supplier and
  line number, has long ones (for windows and models)
* ``events``   -> job run log; ``customer`` -> job list
* ``orders``   -> artefact listing (prefix, key, last_modified)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: fixture derivation (our own test mapping) ----
HOLE_WEIGHTS = (7, 3, 1)  # store, item, day of month
HOLE_MODULUS = 11
# ---- end of fixed values ----


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def panel_from_lineitem(lineitem: DataFrame, item: str = "l_partkey") -> DataFrame:
    """Daily panel with a unique (store, item, date) key and whole-number sales.

    One hash aggregate; Catalyst runs it partial-then-final, so even a key that
    holds a large share of lineitem is combined map-side before the shuffle.
    Stores are the full supplier keys and items the full part keys or the line
    numbers, so the panel and all work after it grow with lineitem.
    """
    keyed = lineitem.select(
        F.col("l_suppkey").cast("int").alias("store"),
        F.col(item).cast("int").alias("item"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity"),
    )
    return keyed.groupBy("store", "item", "date").agg(
        F.sum("l_quantity").cast("float").alias("sales")
    )


def punch_holes(panel: DataFrame) -> DataFrame:
    """Blank ``sales`` on a fixed rule so the missing-value paths have work."""
    ws, wi, wd = HOLE_WEIGHTS
    blank = (F.col("store") * ws + F.col("item") * wi + F.dayofmonth("date") * wd) % HOLE_MODULUS == 0
    return panel.withColumn("sales", F.when(blank, F.lit(None).cast("float")).otherwise(F.col("sales")))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_from_lineitem(load_table(spark, sf_dir, "lineitem"))


def holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return punch_holes(panel(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of about 84 rows each, more of them with more lineitem rows."""
    return panel_from_lineitem(load_table(spark, sf_dir, "lineitem"), item="l_linenumber")


def history_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return punch_holes(history(spark, sf_dir))


def hot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history with about a third of its rows moved to one series, which
    then repeats dates, and sales on a date."""
    rows = history(spark, sf_dir)
    hot = (F.col("store") + F.col("item") + F.dayofmonth("date")) % 3 == 0
    return rows.withColumns({c: F.when(hot, 1).otherwise(F.col(c)) for c in ("store", "item")})


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem row: keys repeat."""
    return load_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("store"), F.col("l_linenumber").cast("int").alias("item"),
        F.to_date("l_shipdate").alias("date"), F.col("l_quantity").cast("float").alias("sales"),
    )


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holed panel as text, with bad, NaN and empty sales on a fixed rule."""
    k = (F.col("store") * 5 + F.col("item")) % 17
    text = F.when(k == 0, "abc").when(k == 1, "NaN").when(k == 2, "").otherwise(F.col("sales").cast("string"))
    rows = holes(spark, sf_dir)
    return rows.select(F.col("date").cast("string").alias("date"), F.col("store").cast("string").alias("store"),
                       F.col("item").cast("string").alias("item"), text.alias("sales"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the run log: user_id = job, event_type = status."""
    return load_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("job"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("started_on"),
        F.col("value").alias("exec_seconds"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job"))


def artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an object listing: priority = prefix, order key = object key."""
    return load_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("prefix"),
        F.col("o_orderkey").alias("key"),
        F.col("o_orderdate").alias("last_modified"),
    )
