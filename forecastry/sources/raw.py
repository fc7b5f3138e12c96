"""The raw sales CSV.

Header row, every column text, no schema inference.  Columns are matched by
header *name*: passing a schema would make Spark map by position, and the raw
column order is not known.  ``enforceSchema=false`` makes Spark check every
file's header against the names it took from the first file, so a file with
another column order fails loudly instead of being mapped by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecastry.schema import RAW_COLUMNS, require_columns


def read_raw_sales(spark: SparkSession, path: str, required=RAW_COLUMNS) -> DataFrame:
    df = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    require_columns(df, required, what=f"raw sales at {path}")
    return df
