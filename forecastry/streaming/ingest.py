"""File-stream ingest: raw CSV directory -> typed Parquet directory.

Exactly-once through the file sink's metadata log and the checkpoint folder;
``trigger(availableNow=True)`` processes whatever has landed, in bounded
micro-batches (``maxFilesPerTrigger``), then stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from forecastry.operators.clean import drop_missing, typed_sales
from forecastry.schema import RAW_COLUMNS, require_columns


def raw_schema_from_header(spark: SparkSession, raw_dir: str) -> T.StructType:
    """All-text schema in the files' own header order (S1: match by name).

    The stream then reads with ``enforceSchema=false``, so a later file whose
    header differs fails loudly instead of being mapped by position.
    """
    names = spark.read.option("header", "true").csv(raw_dir).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def typed_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int = 100,
                 drop_nulls: bool = False) -> DataFrame:
    schema = raw_schema_from_header(spark, raw_dir)
    stream = (
        spark.readStream.option("header", "true")
        .option("enforceSchema", "false")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .schema(schema)
        .csv(raw_dir)
    )
    require_columns(stream, RAW_COLUMNS, what=f"raw sales stream at {raw_dir}")
    typed = typed_sales(stream)
    return drop_missing(typed) if drop_nulls else typed


def ingest_stream(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    checkpoint_dir: str,
    drop_nulls: bool = False,
    max_files_per_trigger: int = 100,
):
    """Run the incremental ingest until the landed files are processed."""
    query = (
        typed_stream(spark, raw_dir, max_files_per_trigger, drop_nulls)
        .writeStream.format("parquet")
        .option("path", processed_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
