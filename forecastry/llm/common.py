"""Small helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastry.session import checkpoint_root

# ASCII upper case to lower case, nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, under names of its own, so
    that extra columns of the input (whatever they are called) cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One Arrow batch in, one out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)
