"""J3's input from a real folder tree: one row per object.

Spark's own file index lists the tree, in parallel tasks where it has many
folders, and without a page limit; the file contents are not read, as only the
index's columns are selected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """(prefix, key, last_modified, n_bytes) of every file below ``root``.

    ``key`` is the path below ``root`` and ``prefix`` its first ``depth`` folders
    ("" for files above that depth).  Hidden files (names beginning with "_" or
    ".") and empty ones are not listed, as everywhere in Spark."""
    if depth < 1:
        raise ValueError("depth counts folders, from 1")
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    key = F.substring("path", len(base) + 1, 1 << 30)
    folders = F.slice(F.split("key", "/"), 1, F.size(F.split("key", "/")) - 1)
    return files.select(key.alias("key"), F.col("modificationTime").alias("last_modified"), F.col("length").alias("n_bytes")).select(
        F.when(F.size(folders) < depth, "").otherwise(F.concat_ws("/", F.slice(folders, 1, depth))).alias("prefix"),
        "key", "last_modified", "n_bytes",
    )
