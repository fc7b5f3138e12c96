"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names
(a shared, fault-tolerant file system).  Only when it is unset, as in local
tests, do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "forecastry",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and hand-over tables.

    Reads ``spark.checkpoint.dir`` (or an already set checkpoint dir).  Only a
    single-process ``local`` or ``local[...]`` session without one gets a fresh
    temporary folder (tests); with executors of its own (``local-cluster``
    among them) a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder: scratch tables must be visible to every executor"
            )
        conf_dir = tempfile.mkdtemp(prefix="forecastry-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch_path`, on whatever store it is.

    Only inside the checkpoint folder: nothing else is ever deleted.
    """
    if not path.startswith(checkpoint_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not in the scratch folder")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    One computation of ``df``; later passes (model fits, ``randomSplit``'s two
    samples) read stable files, so their rows do not depend on recomputation
    after a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def settled(df, *scratch: str):
    """``df`` checkpointed, and the scratch folders it was read from removed.

    Spark removes the checkpoint itself once the result is no longer in use.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    out = df.checkpoint()
    for path in scratch:
        drop_scratch(spark, path)
    return out
