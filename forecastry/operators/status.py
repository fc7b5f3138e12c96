"""Run and artefact status: J1-J3 (re-aimed from a single-process report).

"Latest per group" is ``row_number() = 1`` over the group's ordering.  Spark
plans it as a ``WindowGroupLimit`` that runs *partially on the map side*
before the shuffle (then finally after it), so a job or prefix that owns a
third of all rows leaves each map task as a single row: no task ever ships
or buffers a whole hot group.  The ordering is a plain sort specification,
so mixed directions (newest time, lowest key) need no value tricks and are
independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastry.schema import NO_RUNS, NOT_AVAILABLE


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each group under ``order`` (ties broken by it)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def latest_run(runs: DataFrame, job="job", ts="started_on", tie="run_id") -> DataFrame:
    """Each job's latest run: newest ``started_on``, then highest ``run_id``.

    Runs with a null start time lose to any timed run.
    """
    return top_per_group(runs, [job], [F.desc_nulls_last(ts), F.desc_nulls_last(tie)])


def job_status(jobs: DataFrame, runs: DataFrame, job="job") -> DataFrame:
    """Every job, with its latest run or ``"No Runs Found"``.

    A run without a status reads ``"N/A"``; start time and run time stay
    typed (null when there is no run).  The latest-run side has one row per
    job and is hash-partitioned on ``job`` already, so the left join shuffles
    only ``jobs`` (or broadcasts the small side when Spark's size check allows).
    """
    latest = latest_run(runs, job=job).select(job, "status", "started_on", "exec_seconds", F.lit(True).alias("_has_run"))
    status = (
        F.when(F.col("_has_run").isNull(), F.lit(NO_RUNS))
        .otherwise(F.coalesce(F.col("status"), F.lit(NOT_AVAILABLE)))
        .alias("status")
    )
    joined = jobs.select(job).join(latest, job, "left")
    return joined.select(job, status, "started_on", "exec_seconds")


def latest_artifact(listing: DataFrame, prefix="prefix", key="key", ts="last_modified") -> DataFrame:
    """Newest object per prefix; on equal times the lowest key wins.

    Objects without a time lose to any timed one; prefixes with no object are
    simply absent.
    """
    out = top_per_group(listing, [prefix], [F.desc_nulls_last(ts), F.asc_nulls_last(key)])
    return out.select(prefix, key, ts)
