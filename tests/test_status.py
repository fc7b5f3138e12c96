import datetime as dt

from forecastry.operators import status
from forecastry.schema import ARTEFACT_SCHEMA, RUN_LOG_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0)


def runs(spark):
    rows = [
        (1, 10, "SUCCEEDED", T0, 5.0),
        (2, 10, "FAILED", T0 + dt.timedelta(hours=1), 7.0),
        (3, 11, "RUNNING", T0, 1.0),
        (4, 11, None, T0, 2.0),          # same start time, higher run id wins
        (5, 12, "STOPPED", None, 3.0),   # untimed run still counts as a run
    ]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def test_latest_run(spark):
    out = {r["job"]: r for r in status.latest_run(runs(spark)).collect()}
    assert out[10]["status"] == "FAILED" and out[10]["run_id"] == 2
    assert out[11]["run_id"] == 4
    assert out[12]["run_id"] == 5


def test_job_status(spark):
    jobs = spark.createDataFrame([(10,), (11,), (12,), (13,)], "job long")
    out = {r["job"]: r for r in status.job_status(jobs, runs(spark)).collect()}
    assert out[10]["status"] == "FAILED"
    assert out[11]["status"] == "N/A"
    assert out[13]["status"] == "No Runs Found" and out[13]["started_on"] is None and out[13]["exec_seconds"] is None
    assert len(out) == 4


def test_latest_artifact_ties_and_nulls(spark):
    rows = [
        ("models", 7, T0 + dt.timedelta(days=1)),
        ("models", 3, T0 + dt.timedelta(days=1)),  # tie: lowest key wins
        ("models", 1, T0),
        ("processed", 9, None),                    # untimed only: still listed
        ("processed", 8, None),
    ]
    out = {r["prefix"]: r for r in status.latest_artifact(spark.createDataFrame(rows, ARTEFACT_SCHEMA)).collect()}
    assert out["models"]["key"] == 3 and out["models"]["last_modified"] == T0 + dt.timedelta(days=1)
    assert out["processed"]["key"] == 8
    assert set(out) == {"models", "processed"}


def test_latest_artifact_with_timestamp_ltz(spark):
    df = spark.createDataFrame([("p", 1, T0), ("p", 2, T0 + dt.timedelta(seconds=1))], "prefix string, key long, last_modified timestamp")
    assert status.latest_artifact(df).first()["key"] == 2


def _partial_limit_before_shuffle(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    # printed top-down: the final limit, the exchange, then the map-side partial limit
    return plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit") and "Partial" in plan


def test_latest_keeps_one_row_per_group_map_side(spark):
    assert _partial_limit_before_shuffle(status.latest_run(runs(spark)))
    listing = spark.createDataFrame([("p", 1, T0)], ARTEFACT_SCHEMA)
    assert _partial_limit_before_shuffle(status.latest_artifact(listing))


def test_top_per_group_k(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "g string, v int")
    from pyspark.sql import functions as F
    out = sorted((r["g"], r["v"]) for r in status.top_per_group(df, ["g"], [F.desc("v")], k=2).collect())
    assert out == [("a", 2), ("a", 3), ("b", 5)]


def test_job_status_with_no_runs_at_all(spark):
    jobs = spark.createDataFrame([(1,), (2,)], "job long")
    empty = spark.createDataFrame([], RUN_LOG_SCHEMA)
    out = status.job_status(jobs, empty).collect()
    assert sorted(r["status"] for r in out) == ["No Runs Found", "No Runs Found"]
    assert status.latest_artifact(spark.createDataFrame([], ARTEFACT_SCHEMA)).count() == 0
