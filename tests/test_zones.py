"""Zones are replaced whole or not at all; listing a real folder tree; one parse."""

import os
import subprocess
import sys
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from forecastry.operators import status
from forecastry.plans import jobs
from forecastry.sources import list_objects, read_parquet, write_csv, write_parquet, zones
from test_jobs import zones as raw_zones  # noqa: F401


def fresh(name="zone"):
    return os.path.join(tempfile.mkdtemp(prefix="fc-zone-"), name)


def beside(path):
    return sorted(os.listdir(os.path.dirname(path)))


def test_a_failing_write_leaves_the_old_zone(spark):
    path = fresh()
    write_parquet(spark.range(5), path)
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    for write in (write_parquet, write_csv):
        with pytest.raises(Exception, match="broken"):
            write(bad, path)
        assert read_parquet(spark, path).count() == 5 and beside(path) == ["zone"]


KILLED = """
import sys, time
from pyspark.sql.functions import udf
from forecastry.session import get_session
from forecastry.sources import write_parquet
spark = get_session(master="local[1]")
mark = sys.argv[2]
def die(i):
    if i == 900:
        open(mark, "w").close()
        time.sleep(60)
    return i
write_parquet(spark.range(1000).repartition(4).select(udf(die, "long")("id").alias("id")), sys.argv[1])
"""


def test_a_killed_job_leaves_the_old_zone(spark):
    path, mark = fresh(), fresh("mark")
    write_parquet(spark.range(5), path)
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    job = subprocess.Popen([sys.executable, "-c", KILLED, path, mark], env=env, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        for _ in range(600):
            if os.path.exists(mark) or job.poll() is not None:
                break
            time.sleep(0.1)
        assert os.path.exists(mark)  # it is in the middle of the write
    finally:
        job.kill()
        job.wait()
    assert sorted(r[0] for r in read_parquet(spark, path).collect()) == [0, 1, 2, 3, 4]
    write_parquet(spark.range(7), path)
    assert read_parquet(spark, path).count() == 7


def test_a_crash_between_the_renames_is_recovered(spark):
    path = fresh()
    write_parquet(spark.range(5), path)
    os.rename(path, zones._beside(path, "previous"))  # as if the job had died there
    assert read_parquet(spark, path).count() == 5
    write_parquet(spark.range(6), path)
    assert read_parquet(spark, path).count() == 6 and beside(path) == ["zone"]


def test_a_job_may_replace_the_zone_it_reads(spark):
    path = fresh()
    write_parquet(spark.range(5).withColumn("part", F.lit(1)), path)
    more = spark.range(5, 8).withColumn("part", F.lit(2))
    write_parquet(read_parquet(spark, path).union(more), path, partition_by=["part"])
    assert sorted(map(tuple, read_parquet(spark, path).collect())) == [(k, 1 + (k > 4)) for k in range(8)]


def test_listing_equals_a_walk(spark):
    root = tempfile.mkdtemp(prefix="fc-list-")
    names = ["a/x.bin", "a/deep/er/y.txt", "b c/\u00e4 1.csv", "b c/z%20q.csv", "top.txt", "a/_hidden", "d/empty"]
    for k, name in enumerate(names):
        p = os.path.join(root, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("x" * (k + 1))
        os.utime(p, (1_600_000_000 + 1000 * (k * 7 % 5), 1_600_000_000 + 1000 * (k * 7 % 5)))
    want = {}
    for d, _, files in os.walk(root):
        for f in files:
            p = os.path.join(d, f)
            if not f.startswith(("_", ".")):
                key = os.path.relpath(p, root)
                want[key] = (key.split("/")[0] if "/" in key else "", os.path.getsize(p), int(os.path.getmtime(p)))
    rows = list_objects(spark, root)
    got = {r["key"]: (r["prefix"], r["n_bytes"], int(r["at"])) for r in rows.withColumn("at", F.unix_timestamp("last_modified")).collect()}
    assert got == want
    newest = {r["prefix"]: r["key"] for r in status.latest_artifact(rows.select("prefix", "key", "last_modified")).collect()}
    for prefix in {p for p, _, _ in want.values()}:
        assert newest[prefix] == min((k for k in want if want[k][0] == prefix), key=lambda k: (-want[k][2], k))
    deep = {r["key"]: r["prefix"] for r in list_objects(spark, root, depth=2).collect()}
    assert deep["a/deep/er/y.txt"] == "a/deep" and deep["a/x.bin"] == ""
    assert "content" not in rows._jdf.queryExecution().executedPlan().toString()


def test_ingest_parses_the_text_once(spark, raw_zones, monkeypatch):  # noqa: F811
    import shutil
    raw = fresh("raw")
    shutil.copytree(raw_zones["raw"], raw)
    once, away, scan = jobs.scale.scale_expr, raw + "-away", []

    def without_the_text(df, *args, **options):
        os.rename(raw, away)  # whatever reads the text from here on fails
        scan.append(df)
        return once(df, *args, **options)

    monkeypatch.setattr(jobs.scale, "scale_expr", without_the_text)
    out = fresh("processed")
    stats = jobs.ingest(spark, raw, out)
    assert len(scan) == 1 and stats["n_rows"] == raw_zones["n"] == spark.read.parquet(out).count()


def test_ingest_of_all_null_sales_leaves_nothing_behind(spark):
    from forecastry.session import checkpoint_root
    raw, out = fresh("raw"), fresh("processed")
    spark.createDataFrame([("2020-01-01", "1", "1", "abc")], "date string, store string, item string, sales string").write.option("header", "true").csv(raw)
    with pytest.raises(ValueError, match="no non-null"):
        jobs.ingest(spark, raw, out)
    where = checkpoint_root(spark).replace("file:", "")
    assert not os.path.exists(out) and not [f for f in os.listdir(where) if f.startswith("typed-")]
