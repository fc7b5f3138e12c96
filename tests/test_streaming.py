import os
import tempfile

import pytest

from forecastry.streaming import ingest_stream


def _write(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_incremental_ingest_is_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="fc-stream-")
    raw, out, ck = (os.path.join(root, d) for d in ("raw", "processed", "ck"))
    os.makedirs(raw)
    _write(os.path.join(raw, "a.csv"), "store,item,date,sales", [("1", "1", "2013-01-01", "3"), ("1", "1", "2013-01-02", "abc")])
    ingest_stream(spark, raw, out, ck)
    first = spark.read.parquet(out)
    assert first.count() == 2
    assert dict(first.dtypes) == {"store": "int", "item": "int", "date": "date", "sales": "float"}
    assert first.filter("sales IS NULL").count() == 1
    _write(os.path.join(raw, "b.csv"), "store,item,date,sales", [("2", "5", "2013-01-03", "NaN")])
    ingest_stream(spark, raw, out, ck)
    again = spark.read.parquet(out)
    assert again.count() == 3  # the first file is not ingested twice
    assert again.filter("store = 2").first()["sales"] is None


def test_stream_drop_nulls(spark):
    root = tempfile.mkdtemp(prefix="fc-stream-")
    raw, out, ck = (os.path.join(root, d) for d in ("raw", "processed", "ck"))
    os.makedirs(raw)
    _write(os.path.join(raw, "a.csv"), "sales,date,store,item", [("3", "2013-01-01", "1", "1"), ("", "2013-01-02", "1", "1")])
    ingest_stream(spark, raw, out, ck, drop_nulls=True)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0]["sales"] == 3.0 and rows[0]["store"] == 1


def test_stream_header_mismatch_fails(spark):
    root = tempfile.mkdtemp(prefix="fc-stream-")
    raw, out, ck = (os.path.join(root, d) for d in ("raw", "processed", "ck"))
    os.makedirs(raw)
    _write(os.path.join(raw, "a.csv"), "store,item,date,sales", [("1", "1", "2013-01-01", "3")])
    ingest_stream(spark, raw, out, ck)
    _write(os.path.join(raw, "b.csv"), "item,store,date,sales", [("9", "1", "2013-01-05", "3")])
    with pytest.raises(Exception):
        ingest_stream(spark, raw, out, ck)


def test_stream_from_command_line(spark):
    from forecastry.__main__ import main
    root = tempfile.mkdtemp(prefix="fc-stream-")
    raw, out, ck = (os.path.join(root, d) for d in ("raw", "processed", "ck"))
    os.makedirs(raw)
    _write(os.path.join(raw, "a.csv"), "store,item,date,sales", [("1", "1", "2013-01-01", "3")])
    main(["ingest-stream", "--raw", raw, "--processed", out, "--checkpoint", ck], spark=spark)
    assert spark.read.parquet(out).count() == 1
