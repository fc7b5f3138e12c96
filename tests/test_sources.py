import os
import tempfile

import pytest
from pyspark.ml.feature import VectorAssembler

from forecastry.operators import clean
from forecastry.sources import read_raw_sales, write_csv


def test_raw_csv_read_by_header_name_in_any_order(spark):
    d = tempfile.mkdtemp(prefix="fc-raw-")
    p = os.path.join(d, "base_sales.csv")
    with open(p, "w") as f:
        f.write("sales,item,date,store\n13,2,2013-01-01,1\nabc,x,bad,2\n")
    typed = clean.typed_sales(read_raw_sales(spark, p))
    rows = {r["store"]: r for r in typed.collect()}
    assert rows[1]["sales"] == 13.0 and rows[1]["item"] == 2 and str(rows[1]["date"]) == "2013-01-01"
    assert rows[2]["sales"] is None and rows[2]["item"] is None and rows[2]["date"] is None


def test_raw_csv_missing_column_is_clear(spark):
    d = tempfile.mkdtemp(prefix="fc-raw-")
    p = os.path.join(d, "bad.csv")
    with open(p, "w") as f:
        f.write("date,store,sales\n2013-01-01,1,3\n")
    with pytest.raises(ValueError, match="item"):
        read_raw_sales(spark, p)


def test_csv_sink_rejects_vectors(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="v").transform(spark.createDataFrame([(1.0,)], "x double"))
    with pytest.raises(ValueError, match="scalar"):
        write_csv(df, os.path.join(tempfile.mkdtemp(prefix="fc-csv-"), "out"))


def test_raw_files_with_another_column_order_fail_loudly(spark):
    d = tempfile.mkdtemp(prefix="fc-raw-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("date,store,item,sales\n2013-01-01,1,2,3\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("store,date,item,sales\n1,2013-01-02,2,4\n")
    with pytest.raises(Exception):
        read_raw_sales(spark, d).collect()


def test_raw_files_with_the_same_header_read_together(spark):
    d = tempfile.mkdtemp(prefix="fc-raw-")
    for name, day in (("a.csv", "01"), ("b.csv", "02")):
        with open(os.path.join(d, name), "w") as f:
            f.write(f"store,date,item,sales\n1,2013-01-{day},2,4\n")
    typed = clean.typed_sales(read_raw_sales(spark, d))
    assert sorted(str(r["date"]) for r in typed.collect()) == ["2013-01-01", "2013-01-02"]
