"""Every registered query with an oracle agrees with DuckDB on sf0.001, and on
sf0.01 (the tuned forest, which takes a minute there, on sf0.001 only)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from forecastry.plans.oracles import ORACLES as BASE_ORACLES
from forecastry.plans.queries import QUERIES
from conftest import SMOKE

ORACLES = BASE_ORACLES
TABLES = ["customer", "orders", "lineitem", "events"]


LARGER = "/root/testdata/sf0.01"


def connected(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(folder, t + '.parquet')}')")
    return c


@pytest.fixture(scope="module")
def con():
    return connected(SMOKE)


@pytest.fixture(scope="module")
def con_larger():
    return connected(LARGER)


def _norm(v):
    if v is None or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "hour"):
        return v.date().isoformat() if (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0) else v.isoformat(sep=" ")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SMOKE).toPandas())
    want = _rows(con.execute(ORACLES[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"tuned_forest_check"}))
def test_query_matches_oracle_on_larger_tables(spark, con_larger, name):
    got = _rows(E.queries()[name](spark, LARGER).toPandas())
    assert got == _rows(con_larger.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert E.queries()[name](spark, SMOKE).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rolling_avg_7" in df.columns


SESSION_SENSITIVE = ["typed_from_csv", "demand_features", "monthly_series", "hash_split_train",
                     "latest_run", "job_status", "latest_artifact", "sales_profile"]


@pytest.mark.parametrize("name", SESSION_SENSITIVE)
def test_results_do_not_depend_on_session_settings(spark, con, name):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "200")
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    got = _rows(E.queries()[name](other, SMOKE).toPandas())
    assert got == _rows(con.execute(ORACLES[name]).df())
