import pytest

from forecastry.operators import profile


def ab(spark):
    return spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 5.0), (4.0, 4.0)], "a double, b double")


def test_correlation_null_rules(spark):
    df = ab(spark)
    pairwise = df.agg(profile.corr_column("a", "b")).first()[0]
    as_zero = df.agg(profile.corr_column("a", "b", null_as_zero=True)).first()[0]
    assert round(as_zero, 4) == 0.7593
    assert round(pairwise, 4) == 0.8386


def test_null_as_zero_matches_stat_corr(spark):
    df = ab(spark)
    assert df.agg(profile.corr_column("a", "b", True)).first()[0] == pytest.approx(df.stat.corr("a", "b"), abs=1e-12)


def test_pairwise_matches_functions_corr(spark):
    from pyspark.sql import functions as F
    df = ab(spark)
    assert df.agg(profile.corr_column("a", "b")).first()[0] == pytest.approx(df.agg(F.corr("a", "b")).first()[0], abs=1e-12)


def test_constant_column_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "a double, b double")
    assert df.agg(profile.corr_column("a", "b")).first()[0] is None
    assert df.agg(profile.corr_column("a", "b", True)).first()[0] is None


def test_describe_typed_and_parity(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (6.0,)], "sales float")
    r = profile.describe_typed(df).first()
    assert (r["n_rows"], r["count"], r["min"], r["max"]) == (4, 3, 1.0, 6.0)
    assert r["mean"] == pytest.approx(3.0)
    parity = {row["summary"]: row["sales"] for row in profile.describe(df, ["sales"]).collect()}
    assert parity["count"] == "3" and float(parity["stddev"]) == pytest.approx(r["stddev"])


def test_profile_is_a_single_aggregate(spark):
    df = ab(spark)
    out = profile.profile(df, stats_of=("a", "b"), corr_of=("a", "b"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    r = out.first()
    assert r["n_rows"] == 4 and r["nulls_b"] == 1 and round(r["corr_a_b"], 4) == 0.7593
