"""Least squares from one aggregate, on any rank."""

from decimal import Context, Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecastry.operators import clean, features, linear, model
from forecastry.plans import queries
from forecastry.schema import FEATURE_COLUMNS
from forecastry.session import materialize
from forecastry.sources import tables
from conftest import SMOKE, plan_text


@pytest.fixture(scope="module")
def feats(spark):
    return materialize(features.demand_features(clean.impute_mean(tables.history_holes(spark, SMOKE))), "t-linear")


def test_coefficients_equal_spark_ml(feats):
    fitted = linear.fit(feats)
    ml = model.fit_linear(model.assemble(feats))
    assert fitted.dropped == [] and fitted.n == feats.count()
    assert np.allclose(list(fitted.coefficients.values()), ml.coefficients.toArray(), rtol=1e-7, atol=1e-9)
    assert fitted.intercept == pytest.approx(ml.intercept, rel=1e-7)
    off = linear.predict(feats, fitted).join(
        ml.transform(model.assemble(feats, keep_keys=True)).select("store", "item", "date", F.col("prediction").alias("ml")),
        ["store", "item", "date"]).agg(F.max(F.abs(F.col("prediction") - F.col("ml")))).first()[0]
    assert off < 1e-6


def test_gram_is_45_and_9_sums_whatever_the_layout(feats):
    a, b = (sorted(linear.gram(df).collect()) for df in (feats, feats.repartition(7, "date")))
    assert a == b and len(a) == 54
    x = feats.select(*FEATURE_COLUMNS, "sales").toPandas().astype(float)
    total = {(r["a"], r["b"]): float(r["total"]) for r in a}
    assert total["intercept", "intercept"] == len(x)
    assert total["store", "lag_7"] == pytest.approx((x["store"] * x["lag_7"]).sum(), rel=1e-12)
    assert total["rolling_avg_7", "label"] == pytest.approx((x["rolling_avg_7"] * x["sales"]).sum(), rel=1e-12)


def test_constant_and_dependent_columns_are_named(feats):
    df = feats.withColumns({"third": F.lit(1 / 3), "zero": F.lit(0), "twice": 2 * F.col("lag_1") - F.col("item") + 5})
    names = [*FEATURE_COLUMNS, "third", "zero", "twice"]
    fitted, plain = linear.fit(df, names), linear.fit(feats)
    assert {"third", "zero"} < set(fitted.dropped) and len(fitted.dropped) == 3
    assert set(fitted.dropped) - {"third", "zero"} <= {"twice", "lag_1", "item"}
    p, q = (linear.predict(df, f).agg(F.sum("prediction"), F.sum(F.col("prediction") ** 2)).first() for f in (fitted, plain))
    assert tuple(p) == pytest.approx(tuple(q), rel=1e-9)


def test_all_columns_constant_gives_the_mean(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, 100.0), (1.0, None), (float("nan"), 7.0)], "a double, sales double")
    fitted = linear.fit(df, ["a"])
    assert fitted == linear.LeastSquares({"a": 0.0}, 3.0, ["a"], 2)
    with pytest.raises(ValueError, match="no row"):
        linear.fit(df.limit(0), ["a"])


def test_far_from_zero_is_no_problem(spark):
    df = spark.range(1000).select((F.lit(1_700_000_000.0) + F.col("id") * 3600).alias("t"), (F.col("id") * 2 + 5).cast("double").alias("sales"))
    fitted = linear.fit(df, ["t"])
    assert fitted.dropped == [] and fitted.coefficients["t"] == pytest.approx(2 / 3600, rel=1e-9)
    assert linear.predict(df, fitted).agg(F.max(F.abs(F.col("prediction") - F.col("sales")))).first()[0] < 1e-5


def test_pivoted_cholesky_stops_at_the_rank():
    r = np.random.RandomState(1)
    x = r.normal(size=(50, 3)) @ r.normal(size=(3, 6))
    assert len(linear.pivoted_cholesky(np.corrcoef(x.T))) == 3
    assert linear.pivoted_cholesky(np.eye(4)) == [0, 1, 2, 3]


def test_sums_are_exact_for_large_and_small_products(spark):
    """Far more digits than a double has, both signs; infinite products give nothing."""
    rows = [(3.0e9, 7.0), (-2.5e9, 0.001), (0.1, -0.3), (123456.789, 1e-6), (float("inf"), 2.0), (0.0, 0.0)] * 2000
    df = spark.createDataFrame(rows, "a double, sales double")
    got = {(r["a"], r["b"]): r["total"] for r in linear.gram(df.repartition(5), ["a"]).collect()}
    assert got == {(r["a"], r["b"]): r["total"] for r in linear.gram(df, ["a"]).collect()}

    def product(x, y):
        p = x * y
        return Decimal(p).quantize(Decimal("1e-12"), context=Context(prec=60)) if np.isfinite(p) else 0

    with localcontext(prec=60):
        assert got["a", "a"] == sum(product(x, x) for x, _ in rows)
        assert got["a", "label"] == sum(product(x, y) for x, y in rows)
    with pytest.raises(Exception, match="1e\\+24|1e24"):
        linear.gram(df.withColumn("a", F.lit(1e13)), ["a"]).collect()
    assert all(r["total"] == 0 for r in linear.gram(df.limit(0), ["a"]).collect())


def test_a_task_adds_up_its_rows(feats):
    assert "MapInArrow" in plan_text(linear.gram(feats))


def test_linear_check_joins_nothing(spark, monkeypatch):
    monkeypatch.setattr(queries, "settled", lambda df, *paths: df)
    out = queries.linear_check(spark, SMOKE)
    assert "Join" not in plan_text(out)
    row = out.first()
    assert row["n_test"] > 1000 and row["rmse_below_deviation"] and row["changed_by_reload"] == row["off_the_aggregate"] == 0
