import pytest

from forecastry.operators import scale


def frame(spark, vals):
    return spark.createDataFrame([(float(v),) for v in vals], "sales float")


@pytest.mark.parametrize("method", ["expr", "ml"])
def test_scaling(spark, method):
    out = [r["sales_scaled_value"] for r in scale.minmax_scale(frame(spark, [2, 3, 12]), method=method).orderBy("sales").collect()]
    assert out == pytest.approx([0.0, 0.1, 1.0])


@pytest.mark.parametrize("method", ["expr", "ml"])
def test_constant_column_scales_to_half(spark, method):
    out = [r["sales_scaled_value"] for r in scale.minmax_scale(frame(spark, [2, 2]), method=method).collect()]
    assert out == [0.5, 0.5]


def test_expr_equals_ml_route(spark):
    df = frame(spark, [1, 5, 7.25, 13, 40, 2.5])
    a = scale.minmax_scale(df, method="expr").orderBy("sales").collect()
    b = scale.minmax_scale(df, method="ml").orderBy("sales").collect()
    assert a == b
    assert dict(scale.minmax_scale(df, method="ml").dtypes) == {"sales": "float", "sales_scaled_value": "float"}


def test_ml_route_has_no_python_udf(spark):
    out = scale.minmax_scale(frame(spark, [1, 2]), method="ml")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_impute_then_scale_equals_two_step(spark):
    df = spark.createDataFrame([(1.0,), (None,), (7.0,), (float("nan"),), (4.5,)], "sales float")
    from forecastry.operators import clean
    a = sorted(scale.impute_then_scale(df).collect())
    b = sorted(scale.minmax_scale(clean.impute_mean(df), method="ml").collect())
    assert a == b


def test_impute_then_scale_fill_outside_range(spark):
    # every present value equal: the fill value equals them, range is constant -> 0.5
    df = spark.createDataFrame([(3.0,), (None,), (3.0,)], "sales float")
    assert [r["sales_scaled_value"] for r in scale.impute_then_scale(df).collect()] == [0.5, 0.5, 0.5]
