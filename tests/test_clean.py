import pytest
from pyspark.sql import functions as F

from forecastry.operators import clean


def raw(spark, rows):
    return spark.createDataFrame(rows, "date string, store string, item string, sales string")


def test_bad_text_becomes_null(spark):
    out = clean.typed_sales(raw(spark, [("bad", "1", "x", "abc"), ("2013-01-01", "2", "3", "4.5")]))
    assert dict(out.dtypes) == {"date": "date", "store": "int", "item": "int", "sales": "float"}
    rows = {r["store"]: r for r in out.collect()}
    assert rows[1]["date"] is None and rows[1]["item"] is None and rows[1]["sales"] is None
    assert rows[2]["sales"] == 4.5 and str(rows[2]["date"]) == "2013-01-01"


def test_nan_text_is_null_then_imputed(spark):
    typed = clean.typed_sales(raw(spark, [("2013-01-01", "1", "1", "NaN"), ("2013-01-02", "1", "1", "2"),
                                          ("2013-01-03", "1", "1", "4")]))
    assert typed.filter(F.col("sales").isNull()).count() == 1
    out = clean.impute_mean(typed)
    assert sorted(r["sales"] for r in out.collect()) == [2.0, 3.0, 4.0]


def test_all_null_raises_clear_error(spark):
    typed = clean.typed_sales(raw(spark, [("2013-01-01", "1", "1", None), ("2013-01-02", "1", "1", "abc")]))
    with pytest.raises(ValueError, match="no non-null"):
        clean.impute_mean(typed)


def test_imputed_value_is_cast_back_to_float(spark):
    typed = clean.typed_sales(raw(spark, [("2013-01-01", "1", "1", "1"), ("2013-01-02", "1", "1", "2"),
                                          ("2013-01-03", "1", "1", None), ("2013-01-04", "1", "1", "2")]))
    out = clean.impute_mean(typed)
    assert dict(out.dtypes)["sales"] == "float"
    filled = out.filter(F.col("date") == "2013-01-03").first()["sales"]
    assert filled == pytest.approx(5 / 3, rel=1e-6)


def test_drop_missing_and_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, 3.0), (4, float("nan"))], "a int, b double")
    assert clean.drop_missing(df).count() == 1  # NaN dropped too (X2)
    counts = clean.null_counts(df).collect()
    assert len(counts) == 1 and counts[0].asDict() == {"a": 1, "b": 1}


def test_null_counts_is_one_pass(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    plan = clean.null_counts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_fill_zero(spark):
    df = spark.createDataFrame([(None, 1.0, float("nan"))], "lag_1 float, lag_7 float, rolling_avg_7 double")
    r = clean.fill_zero(df).first()
    assert (r["lag_1"], r["lag_7"], r["rolling_avg_7"]) == (0.0, 1.0, 0.0)


def test_extra_raw_columns_pass_through(spark):
    df = spark.createDataFrame([("2013-01-01", "1", "2", "3", "north")], "date string, store string, item string, sales string, region string")
    out = clean.typed_sales(df)
    assert out.columns == ["date", "store", "item", "sales", "region"]
    assert dict(out.dtypes)["region"] == "string" and out.first()["region"] == "north"


def test_impute_mean_on_double_column(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,)], "sales double")
    out = sorted(r["sales"] for r in clean.impute_mean(df).collect())
    assert out == [1.0, 2.5, 2.5, 4.0]
