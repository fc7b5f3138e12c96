"""Pinned semantics without a home elsewhere: X5, X7, X12, X13."""

import datetime as dt

from forecastry.operators import features, model, summaries
from forecastry.schema import FEATURE_COLUMNS, SCALED_COLUMN


def test_x5_lag_counts_rows_not_days(spark):
    days = [dt.date(2013, 1, 1), dt.date(2013, 1, 5), dt.date(2013, 3, 1)]
    df = spark.createDataFrame([(1, 1, float(i + 1), d) for i, d in enumerate(days)],
                               "store int, item int, sales float, date date")
    out = [r["lag_1"] for r in features.demand_features(df).orderBy("date").collect()]
    assert out == [0.0, 1.0, 2.0]  # the previous row, however many days back


def test_x7_seeded_forest_is_reproducible(spark):
    rows = [(float(i % 7), float(i % 5), float((i * 3) % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, sales float")
    data = model.assemble(df, feature_cols=["a", "b"]).coalesce(2)
    p1 = [r["prediction"] for r in model.fit_forest(data, "light", numTrees=5).transform(data).collect()]
    p2 = [r["prediction"] for r in model.fit_forest(data, "light", numTrees=5).transform(data).collect()]
    assert p1 == p2
    assert all(p["seed"] == 42 for p in model.FOREST_PRESETS.values())


def test_x12_aggregate_ties_break_on_key(spark):
    df = spark.createDataFrame([(3, 1, 5.0), (1, 2, 5.0), (2, 3, 5.0)], "store int, item int, sales float")
    assert [r["store"] for r in summaries.store_avg(df).collect()] == [1, 2, 3]
    assert [r["item"] for r in summaries.item_sales(df).collect()] == [1, 2, 3]


def test_x13_scaled_sales_is_not_a_model_feature():
    assert SCALED_COLUMN not in FEATURE_COLUMNS
    assert "sales" not in FEATURE_COLUMNS  # the label never leaks in directly
