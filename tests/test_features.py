import datetime as dt

from pyspark.sql import functions as F

from forecastry.operators import features
from conftest import plan_text


def series(spark, values, store=1, item=1, start=dt.date(2013, 1, 1)):
    rows = [(store, item, v, start + dt.timedelta(days=i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "store int, item int, sales float, date date")


def test_lags_and_rolling_mean(spark):
    out = features.demand_features(series(spark, [float(v) for v in range(1, 10)])).orderBy("date").collect()
    assert [r["lag_1"] for r in out] == [0.0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert [r["lag_7"] for r in out] == [0.0] * 7 + [1.0, 2.0]
    assert [r["rolling_avg_7"] for r in out] == [1, 1.5, 2, 2.5, 3, 3.5, 4, 5, 6]


def test_leak_free_rolling_mean_excludes_current_row(spark):
    out = features.demand_features(series(spark, [float(v) for v in range(1, 10)]), leak_free=True)
    got = [r["rolling_avg_7"] for r in out.orderBy("date").collect()]
    assert got == [0.0, 1, 1.5, 2, 2.5, 3, 3.5, 4, 5]


def test_series_do_not_mix(spark):
    df = series(spark, [1.0, 2.0], store=1).unionByName(series(spark, [10.0, 20.0], store=2))
    out = {(r["store"], str(r["date"])): r["lag_1"] for r in features.demand_features(df).collect()}
    assert out[(2, "2013-01-01")] == 0.0 and out[(2, "2013-01-02")] == 10.0


def test_weekday_sunday_is_one(spark):
    out = features.demand_features(series(spark, [1.0], start=dt.date(2013, 1, 6))).first()
    assert (out["year"], out["month"], out["day_of_week"]) == (2013, 1, 1)


def test_feature_types(spark):
    out = features.demand_features(series(spark, [1.0, 2.0]))
    t = dict(out.dtypes)
    assert (t["year"], t["month"], t["day_of_week"]) == ("int", "int", "int")
    assert (t["lag_1"], t["lag_7"], t["rolling_avg_7"]) == ("float", "float", "double")


def test_one_window_one_sort_no_python(spark):
    out = features.demand_features(series(spark, [1.0, 2.0, 3.0]))
    plan = plan_text(out)
    assert plan.count("Window [") == 1 or plan.count("Window ") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_rolling_within_frame_bounds(spark):
    import random
    random.seed(7)
    vals = [float(random.randint(0, 50)) for _ in range(40)]
    out = features.demand_features(series(spark, vals)).orderBy("date").collect()
    for i, r in enumerate(out):
        frame = vals[max(0, i - 6): i + 1]
        assert min(frame) - 1e-9 <= r["rolling_avg_7"] <= max(frame) + 1e-9


def test_daily_totals_makes_keys_unique(spark):
    df = series(spark, [1.0, 2.0]).unionByName(series(spark, [3.0]))
    out = features.daily_totals(df)
    assert out.count() == 2
    assert out.filter(F.col("date") == "2013-01-01").first()["sales"] == 4.0


def test_repeated_keys_give_deterministic_features(spark):
    rows = [(1, 1, v, dt.date(2013, 1, 1)) for v in (5.0, 1.0, 3.0)] + [(1, 1, 2.0, dt.date(2013, 1, 2))]
    df = spark.createDataFrame(rows, "store int, item int, sales float, date date")
    a = sorted(features.demand_features(df.repartition(3)).collect())
    b = sorted(features.demand_features(df.coalesce(1)).collect())
    assert a == b
    lags = {r["sales"]: r["lag_1"] for r in a}
    assert lags == {1.0: 0.0, 3.0: 1.0, 5.0: 3.0, 2.0: 5.0}


def test_chunked_features_equal_plain_on_the_panel(spark):
    from forecastry.operators import clean
    from forecastry.session import materialize
    from forecastry.sources import tables
    from conftest import SMOKE
    imp = clean.impute_mean(materialize(tables.holes(spark, SMOKE), "t-chunk"))
    plain = features.demand_features(imp)
    for days in (1, 10, 400):
        chunked = features.demand_features_chunked(imp, chunk_days=days)
        assert chunked.columns == plain.columns
        assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0


def test_chunked_limits_tails_map_side(spark):
    out = features.demand_features_chunked(series(spark, [float(v) for v in range(30)]), chunk_days=5)
    plan = plan_text(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
