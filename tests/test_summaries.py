import pytest

from forecastry.operators import summaries
from forecastry.sources import tables
from conftest import SMOKE, plan_text


@pytest.fixture(scope="module")
def panel(spark):
    return tables.panel(spark, SMOKE).persist()


def test_rollups_agree(panel):
    monthly = sum(r["total_sales"] for r in summaries.monthly_sales(panel).collect())
    items = sum(r["total_sales"] for r in summaries.item_sales(panel).collect())
    rows = {r["store"]: r["n"] for r in panel.groupBy("store").count().withColumnRenamed("count", "n").collect()}
    stores = sum(r["avg_sales"] * rows[r["store"]] for r in summaries.store_avg(panel).collect())
    assert monthly == items
    assert stores == pytest.approx(items, rel=1e-12)


def test_orders(panel):
    m = [(r["year"], r["month"]) for r in summaries.monthly_sales(panel).collect()]
    assert m == sorted(m)
    s = [r["avg_sales"] for r in summaries.store_avg(panel).collect()]
    assert s == sorted(s, reverse=True)
    i = summaries.item_sales(panel).collect()
    assert [r["total_sales"] for r in i] == sorted((r["total_sales"] for r in i), reverse=True)


def test_top_items_is_take_ordered(panel):
    top = summaries.top_items(panel, 10)
    assert "TakeOrderedAndProject" in plan_text(top)
    rows = top.collect()
    assert len(rows) == 10 and isinstance(rows[0]["item"], str)
    full = summaries.item_sales(panel).limit(10).collect()
    assert [int(r["item"]) for r in rows] == [r["item"] for r in full]


def test_cube_summaries_equal_direct(panel):
    cube = summaries.summaries_from_cube(summaries.sales_cube(panel))
    assert cube["monthly_sales"].collect() == summaries.monthly_sales(panel).collect()
    assert cube["item_sales"].collect() == summaries.item_sales(panel).collect()
    a = cube["store_avg"].collect()
    b = summaries.store_avg(panel).collect()
    assert [r["store"] for r in a] == [r["store"] for r in b]
    assert [r["avg_sales"] for r in a] == pytest.approx([r["avg_sales"] for r in b], rel=1e-12)


def test_monthly_series_axis(panel):
    rows = summaries.monthly_series(panel).collect()
    assert all(r["month_start"].day == 1 and r["month_start"].month == r["month"] for r in rows)
    assert [r["month_start"] for r in rows] == sorted(r["month_start"] for r in rows)


def test_sample_rows(panel):
    assert summaries.sample_rows(panel, 5).count() == 5


def test_monthly_spine_fills_gaps(spark):
    import datetime as dt
    rows = [(1, dt.date(2020, 11, 30), 2.0), (1, dt.date(2021, 2, 1), 3.0), (1, dt.date(2021, 2, 9), None), (2, dt.date(2021, 1, 5), None), (2, None, 9.0), (None, dt.date(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "item int, date date, sales float")
    got = [(r["item"], r["year"], r["month"], r["total_sales"]) for r in summaries.monthly_spine(df, "item").collect()]
    assert got == [(None, 2020, 1, 1.0), (1, 2020, 11, 2.0), (1, 2020, 12, 0.0), (1, 2021, 1, 0.0), (1, 2021, 2, 3.0), (2, 2021, 1, 0.0)]
    whole = summaries.monthly_spine(df).collect()
    assert len(whole) == 14 and sum(r["total_sales"] for r in whole) == 6.0
    assert summaries.monthly_spine(df.limit(0)).count() == 0


def test_spine_sorts_totals_before_the_gaps(spark):
    """Months without sales are made after the one sort, in order: no task sorts
    or adds up the whole axis."""
    rows = [(k % 7, f"{1900 + 40 * (k % 3)}-0{1 + k % 2}-05", float(k)) for k in range(100)]
    df = spark.createDataFrame(rows, "item int, day string, sales float").selectExpr("item", "date(day) AS date", "sales")
    out = summaries.monthly_spine(df, "item")
    plan = plan_text(out)
    assert "Generate" in plan.split("Sort")[0] and "Union" not in plan
    got = [(r["item"], r["month_start"]) for r in out.collect()]
    assert got == sorted(set(got)) and len(got) > 7 * 900
    assert sum(r["total_sales"] for r in out.collect()) == sum(range(100))
