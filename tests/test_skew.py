"""Hot keys: one job / prefix / store holding a third of all rows.

Results are checked against a brute-force pandas computation, and plans are
checked to reduce the hot key map-side (partial aggregate or partial
group limit) rather than ship it whole to one task.
"""

from pyspark.sql import functions as F

from forecastry.operators import features, status, summaries
from forecastry.session import settled
from forecastry.sources import tables
from conftest import SMOKE, plan_text


def _hot(df, col, value):
    """Move every third row onto one key value."""
    return df.withColumn(col, F.when(F.xxhash64(*df.columns) % 3 == 0, F.lit(value)).otherwise(F.col(col)))


def test_latest_run_with_hot_job(spark):
    runs = _hot(tables.run_log(spark, SMOKE), "job", 7)
    got = status.latest_run(runs).toPandas().set_index("job").sort_index()
    pdf = runs.toPandas().sort_values(["job", "started_on", "run_id"], ascending=[True, False, False])
    want = pdf.groupby("job").head(1).set_index("job").sort_index()
    assert (got["run_id"] == want["run_id"]).all()
    assert runs.filter("job = 7").count() > runs.count() / 4
    assert "Partial" in plan_text(status.latest_run(runs))


def test_latest_artifact_with_hot_prefix(spark):
    listing = _hot(tables.artefacts(spark, SMOKE), "prefix", "models")
    got = status.latest_artifact(listing).toPandas().set_index("prefix").sort_index()
    pdf = listing.toPandas().sort_values(["prefix", "last_modified", "key"], ascending=[True, False, True])
    want = pdf.groupby("prefix").head(1).set_index("prefix").sort_index()
    assert (got["key"] == want["key"]).all()
    assert "Partial" in plan_text(status.latest_artifact(listing))


def test_store_summary_with_hot_store(spark):
    panel = _hot(tables.panel(spark, SMOKE), "store", 3)
    got = {r["store"]: r["avg_sales"] for r in summaries.store_avg(panel).collect()}
    pdf = panel.toPandas()
    want = pdf.assign(sales=pdf["sales"].astype("float64")).groupby("store")["sales"].mean().to_dict()
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert "partial_avg" in plan_text(summaries.store_avg(panel))


def test_panel_aggregation_is_partial_first(spark):
    plan = plan_text(tables.panel(spark, SMOKE))
    # the map-side partial sum sits below the shuffle
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_features_with_hot_series(spark):
    """One series with a third of all rows, half of them undated, and one date
    and sales repeated: equal to the plain window, in bounded pieces."""
    panel = tables.panel(spark, SMOKE).select("store", "item", "date", "sales")
    of_hash = F.xxhash64("store", "item", "date")
    hot = of_hash % 3 == 0
    rows = panel.select(
        F.when(hot, 1).otherwise(F.col("store")).alias("store"), F.when(hot, 1).otherwise(F.col("item")).alias("item"),
        F.when(hot & (of_hash % 2 == 0), F.lit(None)).when(hot & (of_hash % 5 == 0), F.lit("1995-01-01"))
        .otherwise(F.col("date").cast("string")).cast("date").alias("date"), "sales",
    )
    rows = rows.union(rows.where("store = 1 and item = 1").limit(1).crossJoin(spark.range(300)).drop("id"))
    rows = settled(rows)
    for leak_free in (False, True):
        plain = features.demand_features(rows, leak_free, least_rows=1 << 40)
        ranged = features.demand_features_ranged(rows, 16, leak_free=leak_free)
        assert ranged.columns == plain.columns
        assert ranged.exceptAll(plain).count() == 0 and plain.exceptAll(ranged).count() == 0
    chunks = features.series_chunks(rows, 16, 1)
    sizes = [r["count"] for r in chunks.groupBy("store", "item", "_chunk").count().collect()]
    assert max(sizes) <= 2 * rows.count() / 16


def test_a_hot_series_loads_tasks_evenly(spark):
    """A third of all rows in one series of unique dates: rows are shuffled once,
    and no window task has more than twice the mean."""
    days = F.expr("date_add(date'1900-01-01', cast(id as int))")
    hot = spark.range(20_000).select(F.lit(1).alias("store"), F.lit(1).alias("item"), days.alias("date"), (F.col("id") % 50).cast("float").alias("sales"))
    rest = spark.range(40_000).select(
        (F.col("id") % 500).cast("int").alias("store"), (2 + F.col("id") % 7).cast("int").alias("item"),
        days.alias("date"), (F.col("id") % 31).cast("float").alias("sales"),
    )
    rows = settled(hot.union(rest))
    for leak_free in (False, True):
        cut = features.demand_features(rows, leak_free, least_rows=100)
        plain = features.demand_features(rows, leak_free, least_rows=1 << 40)
        assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0
    chunks = features.series_chunks(rows, least_rows=100)
    of_task = chunks.repartition(8, "store", "item", "_chunk").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in of_task) <= 2 * 60_000 / 8
    sizes = [r["count"] for r in chunks.where("store = 1 and item = 1").groupBy("_chunk").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 3 * 60_000 / 128
    plan = plan_text(features.demand_features(rows, least_rows=100))
    scans_of_rows = plan.split("Union")[0]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and scans_of_rows.count("Exchange hashpartitioning") == 1


def test_series_that_are_not_long_keep_the_plain_window(spark):
    assert features.series_chunks(tables.history(spark, SMOKE)) is None
    assert features.series_chunks(tables.history(spark, SMOKE).limit(0), 16, 1) is None


def test_cuts_order_nulls_and_nan_as_spark_does(spark):
    nan = float("nan")
    rows = [(1, None, d, v) for d in (None, "2020-01-01", "2020-01-02") for v in (None, 1.0, nan, -2.0)] * 3
    df = spark.createDataFrame(rows, "store int, item int, d string, sales float").select(
        "store", "item", F.to_date("d").alias("date"), "sales", F.monotonically_increasing_id().alias("n"))
    df = settled(df)
    at = [tuple(r[0]) for r in df.select(features._row_order(df)).collect()]
    want = [tuple(r[0]) for r in df.select(features._row_order(df).alias("o")).orderBy("o").collect()]
    assert repr(sorted(at, key=features._in_spark_order)) == repr(want)
    chunks = features.series_chunks(df, 12, 1)
    bounds = chunks.groupBy("_chunk").agg(F.min(features._row_order(df)).alias("lo"), F.max(features._row_order(df)).alias("hi"))
    got = [x for r in bounds.orderBy("_chunk").collect() for x in (tuple(r["lo"]), tuple(r["hi"]))]
    assert len(got) > 8 and sorted(got, key=features._in_spark_order) == got


def test_a_rows_chunk_is_found_by_halves(spark):
    """The chunk is the number of cuts up to the row, and no row looks at all cuts."""
    df = settled(spark.range(5000).selectExpr("1 AS store", "1 AS item", "date_add(date'2000-01-01', int(id % 700)) AS date", "float(id % 11) AS sales", "id"))
    (_, _, cuts), = features.series_cuts(df, 64, 1)
    chunks = features.series_chunks(df, 64, 1)
    assert "lambda" not in plan_text(chunks)
    rows = chunks.select(features._row_order(df).alias("at"), "_chunk").collect()
    cuts = [features._in_spark_order(tuple(c)) for c in cuts]
    assert all(r["_chunk"] == sum(c <= features._in_spark_order(tuple(r["at"])) for c in cuts) for r in rows)
    assert len({r["_chunk"] for r in rows}) == len(cuts) + 1 > 50
