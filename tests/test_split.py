from pyspark.sql import functions as F

from forecastry.operators import split
from forecastry.session import materialize
from forecastry.sources import tables
from conftest import SMOKE


def test_random_split_disjoint_complete_and_shares(spark):
    panel = materialize(tables.panel(spark, SMOKE), "t-split")
    n = panel.count()
    train, test = split.random_split(panel, (0.8, 0.2), 42)
    keys = ["store", "item", "date"]
    a, b = train.select(keys), test.select(keys)
    assert a.count() + b.count() == n
    assert a.intersect(b).count() == 0
    assert a.union(b).distinct().count() == n
    assert abs(a.count() / n - 0.8) < 0.05


def test_random_split_seeded_repeatable_on_same_layout(spark):
    panel = materialize(tables.panel(spark, SMOKE), "t-split2")
    t1 = sorted(split.random_split(panel, (0.7, 0.3), 42)[0].collect())
    t2 = sorted(split.random_split(panel, (0.7, 0.3), 42)[0].collect())
    assert t1 == t2


def test_hash_split_is_layout_free(spark):
    panel = tables.panel(spark, SMOKE)
    t1 = sorted(split.hash_split(panel.repartition(3), 80)[0].collect())
    t2 = sorted(split.hash_split(panel.repartition(11), 80)[0].collect())
    assert t1 == t2
    train, test = split.hash_split(panel, 80)
    assert train.count() + test.count() == panel.count()
    assert abs(train.count() / panel.count() - 0.8) < 0.05


def test_hash_split_has_no_shuffle(spark):
    df = spark.read.parquet(f"{SMOKE}/lineitem.parquet").select(
        F.col("l_suppkey").alias("store"), F.col("l_partkey").alias("item"), F.to_date("l_shipdate").alias("date"))
    plan = split.hash_split(df)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_cutoff_split(spark):
    panel = tables.panel(spark, SMOKE)
    train, test = split.cutoff_split(panel, "1998-01-01")
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    assert train.count() + test.count() == panel.count()


def test_cutoff_filter_reaches_the_parquet_scan(spark):
    # through the adapter's derived date: Catalyst unwraps the cast on the train side
    plan = split.cutoff_split(tables.panel(spark, SMOKE), "2000-01-01")[0]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in plan


def test_cutoff_split_sides_push_down_on_a_date_column(spark):
    import datetime as dt
    import tempfile
    path = tempfile.mkdtemp(prefix="fc-cut-") + "/t"
    spark.createDataFrame([(1, dt.date(2013, 1, 1))], "store int, date date").write.parquet(path)
    train, test = split.cutoff_split(spark.read.parquet(path), "2013-06-01")
    assert "PushedFilters: [IsNotNull(date), LessThan(date" in train._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(date" in test._jdf.queryExecution().executedPlan().toString()


def test_panel_scan_reads_only_needed_columns(spark):
    plan = tables.panel(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_scratch_folder_comes_from_the_session(spark):
    from forecastry.session import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(root)


def test_cutoff_split_keeps_undated_rows(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.date(2013, 1, 1)), (2, None), (3, dt.date(2014, 1, 1))], "store int, date date")
    train, test = split.cutoff_split(df, "2013-06-01")
    assert [r["store"] for r in train.collect()] == [1]
    assert sorted(r["store"] for r in test.collect()) == [2, 3]


def test_exact_split_is_exact_and_layout_free(spark):
    panel = tables.panel(spark, SMOKE)
    n = panel.count()
    sides = [[sorted(map(str, s.collect())) for s in split.exact_split(df, 0.8)] for df in (panel, panel.repartition(11), panel.coalesce(1))]
    assert len(sides[0][0]) == round(0.8 * n) and len(sides[0][1]) == n - round(0.8 * n)
    assert sides[0] == sides[1] == sides[2]
    assert sorted(sides[0][0] + sides[0][1]) == sorted(map(str, panel.collect()))
    assert sorted(map(str, split.exact_split(panel, 0.8, seed=7)[0].collect())) != sides[0][0]


def test_exact_split_of_repeated_rows(spark):
    """Copies of one row share a place and are counted out; rows that share only
    the key are told apart; shares of nothing and of all."""
    import datetime as dt
    day = dt.date(2020, 1, 1)
    rows = [(1, 1, day, 5.0, None)] * 400 + [(1, 1, day, float(v), "x") for v in range(100)] + [(2, k, None, None, "y") for k in range(100)]
    df = spark.createDataFrame(rows, "store int, item int, date date, sales float, note string").repartition(4)
    for share in (0.0, 0.001, 0.3, 0.5, 0.6667, 0.9, 1.0):
        train, test = split.exact_split(df, share)
        assert (train.count(), test.count()) == (round(share * 600), 600 - round(share * 600))
        assert train.schema == df.schema and train.unionAll(test).exceptAll(df).count() == 0
    assert [s.count() for s in split.exact_split(df.limit(0), 0.8)] == [0, 0]


def test_exact_split_shuffles_no_rows(spark):
    df = spark.read.parquet(f"{SMOKE}/lineitem.parquet").select(
        F.col("l_suppkey").alias("store"), F.col("l_linenumber").alias("item"), F.to_date("l_shipdate").alias("date"), "l_orderkey")
    for side in split.exact_split(df):
        assert "Exchange" not in side._jdf.queryExecution().executedPlan().toString()
