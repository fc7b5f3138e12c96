"""Registered queries: one per operator family of the blueprint.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole supplied tables (``lineitem`` as sales, ``events``/``customer`` as runs
and jobs, ``orders`` as artefacts).  Column names equal those of the oracle
SQL in :mod:`forecastry.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.regression import LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastry.functions.vectors import vector_to_list
from forecastry.operators import clean, features, linear, model, profile, scale, split, status, summaries
from forecastry.schema import FEATURE_COLUMNS, INGEST_SPLIT, KEY_COLUMNS, LABEL_COLUMN, MODEL_SPLIT, RAW_COLUMNS, SEED, TOP_ITEMS
from forecastry.session import scratch_path, settled
from forecastry.sources import list_objects, read_raw_sales, save_model, write_csv
from forecastry.sources import tables
from forecastry.streaming import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# Float statistics are compared after rounding: stddev/corr are not exact
# across engines' summation orders.
STAT_DIGITS = 6
CORR_DIGITS = 9


def _panel(spark, sf):
    return tables.panel(spark, sf)


def _holes(spark, sf):
    return tables.holes(spark, sf)


def _imputed(spark, sf):
    """Mean imputation with the mean as a scalar subquery of the same plan."""
    return clean.impute_mean_inline(_holes(spark, sf))


def _history(spark, sf):
    """Imputed sales in long series (about 84 rows each)."""
    return clean.impute_mean_inline(tables.history_holes(spark, sf))


def _round_all(df: DataFrame, digits: int, skip=()) -> DataFrame:
    return df.select(*[F.col(c) if c in skip else F.round(c, digits).alias(c) for c in df.columns])


# ---- ingest and clean ----------------------------------------------------


def _text_csv(spark, rows):
    """``rows`` as a raw text CSV in the scratch folder."""
    path = scratch_path(spark, "raw-sales")
    write_csv(rows.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS]), path)
    return path


def typed_from_csv(spark, sf):
    """S1 + S4 + P1: sales written as text CSV, read back by header, typed."""
    path = _text_csv(spark, _holes(spark, sf))
    return settled(clean.typed_sales(read_raw_sales(spark, path)), path)


def typed_from_csv_stream(spark, sf):
    """S1 + P1 + S3 incrementally: the CSV files ingested by a file stream."""
    raw, root = _text_csv(spark, _holes(spark, sf)), scratch_path(spark, "stream")
    ingest_stream(spark, raw, f"{root}/processed", f"{root}/checkpoint")
    return settled(spark.read.parquet(f"{root}/processed"), raw, root)


def typed_dirty_csv(spark, sf):
    """P1 + X1 + X2 on dirty text: "abc", "NaN" and empty sales become null."""
    path = _text_csv(spark, tables.dirty_text(spark, sf))
    return settled(clean.typed_sales(read_raw_sales(spark, path)), path)


def ingest_v1_text(spark, sf):
    """N1 on text, before any cast: nulls drop (an empty CSV field is null),
    "abc" and "NaN" survive."""
    path = _text_csv(spark, tables.dirty_text(spark, sf))
    return settled(clean.drop_missing(read_raw_sales(spark, path)), path)


def drop_missing(spark, sf):
    """N1."""
    return clean.drop_missing(_holes(spark, sf))


def missing_counts(spark, sf):
    """N4 + P6: every column's null count in one pass."""
    return clean.null_counts(_holes(spark, sf))


def mean_impute(spark, sf):
    """N2 + A1."""
    return _imputed(spark, sf)


def minmax_scale(spark, sf):
    """M1 + M3 + M4 + M7 + F4 + A8: the ML route (assembler, scaler, vector -> float)."""
    return scale.minmax_scale(_imputed(spark, sf), method="ml")


def minmax_scale_expr(spark, sf):
    """N2 + A8 + M3 as plain expressions: all statistics are one scalar
    subquery; no vector column, nothing written."""
    return scale.impute_then_scale(_holes(spark, sf))


def constant_scale(spark, sf):
    """A constant column scales to 0.5 in every row."""
    return scale.scale_ml(_panel(spark, sf).withColumn("sales", F.lit(7.0).cast("float")))


def daily_totals(spark, sf):
    """Rows of repeated (store, item, date) summed to one."""
    return features.daily_totals(tables.raw_sales(spark, sf))


# ---- explore -------------------------------------------------------------


def describe_sales(spark, sf):
    """A2 + A3 on sales with holes."""
    out = profile.describe_typed(_holes(spark, sf), "sales")
    return out.withColumns({"mean": F.round("mean", STAT_DIGITS), "stddev": F.round("stddev", STAT_DIGITS)})


def sales_profile(spark, sf):
    """A2 + A3 + N4 + A7 in ONE aggregate: what the ingest job prints."""
    out = profile.profile(_holes(spark, sf))
    keep = [c for c in out.columns if c.startswith("nulls_") or c.endswith(("_count", "_min", "_max")) or c == "n_rows"]
    stats = [c for c in out.columns if c.endswith(("_mean", "_stddev"))]
    corrs = [c for c in out.columns if c.startswith("corr_")]
    return out.select(
        *keep,
        *[F.round(c, STAT_DIGITS).alias(c) for c in stats],
        *[F.round(c, CORR_DIGITS).alias(c) for c in corrs],
    )


def describe_parity(spark, sf):
    """A3 parity: Spark's ``describe`` table of sales, store, item, as numbers."""
    out = profile.describe(_holes(spark, sf), ["sales", "store", "item"])
    return out.select("summary", *[F.round(F.col(c).cast("double"), STAT_DIGITS).alias(c) for c in ("sales", "store", "item")])


def sample_rows(spark, sf):
    """The first five rows by date, store and item."""
    return summaries.sample_rows(_holes(spark, sf), 5)


def monthly_sales(spark, sf):
    """F1 + F2 + A4 + O1."""
    return summaries.monthly_sales(_panel(spark, sf))


def store_avg(spark, sf):
    """A5 + O2 + O4."""
    return summaries.store_avg(_panel(spark, sf))


def item_sales(spark, sf):
    """A6 + O2."""
    return summaries.item_sales(_panel(spark, sf))


def _cube_summary(spark, sf, name):
    """A4-A6 the way the explore job builds them: grouping sets of one pass."""
    return summaries.summaries_from_cube(summaries.sales_cube(_panel(spark, sf)))[name]


def monthly_sales_cube(spark, sf):
    """A4 + O1 through the cube."""
    return _cube_summary(spark, sf, "monthly_sales")


def store_avg_cube(spark, sf):
    """A5 + O2 through the cube."""
    return _cube_summary(spark, sf, "store_avg")


def item_sales_cube(spark, sf):
    """A6 + O2 through the cube."""
    return _cube_summary(spark, sf, "item_sales")


def sales_summaries(spark, sf):
    """A4 + A5 + A6 in one pass: a row per month, per store and per item."""
    part = F.col("part")
    month = F.format_string("%04d-%02d", "year", "month")
    return summaries.sales_cube(_panel(spark, sf)).select(
        F.when(part == summaries.MONTHS, "month").when(part == summaries.STORES, "store").otherwise("item").alias("summary"),
        F.when(part == summaries.MONTHS, month).otherwise(F.coalesce("store", "item").cast("string")).alias("key"),
        "total_sales", "avg_sales",
    )


def top_items(spark, sf):
    """O3 + F5."""
    return summaries.top_items(_panel(spark, sf), TOP_ITEMS)


def monthly_series(spark, sf):
    """C1."""
    return summaries.monthly_series(_panel(spark, sf))


def monthly_spine(spark, sf):
    """C1 on a real time axis: each item's months from first to last, 0 where
    nothing was sold."""
    return summaries.monthly_spine(_panel(spark, sf), "item")


def correlations(spark, sf):
    """A7 (pairs with a null skipped)."""
    return _round_all(profile.correlations(_panel(spark, sf)), CORR_DIGITS)


def correlations_null_as_zero(spark, sf):
    """A7 under the ``stat.corr`` rule: null counted as 0."""
    return _round_all(profile.correlations(_holes(spark, sf), null_as_zero=True), CORR_DIGITS)


# ---- features and splits ---------------------------------------------------


def demand_features(spark, sf):
    """Flagship: F1-F3 + W1-W3 + N3 + P2 on imputed sales."""
    return features.demand_features(_history(spark, sf))


def demand_features_chunked(spark, sf):
    """The flagship with each series cut into 30-day chunks plus a 7-row halo:
    no window partition holds more than one chunk of one series."""
    return features.demand_features_chunked(_history(spark, sf), chunk_days=30)


def demand_features_ranged(spark, sf):
    """The flagship with series cut at quantiles of their rows wherever they have
    more than 1 / 2,048 of all rows."""
    return features.demand_features_ranged(_history(spark, sf), pieces=2048)


def demand_features_hot(spark, sf):
    """The flagship where a third of all rows are one series, which repeats
    dates: that series is cut."""
    return features.demand_features(clean.impute_mean_inline(tables.punch_holes(tables.hot_history(spark, sf))), least_rows=100)


def demand_features_panel(spark, sf):
    """The flagship on the panel of many short series."""
    return features.demand_features(_imputed(spark, sf))


def leak_free_features(spark, sf):
    """X11 opt-in: rolling mean over the 7 rows before the current one."""
    return features.demand_features(_history(spark, sf), leak_free=True)


def hash_split_train(spark, sf):
    """R1 alternative: layout-free 80/20 split by key hash; the train side."""
    return split.hash_split(_panel(spark, sf), 80)[0]


def cutoff_split_test(spark, sf):
    """X11 opt-in: time-ordered split; the test side (2000-01-01 onwards)."""
    return split.cutoff_split(_panel(spark, sf), "2000-01-01")[1]


def exact_split(spark, sf):
    """R1 to the row: round(0.8 n) rows are train, the same on any layout."""
    train, test = split.exact_split(_panel(spark, sf), INGEST_SPLIT[0], SEED)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _labelled_split(table, weights):
    train, test = split.random_split(table, weights, SEED)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def random_split(spark, sf):
    """80/20 ``randomSplit`` (seed 42), every row labelled with its side.

    The split samples a written table, so both sides see one fixed layout:
    disjoint and together complete, even if a partition is recomputed.
    """
    path = scratch_path(spark, "panel")
    _panel(spark, sf).write.parquet(path)
    return settled(_labelled_split(spark.read.parquet(path), INGEST_SPLIT), path)


def random_split_sizes(spark, sf):
    """R1 sizes: rows per side of the 80/20 split (one small aggregate)."""
    return random_split(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def random_split_check(spark, sf):
    """R1 + R2 invariants, for 80/20 and 70/30: rows, keys on both sides, keys
    on neither side, and whether the train share is within four standard errors."""
    path = scratch_path(spark, "panel")
    _panel(spark, sf).write.parquet(path)
    whole = spark.read.parquet(path)
    out = None
    for name, weights in (("80/20", INGEST_SPLIT), ("70/30", MODEL_SPLIT)):
        sides = _labelled_split(whole, weights).unionByName(whole.withColumn("split", F.lit("all")))
        per_key = sides.groupBy(*KEY_COLUMNS).agg(
            *[F.count_if(F.col("split") == side).alias(side) for side in ("train", "test", "all")]
        )
        share = F.sum("train") / F.sum("all")
        row = per_key.agg(
            F.lit(name).alias("split"), F.sum("all").alias("n_rows"),
            F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("on_both_sides"),
            F.count_if(F.col("train") + F.col("test") < F.col("all")).alias("on_neither_side"),
            (F.abs(share - weights[0]) < 4 * F.sqrt(weights[0] * weights[1] / F.sum("all"))).alias("share_as_expected"),
        )
        out = row if out is None else out.unionByName(row)
    return settled(out, path)


# ---- models ------------------------------------------------------------------


def _sides(spark, sf):
    """R2 by key hash, so that the held-out rows are the same on any cluster.
    The features are written once: fits, bounds and evaluations read them.
    Returns the folder to remove at the end, and both sides."""
    path = scratch_path(spark, "features")
    features.demand_features(_history(spark, sf)).write.parquet(path)
    return path, *split.hash_split(spark.read.parquet(path), int(MODEL_SPLIT[0] * 100))


def _model_data(spark, sf):
    """The same, as feature vectors and labels."""
    path, *sides = _sides(spark, sf)
    return path, *(model.assemble(side, keep_keys=True) for side in sides)


def linear_gram(spark, sf):
    """M5's one aggregate: the 45 sums of products of features and 9 with the label."""
    written, train, _ = _sides(spark, sf)
    return settled(linear.gram(train).select("a", "b", F.round("total", 2).cast("double").alias("total")), written)


def linear_normal_equations(spark, sf):
    """M2 + M5: least squares holds exactly when the train residuals are
    orthogonal to every feature and sum to 0: those sums, normalised; null for a
    column without variance."""
    written, train, _ = _sides(spark, sf)
    rows = linear.predict(train, linear.fit(train)).withColumn("e", F.col("sales").cast("double") - F.col("prediction"))
    columns = {"intercept": F.lit(1.0), **{c: F.col(c).cast("double") for c in FEATURE_COLUMNS}}

    def residual(name, f):
        share = F.try_divide(F.sum(f * F.col("e")), F.sqrt(F.sum(f * f) * F.sum(F.col("e") ** 2)))
        rounded = F.round(share, CORR_DIGITS) + F.lit(0.0)
        return rounded if name == "intercept" else F.when(F.min(f) < F.max(f), rounded)

    return settled(rows.agg(F.count(F.lit(1)).alias("n_train"), *[residual(c, f).alias(f"r_{c}") for c, f in columns.items()]), written)


def linear_check(spark, sf):
    """M5 + M8 + S5 invariants of Spark ML's least squares on the held-out rows:
    RMSE below the labels' deviation, predictions changed by a reload, and those
    more than 1e-6 off the ones of the single aggregate."""
    written, train, test = _sides(spark, sf)
    vectors = model.assemble(train)
    fitted, path = model.fit_linear(vectors), scratch_path(spark, "linear")
    save_model(fitted, path)
    again = LinearRegressionModel.load(path).setPredictionCol("reloaded")
    held_out, x = model.assemble(test), vector_to_list("features")
    own = linear.predict(held_out.withColumns({c: x[i] for i, c in enumerate(FEATURE_COLUMNS)}), linear.fit(train), "own")
    rows = again.transform(fitted.transform(own))
    label, p = F.col(LABEL_COLUMN).cast("double"), F.col("prediction")
    out = rows.agg(
        F.count(F.lit(1)).alias("n_test"),
        (F.sqrt(F.avg((label - p) ** 2)) < F.stddev_pop(label)).alias("rmse_below_deviation"),
        F.count_if(p != F.col("reloaded")).alias("changed_by_reload"),
        F.count_if(F.abs(p - F.col("own")) > 1e-6).alias("off_the_aggregate"),
    )
    return settled(out, path, written)


def score_check(spark, sf):
    """P5 + M8: the scored rows' labels as DuckDB computes them, and predictions
    that differ from the coefficients times the features."""
    written, train, test = _model_data(spark, sf)
    fitted = model.fit_linear(train)
    weights = F.array(*[F.lit(float(w)) for w in fitted.coefficients])
    by_hand = F.aggregate(F.zip_with("features", weights, lambda x, w: x * w), F.lit(float(fitted.intercept)), lambda a, b: a + b)
    out = model.score(fitted, test, as_arrays=True).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*KEY_COLUMNS).alias("n_keys"),
        F.round(F.sum(F.col("actual_sales").cast("decimal(28,8)")), 2).cast("double").alias("actual_sales"),
        F.count_if(F.abs(F.col("predicted_sales") - by_hand) > 1e-9).alias("off_the_coefficients"),
    )
    return settled(out, written)


def _forest_check(spark, sf, preset):
    """Rows, keys, predictions outside the train labels' range, RMSE below the
    labels' deviation, and predictions changed by saving and reloading."""
    written, train, test = _model_data(spark, sf)
    fitted, path = model.fit_forest(train, preset), scratch_path(spark, "forest")
    save_model(fitted, path)
    again = RandomForestRegressionModel.load(path).setPredictionCol("reloaded")
    label = F.col(LABEL_COLUMN).cast("double")
    bounds = train.agg(F.struct(F.min(label).alias("lo"), F.max(label).alias("hi"))).scalar()
    p = F.col("prediction")
    out = again.transform(fitted.transform(test)).withColumns({"lo": bounds["lo"], "hi": bounds["hi"]}).agg(
        F.count(F.lit(1)).alias("n_test"), F.count_distinct(*KEY_COLUMNS).alias("n_keys"),
        F.count_if((p < F.col("lo") - 1e-9) | (p > F.col("hi") + 1e-9)).alias("outside_train_range"),
        (F.sqrt(F.avg((label - p) ** 2)) < F.stddev_pop(label)).alias("rmse_below_deviation"),
        F.count_if(p != F.col("reloaded")).alias("changed_by_reload"),
    )
    return settled(out, path, written)


def forest_check(spark, sf):
    """M6b + M8 + S5 invariants of the light forest on the held-out rows."""
    return _forest_check(spark, sf, "light")


def tuned_forest_check(spark, sf):
    """M6a + M8 + S5: the same of the tuned forest (100 trees of depth 12)."""
    return _forest_check(spark, sf, "tuned")


def rmse_check(spark, sf):
    """A9 + M9: each model's RMSE minus ``RegressionEvaluator``'s, rounded."""
    written, train, test = _model_data(spark, sf)
    fitted = {"linear_regression": model.fit_linear(train), "random_forest": model.fit_forest(train, "light")}
    want = [(name, model.rmse_evaluator(m.transform(test))) for name, m in fitted.items()]
    want = spark.createDataFrame(want, "model string, evaluated double")
    both = model.compare_models(fitted, test).join(want, "model")
    both = both.select("model", (F.round(F.col("rmse") - F.col("evaluated"), STAT_DIGITS) + F.lit(0.0)).alias("difference"))
    return settled(both, written)


def linear_forecast(spark, sf):
    """M2 + M5 + M8 + P3 + P5: held-out rows scored by least squares."""
    written, train, test = _model_data(spark, sf)
    return settled(model.score(model.fit_linear(train), test, as_arrays=True), written)


def forest_forecast(spark, sf):
    """M6b + M8: held-out rows scored by the light forest."""
    written, train, test = _model_data(spark, sf)
    return settled(model.score(model.fit_forest(train, "light"), test, as_arrays=True), written)


def model_rmse(spark, sf):
    """A9 + M9: both models' RMSE on the same held-out rows, one scoring pass."""
    written, train, test = _model_data(spark, sf)
    fitted = {"linear_regression": model.fit_linear(train), "random_forest": model.fit_forest(train, "light")}
    return settled(model.compare_models(fitted, test), written)


# ---- status ------------------------------------------------------------------


def latest_run(spark, sf):
    """J1."""
    return status.latest_run(tables.run_log(spark, sf))


def job_status(spark, sf):
    """J2."""
    return status.job_status(tables.jobs(spark, sf), tables.run_log(spark, sf))


def latest_artifact(spark, sf):
    """J3."""
    return status.latest_artifact(tables.artefacts(spark, sf))


def listed_artifacts(spark, sf):
    """J3 from a real listing: a folder per order priority is written, and the
    tree listed: per prefix, whether its newest object is one of its newest
    files, and its rows, by the files found."""
    root = scratch_path(spark, "artefacts")
    tables.artefacts(spark, sf).write.partitionBy("prefix").parquet(root)
    listing = list_objects(spark, root)
    newest = status.latest_artifact(listing.select("prefix", "key", "last_modified"))
    times = listing.groupBy("prefix").agg(F.max("last_modified").alias("newest"))
    rows = spark.read.parquet(root).groupBy("prefix").agg(F.count(F.lit(1)).alias("n_rows"))
    out = newest.join(times, "prefix").select(
        F.url_decode(F.regexp_extract("prefix", "^prefix=(.*)$", 1)).alias("prefix"),
        (F.col("last_modified") == F.col("newest")).alias("is_newest"), F.col("key").endswith(".parquet").alias("is_file"),
    ).join(rows, "prefix")
    return settled(out, root)


QUERIES: dict[str, Query] = {
    "typed_from_csv": typed_from_csv,
    "typed_from_csv_stream": typed_from_csv_stream,
    "typed_dirty_csv": typed_dirty_csv,
    "ingest_v1_text": ingest_v1_text,
    "drop_missing": drop_missing,
    "missing_counts": missing_counts,
    "mean_impute": mean_impute,
    "minmax_scale": minmax_scale,
    "minmax_scale_expr": minmax_scale_expr,
    "constant_scale": constant_scale,
    "daily_totals": daily_totals,
    "describe_sales": describe_sales,
    "sales_profile": sales_profile,
    "describe_parity": describe_parity,
    "sample_rows": sample_rows,
    "monthly_sales": monthly_sales,
    "store_avg": store_avg,
    "item_sales": item_sales,
    "monthly_sales_cube": monthly_sales_cube,
    "store_avg_cube": store_avg_cube,
    "item_sales_cube": item_sales_cube,
    "sales_summaries": sales_summaries,
    "top_items": top_items,
    "monthly_series": monthly_series,
    "monthly_spine": monthly_spine,
    "correlations": correlations,
    "correlations_null_as_zero": correlations_null_as_zero,
    "demand_features": demand_features,
    "demand_features_chunked": demand_features_chunked,
    "demand_features_ranged": demand_features_ranged,
    "demand_features_hot": demand_features_hot,
    "demand_features_panel": demand_features_panel,
    "leak_free_features": leak_free_features,
    "hash_split_train": hash_split_train,
    "cutoff_split_test": cutoff_split_test,
    "exact_split": exact_split,
    "random_split": random_split,
    "random_split_sizes": random_split_sizes,
    "random_split_check": random_split_check,
    "linear_gram": linear_gram,
    "linear_normal_equations": linear_normal_equations,
    "linear_check": linear_check,
    "score_check": score_check,
    "forest_check": forest_check,
    "tuned_forest_check": tuned_forest_check,
    "rmse_check": rmse_check,
    "linear_forecast": linear_forecast,
    "forest_forecast": forest_forecast,
    "model_rmse": model_rmse,
    "latest_run": latest_run,
    "job_status": job_status,
    "latest_artifact": latest_artifact,
    "listed_artifacts": listed_artifacts,
}
