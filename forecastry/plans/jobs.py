"""Batch jobs: the reference's entry points composed from the operators.

Each job takes zone paths, reads, runs its operators and writes whole
directories (overwrite).  Compared with the reference, the jobs:

* parse the raw text once: every printed statistic, the imputation value and the
  scaling bounds are observed while the typed rows are written, and imputing and
  scaling are one projection of those;
* replace a zone only once the new one is whole (:func:`sources.zones.replacing`);
* split from a written table, so ``randomSplit`` sees a stable layout even
  when an executor is lost and a partition is recomputed;
* build the three summaries as grouping sets of one pass.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forecastry.functions.calendar import calendar_columns
from forecastry.operators import clean, features, model, profile, scale, split, status, summaries
from forecastry.schema import FOREST_MODEL, INGEST_SPLIT, LABEL_COLUMN, LINEAR_MODEL, MODEL_SPLIT, SEED, TEST_CSV, TRAIN_CSV
from forecastry.session import drop_scratch, scratch_path
from forecastry.sources import read_parquet, read_raw_sales, save_model, write_csv, write_parquet


def _split(df: DataFrame, weights, seed: int, mode: str, cutoff: str | None = None):
    if mode == "random":
        return split.random_split(df, weights, seed)
    if mode == "exact":
        return split.exact_split(df, weights[0], seed)
    if mode == "hash":
        return split.hash_split(df, int(round(weights[0] * 100)))
    if mode == "cutoff":
        if not cutoff:
            raise ValueError("split mode 'cutoff' needs a cutoff date")
        return split.cutoff_split(df, cutoff)
    raise ValueError(f"unknown split mode {mode!r}")


def _write_split(df: DataFrame, training_path: str, weights, seed: int, mode: str) -> None:
    train, test = _split(df, weights, seed, mode)
    write_csv(train, os.path.join(training_path, TRAIN_CSV))
    write_csv(test, os.path.join(training_path, TEST_CSV))


def ingest_v1(spark: SparkSession, raw_path: str, processed_path: str, training_path: str,
              seed: int = SEED, split_mode: str = "random") -> None:
    """v1 ingest: text columns, rows with any null dropped, Parquet, 80/20 CSVs."""
    cleaned = clean.drop_missing(read_raw_sales(spark, raw_path))
    write_parquet(cleaned, processed_path)
    _write_split(read_parquet(spark, processed_path), training_path, INGEST_SPLIT, seed, split_mode)


def ingest(
    spark: SparkSession,
    raw_path: str,
    processed_path: str,
    training_path: str | None = None,
    eda_path: str | None = None,
    seed: int = SEED,
    split_mode: str = "random",
    scale_method: str = "expr",
) -> dict:
    """v2 ingest: typed, profiled, mean-imputed, min-max scaled; optional split
    CSVs (``training_path``) and summary CSVs (``eda_path``, the plotting variant).

    Returns the profile as a dict (what the reference printed).
    """
    raw = read_raw_sales(spark, raw_path)
    parsed = clean.typed_sales(raw)
    staged = scratch_path(spark, "typed")
    # no shuffle, so the observation is of the write's own tasks: each counts once
    seen = Observation("ingest")
    parsed.observe(seen, *profile.profile_columns(parsed)).write.parquet(staged)
    stats = dict(seen.get)
    stats["raw_dtypes"], stats["dtypes"] = raw.dtypes, parsed.dtypes  # P7: driver metadata, no job
    try:
        if stats["sales_count"] == 0:
            raise ValueError("cannot impute 'sales': it has no non-null values")
        mean = float(stats["sales_mean"])
        typed = spark.read.parquet(staged)
        imputed = clean.impute_mean(typed, mean=mean)
        if scale_method == "expr":
            bounds = scale.imputed_bounds(stats["sales_min"], stats["sales_max"], mean, stats["nulls_sales"],
                                          typed.schema["sales"].dataType)
            processed = scale.scale_expr(imputed, bounds=bounds)
        else:
            processed = scale.minmax_scale(imputed, method=scale_method)
        write_parquet(processed, processed_path)
    finally:
        drop_scratch(spark, staged)
    stats["imputed_mean"] = mean

    written = read_parquet(spark, processed_path)
    if eda_path:
        write_summaries(written, eda_path)
    if training_path:
        _write_split(written, training_path, INGEST_SPLIT, seed, split_mode)
    return stats


def write_summaries(df: DataFrame, eda_path: str, head: int = 10) -> dict[str, list[dict]]:
    """Monthly / store / item summaries from one cube pass, written as CSV.

    Returns the first ``head`` rows of each (what the reference showed),
    taken while the cube is still cached.
    """
    # One row per month, store and item: far smaller than the sales.  A lost
    # block is recomputed from its (deterministic) aggregate.
    cube = summaries.sales_cube(df).persist()
    try:
        heads = {}
        for name, out in summaries.summaries_from_cube(cube).items():
            write_csv(out, os.path.join(eda_path, name))
            heads[name] = [r.asDict() for r in out.limit(head).collect()]
    finally:
        cube.unpersist()
    return heads


def explore(spark: SparkSession, processed_path: str, eda_path: str) -> dict:
    """EDA job: one profile aggregate, one grouping-sets pass, three ordered CSV summaries."""
    df = read_parquet(spark, processed_path).withColumns(calendar_columns("date", "dayofweek"))
    # An aggregate, not an observation below a shuffle: a re-run map task would
    # count its rows twice there.
    stats = df.agg(*profile.profile_columns(df, stats_of=("sales",))).first().asDict()
    heads = write_summaries(df, eda_path)
    stats.update({f"{name}_head": rows for name, rows in heads.items()})
    stats["dtypes"] = df.dtypes
    stats["sample"] = [r.asDict() for r in summaries.sample_rows(df, 5).collect()]
    return stats


def build_features(spark: SparkSession, processed_path: str, features_path: str,
                   leak_free: bool = False, partition_by: list[str] | None = None,
                   unique_keys: str = "trust", chunk_days: int | None = None, pieces: int | None = None) -> None:
    """Feature job: calendar, lag and rolling features (one Window), Parquet out.

    ``partition_by`` (for example ``["year", "month"]``) lets later jobs prune
    by period; each write task then emits one file per period it holds, so on
    a long history it multiplies the file count.

    ``chunk_days`` computes the same features with each series cut into date
    chunks plus a 7-row halo, so no window task holds more than one chunk of
    one series (:func:`features.demand_features_chunked`).  Without it, series of
    more than 1 / ``pieces`` of all rows are cut at quantiles of their rows
    (:func:`features.demand_features`; by default 16 pieces a shuffle partition).

    ``unique_keys="trust"`` (the reference's behaviour) takes one row per
    (store, item, date) as given.  ``"sum"`` first collapses repeated keys with
    a partially aggregated group-by (X12), which keeps every window partition
    within one row per day even if an input repeats a key across a third of
    its rows.
    """
    df = read_parquet(spark, processed_path)
    if unique_keys == "sum":
        df = features.daily_totals(df)
    elif unique_keys != "trust":
        raise ValueError(f"unique_keys must be 'trust' or 'sum', not {unique_keys!r}")
    if chunk_days:
        feats = features.demand_features_chunked(df, chunk_days=chunk_days, leak_free=leak_free)
    else:
        feats = features.demand_features(df, leak_free=leak_free, pieces=pieces)
    write_parquet(feats, features_path, partition_by=partition_by)


def train(
    spark: SparkSession,
    features_path: str,
    predictions_path: str,
    models_path: str,
    forest: str = "tuned",
    seed: int = SEED,
    split_mode: str = "hash",
    keep_keys: bool = False,
    handle_invalid: str = "error",
    cutoff: str | None = None,
) -> dict:
    """Training job: 70/30 split, least squares + forest, forest predictions
    written with both RMSEs observed in the same pass, both models saved."""
    # split first, by key: the sides do not depend on the cluster's layout
    sides = _split(read_parquet(spark, features_path), MODEL_SPLIT, seed, split_mode, cutoff)
    train_df, test_df = (model.assemble(s, keep_keys=keep_keys, handle_invalid=handle_invalid) for s in sides)
    train_df = train_df.persist()
    try:
        lr = model.fit_linear(train_df)
        rf = model.fit_forest(train_df, forest)
    finally:
        train_df.unpersist()
    # One pass over the test rows: both models score them, both RMSEs are
    # observed while the forest's predictions are written.
    models = {"linear_regression": lr, "random_forest": rf}
    rmse = Observation("rmse")
    scored = model.predict_all(models, test_df).observe(rmse, *model.rmse_columns(list(models)))
    predictions = scored.select(
        *[c for c in test_df.columns if c != LABEL_COLUMN],
        F.col(LABEL_COLUMN).alias("actual_sales"),
        F.col("prediction_random_forest").alias("predicted_sales"),
    )
    write_parquet(predictions, predictions_path)
    report = dict(rmse.get)
    report["sample_predictions"] = [r.asDict() for r in read_parquet(spark, predictions_path).limit(5).collect()]
    save_model(lr, os.path.join(models_path, LINEAR_MODEL))
    save_model(rf, os.path.join(models_path, FOREST_MODEL))
    return report


def status_report(runs: DataFrame, jobs: DataFrame, listing: DataFrame) -> dict[str, DataFrame]:
    """Status job: every job's latest run, and the newest artefact per prefix."""
    return {"jobs": status.job_status(jobs, runs), "artefacts": status.latest_artifact(listing)}
