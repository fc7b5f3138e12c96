"""Demand features: F1-F3, W1-W3, N3, P2 (rules X5, X10, X11).

One window spec, ``partitionBy(store, item).orderBy(date)``; Catalyst merges
the three window expressions into ONE Window over ONE sort after ONE hash
exchange on (store, item).

Scale: volume mostly adds series, which the hash exchange spreads over tasks.  A
series that alone holds more than its share of all rows is cut into chunks at
quantiles of its own rows (:func:`series_chunks`): a chunk number is an expression
of the row and of fixed cuts, so it is the same whenever a task runs again, the
rows are shuffled once, and a window task holds a chunk and a 7-row halo.
:func:`demand_features_chunked` cuts every series at dates instead, and
:func:`daily_totals` makes keys unique (X12) with a partially aggregated group-by.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastry.functions.calendar import calendar_columns
from forecastry.operators.clean import fill_zero
from forecastry.schema import HISTORY_COLUMNS, KEY_COLUMNS, LONG_LAG, ROLLING_ROWS, SEED, SHORT_LAG

#: Pieces that all rows together are cut into, for every shuffle partition: a
#: series of more than one piece's rows is cut.  So fine that hashing the pieces
#: to partitions loads them evenly.
PIECES_PER_PARTITION = 16
#: Rows of a piece at least: smaller ones are not worth a halo.
LEAST_ROWS = 10_000
SAMPLES_PER_PIECE = 8


def series_window():
    """Rows of one (store, item) series in date order.

    ``sales`` breaks ties (X12): with a repeated (store, item, date) key the
    remaining ties carry equal sales, so every lag and rolling mean is
    deterministic; with unique keys it changes nothing.
    """
    return Window.partitionBy("store", "item").orderBy("date", "sales")


def daily_totals(df: DataFrame) -> DataFrame:
    """One row per (store, item, date), duplicate rows summed.

    Every other column keeps its least value per key, so the schema does not
    depend on the choice.  The partial aggregate combines repeats before the
    shuffle.
    """
    rest = [c for c in df.columns if c not in (*KEY_COLUMNS, "sales")]
    out = df.groupBy(*KEY_COLUMNS).agg(F.sum("sales").cast("float").alias("sales"), *[F.min(c).alias(c) for c in rest])
    return out.select(*df.columns)


def history_columns(leak_free: bool = False) -> dict:
    """W1-W3.  "7" counts rows, not days.

    The default rolling mean includes the current row, i.e. the label (X11);
    ``leak_free=True`` averages the 7 rows before it instead.
    """
    w = series_window()
    if leak_free:
        frame = w.rowsBetween(-ROLLING_ROWS, -1)
    else:
        frame = w.rowsBetween(-(ROLLING_ROWS - 1), Window.currentRow)
    return {
        "lag_1": F.lag("sales", SHORT_LAG).over(w),
        "lag_7": F.lag("sales", LONG_LAG).over(w),
        "rolling_avg_7": F.avg("sales").over(frame),
    }


def demand_features(
    df: DataFrame, leak_free: bool = False, pieces: int | None = None, least_rows: int = LEAST_ROWS
) -> DataFrame:
    """Calendar + lag + rolling features, missing history filled with 0.

    Series of more than 1 / ``pieces`` of all rows (and of ``least_rows``) are cut
    into chunks; the result is the same."""
    chunks = series_chunks(df, pieces, least_rows)
    if chunks is not None:
        return _features_of_chunks(chunks, df.columns, leak_free, F.col("_cuts").isNotNull())
    out = df.withColumns(calendar_columns("date", "day_of_week")).withColumns(history_columns(leak_free))
    return fill_zero(out, HISTORY_COLUMNS)


HALO_ROWS = max(LONG_LAG, ROLLING_ROWS)  # history rows any feature looks back


def demand_features_chunked(df: DataFrame, chunk_days: int = 90, leak_free: bool = False) -> DataFrame:
    """Same output as :func:`demand_features`, with no window partition larger
    than one date chunk of one series plus a 7-row halo.

    Each series is cut into ``chunk_days`` date chunks.  A chunk's halo is the
    last 7 rows (in date, sales order) before it: every chunk's own tail comes
    from a top-7-per-chunk that Spark limits map-side, and a small window over
    the per-chunk table (one row per chunk) gathers the tails of the 7
    previous non-empty chunks, which always hold the 7 rows wanted.  The
    features are then computed per (series, chunk) with the halo rows in
    front, and the halo rows are dropped.  Use it when single series are long
    enough to strain one task.
    """
    chunk = F.floor(F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")) / F.lit(chunk_days))
    return _features_of_chunks(df.withColumn("_chunk", chunk), df.columns, leak_free)


def _row_order(df: DataFrame) -> Column:
    """(date, sales, hash of the row): the order of a series, ties told apart."""
    hashed = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    return F.struct("date", "sales", F.xxhash64(*hashed).alias("tie"))


def _in_spark_order(row) -> tuple:
    """Sorts (date, sales, tie) as Spark does: nulls first, NaN last."""
    return tuple((v is not None, isinstance(v, float) and math.isnan(v), 0 if v is None or v != v else v) for v in row)


def series_cuts(df: DataFrame, pieces: int, least_rows: int) -> list[tuple]:
    """(store, item, cuts) of every series with more than 1 / ``pieces`` of all
    rows: fewer than ``pieces`` series.  Cuts are quantiles of a random sample of
    ``SAMPLES_PER_PIECE`` rows a piece, sorted."""
    sizes = df.groupBy("store", "item").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    long = sizes.where((F.col("n") * pieces > total) & (F.col("n") > least_rows)).withColumn("total", total).collect()
    if not long:
        return []
    names = df.sparkSession.createDataFrame([(r["store"], r["item"]) for r in long], df.select("store", "item").schema)
    of_long = df.alias("d").join(
        F.broadcast(names.alias("n")),  # fewer than `pieces` rows
        F.col("d.store").eqNullSafe(F.col("n.store")) & F.col("d.item").eqNullSafe(F.col("n.item")), "left_semi",
    )
    sample = of_long.select("store", "item", _row_order(df).alias("at")).orderBy(F.rand(SEED)).limit(SAMPLES_PER_PIECE * pieces).collect()
    found: dict[tuple, list] = {}
    for r in sample:
        found.setdefault((r["store"], r["item"]), []).append(tuple(r["at"]))
    out = []
    for r in long:
        rows = sorted(found.get((r["store"], r["item"]), []), key=_in_spark_order)
        k = max(2, math.ceil(min(r["n"] * pieces / r["total"], r["n"] / max(1, least_rows))))
        cuts = list(dict.fromkeys(rows[len(rows) * j // k] for j in range(1, k))) if rows else []
        if cuts:
            out.append((r["store"], r["item"], cuts))
    return out


def series_chunks(df: DataFrame, pieces: int | None = None, least_rows: int = LEAST_ROWS) -> DataFrame | None:
    """``df`` with ``_cuts`` (null for series that are not cut) and ``_chunk``, the
    number of cuts up to the row; None if no series is cut.

    Cuts lie between rows that differ.  Rows alike in every column stay in one
    chunk: :func:`daily_totals` collapses repeated keys first."""
    pieces = pieces or PIECES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = series_cuts(df, pieces, least_rows)
    if not cuts:
        return None
    levels = max(len(c) for *_, c in cuts).bit_length()
    key = ", ".join(f"`_{f.name}` {f.dataType.simpleString()}" for f in df.select("store", "item").schema)
    order = ", ".join(f"{c}: {df.schema[c].dataType.simpleString()}" for c in ("date", "sales"))
    table = df.sparkSession.createDataFrame(cuts, f"{key}, _cuts array<struct<{order}, tie: bigint>>")
    same = F.col("store").eqNullSafe(F.col("_store")) & F.col("item").eqNullSafe(F.col("_item"))
    # at most `pieces` series and two cuts a piece
    rows = df.join(F.broadcast(table), same, "left").withColumns({
        "_at": F.when(F.col("_cuts").isNotNull(), _row_order(df)), "_chunk": F.lit(0),
    })
    for step in (1 << k for k in reversed(range(levels))):  # a binary search
        reached = F.get("_cuts", F.col("_chunk") + (step - 1)) <= F.col("_at")
        rows = rows.withColumn("_chunk", F.col("_chunk") + F.when(reached, step).otherwise(0))
    return rows.select(*df.columns, "_cuts", "_chunk")


def demand_features_ranged(df: DataFrame, pieces: int, leak_free: bool = False) -> DataFrame:
    """:func:`demand_features` with series cut down to any size."""
    return demand_features(df, leak_free, pieces, least_rows=1)


def _features_of_chunks(rows: DataFrame, columns: list[str], leak_free: bool, cut: Column | None = None) -> DataFrame:
    """Features of rows whose ``_chunk`` ascends with (date, sales) in a series;
    ``cut`` tells rows of series of more than one chunk (default: all)."""
    key = ["store", "item"]
    newest_first = Window.partitionBy(*key, "_chunk").orderBy(F.desc("date"), F.desc_nulls_last("sales"))
    tails = (
        (rows if cut is None else rows.where(cut)).select(*key, "_chunk", "date", "sales")
        .withColumn("_n", F.row_number().over(newest_first))
        .filter(F.col("_n") <= HALO_ROWS)
        .groupBy(*key, "_chunk")
        .agg(F.collect_list(F.struct("date", "sales")).alias("_tail"))
    )
    earlier = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(-HALO_ROWS, -1)
    halo = (
        tails.withColumn("_before", F.flatten(F.collect_list("_tail").over(earlier)))
        .select(*key, "_chunk", F.explode(F.slice(F.sort_array("_before", asc=False), 1, HALO_ROWS)).alias("_h"))
        .select(*key, "_chunk", F.col("_h.date").alias("date"), F.col("_h.sales").alias("sales"),
                F.lit(True).alias("_halo"))
    )
    stacked = rows.drop("_cuts").withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)

    # halo rows first: they may tie with the chunk's own
    w = Window.partitionBy(*key, "_chunk").orderBy(F.desc("_halo"), "date", "sales")
    if leak_free:
        frame = w.rowsBetween(-ROLLING_ROWS, -1)
    else:
        frame = w.rowsBetween(-(ROLLING_ROWS - 1), Window.currentRow)
    history = {
        "lag_1": F.lag("sales", SHORT_LAG).over(w),
        "lag_7": F.lag("sales", LONG_LAG).over(w),
        "rolling_avg_7": F.avg("sales").over(frame),
    }
    out = (
        stacked.withColumns(history)
        .filter(~F.col("_halo"))
        .select(*columns, *history)
        .withColumns(calendar_columns("date", "day_of_week"))
    )
    ordered = [*columns, "year", "month", "day_of_week", *HISTORY_COLUMNS]
    return fill_zero(out.select(*ordered), HISTORY_COLUMNS)
