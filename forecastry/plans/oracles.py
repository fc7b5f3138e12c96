"""DuckDB SQL oracles for the registered queries.

The supplied tables are views named after themselves.  Traps handled here:
DuckDB's ``year``/``month``/``dayofweek`` return BIGINT and ``dayofweek`` is
0 = Sunday (Spark: 1 = Sunday); the test tables' timestamps are cast to
DATE; REAL arithmetic stays REAL in DuckDB, so scaling is done in DOUBLE.
The model and random-split queries have no row oracle; their ``_check``
queries return invariants (key counts, changes by a reload, differences between
two ways) that are literals here, next to counts and sums that DuckDB computes
from the data.  ``linear_gram`` is computed from data throughout.
"""

from __future__ import annotations

from forecastry.schema import FEATURE_COLUMNS

PANEL = """
panel AS (
    SELECT CAST(l_suppkey AS INTEGER) AS store,
           CAST(l_partkey AS INTEGER) AS item,
           CAST(l_shipdate AS DATE) AS "date",
           CAST(sum(l_quantity) AS REAL) AS sales
    FROM lineitem
    GROUP BY 1, 2, 3
)"""

HISTORY = PANEL.replace("l_partkey", "l_linenumber")

# a third of all rows in one series
HOT = HISTORY.replace("panel AS", "whole AS") + """, panel AS (
    SELECT CASE WHEN hot THEN 1 ELSE store END AS store, CASE WHEN hot THEN 1 ELSE item END AS item, "date", sales
    FROM (SELECT *, (store + item + dayofmonth("date")) % 3 = 0 AS hot FROM whole)
)"""

HOLES = """
holes AS (
    SELECT store, item, "date",
           CASE WHEN (store * 7 + item * 3 + dayofmonth("date")) % 11 = 0
                THEN CAST(NULL AS REAL) ELSE sales END AS sales
    FROM panel
)"""

IMPUTED = """
imputed AS (
    SELECT store, item, "date",
           coalesce(sales, CAST((SELECT avg(sales) FROM holes) AS REAL)) AS sales
    FROM holes
)"""


DIRTY = """
dirty AS (
    SELECT store, item, "date", sales,
           CASE (store * 5 + item) % 17 WHEN 0 THEN 'abc' WHEN 1 THEN 'NaN' WHEN 2 THEN ''
                ELSE CAST(sales AS VARCHAR) END AS sales_text
    FROM holes
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SALES = _with(PANEL)
HOLED = _with(PANEL, HOLES)
CLEAN = _with(PANEL, HOLES, IMPUTED)

_SCALED = """
SELECT store, item, "date", sales,
       CAST((CAST(sales AS DOUBLE) - m.lo) / (m.hi - m.lo) AS REAL) AS sales_scaled_value
FROM imputed,
     (SELECT CAST(min(sales) AS DOUBLE) AS lo, CAST(max(sales) AS DOUBLE) AS hi FROM imputed) AS m
"""

_MONTHLY = """
SELECT CAST(year("date") AS INTEGER) AS year,
       CAST(month("date") AS INTEGER) AS month,
       sum(sales) AS total_sales
FROM panel
GROUP BY 1, 2
"""


def _features(frame: str, panel: str = HISTORY) -> str:
    return _with(panel, HOLES, IMPUTED) + f"""
SELECT store, item, "date", sales,
       CAST(year("date") AS INTEGER) AS year,
       CAST(month("date") AS INTEGER) AS month,
       CAST(dayofweek("date") + 1 AS INTEGER) AS day_of_week,
       coalesce(lag(sales, 1) OVER (PARTITION BY store, item ORDER BY "date", sales), CAST(0 AS REAL)) AS lag_1,
       coalesce(lag(sales, 7) OVER (PARTITION BY store, item ORDER BY "date", sales), CAST(0 AS REAL)) AS lag_7,
       coalesce(avg(sales) OVER (PARTITION BY store, item ORDER BY "date", sales {frame}), 0.0) AS rolling_avg_7
FROM imputed
"""


def _nulls(col: str) -> str:
    return f"CAST(count_if({col} IS NULL) AS BIGINT)"


def _stats(col: str) -> str:
    return (
        f"count({col}) AS {col}_count, round(avg({col}), 6) AS {col}_mean, "
        f"round(stddev_samp({col}), 6) AS {col}_stddev, min({col}) AS {col}_min, max({col}) AS {col}_max"
    )


def _corr(a: str, b: str, zero: bool) -> str:
    x, y = (f"coalesce({a}, 0)", f"coalesce({b}, 0)") if zero else (a, b)
    return f"round(corr({x}, {y}), 9) AS corr_{a}_{b}"


def _corrs(zero: bool) -> str:
    return ", ".join(_corr(a, b, zero) for a, b in (("store", "item"), ("store", "sales"), ("item", "sales")))


LATEST_RUN = """
SELECT job, started_on, run_id, status, exec_seconds
FROM (
    SELECT user_id AS job, ts AS started_on, event_id AS run_id,
           event_type AS status, value AS exec_seconds,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
    FROM events
) WHERE rn = 1
"""

# the 70 % side of the key-hash split, and the columns least squares fits
TRAIN_SIDE = """(CAST('0x' || substr(md5(CAST(store AS VARCHAR) || '|' || CAST(item AS VARCHAR) || '|'
                || CAST("date" AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 70)"""
FITTED = ("intercept", *FEATURE_COLUMNS)
TRAILING = "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
HISTORY_SALES = _with(HISTORY, HOLES, IMPUTED)


def _train_features() -> str:
    """The train side of the features, columns as doubles, and a constant."""
    as_doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS)
    return f"(SELECT CAST(1 AS DOUBLE) AS intercept, {as_doubles}, CAST(sales AS DOUBLE) AS label FROM ({_features(TRAILING)}) WHERE {TRAIN_SIDE})"


def _gram() -> str:
    pairs = [(a, b) for k, a in enumerate(FITTED) for b in FITTED[k:]] + [(a, "label") for a in FITTED]
    one = ", ".join(
        f"{{a: '{a}', b: '{b}', total: CAST(round(sum(CAST({a} * {b} AS DECIMAL(36,12))), 2) AS DOUBLE)}}" for a, b in pairs
    )
    return f"SELECT unnest([{one}], recursive := true) FROM {_train_features()}"


def _residuals() -> str:
    """0 for each column that varies among the train rows: what least squares gives."""
    columns = ["0.0::DOUBLE AS r_intercept"]
    columns += [f"CASE WHEN min({c}) < max({c}) THEN 0.0::DOUBLE END AS r_{c}" for c in FEATURE_COLUMNS]
    return f"SELECT count(*) AS n_train, {', '.join(columns)} FROM {_train_features()}"


FOREST_CHECK = HISTORY_SALES + f"""SELECT count(*) AS n_test, count(*) AS n_keys, CAST(0 AS BIGINT) AS outside_train_range,
       true AS rmse_below_deviation, CAST(0 AS BIGINT) AS changed_by_reload FROM imputed WHERE NOT {TRAIN_SIDE}"""

ORACLES: dict[str, str] = {
    "constant_scale": SALES + 'SELECT store, item, "date", CAST(7 AS REAL) AS sales, CAST(0.5 AS REAL) AS sales_scaled_value FROM panel',
    "daily_totals": _with(HISTORY) + 'SELECT store, item, "date", sales FROM panel',
    "monthly_spine": SALES
    + """, totals AS (
    SELECT item, CAST(date_trunc('month', "date") AS DATE) AS month_start, sum(sales) AS total_sales
    FROM panel WHERE "date" IS NOT NULL GROUP BY 1, 2
), spine AS (
    SELECT item, CAST(unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)) AS DATE) AS month_start
    FROM totals GROUP BY item
)
SELECT item, CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month, month_start,
       coalesce(total_sales, 0.0::DOUBLE) AS total_sales
FROM spine LEFT JOIN totals USING (item, month_start)""",
    "exact_split": SALES
    + """SELECT store, item, "date", sales, CASE WHEN n <= round_even(0.8 * count(*) OVER (), 0) THEN 'train' ELSE 'test' END AS split
FROM (
    SELECT *, row_number() OVER (ORDER BY CAST('0x' || substr(md5('42|' || CAST(store AS VARCHAR) || '|' || CAST(item AS VARCHAR)
           || '|' || CAST("date" AS VARCHAR)), 1, 15) AS BIGINT)) AS n
    FROM panel
)""",
    "listed_artifacts": "SELECT o_orderpriority AS prefix, true AS is_newest, true AS is_file, count(*) AS n_rows FROM orders GROUP BY 1",
    "typed_from_csv": HOLED + 'SELECT "date", store, item, sales FROM holes',
    "typed_from_csv_stream": HOLED + 'SELECT "date", store, item, sales FROM holes',
    "typed_dirty_csv": _with(PANEL, HOLES, DIRTY)
    + """SELECT "date", store, item, CASE WHEN (store * 5 + item) % 17 <= 2 THEN NULL ELSE sales END AS sales
FROM dirty""",
    "ingest_v1_text": _with(PANEL, HOLES, DIRTY)
    + """SELECT CAST("date" AS VARCHAR) AS "date", CAST(store AS VARCHAR) AS store, CAST(item AS VARCHAR) AS item,
       sales_text AS sales FROM dirty WHERE sales_text <> ''""",
    "drop_missing": HOLED + "SELECT * FROM holes WHERE sales IS NOT NULL",
    "missing_counts": HOLED
    + f"""SELECT {_nulls("store")} AS store, {_nulls("item")} AS item,
       {_nulls('"date"')} AS "date", {_nulls("sales")} AS sales FROM holes""",
    "mean_impute": CLEAN + "SELECT * FROM imputed",
    "minmax_scale": CLEAN + _SCALED,
    "minmax_scale_expr": CLEAN + _SCALED,
    "describe_sales": HOLED
    + """SELECT count(*) AS n_rows, count(sales) AS "count", round(avg(sales), 6) AS mean,
       round(stddev_samp(sales), 6) AS stddev, min(sales) AS "min", max(sales) AS "max" FROM holes""",
    "sales_profile": HOLED
    + f"""SELECT count(*) AS n_rows,
       {_nulls("store")} AS nulls_store, {_nulls("item")} AS nulls_item,
       {_nulls('"date"')} AS nulls_date, {_nulls("sales")} AS nulls_sales,
       {_stats("sales")}, {_stats("store")}, {_stats("item")},
       {_corrs(True)}
FROM holes""",
    "monthly_sales": SALES + _MONTHLY + "ORDER BY year, month",
    "store_avg": SALES
    + "SELECT store, avg(sales) AS avg_sales FROM panel GROUP BY store ORDER BY avg_sales DESC, store",
    "item_sales": SALES
    + "SELECT item, sum(sales) AS total_sales FROM panel GROUP BY item ORDER BY total_sales DESC, item",
    "monthly_sales_cube": SALES + _MONTHLY + "ORDER BY year, month",
    "store_avg_cube": SALES
    + "SELECT store, avg(sales) AS avg_sales FROM panel GROUP BY store ORDER BY avg_sales DESC, store",
    "item_sales_cube": SALES
    + "SELECT item, sum(sales) AS total_sales FROM panel GROUP BY item ORDER BY total_sales DESC, item",
    "top_items": SALES
    + """SELECT CAST(item AS VARCHAR) AS item, total_sales FROM (
    SELECT item, sum(sales) AS total_sales FROM panel GROUP BY item
    ORDER BY total_sales DESC, item LIMIT 10)""",
    "monthly_series": SALES
    + f"SELECT *, make_date(year, month, 1) AS month_start FROM ({_MONTHLY}) ORDER BY month_start",
    "correlations": SALES + f"SELECT {_corrs(False)} FROM panel",
    "correlations_null_as_zero": HOLED + f"SELECT {_corrs(True)} FROM holes",
    "demand_features": _features(TRAILING),
    "demand_features_chunked": _features(TRAILING),
    "demand_features_ranged": _features(TRAILING),
    "demand_features_hot": _features(TRAILING, HOT),
    "demand_features_panel": _features(TRAILING, PANEL),
    "leak_free_features": _features("ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING"),
    "hash_split_train": SALES
    + """SELECT * FROM panel
WHERE CAST('0x' || substr(md5(CAST(store AS VARCHAR) || '|' || CAST(item AS VARCHAR) || '|'
                              || CAST("date" AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80""",
    "cutoff_split_test": SALES + """SELECT * FROM panel WHERE "date" >= DATE '2000-01-01' OR "date" IS NULL""",
    "sales_summaries": SALES
    + """SELECT 'month' AS summary, strftime("date", '%Y-%m') AS key, sum(sales) AS total_sales, avg(sales) AS avg_sales
FROM panel GROUP BY 2
UNION ALL SELECT 'store', CAST(store AS VARCHAR), sum(sales), avg(sales) FROM panel GROUP BY 2
UNION ALL SELECT 'item', CAST(item AS VARCHAR), sum(sales), avg(sales) FROM panel GROUP BY 2""",
    "sample_rows": HOLED + 'SELECT * FROM holes ORDER BY "date", store, item LIMIT 5',
    "describe_parity": HOLED
    + " UNION ALL ".join(
        f"SELECT '{name}' AS summary, "
        + ", ".join(f"round(CAST({fn.format(c)} AS DOUBLE), 6) AS {c}" for c in ("sales", "store", "item"))
        + " FROM holes"
        for name, fn in (("count", "count({})"), ("mean", "avg({})"), ("stddev", "stddev_samp({})"),
                         ("min", "min({})"), ("max", "max({})"))
    ),
    "random_split_check": SALES
    + """SELECT r.split, count(*) AS n_rows, CAST(0 AS BIGINT) AS on_both_sides, CAST(0 AS BIGINT) AS on_neither_side,
       true AS share_as_expected
FROM panel, (VALUES ('80/20'), ('70/30')) AS r(split) GROUP BY r.split""",
    "linear_gram": _gram(),
    "linear_normal_equations": _residuals(),
    "linear_check": HISTORY_SALES
    + f"""SELECT count(*) AS n_test, true AS rmse_below_deviation, CAST(0 AS BIGINT) AS changed_by_reload,
       CAST(0 AS BIGINT) AS off_the_aggregate FROM imputed WHERE NOT {TRAIN_SIDE}""",
    "score_check": HISTORY_SALES
    + f"""SELECT count(*) AS n_rows, count(DISTINCT (store, item, "date")) AS n_keys,
       CAST(round(sum(CAST(CAST(sales AS DOUBLE) AS DECIMAL(28,8))), 2) AS DOUBLE) AS actual_sales,
       CAST(0 AS BIGINT) AS off_the_coefficients FROM imputed WHERE NOT {TRAIN_SIDE}""",
    "rmse_check": """SELECT * FROM (VALUES ('linear_regression', 0.0::DOUBLE), ('random_forest', 0.0::DOUBLE)) AS r(model, difference)""",
    "forest_check": FOREST_CHECK,
    "tuned_forest_check": FOREST_CHECK,
    "latest_run": LATEST_RUN,
    "job_status": f"""
WITH latest AS ({LATEST_RUN})
SELECT c.c_custkey AS job,
       CASE WHEN l.job IS NULL THEN 'No Runs Found' ELSE coalesce(l.status, 'N/A') END AS status,
       l.started_on, l.exec_seconds
FROM customer AS c LEFT JOIN latest AS l ON c.c_custkey = l.job
""",
    "latest_artifact": """
SELECT prefix, key, last_modified
FROM (
    SELECT o_orderpriority AS prefix, o_orderkey AS key, o_orderdate AS last_modified,
           row_number() OVER (PARTITION BY o_orderpriority
                              ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn
    FROM orders
) WHERE rn = 1
""",
}
