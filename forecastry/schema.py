"""Column names and types of every zone of the pipeline.

Fixed values that must match the reference's data model are kept together
here, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: data model of the reference ----
# raw sales columns (header names; every value arrives as text)
RAW_COLUMNS = ("date", "store", "item", "sales")
# typed sales: column -> Spark SQL type name
TYPED_TYPES = {"store": "int", "item": "int", "sales": "float", "date": "date"}
# calendar and history features, in model order
FEATURE_COLUMNS = (
    "store", "item", "year", "month", "day_of_week", "lag_1", "lag_7", "rolling_avg_7",
)
HISTORY_COLUMNS = ("lag_1", "lag_7", "rolling_avg_7")
SCALED_COLUMN = "sales_scaled_value"
LABEL_COLUMN = "label"
# status-report wording
NO_RUNS = "No Runs Found"
NOT_AVAILABLE = "N/A"
# history features: lags in rows, trailing mean width in rows
SHORT_LAG = 1
LONG_LAG = 7
ROLLING_ROWS = 7
# splits and seeds
INGEST_SPLIT = (0.8, 0.2)
MODEL_SPLIT = (0.7, 0.3)
SEED = 42
# chart data preparation: items shown
TOP_ITEMS = 10
# folder names below the training and model zones
TRAIN_CSV, TEST_CSV = "train.csv", "test.csv"
LINEAR_MODEL, FOREST_MODEL = "linear_regression_model", "random_forest_model"
# ---- end of fixed values ----

KEY_COLUMNS = ("store", "item", "date")

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("job", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_on", T.TimestampNTZType()),
        T.StructField("exec_seconds", T.DoubleType()),
    ]
)

ARTEFACT_SCHEMA = T.StructType(
    [
        T.StructField("prefix", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("last_modified", T.TimestampNTZType()),
    ]
)


def require_columns(df, columns, what: str = "input") -> None:
    """Raise a clear error when any of ``columns`` is missing (metadata only)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required column(s) {missing}; has {df.columns}")
