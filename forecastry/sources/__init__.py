"""Sources and sinks: raw CSV (S1), Parquet zones (S2/S3), CSV sink (S4),
model directories (S5), and the adapter from the supplied test tables."""

from forecastry.sources.listing import list_objects
from forecastry.sources.raw import read_raw_sales
from forecastry.sources.zones import (
    load_model,
    read_parquet,
    save_model,
    write_csv,
    write_parquet,
)

__all__ = [
    "list_objects",
    "read_raw_sales",
    "read_parquet",
    "write_parquet",
    "write_csv",
    "save_model",
    "load_model",
]
