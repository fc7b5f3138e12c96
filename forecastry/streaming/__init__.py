"""Incremental ingest with Structured Streaming.

The reference ingests in batch only.  The per-row part of its ingest (read by
header name, typed cast, optional drop-missing, Parquet out) needs no global
state, so it can also run incrementally over files landing in the raw zone.
Mean imputation and min-max scaling need whole-table statistics and stay in
the batch job (:mod:`forecastry.plans.jobs`).
"""

from forecastry.streaming.ingest import ingest_stream, raw_schema_from_header

__all__ = ["ingest_stream", "raw_schema_from_header"]
