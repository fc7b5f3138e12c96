"""Text-to-type casts (P1) with the bad-text and NaN rules pinned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """NaN is not null to ``isNull``/``avg``; turn it into null right away."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def typed_column(name: str, type_name: str) -> Column:
    """``try_cast`` so unparsable text becomes null instead of failing the job.

    Floating-point targets also map NaN (including the text ``"NaN"``) to null.
    """
    c = F.col(name).try_cast(type_name)
    if type_name in ("float", "double"):
        c = nan_to_null(c)
    return c.alias(name)
