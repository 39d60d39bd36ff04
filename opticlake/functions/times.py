"""Run time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticlake.functions.text import _col


def iso_utc(ts: str | Column) -> Column:
    """Epoch seconds as `2026-01-14T09:30:00Z`; needs the UTC session zone."""
    return F.date_format(F.timestamp_seconds(_col(ts)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_time_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    at = F.timestamp_seconds(F.col(ts))
    return df.withColumns({
        "collection_timestamp": iso_utc(ts),
        "dt": F.date_format(at, "yyyy-MM-dd"),
        "hr": F.date_format(at, "HH"),
    })
