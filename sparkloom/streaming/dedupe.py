"""Incremental exact dedupe of a stream of records."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedupe_stream(records: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """The first record of each key within the watermark's delay; state older than that is dropped."""
    return records.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
