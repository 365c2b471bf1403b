"""Raw readings as they are kept in bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typing import clock


def with_origin(landed: DataFrame, now: Column | None = None) -> DataFrame:
    """All landed fields plus the file a row came from and its arrival time."""
    # The names of the two columns and what they hold.
    return landed.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        clock(now).alias("ingestion_timestamp"),
    )
