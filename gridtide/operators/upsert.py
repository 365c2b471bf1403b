"""Type 1 change data: the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys and sequence columns of the gold tables.
GENERATION_KEYS = ("start_date_id", "start_time_id", "datasetId")
CONSUMPTION_KEYS = ("start_date_id", "start_time_id", "customer_type")
CUSTOMER_TYPE_KEYS = ("customer_type",)
SEQUENCE = "bronze_ingestion_timestamp"

# Set by the clock of the run, so it must not decide which row wins.
RUN_STAMPS = ("gold_processed_timestamp",)


def newest_first(columns: Sequence[str], keys: Sequence[str], sequence_by: str) -> list[Column]:
    """Total order of the rows of a key: by sequence, ties by all other columns."""
    decided = [*keys, sequence_by]
    values = [c for c in columns if c not in decided and c not in RUN_STAMPS]
    stamps = [c for c in columns if c in RUN_STAMPS and c not in decided]
    return [F.col(c).desc_nulls_last() for c in (sequence_by, *values, *stamps)]


def latest_per_key(
    changes: DataFrame,
    keys: Sequence[str] = GENERATION_KEYS,
    sequence_by: str = SEQUENCE,
) -> DataFrame:
    """One whole row per key, the one with the highest sequence.

    NULL keys count as equal and NULL values of the newest row stay NULL. The
    rank filter is planned as a group limit on both sides of the shuffle: each
    map task sends at most one row per key, so a hot key costs its reducer one
    row per task and not its whole history. Without columns besides keys and
    sequence the newest row is just the maximum, a hash aggregation.
    """
    if set(changes.columns) == {*keys, sequence_by}:
        newest = changes.groupBy(*keys).agg(F.max(sequence_by).alias(sequence_by))
        return newest.select(*changes.columns)
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*newest_first(changes.columns, keys, sequence_by))
    )
    return changes.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
