"""Surrogate keys of the fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import floor_to_quarter_hour, second_of_day
from ..functions.typing import clock

# A dimension is broadcast only while its size, as Catalyst estimates it, stays
# below this; a larger one is joined by shuffle, where AQE splits hot keys.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def estimated_bytes(frame: DataFrame) -> int:
    plan = frame._jdf.queryExecution().optimizedPlan()
    return int(plan.stats().sizeInBytes())


def broadcast_if_small(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if estimated_bytes(frame) <= BROADCAST_LIMIT_BYTES else frame


def with_time_keys(
    readings: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    floor: bool = False,
) -> DataFrame:
    """Add ``start_date_id`` and ``start_time_id`` of ``start_time``.

    Readings stay on the left of both joins, so every one is kept: a day
    outside the calendar or a start that is not on a quarter hour gets a NULL
    key. With ``floor`` the time is looked up for the quarter hour it lies in.

    A start matches a quarter hour if both read the same as ``HH:mm:ss``. That
    is compared as a number of seconds, which spares a text per reading.
    """
    start = F.col("start_time")
    moment = floor_to_quarter_hour(start) if floor else start
    date_keys = dates.select("date", F.col("date_id").alias("start_date_id"))
    time_keys = times.select(
        (F.col("hour") * 3600 + F.col("minute") * 60).cast("int").alias("_second"),
        F.col("time_quarter_id").alias("start_time_id"),
    )
    return (
        readings.withColumn("date", start.cast("date"))
        .withColumn("_second", second_of_day(moment))
        .join(broadcast_if_small(date_keys), "date", "left")
        .join(broadcast_if_small(time_keys), "_second", "left")
        .drop("date", "_second")
    )


def union_readings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; duplicates stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def generation_fact_rows(
    readings: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    now: Column | None = None,
    floor: bool = False,
) -> DataFrame:
    # The columns of the fact.
    return with_time_keys(readings, dates, times, floor).select(
        "start_date_id",
        "start_time_id",
        "datasetId",
        "value_mwh",
        "bronze_ingestion_timestamp",
        clock(now).alias("gold_processed_timestamp"),
    )


def consumption_fact_rows(
    readings: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    now: Column | None = None,
    floor: bool = False,
) -> DataFrame:
    # The columns of the fact.
    return with_time_keys(readings, dates, times, floor).select(
        "start_date_id",
        "start_time_id",
        "datasetId",
        "consumption_mwh",
        "time_series_type",
        "resolution",
        "customer_type",
        "reading_count",
        "json_value",
        "bronze_ingestion_timestamp",
        clock(now).alias("gold_processed_timestamp"),
    )


def customer_type_rows(readings: DataFrame) -> DataFrame:
    return readings.select("customer_type", "bronze_ingestion_timestamp")


def unmatched_counts(fact_rows: DataFrame) -> DataFrame:
    """How many rows found no date or no time, next to all rows."""
    return fact_rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("start_date_id").isNull()).alias("n_no_date"),
        F.count_if(F.col("start_time_id").isNull()).alias("n_no_time"),
    )
