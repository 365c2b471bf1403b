"""Generated dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_attributes, time_attributes
from ..sources.tables import literal_rows

# The span of the calendar.
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2050, 12, 31)

# Dataset id, what it generates, how often it is updated.
GENERATE_TYPES = [
    (248, "Solar", "15 mins"),
    (245, "Wind", "15 mins"),
]


def dim_date(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
) -> DataFrame:
    """One row per day, both ends included."""
    days = (end - start).days + 1
    # one partition: the row count is fixed by the span, 11,323 by default
    numbers = spark.range(0, days, 1, numPartitions=1)
    dates = numbers.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    attributes = calendar_attributes(F.col("date"))
    return dates.select("date", *[column.alias(name) for name, column in attributes.items()])


def dim_time(spark: SparkSession) -> DataFrame:
    """The 96 quarter hours of a day."""
    quarters = spark.range(0, 96, 1, numPartitions=1)
    attributes = time_attributes(F.col("id"))
    return quarters.select(*[column.alias(name) for name, column in attributes.items()])


def dim_generate_type(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, GENERATE_TYPES, dataset_id="bigint", generate_type="string", update_frequency="string"
    )
