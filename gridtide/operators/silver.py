"""Typed readings: one transformation per kind of dataset."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Dataset
from ..functions.typing import clock, to_typed

log = logging.getLogger(__name__)

Transformation = Callable[..., DataFrame]

# Silver column, field of the JSON text, type.
JSON_ATTRIBUTES = (
    ("time_series_type", "TimeSeriesType", "string"),
    ("resolution", "Res", "string"),
    ("unit_of_measure", "Uom", "string"),
    ("customer_type", "CustomerType", "string"),
    ("read_timestamp", "ReadTS", "timestamp"),
    ("json_value", "Value", "double"),
    ("reading_count", "Count", "bigint"),
)
JSON_SCHEMA = T.StructType([T.StructField(field, T.StringType()) for _, field, _ in JSON_ATTRIBUTES])


def _typed_reading(value_name: str) -> list[Column]:
    return [
        F.col("datasetId"),
        to_typed("startTime", "timestamp").alias("start_time"),
        to_typed("endTime", "timestamp").alias("end_time"),
        to_typed("value", "double").alias(value_name),
    ]


def _stamps(now: Column | None) -> list[Column]:
    return [
        F.col("ingestion_timestamp").alias("bronze_ingestion_timestamp"),
        clock(now).alias("silver_processed_timestamp"),
    ]


def generation(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Flat wind and solar readings."""
    return bronze.select(*_typed_reading("value_mwh"), *_stamps(now))


def consumption(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Consumption readings with their JSON attributes as columns."""
    parsed = bronze.withColumn("attributes", F.from_json("additionalJson", JSON_SCHEMA))
    flattened = [
        to_typed(f"attributes.{field}", type_name).alias(name)
        for name, field, type_name in JSON_ATTRIBUTES
    ]
    return parsed.select(*_typed_reading("consumption_mwh"), *flattened, *_stamps(now))


# Dataset ids of wind, solar and consumption readings.
WIND, SOLAR, CONSUMPTION = 245, 248, 358
TRANSFORMATIONS: Mapping[int, Transformation] = {
    WIND: generation,
    SOLAR: generation,
    CONSUMPTION: consumption,
}


def dispatch(
    datasets: Iterable[Dataset],
    transformations: Mapping[int, Transformation] = TRANSFORMATIONS,
) -> list[tuple[Dataset, Transformation]]:
    """Pair each dataset with its transformation; one without is skipped."""
    pairs = []
    for dataset in datasets:
        if dataset.id in transformations:
            pairs.append((dataset, transformations[dataset.id]))
        else:
            log.warning("no transformation for dataset %s (%s), skipped", dataset.id, dataset.name)
    return pairs
