"""Silver -> gold."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Dataset, Layout
from ..operators import dims
from ..operators.lookups import (
    consumption_fact_rows,
    customer_type_rows,
    generation_fact_rows,
    union_readings,
)
from ..operators.upsert import CONSUMPTION_KEYS, CUSTOMER_TYPE_KEYS, GENERATION_KEYS
from ..schemas import (
    DIM_CUSTOMER_TYPE,
    FACT_CONSUMPTION,
    FACT_GENERATION,
    SILVER_CONSUMPTION,
    SILVER_GENERATION,
)
from ..sources.sliced import SlicedTable, hash_slices, month_slices
from ..sources.tables import path_exists, stream_table, write_static
from .upsert import run_upsert

CUSTOMER_TYPE_SLICES = 8

SliceRule = Callable[[str], Callable[[], Column]]


# A fact has at most 96 rows per day and dataset or customer type, so a month is
# a good unit to rewrite; day_slices suit very many customer types. A table has to
# keep the slicing it was made with.


def fact_generation_table(path: str, by: SliceRule = month_slices) -> SlicedTable:
    return SlicedTable(path, FACT_GENERATION, by("start_date_id"), GENERATION_KEYS)


def fact_consumption_table(path: str, by: SliceRule = month_slices) -> SlicedTable:
    return SlicedTable(path, FACT_CONSUMPTION, by("start_date_id"), CONSUMPTION_KEYS)


def dim_customer_type_table(path: str) -> SlicedTable:
    slicing = hash_slices(CUSTOMER_TYPE_KEYS, CUSTOMER_TYPE_SLICES)
    return SlicedTable(path, DIM_CUSTOMER_TYPE, slicing, CUSTOMER_TYPE_KEYS)


CHANGING_TABLES = {
    "fact_generation_forecast": fact_generation_table,
    "fact_consumption": fact_consumption_table,
    "dim_customer_type": dim_customer_type_table,
}

DIMENSIONS = {
    "dim_date": dims.dim_date,
    "dim_time": dims.dim_time,
    "dim_generate_type": dims.dim_generate_type,
}


def month_reach(readings: DataFrame) -> DataFrame:
    """Slices of readings by ``month_slices``, from their start alone: what ``date_id`` of the calendar comes to."""
    day = F.col("start_time").cast("date")
    inside = day.between(F.lit(dims.CALENDAR_START), F.lit(dims.CALENDAR_END))
    month = (F.year(day) * 100 + F.month(day)).cast("bigint")
    return readings.select(F.when(inside, month).otherwise(F.lit(0)).alias("slice"))


def store_dimensions(spark: SparkSession, layout: Layout) -> None:
    """Write the generated dimensions that are not there yet."""
    for name, build in DIMENSIONS.items():
        if not path_exists(spark, layout.gold(name) + "/_SUCCESS"):
            write_static(build(spark), layout.gold(name))


def stored_dimensions(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    dates = spark.read.schema(dims.dim_date(spark).schema).parquet(layout.gold("dim_date"))
    times = spark.read.schema(dims.dim_time(spark).schema).parquet(layout.gold("dim_time"))
    return dates, times


def run_fact_generation(
    spark: SparkSession,
    layout: Layout,
    datasets: Sequence[Dataset],
    now: Column | None = None,
    **limits: str,
) -> StreamingQuery:
    """All generation datasets in one stream, looked up and upserted."""
    readings = [stream_table(spark, layout.silver(d), SILVER_GENERATION, **limits) for d in datasets]
    dates, times = stored_dimensions(spark, layout)
    name = "fact_generation_forecast"
    return run_upsert(
        fact_generation_table(layout.gold(name)),
        union_readings(*readings),
        GENERATION_KEYS,
        layout.checkpoint("gold", name),
        name,
        shape=lambda batch: generation_fact_rows(batch, dates, times, now),
        reach=month_reach,
    )


def run_fact_consumption(
    spark: SparkSession,
    layout: Layout,
    dataset: Dataset,
    now: Column | None = None,
    **limits: str,
) -> StreamingQuery:
    readings = stream_table(spark, layout.silver(dataset), SILVER_CONSUMPTION, **limits)
    dates, times = stored_dimensions(spark, layout)
    name = "fact_consumption"
    return run_upsert(
        fact_consumption_table(layout.gold(name)),
        readings,
        CONSUMPTION_KEYS,
        layout.checkpoint("gold", name),
        name,
        shape=lambda batch: consumption_fact_rows(batch, dates, times, now),
        reach=month_reach,
    )


def run_dim_customer_type(
    spark: SparkSession, layout: Layout, dataset: Dataset, **limits: str
) -> StreamingQuery:
    readings = stream_table(spark, layout.silver(dataset), SILVER_CONSUMPTION, **limits)
    name = "dim_customer_type"
    return run_upsert(
        dim_customer_type_table(layout.gold(name)),
        customer_type_rows(readings),
        CUSTOMER_TYPE_KEYS,
        layout.checkpoint("gold", name),
        name,
    )
