"""Control table: which datasets to load, and from when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.typing import clock, iso_text
from ..schemas import CONTROL
from ..sources.tables import literal_rows

# Defaults of the optional columns.
DEFAULT_PAGE_SIZE = 5000
DEFAULT_INCREMENT_DAYS = 1

REQUIRED = (
    "source_system",
    "source_dataset_id",
    "source_dataset_name",
    "target_container",
    "target_folder",
)

# First rows of an environment, with columns SEED_COLUMNS.
SEED_COLUMNS = {
    "source_dataset_id": "int",
    "source_dataset_name": "string",
    "last_timestamp": "timestamp",
    "refresh_timestamp": "timestamp",
    "target_container": "string",
    "page_size": "int",
    "load_increment_days": "int",
}
SEED_ROWS = [
    (358, "Electricity consumption", "2025-01-01T00:00:00", "2025-05-17T11:54:00", "landing", 1000, 20),
    (248, "Solar power generation", "2025-01-01T00:00:00", "2025-05-17T11:50:00", "landing", 1000, 20),
    (245, "Wind power generation", "2025-01-01T00:00:00", "2025-05-17T11:58:00", "landing", 1000, 20),
]


def default_seed(spark: SparkSession, source_system: str = "grid operator") -> DataFrame:
    """The three first datasets; the folder follows from the dataset name."""
    rows = literal_rows(spark, SEED_ROWS, **SEED_COLUMNS)
    return rows.select(
        F.lit(source_system).alias("source_system"),
        "*",
        F.replace(F.lower("source_dataset_name"), F.lit(" "), F.lit("_")).alias("target_folder"),
    )


def _required(name: str) -> Column:
    column = F.col(name)
    return F.when(column.isNull(), F.raise_error(F.lit(f"{name} must not be NULL"))).otherwise(column)


def _or_default(rows: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in rows.columns else default


def with_defaults(rows: DataFrame, environment: str, now: Column | None = None) -> DataFrame:
    """New control rows without id: required columns checked, defaults filled."""
    defaults = {
        "last_timestamp": F.lit(None),
        "refresh_timestamp": F.lit(None),
        "page_size": F.lit(DEFAULT_PAGE_SIZE),
        "load_increment_days": F.lit(DEFAULT_INCREMENT_DAYS),
        "environment": F.lit(environment),
        "created_date": clock(now),
        "is_active": F.lit(True),
    }
    columns = []
    for field in CONTROL.fields[1:]:
        value = _required(field.name) if field.name in REQUIRED else _or_default(
            rows, field.name, defaults[field.name]
        )
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def bootstrap(
    existing: DataFrame,
    seed: DataFrame,
    environment: str,
    now: Column | None = None,
) -> DataFrame:
    """Existing rows, and the seed if the environment has none yet.

    New ids lie above all given ones. As with any identity column they are
    unique and may have gaps, which spares a global numbering.
    """
    known = existing.where(F.col("environment") == environment).agg(F.count(F.lit(1))).scalar()
    fresh = with_defaults(seed, environment, now).where(known == 0)
    highest = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    numbered = fresh.withColumn("id", highest + 1 + F.monotonically_increasing_id())
    return existing.unionByName(numbered.select(*CONTROL.fieldNames()))


def active_datasets(control: DataFrame, environment: str) -> DataFrame:
    """What to load next in this environment; the watermark as ISO text."""
    return control.where(F.col("is_active") & (F.col("environment") == environment)).select(
        "source_dataset_id",
        "source_dataset_name",
        iso_text("last_timestamp").alias("last_timestamp"),
        "target_folder",
        "load_increment_days",
        "page_size",
    )


def advance_watermark(control: DataFrame, marks: DataFrame) -> DataFrame:
    """Control rows with newer marks applied, matched by dataset and environment.

    ``marks`` has source_dataset_id, environment and mark: the run time for
    every loaded dataset, or the end of its newest reading.
    """
    newest = marks.groupBy("source_dataset_id", "environment").agg(F.max("mark").alias("_mark"))
    return (
        control.join(newest, ["source_dataset_id", "environment"], "left")
        .withColumn("last_timestamp", F.coalesce("_mark", "last_timestamp"))
        .select(*CONTROL.fieldNames())
    )
