"""Column lists of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt"
RESCUED_COLUMN = "_rescued"


def table_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, INT, LONG, REAL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
MOMENT, TRUTH = T.TimestampType(), T.BooleanType()

# Landing fields arrive as text; silver gives them their types.
LANDING = table_of(
    datasetId=TEXT,
    startTime=TEXT,
    endTime=TEXT,
    value=TEXT,
    additionalJson=TEXT,
)

BRONZE = T.StructType(
    LANDING.fields
    + table_of(
        **{CORRUPT_COLUMN: TEXT, RESCUED_COLUMN: TEXT},
        source_file=TEXT,
        ingestion_timestamp=MOMENT,
    ).fields
)

SILVER_GENERATION = table_of(
    datasetId=TEXT,
    start_time=MOMENT,
    end_time=MOMENT,
    value_mwh=REAL,
    bronze_ingestion_timestamp=MOMENT,
    silver_processed_timestamp=MOMENT,
)

SILVER_CONSUMPTION = table_of(
    datasetId=TEXT,
    start_time=MOMENT,
    end_time=MOMENT,
    consumption_mwh=REAL,
    time_series_type=TEXT,
    resolution=TEXT,
    unit_of_measure=TEXT,
    customer_type=TEXT,
    read_timestamp=MOMENT,
    json_value=REAL,
    reading_count=LONG,
    bronze_ingestion_timestamp=MOMENT,
    silver_processed_timestamp=MOMENT,
)

FACT_GENERATION = table_of(
    start_date_id=LONG,
    start_time_id=LONG,
    datasetId=TEXT,
    value_mwh=REAL,
    bronze_ingestion_timestamp=MOMENT,
    gold_processed_timestamp=MOMENT,
)

FACT_CONSUMPTION = table_of(
    start_date_id=LONG,
    start_time_id=LONG,
    datasetId=TEXT,
    consumption_mwh=REAL,
    time_series_type=TEXT,
    resolution=TEXT,
    customer_type=TEXT,
    reading_count=LONG,
    json_value=REAL,
    bronze_ingestion_timestamp=MOMENT,
    gold_processed_timestamp=MOMENT,
)

DIM_CUSTOMER_TYPE = table_of(
    customer_type=TEXT,
    bronze_ingestion_timestamp=MOMENT,
)

CONTROL = table_of(
    id=LONG,
    source_system=TEXT,
    source_dataset_id=INT,
    source_dataset_name=TEXT,
    last_timestamp=MOMENT,
    refresh_timestamp=MOMENT,
    target_container=TEXT,
    target_folder=TEXT,
    page_size=INT,
    load_increment_days=INT,
    environment=TEXT,
    created_date=MOMENT,
    is_active=TRUTH,
)
