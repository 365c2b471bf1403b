"""Every operator as a query over the given tables, with the SQL that gives the
same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Dataset, Layout
from ..functions.calendar import floor_to_quarter_hour, time_of_day_text
from ..functions.typing import clock
from ..functions.units import distance_km
from ..operators import control, dims, explore, lookups, quality, silver, windows
from ..operators.bronze import with_origin
from ..operators.upsert import CONSUMPTION_KEYS, CUSTOMER_TYPE_KEYS, GENERATION_KEYS, latest_per_key
from ..schemas import BRONZE, CONTROL, RESCUED_COLUMN, SILVER_CONSUMPTION, SILVER_GENERATION
from ..session import join_path, pin, work_folder
from ..sources.landing import dataset_key, read_landing, write_landing, write_whole_records
from ..sources.paged import fields_of, read_windows
from ..sources.tables import delete_folder, empty_table, ensure_folder, folder_entries, read_table, stream_table, write_static
from ..streaming.bronze import RULE_COUNTS, run_bronze
from ..streaming.gold import (
    dim_customer_type_table,
    fact_consumption_table,
    fact_generation_table,
    store_dimensions,
    stored_dimensions,
)
from ..streaming.metrics import MetricsTable, ObservedCounts
from ..streaming.runs import batch_run, finish
from ..streaming.silver import run_silver
from ..streaming.upsert import run_upsert
from . import change_queries  # noqa: F401  registers its queries
from .pipeline import (
    NEWEST_READING,
    RUN_TIME,
    control_table,
    ensure_control,
    gold_tables,
    land,
    marks_of,
    run_pipeline,
)
from .feeds import (
    EVENT_DATASETS,
    dataset_id_of,
    end_of_events,
    event_control,
    event_feed,
    event_pages,
    order_feed,
    table,
)
from .registry import CATALOG, query, sql_latest  # noqa: F401

# --- pieces of SQL ---------------------------------------------------------------

SQL_DATASET_ID = (
    "CASE event_type WHEN 'click' THEN 245 WHEN 'view' THEN 248 WHEN 'purchase' THEN 358 "
    "WHEN 'signup' THEN 101 WHEN 'error' THEN 102 END"
)
SQL_K = "json_extract_string(props, '$.k')"
SQL_END = "ts + INTERVAL 15 MINUTE"

SQL_GENERATION = f"""
    SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time,
           {SQL_END} AS end_time, value AS value_mwh, ts AS bronze_ingestion_timestamp
    FROM events"""
SQL_ORDER_GENERATION = """
    SELECT o_orderpriority AS "datasetId", o_orderdate AS start_time,
           o_orderdate + INTERVAL 15 MINUTE AS end_time, o_totalprice AS value_mwh,
           o_orderdate AS bronze_ingestion_timestamp
    FROM orders"""
SQL_UNION = f"{SQL_GENERATION} UNION ALL {SQL_ORDER_GENERATION}"
SQL_CONSUMPTION = f"""
    SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time,
           {SQL_END} AS end_time, value AS consumption_mwh, event_type AS time_series_type,
           'PT15M' AS resolution, 'MWh' AS unit_of_measure, {SQL_K} AS customer_type,
           ts AS read_timestamp, value AS json_value, CAST({SQL_K} AS BIGINT) AS reading_count,
           ts AS bronze_ingestion_timestamp
    FROM events"""

SQL_DATE_ID = (
    "CASE WHEN CAST(start_time AS DATE) BETWEEN DATE '2020-01-01' AND DATE '2050-12-31' "
    "THEN CAST(strftime(start_time, '%Y%m%d') AS BIGINT) END"
)
SQL_FLOORED_TIME_ID = "hour(start_time) * 4 + minute(start_time) // 15"
SQL_TIME_ID = (
    f"CASE WHEN minute(start_time) % 15 = 0 AND second(start_time) = 0 "
    f"THEN {SQL_FLOORED_TIME_ID} END"
)


def sql_generation_fact(time_id: str) -> str:
    return f"""
    SELECT {SQL_DATE_ID} AS start_date_id, {time_id} AS start_time_id, "datasetId", value_mwh,
           bronze_ingestion_timestamp
    FROM ({SQL_UNION})"""


SQL_CONSUMPTION_FACT = f"""
    SELECT {SQL_DATE_ID} AS start_date_id, {SQL_FLOORED_TIME_ID} AS start_time_id, "datasetId",
           consumption_mwh, time_series_type, resolution, customer_type, reading_count,
           json_value, bronze_ingestion_timestamp
    FROM ({SQL_CONSUMPTION})"""


SQL_FACT_GENERATION = sql_latest(
    sql_generation_fact(SQL_FLOORED_TIME_ID),
    GENERATION_KEYS,
    "bronze_ingestion_timestamp",
    "value_mwh",
)
SQL_FACT_CONSUMPTION = sql_latest(
    SQL_CONSUMPTION_FACT,
    CONSUMPTION_KEYS,
    "bronze_ingestion_timestamp",
    "datasetId consumption_mwh time_series_type resolution reading_count json_value",
)
SQL_DIM_CUSTOMER_TYPE = f"""
    SELECT {SQL_K} AS customer_type, max(ts) AS bronze_ingestion_timestamp
    FROM events GROUP BY 1"""
SQL_DIM_DATE = """
    SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, year(d) AS year,
           month(d) AS month, day(d) AS day, quarter(d) AS quarter, dayname(d) AS day_name,
           monthname(d) AS month_name, isodow(d) AS day_of_week, dayofyear(d) AS day_of_year,
           weekofyear(d) AS week_of_year, concat(year(d), '-Q', quarter(d)) AS year_quarter,
           strftime(d, '%Y-%m') AS year_month,
           CAST(isodow(d) <= 5 AS BIGINT) AS is_weekday,
           CAST(isodow(d) > 5 AS BIGINT) AS is_weekend,
           CAST(day(d) = 1 AS BIGINT) AS is_month_start,
           CAST(d = last_day(d) AS BIGINT) AS is_month_end,
           CAST(day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS BIGINT) AS is_quarter_start,
           CAST(day(d) = 1 AND month(d) = 1 AS BIGINT) AS is_year_start,
           CAST(day(d) = 31 AND month(d) = 12 AS BIGINT) AS is_year_end
    FROM (SELECT CAST(x AS DATE) AS d
          FROM generate_series(DATE '2020-01-01', DATE '2050-12-31', INTERVAL 1 DAY) AS s(x))"""
SQL_DIM_TIME = """
    SELECT q AS time_quarter_id, q // 4 AS hour, q % 4 AS quarter_of_hour,
           q % 4 * 15 AS minute, printf('%02d:%02d:00', q // 4, q % 4 * 15) AS time_15min
    FROM (SELECT CAST(x AS BIGINT) AS q FROM range(96) AS r(x))"""
SQL_DIM_GENERATE_TYPE = """
    SELECT * FROM (VALUES (CAST(248 AS BIGINT), 'Solar', '15 mins'),
                          (CAST(245 AS BIGINT), 'Wind', '15 mins'))
             AS v(dataset_id, generate_type, update_frequency)"""
SQL_CONTROL = f"""
    SELECT 'grid operator' AS source_system, {SQL_DATASET_ID} AS source_dataset_id,
           event_type AS source_dataset_name, CAST(date_trunc('day', min(ts)) AS TIMESTAMP) AS last_timestamp,
           max(ts) AS refresh_timestamp, 'landing' AS target_container,
           'readings_' || event_type AS target_folder,
           CASE WHEN event_type = 'view' THEN 1000 ELSE 5000 END AS page_size,
           CASE WHEN event_type IN ('click', 'purchase') THEN 7 ELSE 1 END AS load_increment_days,
           'dev' AS environment, event_type <> 'error' AS is_active
    FROM events GROUP BY event_type"""
SQL_NOW = "(SELECT max(ts) + INTERVAL 1 MICROSECOND FROM events)"


# --- building blocks -------------------------------------------------------------


def _generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.generation(event_feed(spark, sf_dir))


def _all_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    solar = silver.generation(order_feed(spark, sf_dir))
    return lookups.union_readings(_generation(spark, sf_dir), solar)


def _consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.consumption(event_feed(spark, sf_dir))


def _generation_fact(spark: SparkSession, sf_dir: str, floor: bool) -> DataFrame:
    return lookups.generation_fact_rows(
        _all_generation(spark, sf_dir), dims.dim_date(spark), dims.dim_time(spark), floor=floor
    ).drop("gold_processed_timestamp")


def _consumption_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.consumption_fact_rows(
        _consumption(spark, sf_dir), dims.dim_date(spark), dims.dim_time(spark), floor=True
    ).drop("gold_processed_timestamp")


def _control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.with_defaults(event_control(spark, sf_dir), "dev")


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.active_datasets(_control(spark, sf_dir), "dev")


def _land_events(spark: SparkSession, sf_dir: str, more: tuple[str, ...] = ()) -> Layout:
    """Land all events by way of a stored control table in which all datasets
    are active. Being stored, its size is known and it can be broadcast."""
    layout = Layout(work_folder(spark, "layers"))
    seed = event_control(spark, sf_dir).drop("is_active")
    stored = ensure_control(spark, layout, seed).read(spark)
    active = control.active_datasets(stored, layout.environment)
    records = event_feed(spark, sf_dir, more=more).drop("ingestion_timestamp")
    land(active, lambda planned: records, layout, end_of_events(spark, sf_dir))
    return layout


# --- landing and bronze ----------------------------------------------------------

SQL_LANDED = f"""
    SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time,
           {SQL_END} AS end_time, value, {SQL_K} AS k,
           concat({SQL_DATASET_ID}, '_', event_type) AS dataset,
           concat(strftime(window_start, '%Y%m%dT%H%M%SZ'), '_to_',
                  strftime(least(window_start + to_days(step), now_), '%Y%m%dT%H%M%SZ')) AS batch
    FROM (SELECT e.*, c.load_increment_days AS step, {SQL_NOW} AS now_,
                 c.last_timestamp + to_days(CAST(c.load_increment_days * (date_diff('microsecond',
                     c.last_timestamp, e.ts) // (c.load_increment_days * 86400000000)) AS INTEGER))
                     AS window_start
          FROM events e JOIN ({SQL_CONTROL}) c ON c.source_dataset_name = e.event_type)"""


def _landed_columns(landed: DataFrame, *more: Column) -> DataFrame:
    """Fields, and the dataset and window that the file lies under."""
    return landed.select(
        "datasetId",
        F.col("startTime").try_cast("timestamp").alias("start_time"),
        F.col("endTime").try_cast("timestamp").alias("end_time"),
        F.col("value").try_cast("double").alias("value"),
        F.get_json_object("additionalJson", "$.CustomerType").alias("k"),
        F.regexp_extract("source_file", "dataset=([^/]+)", 1).alias("dataset"),
        F.regexp_extract("source_file", "batch=([^/]+)", 1).alias("batch"),
        *more,
    )


@query(SQL_LANDED)
def bronze_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all events per dataset and window, read the folder back."""
    layout = _land_events(spark, sf_dir)
    return _landed_columns(with_origin(read_landing(spark, layout.landing)))


# Fields of the source that no layer names: kept as one JSON object of texts.
UNNAMED = ("event_id", "user_id")
SQL_ALL_FIELDS = f"""
    SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time, value, {SQL_K} AS k,
           CAST(json_object('event_id', CAST(event_id AS VARCHAR), 'user_id', CAST(user_id AS VARCHAR)) AS VARCHAR) AS rest
    FROM events"""


def _all_fields(landed: DataFrame) -> DataFrame:
    return _landed_columns(landed, F.col(RESCUED_COLUMN).alias("rest")).drop("end_time", "dataset", "batch")


@query(SQL_ALL_FIELDS)
def bronze_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records into bronze: what nobody names is kept as well."""
    layout = _land_events(spark, sf_dir, UNNAMED)
    return _all_fields(with_origin(read_landing(spark, layout.landing)))


# As many windows as bronze_landing_roundtrip plans, but of whole records and in pages.
SQL_PAGED = f"""
    SELECT l."datasetId", l.start_time, l.value, l.k, l.dataset, l.batch, l.rest
    FROM (SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time, value, {SQL_K} AS k,
                 concat({SQL_DATASET_ID}, '_', event_type) AS dataset,
                 concat(strftime(window_start, '%Y%m%dT%H%M%SZ'), '_to_',
                        strftime(least(window_start + to_days(step), now_), '%Y%m%dT%H%M%SZ')) AS batch,
                 CAST(json_object('event_id', CAST(event_id AS VARCHAR), 'user_id', CAST(user_id AS VARCHAR)) AS VARCHAR) AS rest
          FROM (SELECT e.*, c.load_increment_days AS step, {SQL_NOW} AS now_,
                       c.last_timestamp + to_days(CAST(c.load_increment_days * (date_diff('microsecond',
                           c.last_timestamp, e.ts) // (c.load_increment_days * 86400000000)) AS INTEGER))
                           AS window_start
                FROM events e JOIN ({SQL_CONTROL}) c ON c.source_dataset_name = e.event_type AND c.is_active)) l"""


def _end_moment(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """Just after the last event."""
    last = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return last.replace(tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=1)


@query(SQL_PAGED)
def paged_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of all planned windows by the paged source, one partition a window."""
    records = read_windows(spark, event_pages(sf_dir), _active(spark, sf_dir), _end_moment(spark, sf_dir))
    named = fields_of(records).withColumns(
        {
            "source_file": F.concat(
                F.lit("dataset="), dataset_key("source_dataset_id", "source_dataset_name"), F.lit("/batch="), windows.batch_name(F.col("window_start"), F.col("window_end"))
            )
        }
    )
    return _landed_columns(named, F.col(RESCUED_COLUMN).alias("rest")).drop("end_time")


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of which some lack their start and some their end."""
    feed = event_feed(spark, sf_dir)
    return feed.withColumn(
        "startTime", F.when(F.col("datasetId") != "102", F.col("startTime"))
    ).withColumn("endTime", F.when(F.col("value").cast("double") >= 5, F.col("endTime")))


@query(
    f"""SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS ingestion_timestamp,
               value
        FROM events WHERE event_type <> 'error' AND value >= 5"""
)
def bronze_expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.expect_all_or_drop(_flawed(spark, sf_dir), quality.READING_RULES)
    return kept.select("datasetId", "ingestion_timestamp", F.col("value").try_cast("double").alias("value"))


@query(
    """SELECT 'Rule1' AS rule, count(*) FILTER (WHERE event_type <> 'error') AS passed,
              count(*) FILTER (WHERE event_type = 'error') AS failed FROM events
       UNION ALL
       SELECT 'Rule2', count(*) FILTER (WHERE value >= 5), count(*) FILTER (WHERE value < 5)
       FROM events"""
)
def bronze_expect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectation_metrics(_flawed(spark, sf_dir), quality.READING_RULES)


# --- silver ----------------------------------------------------------------------


@query(SQL_GENERATION)
def silver_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generation(spark, sf_dir).drop("silver_processed_timestamp")


@query(SQL_CONSUMPTION)
def silver_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consumption(spark, sf_dir).drop("silver_processed_timestamp")


SQL_DISPATCH = f"""
    SELECT concat({SQL_DATASET_ID}, '_', event_type) AS silver_table,
           CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time,
           CASE WHEN event_type <> 'purchase' THEN value END AS value_mwh,
           CASE WHEN event_type = 'purchase' THEN value END AS consumption_mwh
    FROM events WHERE event_type IN ('click', 'view', 'purchase')"""


def _dispatched_columns(name: str, typed: DataFrame) -> DataFrame:
    values = [
        F.col(v) if v in typed.columns else F.lit(None).cast("double").alias(v)
        for v in ("value_mwh", "consumption_mwh")
    ]
    return typed.select(F.lit(name).alias("silver_table"), "datasetId", "start_time", *values)


@query(SQL_DISPATCH)
def silver_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each known dataset through its own transformation, unknown ones skipped."""
    tables = [
        _dispatched_columns(d.silver_table, transform(event_feed(spark, sf_dir, d.name)))
        for d, transform in silver.dispatch(EVENT_DATASETS)
    ]
    return lookups.union_readings(*tables)


# --- dimensions ------------------------------------------------------------------


@query(
    f"""SELECT c.*, coalesce(n, 0) AS n_readings FROM ({SQL_DIM_DATE}) c
        LEFT JOIN (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1) e
        ON e.date = c.date"""
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar, with the readings of each day."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = dims.dim_date(spark).join(daily, "date", "left")
    return counted.withColumn("n_readings", F.coalesce("n", F.lit(0))).drop("n")


@query(
    f"""SELECT t.*, coalesce(n, 0) AS n_readings FROM ({SQL_DIM_TIME}) t
        LEFT JOIN (SELECT hour(ts) * 4 + minute(ts) // 15 AS q, count(*) AS n
                   FROM events GROUP BY 1) e ON e.q = t.time_quarter_id"""
)
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter hours, with the readings of each."""
    quarter = time_of_day_text(floor_to_quarter_hour(F.col("ts").cast("timestamp")))
    counts = (
        table(spark, sf_dir, "events")
        .groupBy(quarter.alias("time_15min"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = dims.dim_time(spark).join(counts, "time_15min", "left")
    return counted.withColumn("n_readings", F.coalesce("n", F.lit(0))).drop("n")


@query(
    f"""SELECT g.*, coalesce(n, 0) AS n_readings FROM ({SQL_DIM_GENERATE_TYPE}) g
        LEFT JOIN (SELECT {SQL_DATASET_ID} AS id, count(*) AS n FROM events GROUP BY 1) e
        ON e.id = g.dataset_id"""
)
def dim_generate_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generation types, with the readings of each."""
    counts = (
        table(spark, sf_dir, "events")
        .groupBy(dataset_id_of(F.col("event_type")).cast("bigint").alias("dataset_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = dims.dim_generate_type(spark).join(counts, "dataset_id", "left")
    return counted.withColumn("n_readings", F.coalesce("n", F.lit(0))).drop("n")


@query(SQL_DIM_CUSTOMER_TYPE)
def dim_customer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = lookups.customer_type_rows(_consumption(spark, sf_dir))
    return latest_per_key(changes, CUSTOMER_TYPE_KEYS)


# --- facts -----------------------------------------------------------------------


@query(SQL_UNION)
def union_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_generation(spark, sf_dir).drop("silver_processed_timestamp")


@query(sql_generation_fact(SQL_TIME_ID))
def fact_lookup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact keys: a start off the quarter hour has no time key."""
    return _generation_fact(spark, sf_dir, floor=False)


@query(sql_generation_fact(SQL_FLOORED_TIME_ID))
def fact_lookup_floored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generation_fact(spark, sf_dir, floor=True)


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE start_date_id IS NULL) AS n_no_date,
               count(*) FILTER (WHERE start_time_id IS NULL) AS n_no_time
        FROM ({sql_generation_fact(SQL_TIME_ID)})"""
)
def fact_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.unmatched_counts(_generation_fact(spark, sf_dir, floor=False))


@query(SQL_FACT_GENERATION)
def fact_generation_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_generation_fact(spark, sf_dir, floor=True), GENERATION_KEYS)


@query(
    sql_latest(
        sql_generation_fact(SQL_TIME_ID),
        GENERATION_KEYS,
        "bronze_ingestion_timestamp",
        "value_mwh",
    )
)
def fact_generation_latest_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With exact time keys most readings share a NULL key: the hot-key case."""
    return latest_per_key(_generation_fact(spark, sf_dir, floor=False), GENERATION_KEYS)


@query(SQL_FACT_CONSUMPTION)
def fact_consumption_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_consumption_fact(spark, sf_dir), CONSUMPTION_KEYS)


LINE_KEYS = ("l_orderkey", "l_linenumber")


@query(
    sql_latest(
        "SELECT * FROM lineitem",
        LINE_KEYS,
        "l_shipdate",
        "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus",
    )
)
def upsert_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert rule on the largest table."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEYS, "l_shipdate")


SQL_STAR = f"""
    SELECT d.year, d.month_name, t.hour, coalesce(g.generate_type, 'other') AS generate_type,
           count(*) AS n_facts
    FROM ({SQL_FACT_GENERATION}) f
    LEFT JOIN ({SQL_DIM_DATE}) d ON d.date_id = f.start_date_id
    LEFT JOIN ({SQL_DIM_TIME}) t ON t.time_quarter_id = f.start_time_id
    LEFT JOIN ({SQL_DIM_GENERATE_TYPE}) g ON CAST(g.dataset_id AS VARCHAR) = f."datasetId"
    GROUP BY ALL"""


@query(SQL_STAR)
def star_rollout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generation fact through its three dimensions."""
    facts = latest_per_key(_generation_fact(spark, sf_dir, floor=True), GENERATION_KEYS)
    dates = dims.dim_date(spark).withColumnRenamed("date_id", "start_date_id")
    times = dims.dim_time(spark).withColumnRenamed("time_quarter_id", "start_time_id")
    kinds = dims.dim_generate_type(spark).withColumn("datasetId", F.col("dataset_id").cast("string"))
    kind = F.coalesce("generate_type", F.lit("other")).alias("generate_type")
    return (
        facts.join(lookups.broadcast_if_small(dates), "start_date_id", "left")
        .join(lookups.broadcast_if_small(times), "start_time_id", "left")
        .join(lookups.broadcast_if_small(kinds), "datasetId", "left")
        .groupBy("year", "month_name", "hour", kind)
        .agg(F.count(F.lit(1)).alias("n_facts"))
    )


@query(
    f"""SELECT c.customer_type, d.is_weekend, count(*) AS n_facts, CAST(sum(f.reading_count) AS BIGINT) AS readings
        FROM ({SQL_FACT_CONSUMPTION}) f
        LEFT JOIN ({SQL_DIM_CUSTOMER_TYPE}) c ON c.customer_type = f.customer_type
        LEFT JOIN ({SQL_DIM_DATE}) d ON d.date_id = f.start_date_id
        GROUP BY ALL"""
)
def star_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumption fact with its customer types and calendar."""
    dates = dims.dim_date(spark).withColumnRenamed("date_id", "start_date_id")
    kinds = latest_per_key(
        lookups.customer_type_rows(_consumption(spark, sf_dir)), CUSTOMER_TYPE_KEYS
    ).select("customer_type")
    facts = latest_per_key(_consumption_fact(spark, sf_dir), CONSUMPTION_KEYS)
    return (
        facts.join(kinds.withColumnRenamed("customer_type", "known_type"), F.col("customer_type") == F.col("known_type"), "left")
        .drop("customer_type")
        .withColumnRenamed("known_type", "customer_type")
        .join(lookups.broadcast_if_small(dates), "start_date_id", "left")
        .groupBy("customer_type", "is_weekend")
        .agg(F.count(F.lit(1)).alias("n_facts"), F.sum("reading_count").alias("readings"))
    )


# --- control table ---------------------------------------------------------------


@query(SQL_CONTROL)
def control_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeding an empty table, then seeding again, which changes nothing."""
    seed = event_control(spark, sf_dir)
    empty = empty_table(spark, CONTROL)
    once = control.bootstrap(empty, seed, "dev")
    return control.bootstrap(once, seed, "dev").drop("id", "created_date")


@query(
    f"""SELECT source_dataset_id, source_dataset_name,
               strftime(last_timestamp, '%Y-%m-%dT%H:%M:%S') AS last_timestamp,
               target_folder, load_increment_days, page_size
        FROM ({SQL_CONTROL}) WHERE is_active AND environment = 'dev'"""
)
def control_active_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _active(spark, sf_dir)


@query(f"SELECT count(*) AS n_active FROM ({SQL_CONTROL}) WHERE is_active AND environment = 'dev'")
def control_active_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many datasets there are to load."""
    return _active(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_active"))


SQL_ACTIVE = f"(SELECT * FROM ({SQL_CONTROL}) WHERE is_active)"


@query(
    f"""SELECT source_dataset_id, source_dataset_name, page_size, s AS window_start,
               least(s + to_days(load_increment_days), {SQL_NOW}) AS window_end
        FROM (SELECT *, unnest(generate_series(last_timestamp,
                     {SQL_NOW} - INTERVAL 1 MICROSECOND, to_days(load_increment_days))) AS s
              FROM {SQL_ACTIVE})"""
)
def plan_batch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.plan_windows(_active(spark, sf_dir), end_of_events(spark, sf_dir))


@query(
    f"""SELECT c.source_dataset_id, c.environment, c.page_size,
               coalesce(m.mark, c.last_timestamp) AS last_timestamp
        FROM ({SQL_CONTROL}) c LEFT JOIN
             (SELECT {SQL_DATASET_ID} AS id, max({SQL_END}) AS mark FROM events
              WHERE event_type <> 'error' GROUP BY 1) m ON m.id = c.source_dataset_id"""
)
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every active dataset moves to the end of its newest reading."""
    rows = control.bootstrap(
        empty_table(spark, CONTROL), event_control(spark, sf_dir), "dev"
    )
    loaded = event_feed(spark, sf_dir).join(
        _active(spark, sf_dir).select("source_dataset_id"), "source_dataset_id", "left_semi"
    )
    advanced = control.advance_watermark(rows, marks_of(loaded, "dev"))
    return advanced.select("source_dataset_id", "environment", "page_size", "last_timestamp")


def _marks_after_run(spark: SparkSession, sf_dir: str, marks: str) -> DataFrame:
    layout = Layout(work_folder(spark, "marks"))
    records = event_feed(spark, sf_dir).drop("ingestion_timestamp")
    run_pipeline(
        spark, layout, EVENT_DATASETS, lambda planned: records, _end_moment(spark, sf_dir), event_control(spark, sf_dir), marks=marks
    )
    return control_table(layout).read(spark).select("source_dataset_id", "environment", "page_size", "last_timestamp")


@query(
    f"""SELECT source_dataset_id, environment, page_size,
               CASE WHEN is_active THEN {SQL_NOW} ELSE last_timestamp END AS last_timestamp
        FROM ({SQL_CONTROL})"""
)
def watermark_run_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a whole run, every active dataset stands at the time of the run."""
    return _marks_after_run(spark, sf_dir, RUN_TIME)


@query(CATALOG["watermark_advance"].sql)
def watermark_newest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a whole run, every active dataset stands at the end of its newest reading, which landing observed."""
    return _marks_after_run(spark, sf_dir, NEWEST_READING)


@query(CATALOG["plan_batch_windows"].sql)
def plan_windows_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window planning with its parameters as text, ``7.0``, as a job hands them on."""
    active = _active(spark, sf_dir)
    texts = {c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("page_size", "load_increment_days")}
    return windows.plan_windows(active.withColumns(texts), end_of_events(spark, sf_dir))


# --- exploration -----------------------------------------------------------------


@query(SQL_GENERATION)
def explore_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _generation(spark, sf_dir).drop("silver_processed_timestamp")
    return explore.scan_by_name(typed, "245_wind_power_generation")


@query(SQL_GENERATION)
def explore_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.sorted_by(
        _generation(spark, sf_dir).drop("silver_processed_timestamp"), "start_time"
    )


@query(
    f"""SELECT * FROM ({SQL_CONSUMPTION})
        ORDER BY start_time DESC NULLS LAST, "datasetId" DESC NULLS LAST,
                 consumption_mwh DESC NULLS LAST, customer_type DESC NULLS LAST LIMIT 10"""
)
def explore_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _consumption(spark, sf_dir).drop("silver_processed_timestamp")
    return explore.latest(typed, "start_time", 10)


@query(
    f"""SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS ingestion_timestamp, value
        FROM events WHERE event_type = 'error'"""
)
def explore_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that lack their start."""
    without = explore.missing(_flawed(spark, sf_dir), "startTime")
    return without.select(
        "datasetId", "ingestion_timestamp", F.col("value").try_cast("double").alias("value")
    )


@query(
    f"""SELECT customer_type, resolution, unit_of_measure, time_series_type, count(*) AS n_rows
        FROM ({SQL_CONSUMPTION}) GROUP BY ALL"""
)
def explore_profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.profile(_consumption(spark, sf_dir), *explore.PROFILE_COLUMNS)


@query(
    """SELECT p_partkey, p_retailprice,
              CAST(p_retailprice * CAST('1.60934' AS DOUBLE) AS FLOAT) AS distance_km
       FROM part"""
)
def unit_convert_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_retailprice", distance_km("p_retailprice").alias("distance_km")
    )


# --- streams ---------------------------------------------------------------------
#
# Each of these runs its streams to the end over the whole table and returns the
# table they wrote.


def _bronze_run(spark: SparkSession, sf_dir: str, more: tuple[str, ...] = ()) -> Layout:
    layout = _land_events(spark, sf_dir, more)
    finish(run_bronze(spark, layout, dataset) for dataset in EVENT_DATASETS)
    return layout


@query(SQL_LANDED)
def stream_bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _bronze_run(spark, sf_dir)
    tables = [read_table(spark, layout.bronze(d), BRONZE) for d in EVENT_DATASETS]
    return _landed_columns(lookups.union_readings(*tables))


@query(SQL_ALL_FIELDS)
def stream_bronze_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _bronze_run(spark, sf_dir, UNNAMED)
    tables = [read_table(spark, layout.bronze(d), BRONZE) for d in EVENT_DATASETS]
    return _all_fields(lookups.union_readings(*tables))


PAGED_DAYS = 10


@query(f"SELECT * EXCLUDE (batch) FROM ({SQL_PAGED})")
def stream_paged_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paged source as a stream that lands whole records: two runs, the second from where the first ended."""
    root = work_folder(spark, "paged")
    landing = join_path(root, "landing")
    end, active = _end_moment(spark, sf_dir), _active(spark, sf_dir)
    first = dt.datetime(end.year, end.month, end.day, tzinfo=dt.timezone.utc) - dt.timedelta(days=PAGED_DAYS)
    for until in (first, end):
        records = read_windows(spark, event_pages(sf_dir), active, until, stream=True)
        run = batch_run(records, lambda batch, _: write_whole_records(batch, landing), join_path(root, "checkpoint"), "paged")
        finish([run])
    landed = with_origin(read_landing(spark, landing))
    return _landed_columns(landed, F.col(RESCUED_COLUMN).alias("rest")).drop("end_time", "batch")


@query(
    f"""SELECT '245_click' AS dataset, rule, sum(passed)::BIGINT AS passed, sum(failed)::BIGINT AS failed, 2::BIGINT AS batches
        FROM (SELECT event_type, 'Rule1' AS rule, 1 AS passed, 0 AS failed FROM events
              UNION ALL SELECT event_type, 'Rule2', CASE WHEN value >= 5 THEN 1 ELSE 0 END, CASE WHEN value < 5 THEN 1 ELSE 0 END FROM events)
        WHERE event_type = 'click' GROUP BY ALL
        UNION ALL
        SELECT '102_error', rule, sum(passed)::BIGINT, sum(failed)::BIGINT, 1::BIGINT
        FROM (SELECT event_type, 'Rule1' AS rule, 0 AS passed, 1 AS failed FROM events
              UNION ALL SELECT event_type, 'Rule2', CASE WHEN value >= 5 THEN 1 ELSE 0 END, CASE WHEN value < 5 THEN 1 ELSE 0 END FROM events)
        WHERE event_type = 'error' GROUP BY ALL"""
)
def rule_metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts as kept after two runs of bronze and a repeat of the last batch of each stream.

    The readings of one dataset all lack their start, so its last window has them all: one batch."""
    layout = Layout(work_folder(spark, "metrics"))
    history = MetricsTable(spark, layout.at("landing_admin", "rule_metrics"))
    datasets = [d for d in EVENT_DATASETS if d.name in ("click", "error")]
    seed = event_control(spark, sf_dir).drop("is_active")
    active = control.active_datasets(control.with_defaults(seed, "dev"), "dev")
    until = end_of_events(spark, sf_dir)
    records = windows.assign_windows(_flawed(spark, sf_dir).drop("ingestion_timestamp"), active, until)
    middle = F.col("window_start") < until - F.expr(f"INTERVAL {PAGED_DAYS} DAYS")

    def run() -> None:
        with ObservedCounts(spark, RULE_COUNTS, history=history):
            finish(run_bronze(spark, layout, d) for d in datasets)

    for part in (middle, ~middle):
        write_landing(records.where(part), layout.landing)
        run()
    for d in datasets:
        checkpoint = layout.checkpoint("bronze", d.bronze_table)
        last = max(int(n) for n in folder_entries(spark, join_path(checkpoint, "commits")) if n.isdigit())
        delete_folder(spark, join_path(checkpoint, "commits", str(last)))
    run()
    kept = history.read().withColumn("dataset", F.regexp_replace("stream", "_raw_table$", ""))
    return kept.groupBy("dataset", "rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), F.count_distinct("batch_id").alias("batches"))


PRIORITIES = [Dataset(int(name[0]), name) for name in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]


@query(
    """SELECT concat(o_orderpriority[1], '_', replace(replace(lower(o_orderpriority), ' ', '_'), '-', '_')) AS silver_table,
              o_orderpriority[1] AS "datasetId", o_orderdate AS start_time, o_totalprice AS value_mwh FROM orders"""
)
def order_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset per order priority, with blanks and hyphens in its name, from landing to a silver table of its own."""
    layout = Layout(work_folder(spark, "orders"))
    first = F.col("datasetId").substr(1, 1)
    day = F.date_trunc("month", F.col("startTime").cast("timestamp"))
    records = order_feed(spark, sf_dir).drop("ingestion_timestamp").select(
        first.cast("int").alias("source_dataset_id"),
        F.col("datasetId").alias("source_dataset_name"),
        day.alias("window_start"),
        (day + F.expr("INTERVAL 1 MONTH")).alias("window_end"),
        first.alias("datasetId"),
        "startTime",
        "endTime",
        "value",
        "additionalJson",
    )
    write_landing(records, layout.landing)
    finish(run_bronze(spark, layout, d) for d in PRIORITIES)
    pairs = silver.dispatch(PRIORITIES, {d.id: silver.generation for d in PRIORITIES})
    finish(run_silver(spark, layout, d, transform) for d, transform in pairs)
    tables = [_dispatched_columns(d.silver_table, read_table(spark, layout.silver(d), SILVER_GENERATION)) for d, _ in pairs]
    return lookups.union_readings(*tables).drop("consumption_mwh")


@query(
    f"""SELECT CAST({SQL_DATASET_ID} AS VARCHAR) AS "datasetId", ts AS start_time, {SQL_NOW} AS bronze_ingestion_timestamp, {SQL_NOW} AS silver_processed_timestamp,
               {SQL_NOW} AS gold_processed_timestamp FROM events WHERE event_type = 'purchase'"""
)
def stamped_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival and processing times of all layers under a passed clock."""
    layout = _land_events(spark, sf_dir)
    now = F.lit(_end_moment(spark, sf_dir)).cast("timestamp")
    (dataset,) = [d for d in EVENT_DATASETS if d.id == silver.CONSUMPTION]
    finish([run_bronze(spark, layout, dataset, now)])
    finish([run_silver(spark, layout, dataset, silver.consumption, now)])
    typed = read_table(spark, layout.silver(dataset), SILVER_CONSUMPTION)
    stamped = lookups.with_time_keys(typed, dims.dim_date(spark), dims.dim_time(spark))
    return stamped.select(
        "datasetId", "start_time", "bronze_ingestion_timestamp", "silver_processed_timestamp", clock(now).alias("gold_processed_timestamp")
    )


@query(SQL_DISPATCH)
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _bronze_run(spark, sf_dir)
    pairs = silver.dispatch(EVENT_DATASETS)
    finish(run_silver(spark, layout, d, transform) for d, transform in pairs)
    schemas = {silver.generation: SILVER_GENERATION, silver.consumption: SILVER_CONSUMPTION}
    tables = [
        _dispatched_columns(
            d.silver_table, read_table(spark, layout.silver(d), schemas[transform])
        )
        for d, transform in pairs
    ]
    return lookups.union_readings(*tables)


def _stored_dimensions(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    layout = Layout(root)
    store_dimensions(spark, layout)
    return stored_dimensions(spark, layout)


@query(SQL_FACT_GENERATION)
def stream_fact_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two silver streams, united and upserted; the second arrives a run later."""
    root = work_folder(spark, "generation")
    feeds = {"wind": _generation(spark, sf_dir), "solar": silver.generation(order_feed(spark, sf_dir))}
    paths = {name: join_path(root, "silver", name) for name in feeds}
    for path in paths.values():
        ensure_folder(spark, path)
    fact = fact_generation_table(join_path(root, "gold"))
    for name, feed in feeds.items():
        write_static(feed, paths[name])
        streams = [stream_table(spark, path, SILVER_GENERATION) for path in paths.values()]
        changes = lookups.generation_fact_rows(
            lookups.union_readings(*streams), *_stored_dimensions(spark, root), floor=True
        )
        checkpoint = join_path(root, "checkpoint")
        finish([run_upsert(fact, changes, GENERATION_KEYS, checkpoint, "fact_generation")])
    return fact.read(spark).drop("gold_processed_timestamp")


def _silver_consumption_folder(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    path = join_path(root, "silver")
    write_static(_consumption(spark, sf_dir), path)
    return stream_table(spark, path, SILVER_CONSUMPTION)


@query(SQL_FACT_CONSUMPTION)
def stream_fact_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "consumption")
    changes = lookups.consumption_fact_rows(
        _silver_consumption_folder(spark, sf_dir, root), *_stored_dimensions(spark, root), floor=True
    )
    fact = fact_consumption_table(join_path(root, "gold"))
    checkpoint = join_path(root, "checkpoint")
    finish([run_upsert(fact, changes, CONSUMPTION_KEYS, checkpoint, "fact_consumption")])
    return fact.read(spark).drop("gold_processed_timestamp")


@query(SQL_DIM_CUSTOMER_TYPE)
def stream_dim_customer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "customer-type")
    changes = lookups.customer_type_rows(_silver_consumption_folder(spark, sf_dir, root))
    dim = dim_customer_type_table(join_path(root, "gold"))
    checkpoint = join_path(root, "checkpoint")
    finish([run_upsert(dim, changes, CUSTOMER_TYPE_KEYS, checkpoint, "dim_customer_type")])
    return dim.read(spark)


SQL_PIPELINE_FACTS = f"""
    SELECT 'generation' AS fact, {SQL_DATE_ID} AS start_date_id, {SQL_TIME_ID} AS start_time_id,
           "datasetId" AS key, max(value_mwh) AS mwh
    FROM ({SQL_GENERATION}) WHERE "datasetId" IN ('245', '248') GROUP BY ALL
    UNION ALL
    SELECT 'consumption', {SQL_DATE_ID}, {SQL_TIME_ID}, customer_type, max(consumption_mwh)
    FROM ({SQL_CONSUMPTION}) WHERE "datasetId" = '358' GROUP BY ALL"""


@query(SQL_PIPELINE_FACTS)
def pipeline_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, from control table to gold. All readings of a dataset arrive
    in one micro-batch here, so the largest value wins a key."""
    layout = Layout(work_folder(spark, "pipeline"))
    seed = event_control(spark, sf_dir).drop("is_active")
    records = event_feed(spark, sf_dir).drop("ingestion_timestamp")
    last = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    now = last.replace(tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=1)
    run_pipeline(spark, layout, EVENT_DATASETS, lambda planned: records, now, seed)

    def fact(kind: str, key: str, value: str, name: str) -> DataFrame:
        return gold_tables(layout)[name].read(spark).select(
            F.lit(kind).alias("fact"),
            "start_date_id",
            "start_time_id",
            F.col(key).alias("key"),
            F.col(value).alias("mwh"),
        )

    return lookups.union_readings(
        fact("generation", "datasetId", "value_mwh", "fact_generation_forecast"),
        fact("consumption", "customer_type", "consumption_mwh", "fact_consumption"),
    )
