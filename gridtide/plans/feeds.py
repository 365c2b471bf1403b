"""Readings made from the given tables, in the shape of landed records.

``events`` and ``orders`` stand for two metering feeds: every row is one
reading. The time a row carries is also its arrival time, which makes results
reproducible.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Dataset
from ..operators.silver import CONSUMPTION, SOLAR, WIND, JSON_ATTRIBUTES
from ..session import join_path

# Event type, id of the dataset it stands for.
DATASET_OF_EVENT = {
    "click": WIND,
    "view": SOLAR,
    "purchase": CONSUMPTION,
    "signup": 101,
    "error": 102,
}
EVENT_DATASETS = [Dataset(id_, name) for name, id_ in DATASET_OF_EVENT.items()]

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def dataset_id_of(event_type: Column) -> Column:
    chosen = F.lit(None).cast("int")
    for name, id_ in DATASET_OF_EVENT.items():
        chosen = F.when(event_type == name, F.lit(id_)).otherwise(chosen)
    return chosen


def _reading_fields(start: Column, value: Column, attributes: Column) -> list[Column]:
    end = start + F.expr("INTERVAL 15 MINUTES")
    return [
        F.date_format(start, ISO_MICROS).alias("startTime"),
        F.date_format(end, ISO_MICROS).alias("endTime"),
        value.cast("string").alias("value"),
        attributes.alias("additionalJson"),
        start.alias("ingestion_timestamp"),
    ]


def event_feed(
    spark: SparkSession, sf_dir: str, event_type: str | None = None, more: Sequence[str] = ()
) -> DataFrame:
    """Events as readings with JSON attributes; the customer type is the k of props. ``more``
    are columns of events that come along as fields which no layer names."""
    events = table(spark, sf_dir, "events")
    if event_type is not None:
        events = events.where(F.col("event_type") == event_type)
    start = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k")
    sources = {
        "TimeSeriesType": F.col("event_type"),
        "Res": F.lit("PT15M"),
        "Uom": F.lit("MWh"),
        "CustomerType": k,
        "ReadTS": F.date_format(start, ISO_MICROS),
        "Value": F.col("value").cast("string"),
        "Count": k,
    }
    attributes = F.to_json(F.struct(*[sources[f].alias(f) for _, f, _ in JSON_ATTRIBUTES]))
    id_ = dataset_id_of(F.col("event_type"))
    return events.select(
        id_.alias("source_dataset_id"),
        id_.cast("string").alias("datasetId"),
        *_reading_fields(start, F.col("value"), attributes),
        *more,
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as flat readings, one dataset per priority; all before the calendar starts."""
    orders = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        F.col("o_orderpriority").alias("datasetId"),
        *_reading_fields(start, F.col("o_totalprice"), F.lit(None).cast("string")),
    )


def event_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed rows for a control table: one dataset per event type, some columns
    left to their defaults."""
    events = table(spark, sf_dir, "events")
    name = F.col("event_type")
    return (
        events.groupBy("event_type")
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
        .select(
            F.lit("grid operator").alias("source_system"),
            dataset_id_of(name).alias("source_dataset_id"),
            name.alias("source_dataset_name"),
            F.date_trunc("day", F.col("first").cast("timestamp")).alias("last_timestamp"),
            F.col("last").cast("timestamp").alias("refresh_timestamp"),
            F.lit("landing").alias("target_container"),
            F.concat(F.lit("readings_"), name).alias("target_folder"),
            F.when(name == "view", 1000).alias("page_size"),
            F.when(name.isin("click", "purchase"), 7).alias("load_increment_days"),
            F.when(name == "error", False).alias("is_active"),
        )
    )


def end_of_events(spark: SparkSession, sf_dir: str) -> Column:
    """Just after the last event, as a subquery: the "now" of a run."""
    last = table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).scalar()
    return last + F.expr("INTERVAL 1 MICROSECOND")


def without_zone(frame: DataFrame) -> DataFrame:
    """UTC instants as plain timestamps, which is what SQL engines compare."""
    return frame.select(
        *[
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in frame.schema.fields
        ]
    )


# Rows of a window held at a time, and parts of a span of time that are counted apart.
HELD_ROWS = 250_000
PARTS = 4096
BATCH_ROWS = 65_536
EPOCH = dt.datetime(1970, 1, 1)


def _moment(micros: int) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=micros)


def _micros(moment: dt.datetime) -> int:
    return (moment - EPOCH) // dt.timedelta(microseconds=1)


def _found(path: str, wanted: ds.Expression) -> Iterator[pa.Table]:
    """Rows of a parquet table that are wanted, some at a time and not a row group at once."""
    source = ds.dataset(path)
    for fragment in source.get_fragments(filter=wanted):
        groups = [g.id for part in fragment.split_by_row_group(wanted, source.schema) for g in part.row_groups]
        if groups:
            with fragment.open() as file:
                for batch in pq.ParquetFile(file, buffer_size=1 << 20).iter_batches(BATCH_ROWS, groups, use_threads=False):
                    yield pa.Table.from_batches([batch]).filter(wanted)


def events_in_order(path: str, event_type: str, start: int, end: int) -> Iterator[pa.Table]:
    """Events of a type between two moments (microseconds) by time and id, in tables of HELD_ROWS at most.

    If there are more, the span is cut where their counts say, and each part of it is read by itself. Only
    events of one microsecond are never cut."""
    wanted = (pc.field("event_type") == event_type) & (pc.field("ts") >= _moment(start)) & (pc.field("ts") < _moment(end))
    width = -(-(end - start) // PARTS)
    held, counts = [], np.zeros(PARTS, np.int64)
    for rows in _found(path, wanted):
        at = rows["ts"].cast(pa.timestamp("us")).cast(pa.int64()).to_numpy()
        counts += np.bincount((at - start) // width, minlength=PARTS)
        if counts.sum() > HELD_ROWS and end - start > 1:
            held.clear()
        elif rows.num_rows:
            held.append(rows)
    if counts.sum() <= HELD_ROWS or end - start <= 1:
        if held:
            yield pa.concat_tables(held).sort_by([("ts", "ascending"), ("event_id", "ascending")])
        return
    parts = np.flatnonzero(counts)
    low, total = parts[0], 0
    for part in parts:
        if total and total + counts[part] > HELD_ROWS:
            yield from events_in_order(path, event_type, start + int(low) * width, start + int(part) * width)
            low, total = part, 0
        total += counts[part]
    yield from events_in_order(path, event_type, start + int(low) * width, min(end, start + int(parts[-1] + 1) * width))


def event_pages(sf_dir: str) -> Callable[[int, str, str, int, int], tuple[list[dict], int | None]]:
    """Pages of events as a paged source would give them: the records of a dataset and a window
    by time and id, whole, with nested attributes and fields that no layer names. Of the window at hand
    the next rows are held, in columns; a page that is not the next one is reached from the first."""
    path = join_path(sf_dir, "events.parquet")
    types = {id_: name for name, id_ in DATASET_OF_EVENT.items()}
    held: dict[str, object] = {}

    def record(dataset_id: int, r: dict) -> dict:
        k = json.loads(r["props"]).get("k")
        starts, ends = ((r["ts"] + dt.timedelta(minutes=m)).isoformat(timespec="microseconds") + "Z" for m in (0, 15))
        return {
            "datasetId": dataset_id,
            "startTime": starts,
            "endTime": ends,
            "value": r["value"],
            "additionalJson": {"CustomerType": str(k), "Count": k},
            "event_id": r["event_id"],
            "user_id": r["user_id"],
        }

    def get_page(dataset_id: int, start: str, end: str, page: int, page_size: int) -> tuple[list[dict], int | None]:
        asked = (dataset_id, start, end, page_size)
        if held.pop("next", None) != (asked, page):  # also after an error
            between = [_micros(dt.datetime.fromisoformat(t).replace(tzinfo=None)) for t in (start, end)]
            held["tables"], held["rows"] = events_in_order(path, types[dataset_id], *between), None
            number = 1
        else:
            number = page
        while True:
            rows = held["rows"]
            while rows is None or rows.num_rows <= page_size:
                more = next(held["tables"], None)
                if more is None:
                    break
                rows = more if rows is None else pa.concat_tables([rows, more])
            if rows is None:
                return [], None
            held["rows"] = rows.slice(page_size)
            if number == page or not held["rows"].num_rows:
                break
            number += 1
        if number < page:
            return [], None
        left = held["rows"].num_rows > 0
        if left:
            held["next"] = (asked, page + 1)
        return [record(dataset_id, r) for r in rows.slice(0, page_size).to_pylist()], page + 1 if left else None

    return get_page
