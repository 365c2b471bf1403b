"""Fetching planned windows from a paged source: over a plan (``fetch_windows``), or as
a data source for batch and streams (``paged_source``).

The windows are the work list: Spark spreads them over its tasks, and a task
pages through one window after the other. Records leave page by page, so a
window never has to fit into memory. How a page is asked for is the caller's
business, here it is just a function.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.typing import parameter_int, to_typed
from ..schemas import INT, LANDING
from ..session import share_package
from .landing import records_of

# (dataset id, window start, window end, page number, page size) ->
# (records as dictionaries, number of the next page or None)
GetPage = Callable[[int, str, str, int, int], tuple[list[dict], int | None]]

# Attempts per page, first pause in seconds (doubled each time).
ATTEMPTS = 5
FIRST_PAUSE = 2.0

WINDOW_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


class RateLimited(Exception):
    """Raised by a page function that was told to come back later."""


def patiently(get_page: GetPage, pause: float, *request) -> tuple[list[dict], int | None]:
    """Ask for a page, again after growing pauses while the source is busy."""
    for attempt in range(ATTEMPTS):
        try:
            return get_page(*request)
        except (RateLimited, OSError):
            if attempt == ATTEMPTS - 1:
                raise
            time.sleep(pause * 2**attempt)
    raise AssertionError("unreachable")


def pages_of(
    get_page: GetPage, pause: float, window: tuple, between: float = 0.0
) -> Iterator[list[dict]]:
    """All pages of a window, ``between`` seconds apart; an empty page or no next page ends it."""
    dataset_id, start, end, page_size = window
    page: int | None = 1
    while page is not None:
        if page != 1 and between:
            time.sleep(between)
        records, page = patiently(get_page, pause, dataset_id, start, end, page, page_size)
        if not records:
            return
        yield records


def as_text(value: object) -> str | None:
    """Landing fields are text; a nested object becomes its JSON."""
    return value if value is None or isinstance(value, str) else json.dumps(value)


def fetch_windows(
    windows: DataFrame,
    get_page: GetPage,
    tasks: int,
    pause: float = FIRST_PAUSE,
    between: float = 0.0,
    extra_fields: Sequence[str] = (),
) -> DataFrame:
    """Records of all windows, each with its dataset id; the usual fields and ``extra_fields``.

    ``tasks`` is how many windows are asked for at a time; a source that limits
    the rate of requests sets how high it may be.
    """
    more = [T.StructField(f, T.StringType()) for f in extra_fields if f not in LANDING.fieldNames()]
    fields = [f.name for f in (*LANDING.fields, *more)]
    schema = T.StructType([T.StructField("source_dataset_id", INT), *LANDING.fields, *more])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for window in batch.itertuples(index=False, name=None):
                for records in pages_of(get_page, pause, window, between):
                    yield pd.DataFrame(
                        [(window[0], *[as_text(r.get(f)) for f in fields]) for r in records],
                        columns=schema.names,
                    )

    asked = windows.select(
        "source_dataset_id",
        F.date_format("window_start", WINDOW_TEXT),
        F.date_format("window_end", WINDOW_TEXT),
        "page_size",
    )
    return asked.repartition(tasks, "source_dataset_id", *asked.columns[1:3]).mapInPandas(fetch, schema)


# --- as a data source ----------------------------------------------------------------------------

PAGED_SCHEMA = "source_dataset_id int, source_dataset_name string, window_start timestamp, window_end timestamp, value string"
PAGED_ARROW = pa.schema(
    [
        ("source_dataset_id", pa.int32()),
        ("source_dataset_name", pa.string()),
        ("window_start", pa.timestamp("us", "UTC")),
        ("window_end", pa.timestamp("us", "UTC")),
        ("value", pa.string()),
    ]
)


def _moment(text: str) -> dt.datetime:
    moment = dt.datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


class WindowPartition(InputPartition):
    """One window of one dataset: the unit that a task fetches, and fetches again if it is lost."""

    def __init__(self, dataset_id: int, name: str, start: dt.datetime, end: dt.datetime, page_size: int):
        super().__init__(None)
        self.dataset_id, self.name, self.start, self.end, self.page_size = dataset_id, name, start, end, page_size

    def read(self, get_page: GetPage, pause: float, between: float) -> Iterator[pa.RecordBatch]:
        """All records of the window, whole, a batch per page."""
        asked = (self.dataset_id, self.start.isoformat(), self.end.isoformat(), self.page_size)
        for records in pages_of(get_page, pause, asked, between):
            n = len(records)
            own = (self.dataset_id, self.name, self.start, self.end)
            columns = [pa.array([v] * n, f.type) for v, f in zip(own, PAGED_ARROW)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([json.dumps(r) for r in records])], schema=PAGED_ARROW)


class Windows:
    """The datasets of the options, and the windows they have between two moments."""

    def __init__(self, options: dict[str, str]):
        self.datasets = json.loads(options["datasets"])
        self.end = _moment(options["end"])

    def marks(self) -> dict[str, str]:
        return {str(d["id"]): _moment(d["mark"]).isoformat() for d in self.datasets}

    def ends(self) -> dict[str, str]:
        """Where each dataset stands after this run; never before its mark."""
        return {str(d["id"]): max(self.end, _moment(d["mark"])).isoformat() for d in self.datasets}

    def between(self, starts: dict[str, str], ends: dict[str, str]) -> list[WindowPartition]:
        """Consecutive half-open windows, the last one clipped. A dataset the starts do not know begins at its mark."""
        found = []
        for d in self.datasets:
            start = _moment(starts.get(str(d["id"]), d["mark"]))
            end = _moment(ends.get(str(d["id"]), d["mark"]))
            step = dt.timedelta(days=d["days"])
            if step <= dt.timedelta(0):
                raise ValueError(f"dataset {d['id']}: load_increment_days must be positive")
            while start < end:
                found.append(WindowPartition(d["id"], d["name"], start, min(start + step, end), d["page_size"]))
                start += step
        return found


def paged_source(get_page: GetPage, name: str = "paged", pause: float = FIRST_PAUSE, between: float = 0.0) -> type[DataSource]:
    """A data source whose partitions are windows and whose rows are records as JSON text.

        spark.dataSource.register(paged_source(get_page))
        spark.read.format("paged").options(**window_options(active, end)).load()
        spark.readStream.format("paged").options(...)

    As a stream its offsets are the moments up to which each dataset is fetched: a run
    goes on where the last one ended, and a batch that is repeated after a lost driver asks for the
    same windows.
    """

    class Batch(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.windows = Windows(options)

        def partitions(self) -> list[WindowPartition]:
            # A source without windows still has one partition, an empty window.
            found = self.windows.between(self.windows.marks(), self.windows.ends())
            end = self.windows.end
            return found or [WindowPartition(0, "", end, end, 0)]

        def read(self, partition: WindowPartition) -> Iterator[pa.RecordBatch]:
            if partition.start < partition.end:
                yield from partition.read(get_page, pause, between)

    class Stream(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]):
            self.windows = Windows(options)

        def initialOffset(self) -> dict[str, str]:
            return self.windows.marks()

        def latestOffset(self) -> dict[str, str]:
            return self.windows.ends()

        def partitions(self, start: dict[str, str], end: dict[str, str]) -> list[WindowPartition]:
            return self.windows.between(start, end)

        def read(self, partition: WindowPartition) -> Iterator[pa.RecordBatch]:
            yield from partition.read(get_page, pause, between)

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGED_SCHEMA

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Batch(self.options)

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return Stream(self.options)

    return Paged


def window_options(active: DataFrame, end: dt.datetime) -> dict[str, str]:
    """Options of the source for the active datasets (``active_datasets``), one row each."""
    told = active.select(
        "source_dataset_id",
        "source_dataset_name",
        F.date_format(to_typed("last_timestamp", "timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("mark"),
        parameter_int("load_increment_days").alias("days"),
        parameter_int("page_size").alias("page_size"),
    ).collect()
    for r in told:
        if r.mark is None:
            raise ValueError(f"dataset {r.source_dataset_id}: no watermark")
    datasets = [{"id": r.source_dataset_id, "name": r.source_dataset_name, "mark": r.mark, "days": r.days, "page_size": r.page_size} for r in told]
    return {"datasets": json.dumps(datasets), "end": end.isoformat()}


def read_windows(spark: SparkSession, get_page: GetPage, active: DataFrame, end: dt.datetime, stream: bool = False, **pauses: float) -> DataFrame:
    """Records of all windows up to ``end``, with their dataset and window, each a JSON text."""
    share_package(spark)
    spark.dataSource.register(paged_source(get_page, "gridtide_paged", **pauses))
    reader = spark.readStream if stream else spark.read
    return reader.format("gridtide_paged").options(**window_options(active, end)).load()


def fields_of(windows: DataFrame, extra_fields: Sequence[str] = ()) -> DataFrame:
    """The records as columns, fields nobody names in the rescued one, next to dataset and window."""
    own: list[str | Column] = [n for n in PAGED_ARROW.names if n != "value"]
    return records_of(windows, extra_fields, own)
