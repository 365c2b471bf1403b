"""Landing -> bronze."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Dataset, Layout
from ..operators.bronze import with_origin
from ..operators.quality import READING_RULES, expect_all_or_drop, observed
from ..sources.landing import landing_schema, stream_landing
from ..sources.tables import ensure_folder
from .runs import append_run

# Name under which a run reports its rule counts.
RULE_COUNTS = "reading_rules"


def bronze_stream(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    extra_fields: Sequence[str] = (),
    now: Column | None = None,
    rules: dict[str, str] = READING_RULES,
    **limits: str,
) -> DataFrame:
    """New landed records that meet the rules, with origin and arrival time."""
    landed = with_origin(stream_landing(spark, path, multi_line, extra_fields, **limits), now)
    return expect_all_or_drop(observed(landed, RULE_COUNTS, rules), rules)


def bronze_schema(extra_fields: Sequence[str] = ()) -> T.StructType:
    return (
        landing_schema(extra_fields)
        .add("source_file", T.StringType())
        .add("ingestion_timestamp", T.TimestampType())
    )


def run_bronze(
    spark: SparkSession,
    layout: Layout,
    dataset: Dataset,
    now: Column | None = None,
    **limits: str,
) -> StreamingQuery:
    source = layout.landing_of(dataset)
    ensure_folder(spark, source)
    ensure_folder(spark, layout.bronze(dataset))
    stream = bronze_stream(spark, source, dataset.multi_line, dataset.extra_fields, now, **limits)
    table = dataset.bronze_table
    return append_run(stream, layout.bronze(dataset), layout.checkpoint("bronze", table), table)
