"""Bronze -> silver."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Dataset, Layout
from ..operators.silver import Transformation
from ..schemas import BRONZE
from ..sources.tables import ensure_folder, stream_table
from .runs import append_run


def run_silver(
    spark: SparkSession,
    layout: Layout,
    dataset: Dataset,
    transformation: Transformation,
    now: Column | None = None,
    **limits: str,
) -> StreamingQuery:
    ensure_folder(spark, layout.silver(dataset))
    raw = stream_table(spark, layout.bronze(dataset), BRONZE, **limits)
    table = dataset.silver_table
    return append_run(
        transformation(raw, now),
        layout.silver(dataset),
        layout.checkpoint("silver", table),
        table,
    )
