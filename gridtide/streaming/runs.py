"""Starting and finishing triggered stream runs."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import join_path
from ..sources.tables import read_text


def _triggered(frame: DataFrame, checkpoint: str, name: str) -> DataStreamWriter:
    """Process all that is there now, then stop; the checkpoint keeps the place."""
    return (
        frame.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def append_run(frame: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """Append the new rows of a stream to a parquet table, each exactly once."""
    writer = _triggered(frame, checkpoint, name).outputMode("append")
    return writer.format("parquet").option("path", path).start()


def batch_run(
    frame: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
) -> StreamingQuery:
    """Hand every micro-batch to ``apply``."""
    return _triggered(frame, checkpoint, name).outputMode("update").foreachBatch(apply).start()


def finish(queries: Iterable[StreamingQuery]) -> list[StreamingQuery]:
    """Wait for runs that were started side by side; the first error is raised
    after all of them have ended."""
    queries, failure = list(queries), None
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:
            failure = failure or error
    if failure:
        raise failure
    return queries


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream that owns a checkpoint; it outlives restarts."""
    return json.loads(read_text(spark, join_path(checkpoint, "metadata")))["id"]
