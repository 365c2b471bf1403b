"""Counts that ride along with stream runs."""

from __future__ import annotations

import json
import threading
import warnings
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import join_path
from ..sources.tables import create_once, folder_entries, path_exists


class MetricsTable:
    """Rule counts of every micro-batch of every stream, kept for good.

        <path>/stream=<name>/<stream id>-<batch id>.json     one line, written once

    The counts are those observed in the pass that wrote the batch. A batch that is
    repeated finds its file there and adds nothing. A driver lost between the commit of a batch and its
    report leaves that batch without a file; ``uncounted`` names such batches.
    """

    COLUMNS = "stream_id string, batch_id long, at timestamp, total long, failed map<string,long>"

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path

    def add(self, name: str, stream_id: str, batch_id: int, at: str, counts: dict[str, int]) -> bool:
        """False if this batch of the stream is in the table."""
        failed = {k[len("failed_") :]: n for k, n in counts.items() if k.startswith("failed_")}
        row = {"stream_id": stream_id, "batch_id": batch_id, "at": at, "total": counts["total"], "failed": failed}
        return create_once(self._spark, join_path(self.path, f"stream={name}", f"{stream_id}-{batch_id:09d}.json"), json.dumps(row))

    def read(self) -> DataFrame:
        """stream, stream_id, batch_id, at, rule, passed, failed."""
        if not path_exists(self._spark, self.path):
            rows = self._spark.createDataFrame([], f"{self.COLUMNS}, stream string")
        else:
            rows = self._spark.read.schema(f"{self.COLUMNS}, stream string").json(self.path)
        rules = rows.select("stream", "stream_id", "batch_id", "at", "total", F.explode("failed").alias("rule", "failed"))
        return rules.select("stream", "stream_id", "batch_id", "at", "rule", (F.col("total") - F.col("failed")).alias("passed"), "failed")

    def uncounted(self, name: str, stream_id: str, checkpoint: str) -> list[int]:
        """Committed batches of a stream that the table lacks."""
        done = {int(n) for n in folder_entries(self._spark, join_path(checkpoint, "commits")) if n.isdigit()}
        files = folder_entries(self._spark, join_path(self.path, f"stream={name}"))
        told = {int(n[len(stream_id) + 1 : -5]) for n in files if n.startswith(f"{stream_id}-") and n.endswith(".json")}
        return sorted(done - told)


class ObservedCounts(StreamingQueryListener):
    """Sums the counts observed in every micro-batch of the runs started inside.

        with ObservedCounts(spark, "reading_rules") as counts:
            query = ...
        counts.of(query)

    With ``history`` the counts of each micro-batch are also kept in that table.
    """

    def __init__(self, spark: SparkSession, name: str, patience: float = 60.0, history: MetricsTable | None = None) -> None:
        self._spark, self._name, self._patience, self._history = spark, name, patience, history
        self._totals: dict[str, dict[str, int]] = defaultdict(dict)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> ObservedCounts:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        for ended in list(self._ended.values()):
            ended.wait(self._patience)
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._ended[str(event.runId)]

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self._name)
        if row is not None:
            totals = self._totals[str(event.progress.runId)]
            for key, count in row.asDict().items():
                totals[key] = totals.get(key, 0) + count
            if self._history is not None:
                told = event.progress
                self._history.add(told.name, str(told.id), told.batchId, told.timestamp, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery) -> dict[str, int]:
        """Counts of a finished run; empty if it had nothing to read, or if its end is not told in time. Events come
        in order, so all counts are in once the end of the run was told."""
        if not self._ended[str(query.runId)].wait(self._patience):
            warnings.warn(f"run {query.runId} did not report its end; its counts are left out", stacklevel=2)
            return {}
        return dict(self._totals[str(query.runId)])
