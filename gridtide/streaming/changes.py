"""Change-data flows with deletes, truncates, partial updates and history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import ChangeRule
from ..sources.sliced import SlicedTable, Snapshot
from .runs import batch_run, query_id
from .upsert import merged


@dataclass(frozen=True)
class ChangeTable:
    """A table that changes follow a rule into. ``schema`` is that of the changes; the
    slicing must depend on nothing but the keys, so that all changes of a key meet."""

    path: str
    schema: T.StructType
    rule: ChangeRule
    slicing: Callable[[], Column]

    @property
    def state(self) -> SlicedTable:
        sort = (*self.rule.keys, *([self.rule.sequence_by] if self.rule.history else ()))
        return SlicedTable(self.path, self.rule.state_schema(self.schema), self.slicing, sort)

    def create(self, spark: SparkSession) -> None:
        self.state.create(spark)

    def read(self, spark: SparkSession, snapshot: Snapshot | None = None) -> DataFrame:
        """The visible rows: a filter over the state."""
        at = snapshot or self.state.snapshot(spark)
        kept = self.rule.after(self.state.read(spark, at), at.marker)
        return self.rule.visible(kept, self.rule.kept(self.schema.fieldNames()))

    def merge(self, changes: DataFrame, writer: str | None = None, batch_id: int = -1) -> None:
        """Fold changes into the slices they touch; a batch that is in already changes nothing."""
        spark, rule, state = changes.sparkSession, self.rule, self.state
        names = state.schema.fieldNames()

        def write() -> None:
            base = state.snapshot(spark)
            if base.has(writer, batch_id):
                return
            slices, marker = self._reach(changes, base)
            if slices is not None and not slices and marker == base.marker:
                return
            fresh = rule.state_of(changes)
            rows = fresh
            if slices:
                stored = state.read(spark, base, slices)
                rows = stored.select(*fresh.columns).unionByName(fresh)
            folded = rule.fold(rule.after(rows, marker)).select(*names)
            state.write(spark, base, folded, writer, batch_id, slices, marker)

        merged(write)

    def _reach(self, changes: DataFrame, base: Snapshot) -> tuple[list[int] | None, str | None]:
        """Slices that changes touch (None: there are none to merge with) and the newest truncate, in at most one job."""
        rule = self.rule
        if not base.slices and not rule.truncates:
            return None, base.marker
        asked = [F.collect_set(self.slicing()).alias("slices")]
        if rule.truncates:
            before = F.lit(base.marker).cast(self.schema[rule.sequence_by].dataType)
            asked.append(F.greatest(rule.truncate_mark(changes), before).cast("string").alias("marker"))
        told = changes.agg(*asked).first()
        return (told.slices if base.slices else None), (told.marker if rule.truncates else base.marker)


def run_changes(table: ChangeTable, changes: DataFrame, checkpoint: str, name: str) -> StreamingQuery:
    """Keep a table up to date with a stream of changes."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, query_id(batch.sparkSession, checkpoint), batch_id)

    table.create(changes.sparkSession)
    return batch_run(changes, apply, checkpoint, name)
