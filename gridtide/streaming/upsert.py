"""Change-data flow into a sliced table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import SEQUENCE, latest_per_key
from ..sources.sliced import BaseChanged, SlicedTable
from .runs import batch_run, query_id


# Attempts of a merge whose slices other writers keep changing.
ATTEMPTS = 20

# What a merge writes from the rows it reads, and which slices it touches.
Shape = Callable[[DataFrame], DataFrame]


def merged(write: Callable[[], None]) -> None:
    """Merge, and merge anew while other writers change the same slices in between."""
    for attempt in range(ATTEMPTS):
        try:
            return write()
        except BaseChanged:
            if attempt == ATTEMPTS - 1:
                raise


def upsert(
    table: SlicedTable,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str = SEQUENCE,
    writer: str | None = None,
    batch_id: int = -1,
    reach: DataFrame | None = None,
) -> None:
    """Merge changes into the slices they touch; other slices are not read.

    A batch that its writer has committed before is left out, so a replay
    after a lost driver changes nothing. ``reach`` has a column ``slice`` with the
    slices of the changes, where that takes less than the changes themselves.
    """
    spark = changes.sparkSession

    def write() -> None:
        base, rows, slices = table.snapshot(spark), changes, None
        if base.has(writer, batch_id):
            return
        # a first load, often the largest, has nothing to merge with
        if base.slices:
            touched = changes.select(table.slicing().alias("slice")) if reach is None else reach
            slices = [r.slice for r in touched.select("slice").distinct().collect()]
            if not slices:
                return
            rows = table.read(spark, base, slices).unionByName(changes)
        table.write(spark, base, latest_per_key(rows, keys, sequence_by), writer, batch_id, slices)

    merged(write)


def run_upsert(
    table: SlicedTable,
    changes: DataFrame,
    keys: Sequence[str],
    checkpoint: str,
    name: str,
    sequence_by: str = SEQUENCE,
    shape: Shape | None = None,
    reach: Shape | None = None,
) -> StreamingQuery:
    """Keep a table at the newest row per key of a stream of changes.

    ``shape`` makes changes of the rows of a micro-batch, for example by lookups;
    ``reach`` gives the slices of these rows without doing so.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        writer = query_id(batch.sparkSession, checkpoint)
        shaped = shape(batch) if shape else batch
        upsert(table, shaped, keys, sequence_by, writer, batch_id, reach(batch) if reach else None)

    table.create(changes.sparkSession)
    return batch_run(changes, apply, checkpoint, name)
