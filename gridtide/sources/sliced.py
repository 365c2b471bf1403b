"""Tables that change: parquet written in slices, one new folder per version.

    <path>/data/v=<n>-<attempt>/slice=<s>/part-*.parquet   rows of the slices version n changed
    <path>/versions/v=<n>.json                             where every slice lies, who wrote

A change rewrites only the slices it touches, never a file that is being read.
Version n counts once its file is there. The file appears whole or not at all, and
only one writer can make it; each attempt writes into a folder of its own. So
of writers side by side one succeeds. Another one whose slices nobody else
changed moves on to the next version; if they were changed it is told
(``BaseChanged``) and merges anew. What a lost driver left is not read.
The number of slices is bounded by the slicing rule (months or days of the
calendar, or a fixed number of hash buckets), so the version files are the only
thing that reaches the driver, and reading or writing one takes no Spark job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from contextlib import suppress
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_path
from .tables import create_once, delete_folder, empty_table, folder_entries, read_text


class BaseChanged(RuntimeError):
    """Another writer changed, meanwhile, what this change was computed from."""


class VersionTaken(RuntimeError):
    """Another writer made this version."""


def month_slices(date_key: str) -> Callable[[], Column]:
    """One slice per month of a ``yyyyMMdd`` key, and slice 0 for NULL."""
    return lambda: F.coalesce(F.call_function("div", F.col(date_key), F.lit(100)), F.lit(0))


def day_slices(date_key: str) -> Callable[[], Column]:
    """One slice per day, for tables whose months are too big to rewrite."""
    return lambda: F.coalesce(F.col(date_key), F.lit(0)).cast("bigint")


def hash_slices(keys: Sequence[str], n: int) -> Callable[[], Column]:
    """A fixed number of slices by hash of the keys."""
    return lambda: F.pmod(F.xxhash64(*keys), F.lit(n)).cast("bigint")


@dataclass(frozen=True)
class Snapshot:
    """The newest committed version: where each slice lies, who wrote last, and who wrote what before."""

    version: int
    slices: dict[int, int]
    writer: str | None = None
    batch_id: int = -1
    folders: dict[int, str] = field(default_factory=dict)  # of the versions that slices lie in
    writers: dict[str, int] = field(default_factory=dict)  # newest batch of each writer
    marker: str | None = None  # all rows up to this sequence are removed

    def has(self, writer: str | None, batch_id: int) -> bool:
        """Whether a batch of a writer is in this version."""
        return writer is not None and batch_id <= self.writers.get(writer, -1)

    def to_text(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def of(cls, text: str) -> Snapshot:
        told = json.loads(text)
        numbered = {name: {int(k): v for k, v in told[name].items()} for name in ("slices", "folders")}
        return cls(**{**told, **numbered})


EMPTY = Snapshot(-1, {})


@dataclass(frozen=True)
class SlicedTable:
    path: str
    schema: T.StructType
    slicing: Callable[[], Column]
    sort_columns: tuple[str, ...] = ()

    @property
    def _data(self) -> str:
        return join_path(self.path, "data")

    @property
    def _versions(self) -> str:
        return join_path(self.path, "versions")

    def create(self, spark: SparkSession) -> None:
        """Declare the table; does nothing where it exists."""
        if self.snapshot(spark) == EMPTY:
            with suppress(VersionTaken):
                self._commit(spark, Snapshot(0, {}))

    def snapshot(self, spark: SparkSession) -> Snapshot:
        """The newest committed version; each one lists all slices it is made of."""
        versions = self._numbered(spark)
        return self._version(spark, max(versions)) if versions else EMPTY

    def _version(self, spark: SparkSession, version: int) -> Snapshot:
        return Snapshot.of(read_text(spark, self._version_file(version)))

    def _numbered(self, spark: SparkSession) -> list[int]:
        names = folder_entries(spark, self._versions)
        return [int(name[2:-5]) for name in names if name.startswith("v=") and name.endswith(".json")]

    def _version_file(self, version: int) -> str:
        return join_path(self._versions, f"v={version}.json")

    def _folder(self, snapshot: Snapshot, slice_: int) -> str:
        return join_path(self._data, snapshot.folders[snapshot.slices[slice_]], f"slice={slice_}")

    def read(
        self,
        spark: SparkSession,
        snapshot: Snapshot | None = None,
        slices: Sequence[int] | None = None,
    ) -> DataFrame:
        """Current rows, of all slices or of some; only their folders are listed."""
        at = snapshot or self.snapshot(spark)
        wanted = at.slices if slices is None else [s for s in slices if s in at.slices]
        folders = [self._folder(at, s) for s in wanted]
        if not folders:
            return empty_table(spark, self.schema)
        return spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(*folders)

    def folders(self, spark: SparkSession) -> list[str]:
        """Folders of the current version, one per slice."""
        at = self.snapshot(spark)
        return [self._folder(at, s) for s in sorted(at.slices)]

    def write(
        self,
        spark: SparkSession,
        base: Snapshot,
        rows: DataFrame,
        writer: str | None = None,
        batch_id: int = -1,
        touched: Iterable[int] | None = None,
        marker: str | None = None,
    ) -> Snapshot:
        """Write the new content of some slices as the next version.

        ``rows`` holds those slices as a whole; the others stay as in ``base``, and
        of the ``touched`` ones those without rows go. Without ``touched`` any other
        writer's version is a conflict.
        The rebalance gathers a slice into few files and splits a big one over
        several tasks; sorted rows give row groups narrow key ranges to skip by.
        """
        folder = f"v={base.version + 1}-{uuid.uuid4().hex[:12]}"
        target = join_path(self._data, folder)
        shaped = rows.select(*self.schema.fieldNames(), self.slicing().alias("slice"))
        (
            shaped.hint("rebalance", "slice")
            .sortWithinPartitions("slice", *self.sort_columns)
            .write.mode("overwrite")
            .partitionBy("slice")
            .parquet(target)
        )
        names = folder_entries(spark, target)
        written = [int(n[len("slice=") :]) for n in names if n.startswith("slice=")]
        touched = None if touched is None else {*touched}
        mine = None if touched is None else {*touched, *written}
        stray = [s for s in written if touched is not None and s in base.slices and s not in touched]
        if stray:
            raise ValueError(f"{self.path}: rows for slices {stray}, whose former rows were not read")
        at = base
        while True:
            version = at.version + 1
            slices = {s: v for s, v in at.slices.items() if s not in (mine or ())} | {s: version for s in written}
            folders = {v: at.folders.get(v, folder) for v in {*slices.values()}}
            writers = at.writers if writer is None else {**at.writers, writer: batch_id}
            now = Snapshot(version, slices, writer, batch_id, folders, writers, marker or at.marker)
            try:
                self._commit(spark, now)
                return now
            except VersionTaken:
                at = self._moved_on(spark, base, mine, writer, batch_id, target)

    def _moved_on(self, spark, base: Snapshot, mine: set[int] | None, writer, batch_id: int, target: str) -> Snapshot:
        """The newest version, if a change computed from ``base`` still holds on top of it."""
        at = self.snapshot(spark)
        same = mine is not None and at.marker == base.marker and not at.has(writer, batch_id)
        if same and all(at.folders.get(at.slices.get(s)) == base.folders.get(base.slices.get(s)) for s in mine):
            return at
        delete_folder(spark, target)
        raise BaseChanged(f"{self.path}: version {at.version} changed what was computed from version {base.version}")

    def replace(self, spark: SparkSession, rows: DataFrame) -> Snapshot:
        """Replace the whole table by rows computed from an earlier version."""
        return self.write(spark, replace(self.snapshot(spark), slices={}, folders={}), rows)

    def _commit(self, spark: SparkSession, snapshot: Snapshot) -> None:
        if not create_once(spark, self._version_file(snapshot.version), snapshot.to_text()):
            raise VersionTaken(self._version_file(snapshot.version))

    def prune(self, spark: SparkSession, keep: int = 5) -> list[str]:
        """Delete folders that none of the last ``keep`` versions refers to, and what writers left
        that did not get to the oldest of them."""
        versions = sorted(self._numbered(spark))
        former, kept = versions[:-keep], versions[-keep:]
        if not former:
            return []
        listed = self._listed(spark, kept)
        stale = self._listed(spark, former) - listed
        folders = [join_path(self._data, folder, f"slice={s}") for folder, s in sorted(stale)]
        folders += [self._version_file(v) for v in former]
        known = {folder for folder, _ in listed}
        left = [n for n in folder_entries(spark, self._data) if n.startswith("v=") and n not in known and int(n[2:].split("-")[0]) < kept[0]]
        for folder in [*folders, *(join_path(self._data, name) for name in left)]:
            delete_folder(spark, folder)
        return folders

    def _listed(self, spark: SparkSession, versions: Sequence[int]) -> set[tuple[str, int]]:
        """Data folders that some versions are made of: versions times slices at most."""
        found = (self._version(spark, v) for v in versions)
        return {(at.folders[v], s) for at in found for s, v in at.slices.items()}
