"""Layer tables stored as parquet folders."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _located(spark: SparkSession, path: str):
    """File system and path object of a folder, whatever storage it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make an empty folder, so that a stream over it can start."""
    files, where = _located(spark, path)
    files.mkdirs(where)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], **columns: str) -> DataFrame:
    """A few fixed rows inside the plan, so that Catalyst knows their size."""
    text = json.dumps([dict(zip(columns, row)) for row in rows])
    fields = ", ".join(f"{name}: {kind}" for name, kind in columns.items())
    entries = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    return spark.range(0, 1, 1, numPartitions=1).select(F.inline(entries))


def delete_folder(spark: SparkSession, path: str) -> None:
    files, where = _located(spark, path)
    files.delete(where, True)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name; where that is taken (by a run that was interrupted), what is missing there is moved."""
    files, where = _located(spark, path)
    _, to = _located(spark, target)
    if not files.exists(to):
        files.mkdirs(to.getParent())
        if files.rename(where, to):
            return
        raise OSError(f"could not move {path} to {target}")
    for entry in folder_entries(spark, path):
        _, part = _located(spark, f"{target.rstrip('/')}/{entry}")
        if not files.exists(part):
            files.rename(spark._jvm.org.apache.hadoop.fs.Path(where, entry), part)
    files.delete(where, True)


def folder_entries(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below; none if it is missing."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(where)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver without a job."""
    files, where = _located(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, unless it is there: then False.

    The draft gets its name in one step that fails where the name is taken: a
    link on a local disk, a rename elsewhere (HDFS and stores with real folders). A store
    that copies on rename has no such step; there only one writer may run.
    """
    files, where = _located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent().getParent(), f".draft-{uuid.uuid4().hex}")
    files.mkdirs(where.getParent())
    stream = files.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.makeQualified(where).toUri().getScheme() != "file":
            return bool(not files.exists(where) and files.rename(draft, where))
        paths = spark._jvm.java.nio.file.Paths
        ends = [paths.get(files.makeQualified(p).toUri().getPath(), spark._sc._gateway.new_array(spark._jvm.String, 0)) for p in (where, draft)]
        try:
            spark._jvm.java.nio.file.Files.createLink(*ends)
        except Exception:
            if files.exists(where):
                return False
            raise
        return True
    finally:
        files.delete(draft, False)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows; Catalyst sees that and drops the branch from a plan."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns).limit(0)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A snapshot of a layer table."""
    return spark.read.schema(schema).parquet(path)


# Restored and copied files keep their old dates: without this the file source leaves
# out, silently, what is a week older than the newest file it has seen.
ANY_AGE = {"maxFileAge": "36500d"}


def stream_table(spark: SparkSession, path: str, schema: T.StructType, **limits: str) -> DataFrame:
    """A layer table as a stream of the rows appended to it."""
    return spark.readStream.schema(schema).options(**{**ANY_AGE, **limits}).parquet(path)


def write_static(frame: DataFrame, path: str) -> None:
    """Store a generated table, replacing it as a whole."""
    frame.write.mode("overwrite").parquet(path)
