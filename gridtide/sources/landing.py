"""Landing zone: JSON files per dataset and load window.

    landing/dataset=<id>_<name>/batch=<start>_to_<end>/part-*.json

Our writer makes one record per line, because such files can be split over
tasks. Files that hold one JSON array each are read with ``multi_line``; a
task then needs memory for a whole file.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Dataset
from ..functions.typing import as_column, compact_text
from ..operators.windows import batch_name
from ..schemas import CORRUPT_COLUMN, LANDING, RESCUED_COLUMN, TEXT
from ..session import join_path
from .tables import ANY_AGE, delete_folder, folder_entries, literal_rows, move_folder, path_exists


def dataset_key(dataset_id, dataset_name):
    """``Dataset.key`` as a column, for many datasets in one write."""
    name = F.regexp_replace(F.lower(as_column(dataset_name)), "[^0-9a-z_]", "_")
    return F.concat_ws("_", as_column(dataset_id).cast("string"), name)


# Where records lie that no window took: one folder per reason and run.
REJECTED = "_rejected"

WINDOW_COLUMNS = ("source_dataset_id", "source_dataset_name", "window_start", "window_end")


def _folders(records: DataFrame) -> list:
    dataset = dataset_key("source_dataset_id", "source_dataset_name")
    batch = batch_name(F.col("window_start"), F.col("window_end"))
    if "rejected" in records.columns:
        refused = F.col("rejected").isNotNull()
        dataset = F.when(refused, F.lit(REJECTED)).otherwise(dataset)
        batch = F.when(refused, F.concat_ws("_at_", "rejected", compact_text("rejected_at"))).otherwise(batch)
    return [dataset.alias("dataset"), batch.alias("batch")]


def rejected_counts(spark: SparkSession, root: str, at) -> DataFrame:
    """(reason, n) of the records that the run ending ``at`` landed in no window."""
    ends = F.concat(F.lit("_at_"), compact_text(at))
    folder = f"{root.rstrip('/')}/dataset={REJECTED}"
    if not path_exists(spark, folder):
        return spark.range(0).select(F.lit("").alias("reason"), F.lit(0).cast("long").alias("n"))
    rows = spark.read.schema("value string, batch string").option("basePath", folder).json(folder)
    mine = rows.where(F.col("batch").endswith(ends))
    return mine.groupBy(F.regexp_replace("batch", "_at_[^_]*$", "").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def write_landing(records: DataFrame, root: str, gathered: bool = False) -> None:
    """Land records that carry their dataset and window (see ``assign_windows``);
    all their other columns are fields.

    A window that is landed again replaces its former files; other windows stay.
    The rebalance gathers each window into few files and splits a window that
    holds much of the data, so neither tiny files nor one huge task result.
    Records that come window by window, as from ``fetch_windows``, are
    ``gathered`` already and need no shuffle.
    """
    shaped = records.select(
        *_folders(records),
        *[name for name in records.columns if name not in (*WINDOW_COLUMNS, "rejected", "rejected_at")],
    )
    placed = shaped if gathered else shaped.hint("rebalance", "dataset", "batch")
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "batch")
        .json(root)
    )


def write_whole_records(windows: DataFrame, root: str) -> None:
    """Land records as the source gave them, one JSON text a line, per dataset and window.

    The windows come gathered, one per task, so there is no shuffle. A window that is
    landed again replaces its former files.
    """
    dataset = dataset_key("source_dataset_id", "source_dataset_name").alias("dataset")
    batch = batch_name(F.col("window_start"), F.col("window_end")).alias("batch")
    (
        windows.select(dataset, batch, "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "batch")
        .text(root)
    )


# Folders of landed windows, and of records taken in again; others are left where they are.
LANDED = re.compile(r"batch=(\d{8}T\d{6}Z_to_\d{8}T\d{6}Z|[a-z_]+_at_\d{8}T\d{6}Z)")


def archive_landed(spark: SparkSession, landing: str, archive: str) -> list[str]:
    """Move the landed windows of a dataset out of the folder that its stream lists.

    Only names move, so a run lists what was landed since the last one and not its whole history.
    """
    moved = [name for name in folder_entries(spark, landing) if LANDED.fullmatch(name)]
    for name in moved:
        move_folder(spark, join_path(landing, name), join_path(archive, name))
    return moved


def readmit(spark: SparkSession, root: str, datasets: Sequence[Dataset], reason: str) -> int:
    """Land records again that no window took for this ``reason``; the next run reads them.

    Each goes, as it is, to the folder of the dataset its ``datasetId`` names, under the name
    it was rejected by, so a call that is interrupted can be repeated. Records of no known dataset stay
    rejected. Gives the number of records landed.
    """
    folder = join_path(root, f"dataset={REJECTED}")
    names = [name for name in folder_entries(spark, folder) if name.startswith(f"batch={reason}_at_")]
    if not names or not datasets:
        return 0
    known = literal_rows(spark, [(str(d.id), d.key) for d in datasets], id="string", dataset="string")
    texts = spark.read.option("basePath", folder).text([join_path(folder, name) for name in names])
    named = texts.join(known, F.get_json_object("value", "$.datasetId") == F.col("id"), "left")
    back = named.where("dataset IS NOT NULL").select("dataset", "batch", "value")
    seen = Observation("readmitted")
    (
        back.observe(seen, F.count(F.lit(1)).alias("n"))
        .hint("rebalance", "dataset", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "batch")
        .text(root)
    )
    left = named.where("dataset IS NULL").select(F.lit(REJECTED).alias("dataset"), F.concat(F.lit("no_dataset"), F.regexp_extract("batch", "_at_.*", 0)).alias("batch"), "value")
    if reason != "no_dataset":
        left.write.mode("append").partitionBy("dataset", "batch").text(root)
        for name in names:
            delete_folder(spark, join_path(folder, name))
    return seen.get["n"]


def landing_schema(extra_fields: Sequence[str] = ()) -> T.StructType:
    added = [T.StructField(f, TEXT) for f in extra_fields if f not in LANDING.fieldNames()]
    return T.StructType([*LANDING.fields, *added, T.StructField(CORRUPT_COLUMN, TEXT), T.StructField(RESCUED_COLUMN, TEXT)])


def infer_extra_fields(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[str, ...]:
    """Fields that occur in the files besides the usual ones; reads every file."""
    found = (
        spark.read.option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("primitivesAsString", True)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )
    usual = {*LANDING.fieldNames(), CORRUPT_COLUMN}
    return tuple(name for name in found.columns if name not in usual)


EVERY_FOLDER = {"recursiveFileLookup": "true"}


def records_of(texts: DataFrame, extra_fields: Sequence[str] = (), others: Sequence[str] = ()) -> DataFrame:
    """Records of the JSON texts in ``value``, each an object or an array of them, in one parse;
    ``others`` are columns that stay.

    Every field is text, a nested one its JSON. The named fields are columns; all others of a record
    are kept as one JSON object in the rescued column, so that a source may add fields at any
    time. A text that is no JSON is one row, kept whole.
    """
    schema = landing_schema(extra_fields)
    named = [name for name in schema.fieldNames() if name not in (CORRUPT_COLUMN, RESCUED_COLUMN)]
    value = F.col("value")
    whole = F.when(F.ltrim(value).startswith("["), value).otherwise(F.concat(F.lit("["), value, F.lit("]")))
    parsed = F.from_json(whole, "array<map<string,string>>")
    bad = parsed.isNull() | F.exists(parsed, lambda record: record.isNull())
    one = F.explode(F.when(bad, F.array(F.lit(None).cast("map<string,string>"))).otherwise(parsed))
    rows = texts.where(F.trim(value, F.lit(" \t\r\n")) != "").select(*others, value, one.alias("record"))
    rest = F.map_filter("record", lambda name, _: ~name.isin(named))
    return rows.select(
        *others,
        *[F.try_element_at("record", F.lit(name)).alias(name) for name in named],
        F.when(F.col("record").isNull(), F.col("value")).alias(CORRUPT_COLUMN),
        F.when(F.size(rest) > 0, F.to_json(rest)).alias(RESCUED_COLUMN),
    )


def read_landing(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    extra_fields: Sequence[str] = (),
) -> DataFrame:
    """All files below a folder as a batch frame."""
    return records_of(spark.read.options(**EVERY_FOLDER).text(path, wholetext=multi_line), extra_fields)


def stream_landing(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    extra_fields: Sequence[str] = (),
    **limits: str,
) -> DataFrame:
    """Files not seen by this stream before; ``limits`` are options of the file
    source such as maxFilesPerTrigger, maxBytesPerTrigger or cleanSource."""
    reader = spark.readStream.options(**{**ANY_AGE, **EVERY_FOLDER, **limits})
    return records_of(reader.text(path, wholetext=multi_line), extra_fields)
