"""spark-submit entry: one pipeline run over a folder of records.

    spark-submit --py-files gridtide.zip gridtide/__main__.py --root s3a://lake --environment dev \\
        --datasets '[{"id": 245, "name": "Wind power generation"}]' --records s3a://drop/readings
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Layout, parse_datasets
from .plans.pipeline import publish, run_pipeline
from .session import build_session
from .sources.landing import read_landing


def feed_from(spark: SparkSession, path: str, multi_line: bool, extra_fields: Sequence[str] = ()):
    """Records of a folder, unreadable lines too; the windows pick from them when they
    are landed, and the rest is landed as rejected."""

    def feed(windows: DataFrame) -> DataFrame:
        records = read_landing(spark, path, multi_line, extra_fields)
        return records.select(F.col("datasetId").try_cast("int").alias("source_dataset_id"), "*")

    return feed


def main() -> None:
    parser = argparse.ArgumentParser(prog="gridtide", description=__doc__)
    parser.add_argument("--root", required=True)
    parser.add_argument("--environment", default="dev", choices=["dev", "test", "prod"])
    parser.add_argument("--datasets", required=True, help="JSON array of id and name")
    parser.add_argument("--records", required=True, help="folder of JSON records")
    parser.add_argument("--multi-line", action="store_true", help="files hold JSON arrays")
    parser.add_argument("--max-files-per-trigger", help="bounds the size of a micro-batch")
    parser.add_argument("--max-bytes-per-trigger", help="the same by size; a first load is cut by it")
    args = parser.parse_args()

    spark = build_session()
    layout = Layout(args.root, args.environment)
    datasets = parse_datasets(args.datasets)
    limits = {}
    if args.max_files_per_trigger:
        limits["maxFilesPerTrigger"] = args.max_files_per_trigger
    if args.max_bytes_per_trigger:
        limits["maxBytesPerTrigger"] = args.max_bytes_per_trigger
    extra = tuple(dict.fromkeys(f for d in datasets for f in d.extra_fields))
    feed = feed_from(spark, args.records, args.multi_line, extra)
    totals = run_pipeline(spark, layout, datasets, feed, **limits)
    publish(spark, layout, datasets)
    for table, counts in totals.items():
        print(table, counts)


if __name__ == "__main__":
    main()
