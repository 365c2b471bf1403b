"""A window, slice or key with much of the data is spread over tasks."""

import pytest
from pyspark.sql import functions as F

from gridtide.operators.upsert import latest_per_key
from gridtide.schemas import LONG, TEXT, table_of
from gridtide.sources.landing import read_landing, write_landing
from gridtide.sources.sliced import SlicedTable, month_slices


@pytest.fixture
def small_partitions(spark):
    """Partitions of 64 KiB stand for the sizes of a cluster."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for name in names:
        spark.conf.set(name, "64k")
    yield
    for name in names:
        spark.conf.unset(name)


def test_hot_window_is_landed_by_many_tasks(spark, tmp_path, small_partitions):
    start = F.timestamp_seconds(F.lit(1735689600) + F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5) * 86400)
    records = spark.range(0, 60_000, 1, 8).select(
        F.lit(1).alias("source_dataset_id"),
        F.lit("a").alias("source_dataset_name"),
        start.alias("window_start"),
        (start + F.expr("INTERVAL 1 DAY")).alias("window_end"),
        F.lit("1").alias("datasetId"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    )
    write_landing(records, str(tmp_path))
    files = {
        p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "dataset=1_a").iterdir()
    }
    assert len(files) == 5
    assert files["batch=20250101T000000Z_to_20250102T000000Z"] >= 4
    assert read_landing(spark, str(tmp_path)).count() == 60_000


def test_hot_slice_is_written_by_many_tasks(spark, tmp_path, small_partitions):
    schema = table_of(start_date_id=LONG, n=LONG, v=TEXT)
    table = SlicedTable(str(tmp_path), schema, month_slices("start_date_id"), ("start_date_id", "n"))
    table.create(spark)
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 20250101).otherwise(20250101 + F.col("id") % 3 * 100).alias("start_date_id"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    table.replace(spark, rows)
    assert all(len(list(p.glob("part-*"))) > 1 for p in (tmp_path / "data" / "v=1").glob("slice=*"))
    assert table.read(spark).count() == 40_000


def test_hot_key_sends_one_row_per_task(spark):
    rows = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        F.lit("x").alias("v"),
    )
    latest = latest_per_key(rows, ["k"], "seq")
    assert latest.count() == 60_001
    assert latest.where("k = 0").first().seq == 89_997
    # six map tasks with one row of the hot key each, and 60,000 single keys
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
