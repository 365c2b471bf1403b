"""The whole run on a small feed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridtide.config import Layout, parse_datasets
from gridtide.plans import pipeline
from gridtide.plans.pipeline import control_table, publish, run_pipeline
from gridtide.sources.landing import archive_landed, read_landing, readmit
from gridtide.streaming.gold import (
    dim_customer_type_table,
    fact_consumption_table,
    fact_generation_table,
)

UTC = dt.timezone.utc
DATASETS = parse_datasets(
    '[{"id": 248, "name": "Solar power generation"}, {"id": 245, "name": "Wind power generation"},'
    ' {"id": 358, "name": "Electricity consumption", "extra_fields": ["quality"]}, {"id": 7, "name": "Not known"}]'
)
FIELDS = "source_dataset_id int, datasetId string, startTime string, endTime string, value string, additionalJson string"


def reading(id_, start, value, extra=None, end="2025-01-09T00:00:00Z"):
    return (id_, str(id_), start, end, value, extra)


FIRST = [
    reading(245, "2025-01-01T00:00:00Z", "1.5"),
    reading(245, "2025-01-01T02:15:00+02:00", "2.5"),
    reading(248, "2025-01-22T10:45:00Z", "3.5"),
    reading(248, "2025-01-22T10:46:00Z", "abc"),
    reading(248, None, "9"),
    reading(248, "garbage", "8"),
    reading(248, "2025-01-22T10:45:00Z", "9", end=None),
    reading(358, "2025-01-02T00:00:00Z", "5", '{"CustomerType": "Home", "Count": 7, "Value": "5.0"}'),
    reading(358, "2025-01-02T00:00:00Z", "6", "{bad"),
    reading(245, "2024-12-31T23:45:00Z", "0"),  # before the watermark
]


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def feed_of(spark, records):
    return lambda windows: spark.createDataFrame(records, FIELDS).withColumn("quality", F.lit("ok"))


def test_two_runs(spark, rows, layout):
    totals = run_pipeline(
        spark, layout, DATASETS, feed_of(spark, FIRST), dt.datetime(2025, 2, 1, tzinfo=UTC)
    )
    assert totals["248_solar_power_generation_raw_table"] == {
        "total": 5, "failed_Rule1": 1, "failed_Rule2": 1,
    }
    assert totals["7_not_known_raw_table"] == {}
    assert totals["rejected"] == {"before_mark": 1}
    generation = fact_generation_table(layout.gold("fact_generation_forecast"))
    keys = ("start_date_id", "start_time_id", "datasetId", "value_mwh")
    assert rows(generation.read(spark), *keys) == sorted(
        [
            (20250101, 0, "245", 1.5),
            (20250101, 1, "245", 2.5),
            (20250122, 43, "248", 3.5),
            (20250122, None, "248", None),
            (None, None, "248", 8.0),
        ],
        key=repr,
    )
    consumption = fact_consumption_table(layout.gold("fact_consumption"))
    assert rows(consumption.read(spark), "start_date_id", "customer_type", "reading_count") == sorted(
        [(20250102, "Home", 7), (20250102, None, None)], key=repr
    )
    kinds = dim_customer_type_table(layout.gold("dim_customer_type"))
    assert rows(kinds.read(spark), "customer_type") == [("Home",), (None,)]
    marks = control_table(layout).read(spark).select("last_timestamp").distinct()
    assert rows(marks.select(F.col("last_timestamp").cast("string"))) == [("2025-02-01 00:00:00",)]

    # a later run: one changed value, one new day, unchanged rows stay
    second = [
        reading(245, "2025-02-01T00:00:00Z", "10"),
        reading(245, "2025-02-01T00:00:00Z", "10"),
        reading(358, "2025-02-01T00:00:00Z", None, '{"CustomerType": "Home"}'),
    ]
    run_pipeline(spark, layout, DATASETS, feed_of(spark, second), dt.datetime(2025, 2, 2, tzinfo=UTC))
    assert generation.read(spark).count() == 6
    assert rows(generation.read(spark).where("start_date_id = 20250201"), *keys) == [
        (20250201, 0, "245", 10.0)
    ]
    assert consumption.read(spark).count() == 3
    snapshot = generation.snapshot(spark)
    assert snapshot.version == 2
    assert snapshot.slices == {0: 1, 202501: 1, 202502: 2}

    # nothing new: no version is written
    run_pipeline(
        spark, layout, DATASETS, feed_of(spark, []), dt.datetime(2025, 2, 3, tzinfo=UTC), keep_versions=1
    )
    assert generation.snapshot(spark).version == 2
    assert generation.read(spark).count() == 6

    # all tables by name
    publish(spark, layout, DATASETS)
    assert spark.sql("SELECT * FROM gridtide_dev_bronze.`245_wind_power_generation_raw_table`").count() == 4
    kept = spark.sql("SELECT quality FROM gridtide_dev_bronze.`358_electricity_consumption_raw_table`")
    assert rows(kept.distinct()) == [("ok",)]
    assert spark.sql("SELECT * FROM gridtide_dev_silver.`358_electricity_consumption`").count() == 3
    assert spark.sql("SELECT * FROM gridtide_dev_landing_admin.meta_control_table").count() == 3
    joined = spark.sql(
        "SELECT d.year_month, g.generate_type, sum(f.value_mwh) FROM gridtide_dev_gold.fact_generation_forecast f"
        " JOIN gridtide_dev_gold.dim_date d ON d.date_id = f.start_date_id"
        " JOIN gridtide_dev_gold.dim_generate_type g ON string(g.dataset_id) = f.datasetId"
        " GROUP BY ALL"
    )
    assert rows(joined) == [
        ("2025-01", "Solar", 3.5), ("2025-01", "Wind", 4.0), ("2025-02", "Wind", 10.0),
    ]
    told = {
        r.col_name: r.data_type
        for r in spark.sql("DESCRIBE EXTENDED gridtide_dev_bronze.`245_wind_power_generation_raw_table`").collect()
    }
    assert "landing zone" in told["Comment"] and "quality=bronze" in told["Table Properties"]
    publish(spark, layout, DATASETS)


def bronze_rows(spark, layout):
    return {d.key: spark.read.parquet(layout.bronze(d)).count() for d in DATASETS[:3]}


def test_repeated_run_does_not_double(spark, layout, monkeypatch):
    """A run that fails before its mark moves is repeated with the same end, and adds nothing."""
    from gridtide.plans import pipeline

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(pipeline.control, "advance_watermark", fail)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, layout, DATASETS, feed_of(spark, FIRST), dt.datetime(2025, 2, 1, tzinfo=UTC))
    before = bronze_rows(spark, layout)
    run_pipeline(spark, layout, DATASETS, feed_of(spark, FIRST), dt.datetime(2025, 2, 1, 5, tzinfo=UTC))
    assert bronze_rows(spark, layout) == before
    marks = control_table(layout).read(spark).select(F.col("last_timestamp").cast("string")).distinct()
    assert [r[0] for r in marks.collect()] == ["2025-02-01 00:00:00"]


def test_names_hold_in_other_sessions_and_after_pruning(spark, layout):
    run_pipeline(spark, layout, DATASETS, feed_of(spark, FIRST[:2]), dt.datetime(2025, 2, 1, tzinfo=UTC))
    publish(spark, layout, DATASETS)
    later = [reading(245, "2025-02-01T00:00:00Z", "10")]
    run_pipeline(spark, layout, DATASETS, feed_of(spark, later), dt.datetime(2025, 2, 2, tzinfo=UTC), keep_versions=1)
    other = spark.newSession()
    assert other.sql("SELECT * FROM gridtide_dev_gold.fact_generation_forecast").count() == 3
    assert other.sql("SELECT * FROM gridtide_dev_landing_admin.meta_control_table").count() == 3


def test_old_files_are_read(spark, tmp_path):
    """A file much older than the newest one, added later, is not left out."""
    import os
    import time

    from gridtide.sources.landing import stream_landing
    from gridtide.streaming.runs import append_run, finish

    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for n in range(2):
        (folder / f"{n}.json").write_text('{"datasetId": "1"}\n')
        if n:
            os.utime(folder / f"{n}.json", (time.time() - 30 * 86400,) * 2)
        stream = stream_landing(spark, str(folder))
        finish([append_run(stream, out, str(tmp_path / "checkpoint"), "old_files")])
    assert spark.read.parquet(out).count() == 2


def folders(layout, dataset, root="landing"):
    path = layout.at(root, f"dataset={dataset.key}")
    return sorted(n for n in os.listdir(path) if n.startswith("batch=")) if os.path.isdir(path) else []


def test_a_run_lists_only_what_is_new(spark, rows, layout, monkeypatch):
    """Windows that bronze has read are archived; other files in the landing zone stay and are read once."""
    wind = DATASETS[1]
    listed = []
    streams = pipeline.run_streams
    monkeypatch.setattr(pipeline, "run_streams", lambda *a, **k: listed.append(folders(layout, wind)) or streams(*a, **k))
    first = [reading(245, f"2025-01-{d:02d}T00:00:00Z", "1") for d in (1, 15, 30)]
    run_pipeline(spark, layout, DATASETS, feed_of(spark, first), dt.datetime(2025, 2, 1, tzinfo=UTC))
    assert len(listed[0]) == 2 and folders(layout, wind) == []
    other = layout.landing_of(wind) + "/dropped.json"
    with open(other, "w") as out:
        out.write('{"datasetId": "245", "startTime": "2025-02-01T01:00:00Z", "endTime": "2025-02-01T01:15:00Z", "value": 4}')
    run_pipeline(spark, layout, DATASETS, feed_of(spark, [reading(245, "2025-02-01T00:00:00Z", "2")]), dt.datetime(2025, 2, 2, tzinfo=UTC))
    assert len(listed[1]) == 1 and folders(layout, wind) == [] and os.path.exists(other)
    run_pipeline(spark, layout, DATASETS, feed_of(spark, []), dt.datetime(2025, 2, 3, tzinfo=UTC))
    assert listed[2] == []
    assert spark.read.parquet(layout.bronze(wind)).count() == 5
    assert len(folders(layout, wind, "landing_archive")) == 3
    assert read_landing(spark, layout.at("landing_archive")).count() == 4


def test_archiving_that_was_interrupted(spark, layout, tmp_path):
    source, target = tmp_path / "s", tmp_path / "t"
    name = "batch=20250101T000000Z_to_20250102T000000Z"
    for folder, files in ((source / name, "ab"), (target / name, "a"), (source / "else", "c")):
        folder.mkdir(parents=True)
        for f in files:
            (folder / f).write_text(f)
    assert archive_landed(spark, str(source), str(target)) == [name]
    assert sorted(p.name for p in (target / name).iterdir() if not p.name.startswith(".")) == ["a", "b"]
    assert sorted(os.listdir(source)) == ["else"]


def test_records_before_the_mark_can_be_taken_in_again(spark, rows, layout):
    old = reading(245, "2024-12-31T23:45:00Z", "7")
    records = [old, reading(999, "2024-12-31T23:45:00Z", "8"), (245, "no such id", "2024-12-30T00:00:00Z", "2024-12-30T00:15:00Z", "9", None)]
    totals = run_pipeline(spark, layout, DATASETS, feed_of(spark, records), dt.datetime(2025, 2, 1, tzinfo=UTC))
    assert totals["rejected"] == {"before_mark": 2, "unknown_dataset": 1}
    assert readmit(spark, layout.landing, DATASETS, "before_mark") == 1
    assert readmit(spark, layout.landing, DATASETS, "before_mark") == 0
    totals = run_pipeline(spark, layout, DATASETS, feed_of(spark, []), dt.datetime(2025, 2, 2, tzinfo=UTC))
    assert totals["245_wind_power_generation_raw_table"]["total"] == 1
    fact = fact_generation_table(layout.gold("fact_generation_forecast"))
    assert rows(fact.read(spark), "start_date_id", "value_mwh") == [(20241231, 7.0)]
    # what names no dataset is still there, by that reason
    left = os.listdir(layout.at("landing", "dataset=_rejected"))
    assert [n.split("_at_")[0] for n in sorted(left) if n.startswith("batch=")] == ["batch=no_dataset", "batch=unknown_dataset"]
    run_pipeline(spark, layout, DATASETS, feed_of(spark, []), dt.datetime(2025, 2, 3, tzinfo=UTC))
    assert fact.read(spark).count() == 1
