"""Rule counts that last, and marks from what landing observed."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridtide.config import Dataset, Layout
from gridtide.operators.quality import READING_RULES
from gridtide.plans.pipeline import NEWEST_READING, PendingRun, control_table, run_pipeline
from gridtide.sources.tables import delete_folder
from gridtide.streaming.bronze import RULE_COUNTS, run_bronze
from gridtide.streaming.metrics import MetricsTable, ObservedCounts
from gridtide.streaming.runs import finish
from test_pipeline import DATASETS, feed_of, reading

UTC = dt.timezone.utc
WIND = Dataset(245, "Wind power generation")


def drop(layout, name, starts):
    folder = layout.landing_of(WIND)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.writelines(json.dumps({"startTime": s, "endTime": "2025-01-01T01:00:00Z"}) + "\n" for s in starts)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


@pytest.fixture
def history(spark, layout):
    return MetricsTable(spark, layout.at("rule_metrics"))


def run(spark, layout, history, **limits):
    with ObservedCounts(spark, RULE_COUNTS, history=history):
        return finish([run_bronze(spark, layout, WIND, **limits)])[0]


def test_every_batch_once(spark, rows, layout, history):
    assert history.read().collect() == []
    drop(layout, "a.json", ["2025-01-01T00:00:00Z", None])
    drop(layout, "b.json", [None, None, None])
    run(spark, layout, history, maxFilesPerTrigger="1")
    drop(layout, "c.json", ["2025-01-01T00:15:00Z"])
    query = run(spark, layout, history)
    run(spark, layout, history)  # nothing new
    by_batch = history.read().where("rule = 'Rule1'").select("batch_id", "passed", "failed")
    assert sorted(r.passed + r.failed for r in by_batch.collect()) == [1, 2, 3]
    assert rows(history.read().groupBy("stream", "rule").agg(F.sum("passed"), F.sum("failed"))) == [
        (WIND.bronze_table, "Rule1", 2, 4), (WIND.bronze_table, "Rule2", 6, 0)
    ]
    assert {r.rule for r in history.read().collect()} == set(READING_RULES)

    # a batch whose commit was lost is run again, and is not counted again
    before = rows(history.read())
    checkpoint = layout.checkpoint("bronze", WIND.bronze_table)
    delete_folder(spark, f"{checkpoint}/commits/2")
    run(spark, layout, history)
    assert rows(history.read()) == before
    assert history.uncounted(WIND.bronze_table, str(query.id), checkpoint) == []

    # a batch that was committed without its report is named
    delete_folder(spark, f"{history.path}/stream={WIND.bronze_table}/{query.id}-{1:09d}.json")
    assert history.uncounted(WIND.bronze_table, str(query.id), checkpoint) == [1]


def test_the_pipeline_keeps_its_counts(spark, rows, layout):
    readings = [reading(245, "2025-01-01T00:00:00Z", "1"), reading(245, None, "2"), reading(248, "2025-01-02T00:00:00Z", "3")]
    for day in (1, 2):
        run_pipeline(spark, layout, DATASETS, feed_of(spark, readings if day == 1 else []), dt.datetime(2025, 2, day, tzinfo=UTC))
    kept = MetricsTable(spark, layout.at("landing_admin", "rule_metrics")).read()
    found = rows(kept.where("rule = 'Rule1' AND passed + failed > 0"), "stream", "passed", "failed")
    assert found == [("245_wind_power_generation_raw_table", 1, 1), ("248_solar_power_generation_raw_table", 1, 0)]


def marks(spark, layout):
    table = control_table(layout).read(spark).select("source_dataset_id", F.col("last_timestamp").cast("string"))
    return {r[0]: r[1] for r in table.collect()}


def test_marks_of_the_newest_reading(spark, layout):
    """Readings that no window takes move no mark, and a dataset without readings keeps its own."""
    first = [
        reading(245, "2025-01-01T00:00:00Z", "1", end="2025-01-01T00:15:00Z"),
        reading(245, "2025-01-03T10:00:00Z", "1", end="2025-01-03T10:15:00Z"),
        reading(245, None, "2"),
        reading(358, "2024-12-01T00:00:00Z", "3", "{}"),
    ]
    run_pipeline(spark, layout, DATASETS, feed_of(spark, first), dt.datetime(2025, 2, 1, tzinfo=UTC), marks=NEWEST_READING)
    told = marks(spark, layout)
    assert (told[248], told[358]) == ("2025-01-01 00:00:00",) * 2
    assert told[245] == "2025-01-03 10:15:00"
    # a reading that was published late is asked for by the next run, which starts at that mark
    late = [reading(245, "2025-01-20T00:00:00Z", "9", end="2025-01-20T00:15:00Z")]
    totals = run_pipeline(spark, layout, DATASETS, feed_of(spark, late), dt.datetime(2025, 2, 2, tzinfo=UTC), marks=NEWEST_READING)
    assert "rejected" not in totals
    assert marks(spark, layout)[245] == "2025-01-20 00:15:00"
    with pytest.raises(ValueError):
        run_pipeline(spark, layout, DATASETS, feed_of(spark, []), dt.datetime(2025, 2, 3, tzinfo=UTC), marks="other")


def test_marks_of_a_run_that_is_repeated(spark, layout, monkeypatch):
    """What landing observed is kept with the landed windows, since a repeated run does not land again."""
    def lost(*_):
        raise RuntimeError("driver lost")

    readings = [reading(245, "2025-01-03T10:00:00Z", "1", end="2025-01-03T10:15:00Z")]
    with monkeypatch.context() as patch:
        patch.setattr(PendingRun, "finish", lost)
        patch.setattr("gridtide.plans.pipeline.run_streams", lost)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, layout, DATASETS, feed_of(spark, readings), dt.datetime(2025, 2, 1, tzinfo=UTC), marks=NEWEST_READING)
    assert marks(spark, layout)[245] == "2025-01-01 00:00:00"
    run_pipeline(spark, layout, DATASETS, feed_of(spark, []), dt.datetime(2025, 3, 1, tzinfo=UTC), marks=NEWEST_READING)
    assert marks(spark, layout)[245] == "2025-01-03 10:15:00"
