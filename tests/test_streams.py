"""Streams give what the batch functions give, however the input is cut."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridtide.config import Dataset, Layout
from gridtide.operators import dims, lookups, quality, silver
from gridtide.operators.bronze import with_origin
from gridtide.operators.upsert import GENERATION_KEYS, latest_per_key
from gridtide.schemas import BRONZE, SILVER_GENERATION
from gridtide.sources.landing import read_landing
from gridtide.sources.sliced import SlicedTable
from gridtide.sources.tables import read_table, stream_table
from gridtide.streaming.bronze import RULE_COUNTS, run_bronze
from gridtide.streaming.gold import fact_generation_table
from gridtide.streaming.metrics import ObservedCounts
from gridtide.streaming.runs import finish
from gridtide.streaming.silver import run_silver
from gridtide.streaming.upsert import run_upsert

WIND = Dataset(245, "Wind power", multi_line=True)


def readings(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day, quarter = rng.randint(1, 60), rng.randint(0, 95)
        start = f"2025-{1 + day // 31:02d}-{1 + day % 28:02d}T{quarter // 4:02d}:{quarter % 4 * 15:02d}:00Z"
        out.append(
            {
                "datasetId": 245,
                "startTime": start if rng.random() < 0.95 else None,
                "endTime": start if rng.random() < 0.95 else None,
                "value": rng.choice([round(rng.random() * 9, 2), "abc", None]),
            }
        )
    return out


def drop_files(layout, records, parts, name):
    folder = layout.landing_of(WIND)
    import os

    os.makedirs(folder, exist_ok=True)
    for i in range(parts):
        with open(f"{folder}/{name}_{i}.json", "w") as out:
            json.dump(records[i::parts], out, indent=4)


def test_bronze_and_silver_equal_batch(spark, rows, tmp_path):
    layout = Layout(str(tmp_path))
    drop_files(layout, readings(60, 1), 3, "first")
    with ObservedCounts(spark, RULE_COUNTS) as counts:
        (first,) = finish([run_bronze(spark, layout, WIND, maxFilesPerTrigger="1")])
    assert len([p for p in first.recentProgress if p.numInputRows]) == 3
    finish([run_silver(spark, layout, WIND, silver.generation)])
    # only files that were not there before are read by the next run
    drop_files(layout, readings(40, 2), 2, "second")
    with ObservedCounts(spark, RULE_COUNTS) as more_counts:
        (second,) = finish([run_bronze(spark, layout, WIND)])
    finish([run_silver(spark, layout, WIND, silver.generation)])
    # (an array file is one input row; its records are counted by the rules)
    assert (sum(p.numInputRows for p in second.recentProgress), more_counts.of(second)["total"]) == (2, 40)

    landed = with_origin(read_landing(spark, layout.landing_of(WIND), multi_line=True))
    kept = quality.expect_all_or_drop(landed, quality.READING_RULES)
    raw = read_table(spark, layout.bronze(WIND), BRONZE)
    columns = ("startTime", "endTime", "value", "source_file")
    assert rows(raw, *columns) == rows(kept, *columns)
    typed = read_table(spark, layout.silver(WIND), SILVER_GENERATION)
    columns = ("datasetId", "start_time", "end_time", "value_mwh")
    assert rows(typed, *columns) == rows(silver.generation(kept), *columns)

    failed = {r.rule: r.failed for r in quality.expectation_metrics(landed, quality.READING_RULES).collect()}
    counted = [counts.of(first), more_counts.of(second)]
    assert sum(c["total"] for c in counted) == 100
    for rule, n in failed.items():
        assert sum(c[f"failed_{rule}"] for c in counted) == n


def silver_rows(spark, n, seed):
    rng = random.Random(seed)
    data = [
        (
            str(rng.choice([245, 248])),
            rng.choice(["2025-01-01 00:15:00", "2025-02-01 10:00:00", "2019-01-01 00:00:00", "2025-02-01 10:01:00"]),
            rng.random(),
            rng.randint(0, 5),
        )
        for _ in range(n)
    ]
    frame = spark.createDataFrame(data, "datasetId string, t string, value_mwh double, s int")
    moment = F.col("t").cast("timestamp")
    arrived = F.timestamp_seconds(F.lit(1735689600) + F.col("s"))
    return frame.select(
        "datasetId",
        moment.alias("start_time"),
        moment.alias("end_time"),
        "value_mwh",
        arrived.alias("bronze_ingestion_timestamp"),
        arrived.alias("silver_processed_timestamp"),
    )


def flow(spark, root):
    stream = stream_table(spark, f"{root}/silver", SILVER_GENERATION, maxFilesPerTrigger="1")
    changes = lookups.generation_fact_rows(stream, dims.dim_date(spark), dims.dim_time(spark))
    fact = fact_generation_table(f"{root}/gold")
    finish([run_upsert(fact, changes, GENERATION_KEYS, f"{root}/checkpoint", "fact")])
    return fact


@pytest.mark.parametrize("crash", [False, True])
def test_upsert_stream_equals_batch(spark, rows, tmp_path, monkeypatch, crash):
    root = str(tmp_path)
    everything = silver_rows(spark, 120, 7).cache()
    everything.repartition(4).write.parquet(f"{root}/silver")
    if crash:
        commit, left = SlicedTable._commit, [3]

        def lost(table, session, snapshot):
            left[0] -= 1
            if left[0] == 0:
                raise RuntimeError("driver lost")
            commit(table, session, snapshot)

        with monkeypatch.context() as patch:
            patch.setattr(SlicedTable, "_commit", lost)
            with pytest.raises(Exception):
                flow(spark, root)
    fact = flow(spark, root)
    expected = latest_per_key(
        lookups.generation_fact_rows(everything, dims.dim_date(spark), dims.dim_time(spark)),
        GENERATION_KEYS,
    )
    columns = [c for c in expected.columns if c != "gold_processed_timestamp"]
    assert rows(fact.read(spark), *columns) == rows(expected, *columns)
    assert fact.snapshot(spark).version == 4
    # a run without new files changes nothing
    assert flow(spark, root).snapshot(spark).version == 4
