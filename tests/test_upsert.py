import itertools
import random

import pytest
from pyspark.sql import functions as F

from gridtide.operators import dims, lookups
from gridtide.operators.upsert import latest_per_key
from gridtide.sources.sliced import SlicedTable, day_slices, hash_slices, month_slices
from gridtide.schemas import LONG, REAL, TEXT, table_of
from gridtide.streaming.upsert import upsert

SCHEMA = table_of(start_date_id=LONG, k=TEXT, seq=LONG, v=REAL, note=TEXT)
KEYS = ("start_date_id", "k")


def frame_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(rows):
    """Newest row per key; NULL below every value, larger values win ties."""
    best = {}
    for row in rows:
        rank = tuple((x is not None, x) if x is not None else (False, 0) for x in row[2:])
        rank = tuple((known, value if known else "" if i == 2 else 0) for i, (known, value) in enumerate(rank))
        if row[:2] not in best or rank > best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


def random_rows(n, seed):
    rng = random.Random(seed)
    dates = [20250101, 20250131, 20250201, 20260101, None]
    return [
        (
            rng.choice(dates),
            # one key holds a third of the rows
            "hot" if rng.random() < 0.34 else rng.choice(["a", "b", None, "c"]),
            rng.randint(0, 6),
            rng.choice([None, 0.5, 1.5, 2.5]),
            rng.choice([None, "x", "y"]),
        )
        for _ in range(n)
    ]


def test_latest_matches_brute_force(spark, rows):
    data = random_rows(400, 1)
    for _ in range(2):
        random.Random(2).shuffle(data)
        assert rows(latest_per_key(frame_of(spark, data).repartition(5), KEYS, "seq")) == brute_force(data)


def test_null_replaces_value(spark, rows):
    data = [(1, "a", 1, 5.0, "x"), (1, "a", 2, None, None)]
    assert rows(latest_per_key(frame_of(spark, data), KEYS, "seq")) == [(1, "a", 2, None, None)]


def test_maximum_form(spark, rows):
    frame = frame_of(spark, random_rows(100, 3)).select("k", "seq")
    got = latest_per_key(frame, ["k"], "seq")
    assert got.columns == ["k", "seq"]
    assert rows(got) == rows(frame.groupBy("k").agg(F.max("seq")))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = latest_per_key(frame_of(spark, []), KEYS, "seq")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")


@pytest.fixture
def target(spark, tmp_path):
    return SlicedTable(str(tmp_path / "t"), SCHEMA, month_slices("start_date_id"), KEYS)


def test_any_split_into_batches_gives_the_same(spark, rows, target):
    data = random_rows(240, 4)
    target.create(spark)
    for i, start in enumerate(range(0, 240, 60)):
        upsert(target, frame_of(spark, data[start : start + 60]), KEYS, "seq", "w", i)
    assert rows(target.read(spark)) == brute_force(data)
    assert set(target.snapshot(spark).slices) == {0, 202501, 202502, 202601}


def test_many_slices(spark, rows, tmp_path):
    days = [20250101 + d for d in range(28)] + [20250201 + d for d in range(28)] + [None]
    table = SlicedTable(str(tmp_path / "d"), SCHEMA, day_slices("start_date_id"), KEYS)
    table.create(spark)
    data = [(d, "a", 1, 1.0, None) for d in days]
    upsert(table, frame_of(spark, data), KEYS, "seq", "w", 0)
    upsert(table, frame_of(spark, [(20250110, "a", 2, 2.0, None)]), KEYS, "seq", "w", 1)
    assert table.read(spark).count() == 57
    versions = table.snapshot(spark).slices
    assert (versions[20250110], versions[20250111], versions[0]) == (2, 1, 1)


def test_late_row_and_untouched_slices(spark, rows, target):
    target.create(spark)
    assert target.read(spark).count() == 0
    upsert(target, frame_of(spark, [(20250101, "a", 5, 1.0, None), (20250201, "a", 5, 2.0, None)]), KEYS, "seq", "w", 0)
    before = rows(target.read(spark))
    upsert(target, frame_of(spark, [(20250101, "a", 4, 9.0, None)]), KEYS, "seq", "w", 1)
    assert rows(target.read(spark)) == before
    assert target.snapshot(spark).slices == {202501: 2, 202502: 1}
    assert rows(target.read(spark, slices=[202502])) == [(20250201, "a", 5, 2.0, None)]


def test_replay_and_new_writer(spark, rows, target):
    target.create(spark)
    first = frame_of(spark, [(20250101, "a", 1, 1.0, None)])
    upsert(target, first, KEYS, "seq", "w", 0)
    upsert(target, first, KEYS, "seq", "w", 0)
    assert target.snapshot(spark).version == 1
    # a stream with a new checkpoint counts its batches from 0 again
    upsert(target, frame_of(spark, [(20250101, "a", 2, 2.0, None)]), KEYS, "seq", "other", 0)
    assert rows(target.read(spark)) == [(20250101, "a", 2, 2.0, None)]


def test_crash_before_commit(spark, rows, target, monkeypatch):
    target.create(spark)
    upsert(target, frame_of(spark, [(20250101, "a", 1, 1.0, None)]), KEYS, "seq", "w", 0)

    def lost(*_):
        raise RuntimeError("driver lost")

    changes = frame_of(spark, [(20250101, "b", 1, 3.0, None)])
    with monkeypatch.context() as patch:
        patch.setattr(SlicedTable, "_commit", lost)
        with pytest.raises(RuntimeError):
            upsert(target, changes, KEYS, "seq", "w", 1)
    assert rows(target.read(spark)) == [(20250101, "a", 1, 1.0, None)]
    upsert(target, changes, KEYS, "seq", "w", 1)
    assert target.read(spark).count() == 2


def test_prune_keeps_what_is_current(spark, rows, target, tmp_path):
    target.create(spark)
    for i in range(4):
        date = 20250101 if i else 20260101
        upsert(target, frame_of(spark, [(date, "a", i, float(i), None)]), KEYS, "seq", "w", i)
    before = rows(target.read(spark))
    removed = target.prune(spark, keep=2)
    assert len(removed) == 4  # versions 0, 1, 2 and the data of slice 202501 in version 2
    assert rows(target.read(spark)) == before
    assert target.prune(spark, keep=2) == []


def test_replace(spark, rows, tmp_path):
    table = SlicedTable(str(tmp_path / "r"), SCHEMA, hash_slices(["k"], 3))
    table.create(spark)
    table.replace(spark, frame_of(spark, [(1, k, 1, 1.0, None) for k in "abcdef"]))
    assert table.read(spark).count() == 6
    # rows computed from the table itself; slices that lose their rows are gone
    table.replace(spark, table.read(spark).where("k = 'a'").withColumn("v", F.col("v") + 1))
    assert rows(table.read(spark)) == [(1, "a", 1, 2.0, None)]
    table.replace(spark, table.read(spark).where("false"))
    assert table.read(spark).count() == 0


READINGS = [
    ("2025-01-01 00:00:00", 20250101, 0, 0),
    ("2025-01-01 00:15:00.5", 20250101, 1, 1),
    ("2025-01-01 00:07:00", 20250101, None, 0),
    ("2019-01-01 10:00:00", None, 40, 40),
    ("2060-01-01 23:59:59", None, None, 95),
    (None, None, None, None),
]


@pytest.mark.parametrize("limit", [lookups.BROADCAST_LIMIT_BYTES, 0])
def test_time_keys(spark, rows, monkeypatch, limit):
    """Also without broadcast the same keys come out."""
    monkeypatch.setattr(lookups, "BROADCAST_LIMIT_BYTES", limit)
    if not limit:
        monkeypatch.setattr(lookups.F, "broadcast", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(READINGS)], "i int, t string")
    frame = frame.select("i", F.col("t").cast("timestamp").alias("start_time"))
    for floor, column in ((False, 2), (True, 3)):
        keyed = lookups.with_time_keys(frame, dims.dim_date(spark), dims.dim_time(spark), floor)
        got = keyed.select("i", "start_date_id", "start_time_id").orderBy("i").collect()
        assert [tuple(r) for r in got] == [(i, r[1], r[column]) for i, r in enumerate(READINGS)]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unmatched_are_counted(spark):
    frame = spark.createDataFrame([(r[0],) for r in READINGS], "t string")
    frame = frame.select(F.col("t").cast("timestamp").alias("start_time"))
    keyed = lookups.with_time_keys(frame, dims.dim_date(spark), dims.dim_time(spark))
    assert tuple(lookups.unmatched_counts(keyed).first()) == (6, 3, 3)


def test_union_is_by_name_and_strict(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert lookups.union_readings(a, b, a).collect() == [(1, "x"), (2, "y"), (1, "x")]
    with pytest.raises(Exception):
        lookups.union_readings(a, b.drop("n")).collect()
