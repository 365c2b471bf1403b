"""Change rules against a plain replay of the changes in the order of their sequence."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from gridtide.operators.changes import END_AT, START_AT, ChangeRule, changed
from gridtide.schemas import LONG, TEXT, table_of
from gridtide.sources.sliced import hash_slices
from gridtide.sources.tables import stream_table
from gridtide.streaming.changes import ChangeTable, run_changes
from gridtide.streaming.runs import finish

SCHEMA = table_of(k=TEXT, seq=LONG, op=TEXT, a=LONG, b=TEXT)
NAMES = SCHEMA.fieldNames()
DELETES, TRUNCATES = "op = 'D'", "op = 'T'"


def draw_changes(n, seed, ops="UUUUUD", moments=12):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else rng.choice(["x", "y", None]), rng.randrange(moments), rng.choice(ops), rng.choice([None, 1, 2]), rng.choice([None, "p", "q"]))
        for _ in range(n)
    ]


def order(row):
    """Of one moment a delete comes last, then the larger columns, NULL below all."""
    return (row[1], row[2] == "D", *((v is not None, v if v is not None else 0 if isinstance(v, int) else "") for v in (row[2],)), (row[3] is not None, row[3] or 0), (row[4] is not None, row[4] or ""))


def newest_rows(rows):
    """Type 1: the last change of a key, unless it is a delete or not newer than the last truncate."""
    cut = max((r[1] for r in rows if r[2] == "T"), default=-1)
    last = {}
    for r in sorted((r for r in rows if r[2] != "T" and r[1] > cut), key=order):
        last[r[0]] = r
    return [r for r in last.values() if r[2] != "D"]


def merged_rows(rows):
    """NULLs keep what was there; a delete or truncate takes all up to its moment."""
    cut = max((r[1] for r in rows if r[2] == "T"), default=-1)
    out = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key and r[2] != "T"]
        gone = max([r[1] for r in mine if r[2] == "D"] + [cut])
        alive = sorted((r for r in mine if r[2] != "D" and r[1] > gone), key=lambda r: r[1])
        if alive:
            newest = [max(((r[1], r[i]) for r in alive if r[i] is not None), default=(0, None))[1] for i in (2, 3, 4)]
            out.append((key, alive[-1][1], *newest))
    return out


def intervals(rows, tracked):
    """Type 2: the changes of a key in order; ``tracked`` names the columns that open an interval, None: every change does."""
    out = []
    for key in {r[0] for r in rows}:
        moments = {}
        for r in sorted((r for r in rows if r[0] == key), key=order):
            moments[r[1]] = r
        now = None
        for at, r in sorted(moments.items()):
            if now and (r[2] == "D" or tracked is None or any(r[NAMES.index(c)] != now[0][NAMES.index(c)] for c in tracked)):
                out.append((*now[0], now[1], at))
                now = None
            if r[2] != "D":
                now = (r, now[1] if now else at)
        if now:
            out.append((*now[0], now[1], None))
    return out


RULES = {
    "deletes": (ChangeRule(("k",), "seq", deletes=DELETES), "UUUUUD", newest_rows),
    "truncates": (ChangeRule(("k",), "seq", deletes=DELETES, truncates=TRUNCATES), "UUUUUUUUUUDT", newest_rows),
    "ignore nulls": (ChangeRule(("k",), "seq", deletes=DELETES, truncates=TRUNCATES, ignore_nulls=True), "UUUUUUUUUUDT", merged_rows),
    "history": (ChangeRule(("k",), "seq", deletes=DELETES, history=True), "UUUUUD", lambda r: intervals(r, None)),
    "tracked": (ChangeRule(("k",), "seq", deletes=DELETES, history=True, track=("a",)), "UUUUUD", lambda r: intervals(r, ["a"])),
    "tracked but": (ChangeRule(("k",), "seq", deletes=DELETES, history=True, track_except=("op", "b")), "UUUUUD", lambda r: intervals(r, ["a"])),
}


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", RULES)
def test_batch(spark, name):
    rule, ops, expected = RULES[name]
    for seed in range(4):
        data = draw_changes(60, seed, ops, moments=40)
        got = changed(frame_of(spark, data).repartition(4), rule)
        assert ordered(got.collect()) == ordered(expected(data))
    assert changed(frame_of(spark, []), rule).collect() == []


@pytest.mark.parametrize("name", RULES)
def test_any_order_and_split_gives_the_same(spark, tmp_path, name):
    """Micro-batches in random order: late changes, late deletes, late truncates; and each one replayed."""
    rule, ops, expected = RULES[name]
    data = draw_changes(60, 11, ops, moments=40)
    random.Random(5).shuffle(data)
    table = ChangeTable(str(tmp_path / "t"), SCHEMA, rule, hash_slices(rule.keys, 3))
    table.create(spark)
    assert table.read(spark).collect() == []
    for i in range(4):
        batch = frame_of(spark, data[15 * i : 15 * i + 15])
        table.merge(batch, "w", i)
        version = table.state.snapshot(spark).version
        table.merge(batch, "w", i)
        assert table.state.snapshot(spark).version == version
        assert ordered(table.read(spark).collect()) == ordered(expected(data[: 15 * i + 15]))
    # the same changes by another writer change no row
    table.merge(frame_of(spark, data), "other", 0)
    assert ordered(table.read(spark).collect()) == ordered(expected(data))


def test_late_upsert_does_not_bring_a_key_back(spark, tmp_path):
    table = ChangeTable(str(tmp_path / "t"), SCHEMA, RULES["deletes"][0], hash_slices(("k",), 2))
    table.create(spark)
    for i, change in enumerate([("x", 1, "U", 1, "p"), ("x", 5, "D", None, None), ("x", 4, "U", 2, "q")]):
        table.merge(frame_of(spark, [change]), "w", i)
    assert table.read(spark).collect() == []
    table.merge(frame_of(spark, [("x", 6, "U", 3, "r")]), "w", 3)
    assert ordered(table.read(spark).collect()) == [("x", 6, "U", 3, "r")]


def test_late_change_splits_an_interval(spark, tmp_path):
    table = ChangeTable(str(tmp_path / "t"), SCHEMA, RULES["tracked"][0], hash_slices(("k",), 2))
    table.create(spark)
    for i, change in enumerate([("x", 1, "U", 1, "p"), ("x", 5, "U", 1, "q")]):
        table.merge(frame_of(spark, [change]), "w", i)
    # untracked columns were updated in place
    assert ordered(table.read(spark).collect()) == [("x", 5, "U", 1, "q", 1, None)]
    table.merge(frame_of(spark, [("x", 3, "U", 2, "late")]), "w", 2)
    assert table.read(spark).columns == [*NAMES, START_AT, END_AT]
    assert ordered(table.read(spark).collect()) == [("x", 1, "U", 1, "p", 1, 3), ("x", 3, "U", 2, "late", 3, 5), ("x", 5, "U", 1, "q", 5, None)]


def test_truncate_reaches_slices_it_does_not_rewrite(spark, tmp_path):
    table = ChangeTable(str(tmp_path / "t"), SCHEMA, RULES["truncates"][0], hash_slices(("k",), 64))
    table.create(spark)
    keys = [f"k{i}" for i in range(40)]
    table.merge(frame_of(spark, [(k, 1, "U", 1, None) for k in keys]), "w", 0)
    before = table.state.snapshot(spark)
    table.merge(frame_of(spark, [(None, 7, "T", None, None), ("new", 8, "U", 1, None)]), "w", 1)
    after = table.state.snapshot(spark)
    kept = [s for s in before.slices if after.slices.get(s) == before.slices[s]]
    assert len(kept) > 10 and after.marker == "7"
    assert ordered(table.read(spark).collect()) == [("new", 8, "U", 1, None)]
    # a late row from before the truncate stays out, also in a slice that has none
    table.merge(frame_of(spark, [("late", 6, "U", 1, None), ("k3", 9, "U", 2, None)]), "w", 2)
    assert ordered(table.read(spark).collect()) == [("k3", 9, "U", 2, None), ("new", 8, "U", 1, None)]


def test_stream(spark, tmp_path):
    rule, ops, expected = RULES["ignore nulls"]
    data = draw_changes(80, 3, ops, moments=60)
    frame_of(spark, data).repartition(4).write.parquet(str(tmp_path / "in"))
    table = ChangeTable(str(tmp_path / "t"), SCHEMA, rule, hash_slices(("k",), 3))
    for _ in range(2):  # the second run finds nothing new
        stream = stream_table(spark, str(tmp_path / "in"), SCHEMA, maxFilesPerTrigger="1")
        finish([run_changes(table, stream, str(tmp_path / "c"), "changes")])
        assert ordered(table.read(spark).collect()) == ordered(expected(data))
    assert table.state.snapshot(spark).version == 4


def test_column_lists(spark):
    data = [("x", 1, "U", 1, "p"), ("x", 2, "U", 2, "q")]
    only = changed(frame_of(spark, data), ChangeRule(("k",), "seq", columns=("a",)))
    assert (only.columns, ordered(only.collect())) == (["k", "seq", "a"], [("x", 2, 2)])
    but = changed(frame_of(spark, data), ChangeRule(("k",), "seq", deletes="b = 'q'", except_columns=("b", "op")))
    assert (but.columns, but.collect()) == (["k", "seq", "a"], [])


def test_rules_that_make_no_sense(spark):
    for wrong in ({"columns": ("a",), "except_columns": ("b",)}, {"track": ("a",)}, {"history": True, "truncates": TRUNCATES},
                  {"history": True, "ignore_nulls": True}, {"history": True, "track": ("a",), "track_except": ("b",)}):
        with pytest.raises(ValueError):
            ChangeRule(("k",), "seq", **wrong)
    with pytest.raises(ValueError):
        changed(frame_of(spark, []).withColumn("_gone", F.lit(1)), ChangeRule(("k",), "seq"))
    with pytest.raises(Exception, match="seq must not be NULL"):
        changed(frame_of(spark, [("x", None, "U", 1, None)]), ChangeRule(("k",), "seq")).collect()


@pytest.mark.parametrize("name", ["history", "tracked"])
def test_history_is_one_shuffle(spark, name):
    plan = changed(frame_of(spark, []), RULES[name][0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_orders_of_a_hot_key(spark):
    """A key with many changes, in any order of arrival."""
    data = [("hot", i, "D" if i % 50 == 49 else "U", i // 7 % 3, str(i)) for i in range(2000)]
    random.Random(1).shuffle(data)
    got = changed(frame_of(spark, data), RULES["tracked"][0])
    assert ordered(got.collect()) == ordered(intervals(data, ["a"]))
    assert len(list(itertools.islice(got.where(f"{END_AT} IS NULL").toLocalIterator(), 2))) <= 1
