"""A history takes one sort of its rows, and so one sorted copy of them in a task's memory."""

import io
from contextlib import redirect_stdout

import pytest

from gridtide.operators.changes import ChangeRule, changed
from gridtide.schemas import LONG, TEXT, table_of
from gridtide.sources.sliced import hash_slices
from gridtide.streaming.changes import ChangeTable

SCHEMA = table_of(k=TEXT, seq=LONG, op=TEXT, a=LONG, b=TEXT)
ROWS = [("x", 1, "U", 1, "p"), ("x", 2, "U", 1, "q"), ("x", 2, "U", 1, "p"), ("x", 3, "D", 1, "q"), (None, 1, "U", None, None), ("x", 4, "U", 1, "q"), ("x", 5, "U", 2, None)]


@pytest.mark.parametrize("how", [{}, {"track": ("a",)}, {"track_except": ("b",)}], ids=str)
def test_one_sort(spark, how):
    rule = ChangeRule(keys=("k",), sequence_by="seq", deletes="op = 'D'", history=True, except_columns=("op",), **how)
    out = changed(spark.createDataFrame(ROWS * 2, SCHEMA), rule)
    told = io.StringIO()
    with redirect_stdout(told):
        out.explain()
    assert told.getvalue().count("Sort [") == 1
    got = sorted(((r.k or "", r.seq, r.a, r.b, r["__START_AT"], r["__END_AT"]) for r in out.collect()), key=lambda r: (r[0], r[4]))
    if how == {}:
        want = [("", 1, None, None, 1, None), ("x", 1, 1, "p", 1, 2), ("x", 2, 1, "q", 2, 3), ("x", 4, 1, "q", 4, 5), ("x", 5, 2, None, 5, None)]
    elif "track" in how:
        want = [("", 1, None, None, 1, None), ("x", 2, 1, "q", 1, 3), ("x", 4, 1, "q", 4, 5), ("x", 5, 2, None, 5, None)]
    else:
        want = [("", 1, None, None, 1, None), ("x", 2, 1, "q", 1, 3), ("x", 4, 1, "q", 4, 5), ("x", 5, 2, None, 5, None)]
    assert got == want


def test_a_merge_into_a_stored_history_takes_one_sort_too(spark, tmp_path):
    rule = ChangeRule(keys=("k",), sequence_by="seq", deletes="op = 'D'", history=True, except_columns=("op",), track=("a",))
    table = ChangeTable(str(tmp_path / "t"), SCHEMA, rule, hash_slices(rule.keys, 4))
    table.create(spark)
    table.merge(spark.createDataFrame(ROWS[3:], SCHEMA))
    fresh = rule.state_of(spark.createDataFrame(ROWS[:3], SCHEMA))
    stored = table.state.read(spark).select(*fresh.columns)
    told = io.StringIO()
    with redirect_stdout(told):
        rule.fold(stored.unionByName(fresh)).explain()
    assert told.getvalue().count("Sort [") == 1
    table.merge(spark.createDataFrame(ROWS[:3], SCHEMA))
    whole = changed(spark.createDataFrame(ROWS, SCHEMA), rule)
    assert sorted(map(str, table.read(spark).collect())) == sorted(map(str, whole.collect()))
