import json

import pytest
from pyspark.sql import functions as F

from gridtide.config import Dataset
from gridtide.operators import quality, silver
from gridtide.operators.bronze import with_origin
from gridtide.sources.landing import infer_extra_fields, read_landing


def now():
    return F.lit("2025-03-01 00:00:00").cast("timestamp")


RECORDS = [
    {"datasetId": 358, "startTime": "2025-01-01T00:00:00Z", "endTime": "2025-01-01T01:00:00Z",
     "value": 1.25, "additionalJson": {"CustomerType": "Home", "Count": 7, "ReadTS": "2025-01-02T00:00:00Z"}},
    {"datasetId": 358, "startTime": "2025-01-01T00:00:00Z", "endTime": "2025-01-01T01:00:00Z",
     "value": 1.25, "additionalJson": json.dumps({"CustomerType": "Home", "Count": 7, "ReadTS": "2025-01-02T00:00:00Z"})},
    {"datasetId": 358, "startTime": "", "endTime": "2025-01-01T01:00:00Z", "value": "abc",
     "additionalJson": "{bad"},
]


def land(path, records, lines):
    path.mkdir()
    text = "\n".join(map(json.dumps, records)) if lines else json.dumps(records, indent=4)
    (path / "batch.json").write_text(text)
    return str(path)


def test_array_and_lines_read_alike(spark, rows, tmp_path):
    as_lines = read_landing(spark, land(tmp_path / "a", RECORDS, True))
    as_array = read_landing(spark, land(tmp_path / "b", RECORDS, False), multi_line=True)
    flat = ("datasetId", "startTime", "endTime", "value", "_corrupt")
    assert rows(as_lines, *flat) == rows(as_array, *flat)
    assert as_array.count() == 3


def test_consumption(spark, tmp_path):
    landed = read_landing(spark, land(tmp_path / "a", RECORDS, False), multi_line=True)
    raw = with_origin(landed, now())
    assert raw.first().source_file.endswith("batch.json")
    typed = silver.consumption(raw, now()).collect()
    # an object and a text holding the same JSON give the same row
    assert typed[0] == typed[1]
    assert typed[0].reading_count == 7
    assert typed[0].customer_type == "Home"
    assert typed[0].consumption_mwh == 1.25
    assert str(typed[0].read_timestamp) == "2025-01-02 00:00:00"
    assert typed[0].json_value is None
    # bad text: the row stays, its values are NULL
    assert typed[2].start_time is None and typed[2].consumption_mwh is None
    assert [typed[2][name] for name, _, _ in silver.JSON_ATTRIBUTES] == [None] * 7


def test_unreadable_file_is_kept_apart(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"datasetId": 1, "startTime": ')
    landed = read_landing(spark, str(tmp_path)).cache()
    assert landed.first()._corrupt is not None
    assert quality.expect_all_or_drop(landed, quality.READING_RULES).count() == 0
    landed.unpersist()


def test_inferred_extra_fields_reach_bronze(spark, tmp_path):
    path = land(tmp_path / "a", [{**RECORDS[0], "quality": 3}], True)
    extra = infer_extra_fields(spark, path)
    assert extra == ("quality",)
    row = read_landing(spark, path, extra_fields=extra).first()
    assert row.quality == "3"
    assert row.datasetId == "358"


def test_dispatch_skips_unknown(caplog):
    datasets = [Dataset(245, "w"), Dataset(9, "x"), Dataset(358, "c")]
    pairs = silver.dispatch(datasets)
    assert [(d.id, t) for d, t in pairs] == [(245, silver.generation), (358, silver.consumption)]
    assert "9" in caplog.text


def test_expectations(spark, rows):
    frame = spark.createDataFrame(
        [("a", "b", 1), (None, "b", 2), ("a", None, 3), (None, None, 4), ("a", "b", None)],
        "startTime string, endTime string, n int",
    )
    assert rows(quality.expect_all_or_drop(frame, quality.READING_RULES), "n") == [(1,), (None,)]
    # an unknown verdict counts as failed
    rules = {**quality.READING_RULES, "positive": "n > 0"}
    assert rows(quality.expect_all_or_drop(frame, rules), "n") == [(1,)]
    assert rows(quality.expectation_metrics(frame, rules)) == [
        ("Rule1", 3, 2), ("Rule2", 3, 2), ("positive", 4, 1),
    ]
    assert quality.expect_all_or_drop(frame, {}).count() == 5


ODD_RECORDS = [
    {**RECORDS[0], "quality": 3, "tags": ["a", None], "note": None},
    {"datasetId": None, "nested": {"x": {"y": 1}}, "_corrupt": "a field of this name", "é ü": "z"},
    {},
]


@pytest.mark.parametrize("lines", [True, False])
def test_fields_nobody_names_are_kept(spark, tmp_path, lines):
    path = land(tmp_path / "a", ODD_RECORDS, lines)
    (tmp_path / "a" / "more.json").write_text("\n \n[" + json.dumps({"a": 1}) + "," + json.dumps({"value": 2}) + "]\n" if lines else "")
    got = [(r.datasetId, r.value, r._corrupt, json.loads(r._rescued) if r._rescued else None) for r in read_landing(spark, path, not lines, ("note",)).collect()]
    want = [
        ("358", "1.25", None, {"quality": "3", "tags": '["a",null]'}),
        (None, None, None, {"nested": '{"x":{"y":1}}', "_corrupt": "a field of this name", "é ü": "z"}),
        (None, None, None, None),
    ] + ([(None, None, None, {"a": "1"}), (None, "2", None, None)] if lines else [])
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("text", ['{"datasetId": 1', "[{}, 7]", "no json", '"text"', "[[]]"])
def test_what_is_no_record_is_kept_whole(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    for multi_line in (False, True):
        (row,) = read_landing(spark, str(tmp_path), multi_line).collect()
        assert (row._corrupt, row._rescued, row.startTime) == (text, None, None)


def test_origin_of_rescued_records(spark, tmp_path):
    raw = with_origin(read_landing(spark, land(tmp_path / "a", ODD_RECORDS, True)), now())
    assert raw.columns[-3:] == ["_rescued", "source_file", "ingestion_timestamp"]
    assert all(r.source_file.endswith("batch.json") for r in raw.collect())
