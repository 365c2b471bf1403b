import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridtide.operators.windows import assign_windows, plan_windows
from gridtide.sources import paged
from gridtide.sources.landing import read_landing, write_landing, write_whole_records
from gridtide.streaming.runs import batch_run, finish
from gridtide.sources.paged import RateLimited, fetch_windows, pages_of, patiently


def test_pages_end(spark):
    def empty_third(id_, start, end, page, size):
        return ([{"value": page}] if page < 3 else []), page + 1

    assert list(pages_of(empty_third, 0, (1, "a", "b", 2))) == [[{"value": 1}], [{"value": 2}]]

    def last_second(id_, start, end, page, size):
        return [{"value": page}], 2 if page == 1 else None

    assert len(list(pages_of(last_second, 0, (1, "a", "b", 2)))) == 2


def test_busy_source():
    calls = []

    def busy(*request):
        calls.append(request)
        if len(calls) < 3:
            raise RateLimited
        return [{}], None

    assert patiently(busy, 0, 1) == ([{}], None)
    assert len(calls) == 3

    def always(*request):
        raise RateLimited

    with pytest.raises(RateLimited):
        patiently(always, 0, 1)


def test_every_window_is_fetched(spark, rows, tmp_path):
    datasets = spark.createDataFrame(
        [(1, "a", "2025-01-01T00:00:00", "2", "2"), (2, "b", "2025-01-03T00:00:00", "1", "2")],
        "source_dataset_id int, source_dataset_name string, last_timestamp string,"
        " load_increment_days string, page_size string",
    )

    def get_page(id_, start, end, page, size):
        # three records per window, in pages of two
        found = [
            {"datasetId": id_, "startTime": start, "value": n, "additionalJson": {"n": n}}
            for n in range(3)
        ][(page - 1) * size : page * size]
        return found, page + 1 if page * size < 3 else None

    now = F.lit("2025-01-05").cast("timestamp")
    windows = plan_windows(datasets, now)
    got = fetch_windows(windows, get_page, tasks=3)
    assert got.count() == 4 * 3
    assert rows(got.where("source_dataset_id = 2 and value = '1'"), "datasetId", "startTime", "additionalJson", "endTime") == [
        ("2", "2025-01-03T00:00:00Z", '{"n": 1}', None),
        ("2", "2025-01-04T00:00:00Z", '{"n": 1}', None),
    ]

    # landed without a shuffle: one file per window
    write_landing(assign_windows(got, datasets, now), str(tmp_path), gathered=True)
    assert len(list(tmp_path.glob("dataset=*/batch=*/part-*.json"))) == 4
    assert read_landing(spark, str(tmp_path)).count() == 12


# --- as a data source ---------------------------------------------------------------------------

UTC = dt.timezone.utc


def options(end, **marks):
    datasets = [{"id": int(k[1:]), "name": f"Name {k}", "mark": mark, "days": 2, "page_size": 3} for k, mark in marks.items()]
    return {"datasets": json.dumps(datasets), "end": end}


def test_windows_between_offsets():
    windows = paged.Windows(options("2025-01-06T12:00:00+00:00", d1="2025-01-01T00:00:00", d2="2025-01-07T00:00:00"))
    spans = [(w.dataset_id, w.start.day, w.end.day, w.end.hour) for w in windows.between(windows.marks(), windows.ends())]
    assert spans == [(1, 1, 3, 0), (1, 3, 5, 0), (1, 5, 6, 12)]
    assert windows.ends()["2"] == "2025-01-07T00:00:00+00:00"  # a mark never moves back
    # the next run goes on where this one ended; a dataset that is new begins at its mark
    later = paged.Windows(options("2025-01-08T00:00:00+00:00", d1="2025-01-01T00:00:00", d3="2025-01-07T00:00:00"))
    spans = [(w.dataset_id, w.start.day, w.start.hour, w.end.day) for w in later.between(windows.ends(), later.ends())]
    assert spans == [(1, 6, 12, 8), (3, 7, 0, 8)]
    with pytest.raises(ValueError, match="dataset 1"):
        broken = paged.Windows({"datasets": json.dumps([{"id": 1, "name": "", "mark": "2025-01-01", "days": 0, "page_size": 1}]), "end": "2025-01-02"})
        broken.between(broken.marks(), broken.ends())


def hourly(log, busy=0):
    """A source with one record an hour; it notes what it is asked, and is busy the first times."""

    def get_page(dataset_id, start, end, page, page_size):
        path = os.path.join(log, f"{dataset_id}-{start}-{page}".replace(":", ""))
        tries = len(os.listdir(path)) if os.path.isdir(path) else 0
        os.makedirs(path, exist_ok=True)
        open(os.path.join(path, str(tries)), "w").close()
        if tries < busy:
            raise OSError("busy")
        first, last = dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end)
        hours = int((last - first).total_seconds() // 3600)
        records = [{"startTime": (first + dt.timedelta(hours=h)).isoformat(), "value": h, "odd": {"é": [dataset_id]}} for h in range(hours)]
        return records[(page - 1) * page_size : page * page_size], page + 1 if page * page_size < hours else None

    return get_page


def active_of(spark, *rows):
    return spark.createDataFrame(rows, "source_dataset_id int, source_dataset_name string, last_timestamp string, load_increment_days string, page_size string")


def test_batch_source(spark, tmp_path):
    active = active_of(spark, (1, "Wind power", "2025-01-01T00:00:00", "1.0", "5"), (2, "Solar", "2025-01-02T12:00:00", "2", "7"), (3, "None due", "2025-01-04T00:00:00", "1", "5"))
    end = dt.datetime(2025, 1, 3, tzinfo=UTC)
    frame = paged.read_windows(spark, hourly(str(tmp_path), busy=1), active, end, pause=0.0)
    assert frame.rdd.getNumPartitions() == 3  # one per window
    got = paged.fields_of(frame).orderBy("source_dataset_id", "startTime").collect()
    assert [r.source_dataset_id for r in got] == [1] * 48 + [2] * 12
    assert (got[0].source_dataset_name, got[0].value, json.loads(got[0]._rescued)) == ("Wind power", "0", {"odd": '{"é":[1]}'})
    assert sorted({(r.source_dataset_id, str(r.window_start), str(r.window_end)) for r in got}) == [
        (1, "2025-01-01 00:00:00", "2025-01-02 00:00:00"), (1, "2025-01-02 00:00:00", "2025-01-03 00:00:00"), (2, "2025-01-02 12:00:00", "2025-01-03 00:00:00")
    ]
    nothing = paged.read_windows(spark, hourly(str(tmp_path)), active.where("source_dataset_id = 3"), end)
    assert paged.fields_of(nothing).collect() == []
    assert paged.read_windows(spark, hourly(str(tmp_path)), active.where("false"), end).collect() == []
    with pytest.raises(ValueError, match="no watermark"):
        paged.read_windows(spark, hourly(str(tmp_path)), active_of(spark, (4, "x", None, "1", "5")), end)


def test_stream_source_goes_on_where_it_ended(spark, tmp_path):
    active = active_of(spark, (1, "Wind power", "2025-01-01T00:00:00", "1", "30"))
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")

    def run(day, fail=False):
        def apply(batch, _):
            write_whole_records(batch, landing)
            if fail:
                raise RuntimeError("driver lost")

        stream = paged.read_windows(spark, hourly(log), active, dt.datetime(2025, 1, day, tzinfo=UTC), stream=True)
        finish([batch_run(stream, apply, str(tmp_path / "checkpoint"), "paged")])

    run(3)
    asked = set(os.listdir(log))
    assert len(asked) == 2
    run(3)  # nothing new
    with pytest.raises(Exception):
        run(5, fail=True)
    run(5)  # the batch that was lost is asked for again, and lands once
    assert {n for n in os.listdir(log)} - asked == {f"1-2025-01-0{d}T000000+0000-1" for d in (3, 4)}
    assert sorted(len(os.listdir(os.path.join(log, n))) for n in os.listdir(log)) == [1, 1, 2, 2]
    got = read_landing(spark, landing)
    assert got.count() == 96 and got.select("startTime").distinct().count() == 96
    assert sorted(os.listdir(os.path.join(landing, "dataset=1_wind_power")))[-1] == "batch=20250104T000000Z_to_20250105T000000Z"
