"""Pages of events: a window is held in parts, whatever it holds."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq

from gridtide.plans import feeds
from gridtide.operators.silver import WIND


def write_events(folder, n, groups=7):
    start = dt.datetime(2024, 1, 1)
    rows = [
        {
            "event_id": (i * 37) % n,
            "ts": start + dt.timedelta(seconds=(i * 7919) % 5000 if i % 3 else 60),  # a third at one instant
            "user_id": i % 5,
            "event_type": "click" if i % 4 else "view",
            "value": float(i),
            "props": json.dumps({"k": i % 9}),
        }
        for i in range(n)
    ]
    rows += [{**rows[1], "ts": None, "event_id": n}, {**rows[1], "event_type": None, "event_id": n + 1}]
    schema = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])
    pq.write_table(pa.Table.from_pylist(rows, schema), f"{folder}/events.parquet", row_group_size=max(1, n // groups))
    return sorted((r["ts"], r["event_id"]) for r in rows if r["event_type"] == "click" and r["ts"])


WINDOW = ("2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00")


def pages(get_page, size):
    page, got = 1, []
    while page:
        records, page = get_page(WIND, *WINDOW, page, size)
        got.append(records)
    return got


def moments(records):
    return [(dt.datetime.fromisoformat(r["startTime"]).replace(tzinfo=None), r["event_id"]) for r in records]


def test_a_window_is_never_held_whole(tmp_path, monkeypatch):
    """However many events a window has, tables stay small, and pages are complete and in order."""
    wanted = write_events(tmp_path, 3000)
    monkeypatch.setattr(feeds, "HELD_ROWS", 40)
    monkeypatch.setattr(feeds, "PARTS", 16)
    at_once = max(sum(1 for t, _ in wanted if t == moment) for moment in {t for t, _ in wanted})
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 10**6
    sizes = [t.num_rows for t in feeds.events_in_order(f"{tmp_path}/events.parquet", "click", start, start + 86400 * 10**6)]
    assert sum(sizes) == len(wanted) and sorted(sizes)[-2:] <= [40, at_once] and len(sizes) > 20
    for size in (7, 100, 5000):
        got = pages(feeds.event_pages(str(tmp_path)), size)
        assert {len(p) for p in got[:-1]} <= {size} and 0 < len(got[-1]) <= size
        assert moments(r for p in got for r in p) == wanted


def test_pages_in_any_order(tmp_path, monkeypatch):
    wanted = write_events(tmp_path, 200)
    monkeypatch.setattr(feeds, "HELD_ROWS", 30)
    get_page = feeds.event_pages(str(tmp_path))
    for page in (3, 1, 2, 2, 5, 4, 1):
        assert moments(get_page(WIND, *WINDOW, page, 20)[0]) == wanted[(page - 1) * 20 : page * 20]
    assert get_page(WIND, *WINDOW, 99, 20) == ([], None)
    assert get_page(WIND, "2025-01-01T00:00:00+00:00", "2025-01-02T00:00:00+00:00", 1, 20) == ([], None)


def test_a_page_asked_again_after_an_error_is_whole(tmp_path, monkeypatch):
    wanted = write_events(tmp_path, 200)
    monkeypatch.setattr(feeds, "HELD_ROWS", 30)
    get_page, read, calls = feeds.event_pages(str(tmp_path)), feeds._found, []

    def flaky(*asked):
        calls.append(asked)
        if len(calls) == 4:
            raise OSError
        return read(*asked)

    monkeypatch.setattr(feeds, "_found", flaky)
    got, page = [], 1
    while page:
        try:
            records, page = get_page(WIND, *WINDOW, page, 20)
        except OSError:
            continue
        got += records
    assert moments(got) == wanted and len(calls) > 4
