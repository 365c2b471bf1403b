import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridtide.config import Dataset, Layout, parse_datasets, slug
from gridtide.functions.calendar import floor_to_quarter_hour, second_of_day, time_of_day_text
from gridtide.functions.typing import compact_text, iso_text, parameter_int, to_typed
from gridtide.functions.units import distance_km
from gridtide.operators import dims
from gridtide.session import join_path


def values(spark, *items):
    return spark.createDataFrame([(i,) for i in items], "v string")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-01T02:00:00+02:00", "2025-01-01 00:00:00"),
        ("2025-01-01T00:00:00Z", "2025-01-01 00:00:00"),
        ("2025-01-01 00:00:00", "2025-01-01 00:00:00"),
        ("2025-01-01", "2025-01-01 00:00:00"),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_text_to_timestamp(spark, text, expected):
    got = values(spark, text).select(to_typed("v", "timestamp").cast("string")).first()[0]
    assert got == expected


def test_bad_numbers_are_null(spark, rows):
    frame = values(spark, "1.5", "abc", "", None, "7")
    assert frame.select(to_typed("v", "double")).collect() == [(1.5,), (None,), (None,), (None,), (7.0,)]
    assert frame.select(to_typed("v", "bigint")).where("v is not null").collect()[-1] == (7,)


def test_parameters(spark):
    assert values(spark, "20", "20.0").select(parameter_int("v")).collect() == [(20,), (20,)]


def test_timestamp_texts(spark):
    moments = values(spark, "2025-01-01 10:00:00", "2025-01-01 10:00:00.5").select(
        F.col("v").cast("timestamp").alias("v")
    )
    assert [r[0] for r in moments.select(iso_text("v")).collect()] == [
        "2025-01-01T10:00:00",
        "2025-01-01T10:00:00.500000",
    ]
    assert moments.select(compact_text("v")).first()[0] == "20250101T100000Z"


def test_floor_and_time_of_day(spark):
    frame = values(spark, "2025-01-01 00:07:00", "1969-12-31 23:59:59", "2025-01-01 10:15:00.25")
    moment = F.col("v").cast("timestamp")
    got = frame.select(
        floor_to_quarter_hour(moment).cast("string"), time_of_day_text(moment), second_of_day(moment)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("2025-01-01 00:00:00", "00:07:00", 420),
        ("1969-12-31 23:45:00", "23:59:59", 86399),
        ("2025-01-01 10:15:00", "10:15:00", 36900),
    ]


def test_calendar(spark):
    calendar = dims.dim_date(spark)
    assert calendar.count() == 11_323
    assert len(calendar.columns) == 20
    weeks = {
        str(r.date): r.week_of_year
        for r in calendar.where("date_id in (20200229, 20210103, 20241230, 20501231)").collect()
    }
    assert weeks == {"2020-02-29": 9, "2021-01-03": 53, "2024-12-30": 1, "2050-12-31": 52}
    # against the calendar of the standard library
    for r in calendar.where("day in (1, 15, 28, 29, 30, 31) and year < 2030").collect():
        day = r.date
        assert r.date_id == int(day.strftime("%Y%m%d"))
        assert (r.day_name, r.month_name) == (day.strftime("%A"), day.strftime("%B"))
        assert r.day_of_week == day.isoweekday()
        assert r.week_of_year == day.isocalendar()[1]
        assert r.day_of_year == day.timetuple().tm_yday
        assert r.is_weekend == int(day.isoweekday() > 5) == 1 - r.is_weekday
        assert r.is_month_end == int((day + dt.timedelta(days=1)).day == 1)
        assert r.is_quarter_start == int(day.day == 1 and day.month in (1, 4, 7, 10))
        assert r.year_quarter == f"{day.year}-Q{(day.month + 2) // 3}"


def test_quarter_hours(spark):
    quarters = dims.dim_time(spark)
    assert quarters.count() == 96
    assert tuple(quarters.where("time_quarter_id = 43").first()) == (43, 10, 3, 45, "10:45:00")
    assert {t for _, t in quarters.dtypes} == {"bigint", "string"}


def test_generate_types(spark, rows):
    assert rows(dims.dim_generate_type(spark)) == [
        (245, "Wind", "15 mins"),
        (248, "Solar", "15 mins"),
    ]


def test_distance(spark):
    frame = spark.createDataFrame([(1.0,), (None,)], "m double")
    got = frame.select(distance_km("m").alias("km"))
    assert got.dtypes == [("km", "float")]
    assert got.collect()[1].km is None
    assert abs(got.collect()[0].km - 1.60934) < 1e-6


def test_names_and_paths():
    assert slug("Wind power (MW)") == "wind_power__mw_"
    assert Dataset(245, "Wind power").bronze_table == "245_wind_power_raw_table"
    assert Dataset(245, "Wind power").silver_table == "245_wind_power"
    assert parse_datasets('[{"id": "7", "name": "A b"}]') == [Dataset(7, "A b")]
    for text in ("nonsense", None, '[{"datasetId": 1}]'):
        with pytest.raises(ValueError):
            parse_datasets(text)
    assert join_path("s3a://x/", "/a/", "b") == "s3a://x/a/b"
    assert Layout("/r/", "test").landing_of(Dataset(1, "A b")) == "/r/test/landing/dataset=1_a_b"
