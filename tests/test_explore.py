from gridtide.operators import explore


def test_order_and_latest(spark):
    frame = spark.createDataFrame([(2, "b"), (1, "z"), (None, "n"), (2, "a"), (1, "y")], "t int, s string")
    ordered = explore.sorted_by(frame.repartition(3), "t").collect()
    assert [tuple(r) for r in ordered] == [(1, "y"), (1, "z"), (2, "a"), (2, "b"), (None, "n")]
    assert explore.latest(frame, "t", 3).collect() == [(2, "b"), (2, "a"), (1, "z")]
    plan = explore.latest(frame, "t", 3)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_missing_and_profile(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (None, "a"), (1, "a")], "t int, s string")
    assert rows(explore.missing(frame, "t")) == [(None, "a")]
    assert rows(explore.profile(frame, "t", "s")) == [(1, "a", 2), (None, "a", 1)]


def test_scan_under_a_name_with_digits(spark):
    frame = spark.range(3)
    assert explore.scan_by_name(frame, "245_wind").count() == 3
    assert spark.sql("SELECT count(*) FROM `245_wind` WHERE id > 0").first()[0] == 2
