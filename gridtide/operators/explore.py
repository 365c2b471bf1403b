"""Looking at tables by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_by_name(frame: DataFrame, table: str) -> DataFrame:
    """Read a table through SQL under a name that begins with digits."""
    frame.createOrReplaceTempView(f"`{table}`")
    return frame.sparkSession.sql(f"SELECT * FROM `{table}`")


def sorted_by(frame: DataFrame, column: str) -> DataFrame:
    """Full ascending sort. The other columns break ties, which also lets the
    range exchange split a run of equal values over many partitions."""
    others = [name for name in frame.columns if name != column]
    return frame.orderBy(*[F.col(name).asc_nulls_last() for name in (column, *others)])


def latest(frame: DataFrame, column: str, n: int) -> DataFrame:
    """The n rows with the highest value; ties by all other columns."""
    others = [name for name in frame.columns if name != column]
    return frame.orderBy(*[F.col(name).desc_nulls_last() for name in (column, *others)]).limit(n)


def missing(frame: DataFrame, column: str) -> DataFrame:
    return frame.where(F.col(column).isNull())


def profile(frame: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of values."""
    return frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


PROFILE_COLUMNS = ("customer_type", "resolution", "unit_of_measure", "time_series_type")
