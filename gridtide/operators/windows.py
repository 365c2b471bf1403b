"""Load windows: consecutive spans from the watermark of a dataset to now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typing import compact_text, parameter_int, to_typed
from .lookups import broadcast_if_small

DAY_MICROS = 86_400 * 1_000_000


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def _div(value: Column, by: Column) -> Column:
    return F.call_function("div", value, by)


def _checked(value: Column, good: Column, what: str) -> Column:
    """The value, or an error that names the dataset: a mark or step that plans no
    window would skip a dataset's history for ever."""
    told = F.concat(F.lit("dataset "), F.col("source_dataset_id").cast("string"), F.lit(f": {what}"))
    return F.when(F.coalesce(good, F.lit(False)), value).otherwise(F.raise_error(told))


def _spans(active: DataFrame, now: Column) -> DataFrame:
    """Start, end and step of every dataset."""
    mark, days = to_typed("last_timestamp", "timestamp"), parameter_int("load_increment_days")
    return active.select(
        "source_dataset_id",
        "source_dataset_name",
        parameter_int("page_size").alias("page_size"),
        _checked(mark, mark.isNotNull(), "no watermark").alias("_start"),
        now.cast("timestamp").alias("_end"),
        (_checked(days, days > 0, "load_increment_days must be positive") * F.lit(DAY_MICROS)).alias("_step"),
    )


def _window(number: Column) -> list[Column]:
    """Bounds of a numbered window; the last one is clipped at the end."""
    start = F.timestamp_micros(_micros(F.col("_start")) + number * F.col("_step"))
    end = F.timestamp_micros(_micros(F.col("_start")) + (number + 1) * F.col("_step"))
    return [start.alias("window_start"), F.least(end, F.col("_end")).alias("window_end")]


def plan_windows(active: DataFrame, now: Column) -> DataFrame:
    """One row per dataset and window."""
    last = _div(_micros(F.col("_end")) - _micros(F.col("_start")) - 1, F.col("_step"))
    numbered = _spans(active, now).where("_start < _end").withColumn("_number", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return numbered.select(
        "source_dataset_id", "source_dataset_name", "page_size", *_window(F.col("_number"))
    )


def place_records(records: DataFrame, active: DataFrame, now: Column) -> DataFrame:
    """All records with the window they belong to, or with the reason why none takes them.

    A window number is plain arithmetic on the start time, so no record is
    compared with the windows themselves: the only join is on the dataset id.
    ``records`` has source_dataset_id next to the landing fields. A record
    whose start is not a time goes to the last window, so that bronze sees it
    and its rules count it.
    """
    last_moment = F.col("_end") - F.expr("INTERVAL 1 MICROSECOND")
    number = _div(_micros(F.col("_started")) - _micros(F.col("_start")), F.col("_step"))
    spans = broadcast_if_small(_spans(active, now).withColumn("_known", F.lit(True)))
    reason = (
        F.when(F.col("source_dataset_id").isNull(), "no_dataset")
        .when(F.col("_known").isNull(), "unknown_dataset")
        .when(F.col("_started") < F.col("_start"), "before_mark")
        .when((F.col("_started") >= F.col("_end")) | (F.col("_start") >= F.col("_end")), "after_end")
    )
    return (
        records.withColumn("_started", to_typed("startTime", "timestamp"))
        .join(spans, "source_dataset_id", "left")
        .withColumn("_started", F.coalesce("_started", last_moment))
        .select(
            *records.columns, "source_dataset_name", *_window(number), reason.alias("rejected"), now.cast("timestamp").alias("rejected_at")
        )
    )


def assign_windows(records: DataFrame, active: DataFrame, now: Column) -> DataFrame:
    """The records of the planned span with the window they belong to."""
    placed = place_records(records, active, now)
    return placed.where("rejected IS NULL").drop("rejected", "rejected_at")


def batch_name(start: Column, end: Column) -> Column:
    """``<start>_to_<end>`` in compact text."""
    return F.concat_ws("_to_", compact_text(start), compact_text(end))
