"""Text to typed values. A value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_typed(value: Column | str, type_name: str) -> Column:
    """Guarded cast: bad text gives NULL also when ANSI mode is on."""
    return as_column(value).try_cast(type_name)


def parameter_int(value: Column | str) -> Column:
    """Whole number from parameter text such as ``"20"`` or ``"20.0"``."""
    return as_column(value).cast("double").cast("int")


def iso_text(value: Column | str) -> Column:
    """ISO 8601 text; the fraction appears only where there is one."""
    moment = as_column(value)
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    precise = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    has_fraction = F.pmod(F.unix_micros(moment.cast("timestamp")), F.lit(1_000_000)) != 0
    return F.when(has_fraction, precise).otherwise(whole)


def compact_text(value: Column | str) -> Column:
    """``20250101T000000Z``, as used in batch names."""
    return F.date_format(as_column(value), "yyyyMMdd'T'HHmmss'Z'")


def clock(now: Column | None) -> Column:
    """The passed time, or the time of the query (of the micro-batch)."""
    return F.current_timestamp() if now is None else now
