"""Unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .typing import as_column

# Fixed value: kilometres in a mile.
KM_PER_MILE = 1.60934


def distance_km(miles: Column | str) -> Column:
    """Miles to kilometres as a float; NULL stays NULL."""
    return (as_column(miles).cast("double") * F.lit(KM_PER_MILE)).cast("float")
