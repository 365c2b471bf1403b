"""Where queries are registered, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import pin
from .feeds import without_zone

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(sql: str | None, name: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_zone(run(pin(spark), sf_dir))

        CATALOG[name or run.__name__] = Query(pinned, sql)
        return run

    return register


def sql_latest(rows: str, keys: tuple[str, ...], sequence: str, ties: str) -> str:
    named = ", ".join(f'"{key}"' for key in keys)
    order = ", ".join(f'"{c}" DESC NULLS LAST' for c in [sequence, *ties.split()])
    return f"""
    SELECT * EXCLUDE (rank_) FROM (
        SELECT *, row_number() OVER (PARTITION BY {named} ORDER BY {order}) AS rank_
        FROM ({rows})) WHERE rank_ = 1"""
