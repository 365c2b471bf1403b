"""Change data with deletes, truncates, partial updates and history, over ``lineitem``.

Each rule is a query over the whole table at once, and another one (``stream_``) in which a
hash deals the changes into two runs of a stream: its second run brings changes
older than those stored, and both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import ChangeRule, changed
from ..session import join_path, work_folder
from ..sources.sliced import hash_slices
from ..sources.tables import ensure_folder, stream_table
from ..streaming.changes import ChangeTable, run_changes
from ..streaming.runs import finish
from .feeds import table
from .registry import query, sql_latest

SLICES = 16

LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_VALUES = "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
RETURNED = "l_returnflag = 'R'"
CLEARED = "l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00'"

HISTORY_COLUMNS = ("l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
TRACKED = ("l_returnflag", "l_linestatus")
IN_PLACE = ("l_suppkey", "l_quantity")


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def partial_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of which some say nothing about their tax, and others about supplier and price."""
    rows = line_changes(spark, sf_dir)
    return rows.withColumns(
        {
            "l_tax": F.when(F.col("l_linestatus") == "F", F.col("l_tax")),
            "l_suppkey": F.when(F.col("l_quantity") > 20, F.col("l_suppkey")),
            "l_extendedprice": F.when(F.col("l_quantity") > 20, F.col("l_extendedprice")),
        }
    )


def streamed(spark: SparkSession, changes: DataFrame, rule: ChangeRule) -> DataFrame:
    """The table after two runs of a stream, each with the changes of one hash bucket."""
    root = work_folder(spark, "changes")
    folder = join_path(root, "changes")
    ensure_folder(spark, folder)
    target = ChangeTable(join_path(root, "table"), changes.schema, rule, hash_slices(rule.keys, SLICES))
    for half in range(2):
        changes.where(F.pmod(F.xxhash64(*changes.columns), F.lit(2)) == half).write.mode("append").parquet(folder)
        stream = stream_table(spark, folder, changes.schema)
        finish([run_changes(target, stream, join_path(root, "checkpoint"), "changes")])
    return target.read(spark)


@dataclass(frozen=True)
class Flow:
    """Rules over the same changes; with several, a column tells which one a row is from."""

    changes: Callable[[SparkSession, str], DataFrame]
    rules: dict[str, ChangeRule]
    sql: str

    def rows(self, spark: SparkSession, sf_dir: str, how: Callable[[DataFrame, ChangeRule], DataFrame]) -> DataFrame:
        made = []
        for label, rule in self.rules.items():
            shown = how(self.changes(spark, sf_dir), rule)
            named = {"__START_AT": "start_at", "__END_AT": "end_at"}
            shown = shown.withColumnsRenamed(named) if rule.history else shown
            made.append(shown.withColumn("rule", F.lit(label)) if len(self.rules) > 1 else shown)
        out = made[0]
        for more in made[1:]:
            out = out.unionByName(more)
        return out


_VALUES = LINE_VALUES.split()


def _sql_newest(rows: str) -> str:
    """The newest change per key; of one moment a delete first."""
    return sql_latest(f"SELECT *, coalesce({RETURNED}, false) AS gone FROM ({rows})", LINE_KEYS, "l_shipdate", f"gone {LINE_VALUES}")


SQL_DELETES = f"SELECT * EXCLUDE (gone) FROM ({_sql_newest('SELECT * FROM lineitem')}) WHERE NOT gone"

SQL_TRUNCATE = sql_latest(
    f"SELECT * FROM lineitem WHERE NOT ({CLEARED}) AND l_shipdate > (SELECT max(l_shipdate) FROM lineitem WHERE {CLEARED})",
    LINE_KEYS,
    "l_shipdate",
    LINE_VALUES,
)

SQL_PARTIAL = """SELECT * REPLACE (CASE WHEN l_linestatus = 'F' THEN l_tax END AS l_tax,
    CASE WHEN l_quantity > 20 THEN l_suppkey END AS l_suppkey, CASE WHEN l_quantity > 20 THEN l_extendedprice END AS l_extendedprice) FROM lineitem"""


def _sql_value(column: str) -> str:
    newest = f"max({{'at': l_shipdate, 'value': {column}}}) FILTER ({column} IS NOT NULL AND NOT gone AND (gone_at IS NULL OR l_shipdate > gone_at))"
    return f"{newest}.value AS {column}"


SQL_IGNORE_NULLS = f"""
    SELECT {", ".join(LINE_KEYS)}, max(l_shipdate) FILTER (NOT gone) AS l_shipdate, {", ".join(_sql_value(c) for c in _VALUES)}
    FROM (SELECT *, {RETURNED} AS gone, max(l_shipdate) FILTER ({RETURNED}) OVER (PARTITION BY {", ".join(LINE_KEYS)}) AS gone_at FROM ({SQL_PARTIAL}))
    GROUP BY {", ".join(LINE_KEYS)} HAVING max(l_shipdate) FILTER (NOT gone AND (gone_at IS NULL OR l_shipdate > gone_at)) IS NOT NULL"""

# One change per order and moment, deletes first.
_HISTORY_TIES = ", ".join(f"{c} DESC NULLS LAST" for c in HISTORY_COLUMNS)
SQL_MOMENTS = f"""
    SELECT l_orderkey, l_shipdate, {", ".join(HISTORY_COLUMNS)}, gone
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY gone DESC, {_HISTORY_TIES}) AS n
          FROM (SELECT *, {RETURNED} AS gone FROM lineitem)) WHERE n = 1"""
SQL_HISTORY = f"""
    SELECT * EXCLUDE (gone) FROM (
        SELECT *, l_shipdate AS start_at, lead(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS end_at FROM ({SQL_MOMENTS}))
    WHERE NOT gone"""
# Islands of equal tracked columns; what is not tracked, the sequence too, is that of the last change.
SQL_TRACKED = f"""
    WITH m AS ({SQL_MOMENTS}),
    b AS (SELECT *, coalesce((lag(gone) OVER w, lag(l_returnflag) OVER w, lag(l_linestatus) OVER w) IS DISTINCT FROM (gone, l_returnflag, l_linestatus), true)
            OR row_number() OVER w = 1 AS breaks FROM m WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate)),
    i AS (SELECT *, sum(CAST(breaks AS INT)) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS island FROM b),
    g AS (SELECT l_orderkey, island, max(l_shipdate) AS l_shipdate, arg_max(l_suppkey, l_shipdate) AS l_suppkey, arg_max(l_quantity, l_shipdate) AS l_quantity,
            any_value(l_returnflag) AS l_returnflag, any_value(l_linestatus) AS l_linestatus, any_value(gone) AS gone, min(l_shipdate) AS start_at FROM i GROUP BY l_orderkey, island),
    e AS (SELECT *, lead(start_at) OVER (PARTITION BY l_orderkey ORDER BY island) AS end_at FROM g),
    r(rule) AS (VALUES ('list'), ('except list'))
    SELECT e.* EXCLUDE (gone, island), rule FROM e CROSS JOIN r WHERE NOT gone"""

_history = {"keys": ("l_orderkey",), "sequence_by": "l_shipdate", "deletes": RETURNED, "columns": HISTORY_COLUMNS, "history": True}

FLOWS = {
    "upsert_deletes": Flow(line_changes, {"": ChangeRule(LINE_KEYS, "l_shipdate", deletes=RETURNED)}, SQL_DELETES),
    "upsert_truncate": Flow(line_changes, {"": ChangeRule(LINE_KEYS, "l_shipdate", truncates=CLEARED)}, SQL_TRUNCATE),
    "upsert_ignore_nulls": Flow(partial_changes, {"": ChangeRule(LINE_KEYS, "l_shipdate", deletes=RETURNED, ignore_nulls=True)}, SQL_IGNORE_NULLS),
    "scd2_line_items": Flow(line_changes, {"": ChangeRule(**_history)}, SQL_HISTORY),
    "scd2_tracked": Flow(
        line_changes,
        {"list": ChangeRule(**_history, track=TRACKED), "except list": ChangeRule(**_history, track_except=IN_PLACE)},
        SQL_TRACKED,
    ),
}

for _name, _flow in FLOWS.items():
    query(_flow.sql, _name)(lambda spark, sf_dir, flow=_flow: flow.rows(spark, sf_dir, changed))
    query(_flow.sql, f"stream_{_name}")(lambda spark, sf_dir, flow=_flow: flow.rows(spark, sf_dir, lambda changes, rule: streamed(spark, changes, rule)))
