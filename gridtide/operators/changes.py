"""Change data beyond the newest row: deletes, truncates, partial updates, history.

A changing table is kept as a state from which its visible rows follow without a
join. Folding is a function of the set of changes: any order and any split
into batches gives the same state, late and repeated changes included.

    newest row       the newest change per key, also if it is a delete (a tombstone, hidden
                     at read), so that an older upsert that comes late stays out
    ignored NULLs    per key the newest value of each column with its sequence, and the newest delete
    history          every change of a key, with the interval it opens if it opens one

A change with the sequence of a delete, or of a truncate, is removed by it. Of changes
of a key with one sequence the one with the larger columns wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import passes
from .upsert import latest_per_key, newest_first

# Columns of a history. Users of other change-data flows know them by these names.
START_AT, END_AT = "__START_AT", "__END_AT"

GONE, GONE_AT, SEEN_AT = "_gone", "_gone_at", "_seen_at"
HEAD, SHOWN = "_head", "_shown"


@dataclass(frozen=True)
class ChangeRule:
    """How changes become rows.

    ``deletes`` and ``truncates`` are conditions on a change; a truncate needs no key. ``columns``
    or ``except_columns`` choose what is kept. With ``history`` each key has rows with
    the interval they hold in; ``track`` or ``track_except`` name the columns whose change opens a new
    one, the others are updated in place. Without either every change opens an interval.
    """

    keys: tuple[str, ...]
    sequence_by: str
    deletes: str | None = None
    truncates: str | None = None
    ignore_nulls: bool = False
    columns: tuple[str, ...] | None = None
    except_columns: tuple[str, ...] | None = None
    history: bool = False
    track: tuple[str, ...] | None = None
    track_except: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.columns is not None and self.except_columns is not None:
            raise ValueError("columns and except_columns exclude each other")
        if self.track is not None and self.track_except is not None:
            raise ValueError("track and track_except exclude each other")
        if not self.history and (self.track is not None or self.track_except is not None):
            raise ValueError("tracked columns need history")
        if self.history and (self.truncates or self.ignore_nulls):
            raise ValueError("a history has neither truncates nor ignored NULLs")

    def kept(self, names: Sequence[str]) -> list[str]:
        """Columns of the table, in the order of the changes; keys and sequence always stay."""
        always = {*self.keys, self.sequence_by}
        if self.columns is not None:
            return [n for n in names if n in always or n in self.columns]
        return [n for n in names if n in always or n not in (self.except_columns or ())]

    def values(self, names: Sequence[str]) -> list[str]:
        return [n for n in names if n not in self.keys and n != self.sequence_by]

    def untracked(self, names: Sequence[str]) -> list[str]:
        """Columns updated in place: none unless some are tracked."""
        if self.track is not None:
            return [n for n in names if n not in self.keys and n not in self.track]
        if self.track_except is not None:
            return [n for n in names if n not in self.keys and (n in self.track_except or n == self.sequence_by)]
        return []

    # --- changes -> state ------------------------------------------------------------------------

    def _condition(self, text: str | None) -> Column:
        return passes(text) if text else F.lit(False)

    def truncate_mark(self, changes: DataFrame) -> Column:
        """The newest truncate among changes, as an aggregate."""
        return F.max(F.when(self._condition(self.truncates), F.col(self.sequence_by)))

    def state_of(self, changes: DataFrame) -> DataFrame:
        """Changes of rows as state rows of one change each; truncates are no rows."""
        names = self.kept(changes.columns)
        clash = [n for n in names if n in (GONE, GONE_AT, SEEN_AT, HEAD, SHOWN, START_AT, END_AT)]
        if clash:
            raise ValueError(f"columns of the state must not be among the changes: {clash}")
        sequence = F.col(self.sequence_by)
        told = F.when(sequence.isNotNull(), sequence).otherwise(F.raise_error(F.lit(f"{self.sequence_by} must not be NULL")))
        gone = self._condition(self.deletes)
        of_rows = changes.where(~self._condition(self.truncates)) if self.truncates else changes
        rows = of_rows.select(*[told.alias(n) if n == self.sequence_by else F.col(n) for n in names], gone.alias(GONE))
        if not self.ignore_nulls:
            return rows
        values = self.values(names)
        here = ~F.col(GONE)
        return rows.select(
            *self.keys,
            F.when(here, sequence).alias(SEEN_AT),
            F.when(~here, sequence).alias(GONE_AT),
            *[F.when(here & F.col(v).isNotNull(), F.struct(sequence.alias("at"), F.col(v).alias("value"))).alias(v) for v in values],
        )

    def fold(self, state: DataFrame) -> DataFrame:
        """State rows of any changes as one state."""
        if self.history:
            return self._intervals(state)
        if self.ignore_nulls:
            others = [n for n in state.columns if n not in self.keys]
            return state.groupBy(*self.keys).agg(*[F.max(n).alias(n) for n in others]).select(*state.columns)
        ordered = state.select(GONE, *[n for n in state.columns if n != GONE])
        return latest_per_key(ordered, self.keys, self.sequence_by).select(*state.columns)

    def _intervals(self, state: DataFrame) -> DataFrame:
        """Every change once, the intervals it opens computed anew.

        All windows go from a key's newest change to its oldest, so one shuffle and one sort serve them;
        their frames only grow, so a key takes time in proportion to its changes.
        """
        names = [n for n in state.columns if n not in (HEAD, SHOWN, END_AT)]
        plain = [n for n in names if n != GONE]
        dealt = state.select(GONE, *plain).repartition(*self.keys)
        sequence = F.col(self.sequence_by)
        by_key = Window.partitionBy(*self.keys)
        # Of the changes of one moment the first in this order stays. Its order begins with that of all other windows.
        moment = by_key.orderBy(*newest_first(dealt.columns, self.keys, self.sequence_by))
        once = dealt.withColumn(HEAD, ~F.lag(sequence).over(moment).eqNullSafe(sequence)).where(HEAD).drop(HEAD)
        backward = by_key.orderBy(sequence.desc())
        hidden = self.untracked(plain)
        if hidden:
            tracked = F.struct(GONE, *[n for n in plain if n not in self.keys and n not in hidden])
            # The first change of a key, one after a delete, or one of a tracked column opens an interval.
            opens = ~F.col(GONE) & ~F.lead(tracked).over(backward).eqNullSafe(tracked)
        else:
            opens = ~F.col(GONE)
        marked = once.withColumn(HEAD, opens)
        bound = F.col(HEAD) | F.col(GONE)
        ends = F.last(F.when(bound, sequence), ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1))
        marked = marked.withColumn(END_AT, ends)
        if not hidden:
            return marked.select(*names, HEAD, END_AT)
        # What an interval shows of the other columns is in its last change, the one that none or a bound follows.
        newest = F.when(F.coalesce(F.lag(bound).over(backward), F.lit(True)) & ~F.col(GONE), F.struct(*hidden))
        shown = F.last(F.col(SHOWN), ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, 0))
        marked = marked.withColumn(SHOWN, newest).withColumn(SHOWN, F.when(~F.col(GONE), shown))
        return marked.select(*names, HEAD, END_AT, SHOWN)

    # --- state -> rows ---------------------------------------------------------------------------

    def visible(self, state: DataFrame, names: Sequence[str]) -> DataFrame:
        """The rows that the table shows."""
        if self.history:
            hidden = self.untracked(names)
            columns = [F.col(SHOWN)[n].alias(n) if n in hidden else F.col(n) for n in names]
            return state.where(HEAD).select(*columns, F.col(self.sequence_by).alias(START_AT), F.col(END_AT))
        if self.ignore_nulls:
            lives = F.col(GONE_AT).isNull() | (F.col(SEEN_AT) > F.col(GONE_AT))
            seen = state.where(F.col(SEEN_AT).isNotNull() & lives)
            held = {n: F.when(F.col(GONE_AT).isNull() | (F.col(n)["at"] > F.col(GONE_AT)), F.col(n)["value"]) for n in self.values(names)}
            held |= {self.sequence_by: F.col(SEEN_AT)}
            return seen.select(*[held[n].alias(n) if n in held else F.col(n) for n in names])
        return state.where(~F.col(GONE)).select(*names)

    def after(self, state: DataFrame, marker: str | None) -> DataFrame:
        """State without what a truncate at ``marker`` removes."""
        if marker is None:
            return state
        kind = state.schema[SEEN_AT if self.ignore_nulls else self.sequence_by].dataType
        cut = F.lit(marker).cast(kind)
        if not self.ignore_nulls:
            return state.where(F.col(self.sequence_by) > cut)
        newer = F.coalesce(F.greatest(SEEN_AT, GONE_AT) > cut, F.lit(False))
        return state.where(newer).withColumn(GONE_AT, F.greatest(GONE_AT, cut))

    def state_schema(self, changes: T.StructType) -> T.StructType:
        names = self.kept(changes.fieldNames())
        kinds = {n: changes[n].dataType for n in names}
        sequence = kinds[self.sequence_by]
        if self.ignore_nulls:
            dated = {v: T.StructType([T.StructField("at", sequence), T.StructField("value", kinds[v])]) for v in self.values(names)}
            fields = {k: kinds[k] for k in self.keys} | {SEEN_AT: sequence, GONE_AT: sequence} | dated
        else:
            fields = kinds | {GONE: T.BooleanType()}
        if self.history:
            fields |= {HEAD: T.BooleanType(), END_AT: sequence}
            hidden = self.untracked(names)
            if hidden:
                fields[SHOWN] = T.StructType([T.StructField(n, kinds[n]) for n in hidden])
        return T.StructType([T.StructField(n, kind) for n, kind in fields.items()])


def changed(changes: DataFrame, rule: ChangeRule) -> DataFrame:
    """The table that all changes of a batch give at once."""
    state = rule.state_of(changes)
    if rule.truncates:
        # One row, so the comparison with it is a subquery and no join.
        cut = changes.agg(rule.truncate_mark(changes)).scalar()
        state = _after_column(rule, state, cut)
    return rule.visible(rule.fold(state), rule.kept(changes.columns))


def _after_column(rule: ChangeRule, state: DataFrame, cut: Column) -> DataFrame:
    if rule.ignore_nulls:
        newer = F.coalesce(F.greatest(SEEN_AT, GONE_AT) > cut, F.lit(False)) | cut.isNull()
        return state.where(newer).withColumn(GONE_AT, F.greatest(GONE_AT, cut))
    return state.where(cut.isNull() | (F.col(rule.sequence_by) > cut))
