"""Repair of conversations whose turns are damaged: the cheapest edits, found by branch and bound.

A conversation should read ``s?(ua)+`` by the initials of its roles (system, user, assistant), or be
empty. Rows are kept (0), given the role user or assistant (2) or deleted (3; blank rows and rows seen
before must be), and empty rows may be inserted anywhere (2); a truncated row that stays adds 1. Of the
cheapest edits those with the least audit count, the text of the edits' initials K, R, D and I.

The search goes depth first with an explicit stack over nodes (row, state of the pattern). A suffix
lower bound, the cost of the remaining rows if the end were free behind a system row, cuts a branch that
cannot beat the incumbent (cost, audit); a dominance table keeps the best prefix known for each node and
cuts worse ones, also when they wait on the stack. The search ends when nothing is left that could
be better, which proves the incumbent. Prefixes are linked, so a long conversation needs some
hundred bytes a row. Two prefixes of a node with equal cost differ in some edit, since the edits
alone determine the cost; so the one whose audit is less stays so with any suffix.

Rows move twice. First without texts: sorted by conversation and turn, they stream through a task, which
holds one byte and one digest a row of the conversation at hand. Then texts, sorted likewise
behind one row with the plan, stream through the digest of the repaired text, so that no
task holds the texts of a conversation, however long.

Rows of a conversation are taken by turn (NULL first), ties by role and the SHA-256 of role and
text, so the result does not depend on the order of rows. NULL roles and texts are one space. An
empty role has no initial: such a row is not kept as it is. A NULL conv_id is a conversation like
others. A conversation without rows after the damage, and a table without rows, need no edit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merkle import sql_crc32

VISIBLE = "[^\\x20\\x09-\\x0D]"
ENDING = "[.!?]"

# Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1

# States of the pattern s?(ua)+: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
COMPLETE = (START, AFTER_A)
STATES = 4

# A row as one byte: its initial in the low bits, then whether it has to go, and whether it is truncated.
OTHER, S, U, A = range(4)
MUST_GO, TRUNCATED = 4, 8

# By state and initial: the state after the row, or None.
NEXT = {START: {S: AFTER_S, U: AFTER_U}, AFTER_S: {U: AFTER_U}, AFTER_U: {A: AFTER_A}, AFTER_A: {U: AFTER_U}}
# By state: the state after a user or assistant that is put here.
PUT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}

MEMO_ROWS = 64


# --- search ----------------------------------------------------------------------------------------


def suffix_bounds(rows: bytes) -> list[tuple[int, int, int, int]]:
    """By row and state, a cost that this row and all after it have at least: their least cost if a
    conversation could end behind its system row."""
    bounds = [(0, 0, INSERT, 0)]
    for row in reversed(rows):
        later, own = bounds[-1], []
        for state in range(STATES):
            least = DELETE + later[state]
            if not row & MUST_GO:
                stays = CUT if row & TRUNCATED else 0
                least = min(least, REROLE + stays + later[PUT[state]])
                kept = NEXT[state].get(row & 3)
                if kept is not None:
                    least = min(least, KEEP + stays + later[kept])
            own.append(least)
        bounds.append(tuple(min(own[state], INSERT + own[PUT[state]]) for state in range(STATES)))
    bounds.reverse()
    return bounds


# A prefix of edits: (prefix before it, edit, number of edits), None if there is none yet.


def audit_less(a: tuple | None, b: tuple | None) -> bool:
    """Whether audit ``a`` comes before ``b``; walks back only to where the two part."""
    first, longer = 0, 0
    while a is not b:
        depth_a, depth_b = a[2] if a else 0, b[2] if b else 0
        if depth_a == depth_b:
            if a[1] != b[1]:
                first = -1 if a[1] < b[1] else 1
            a, b = a[0], b[0]
        elif depth_a > depth_b:
            a, longer = a[0], 1
        else:
            b, longer = b[0], -1
    return (first or longer) < 0


def prefixes(prefix: tuple | None) -> list[tuple | None]:
    """A prefix and all shorter ones, by length."""
    found = [prefix]
    while found[-1]:
        found.append(found[-1][0])
    found.reverse()
    return found


def moves(row: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after it) of one row."""
    yield "D", DELETE, state
    if not row & MUST_GO:
        stays = CUT if row & TRUNCATED else 0
        kept = NEXT[state].get(row & 3)
        if kept is not None:
            yield "K", KEEP + stays, kept
        yield "R", REROLE + stays, PUT[state]


def search(rows: bytes) -> tuple[int, str]:
    """Least cost and, of the edits with that cost, the least audit."""
    n, bounds = len(rows), suffix_bounds(rows)
    known: dict[int, tuple[int, tuple | None]] = {START: (0, None)}  # dominance table, by row * STATES + state
    best_cost, trail = DELETE * n, [None]  # the incumbent, with all its prefixes
    for k in range(n):
        trail.append((trail[-1], "D", k + 1))  # at first an empty conversation
    stack = [(0, START, 0, None)]
    while stack:
        i, state, cost, prefix = stack.pop()
        least = cost + bounds[i][state]
        if known[i * STATES + state][1] is not prefix or least > best_cost:
            continue
        if least == best_cost and prefix and audit_less(trail[min(prefix[2], len(trail) - 1)], prefix):
            continue
        if i == n and state in COMPLETE and (cost < best_cost or audit_less(prefix, trail[-1])):
            best_cost, trail = cost, prefixes(prefix)
        depth = prefix[2] + 1 if prefix else 1
        open_ = [("I", INSERT, PUT[state], i)]
        if i < n:
            open_ += [(edit, more, to, i + 1) for edit, more, to in moves(rows[i], state)]
        children = []
        for edit, more, to, j in open_:
            total, least = cost + more, cost + more + bounds[j][to]
            if least > best_cost:
                continue
            longer, former = (prefix, edit, depth), known.get(j * STATES + to)
            if former and (former[0] < total or former[0] == total and not audit_less(longer, former[1])):
                continue
            known[j * STATES + to] = (total, longer)
            children.append((least, edit, (j, to, total, longer)))
        children.sort(key=lambda c: c[:2], reverse=True)
        stack.extend(child for _, _, child in children)
    return best_cost, "".join(prefix[1] for prefix in trail[1:])


remembered = lru_cache(maxsize=1 << 16)(search)


def solved(rows: bytes) -> tuple[int, str]:
    """``search``; short conversations of the same make are searched once a task."""
    return remembered(rows) if len(rows) <= MEMO_ROWS else search(rows)


# --- damage ----------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows as they are after the damage, which is drawn from conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    drawn = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("drawn"),
    )
    how = F.col("drawn")
    text = F.when(how == 1, F.lit("")).when(how == 2, F.regexp_replace("text", ENDING, "")).otherwise(F.col("text"))
    role = F.when(how == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.when(how == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(how == 0)))
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("gone"))


# --- streams of sorted rows ------------------------------------------------------------------------

PLAN = {"gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string"}
PLANNED = pa.schema([("conv_id", pa.int64()), *[(name, pa.string() if kind == "string" else pa.int64()) for name, kind in PLAN.items()]])
PLANNED_DDL = ", ".join(["conv_id long", *[f"{name} {kind}" for name, kind in PLAN.items()]])

INITIALS = {"s": S, "u": U, "a": A}
LEGAL = {(S, U), (U, A), (A, U)}


def _faced(rows: DataFrame) -> DataFrame:
    """Rows without texts: what the search and the counts ask of them."""
    bare = F.regexp_extract("text", f"({VISIBLE})[\\x20\\x09-\\x0D]*\\z", 1)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "gone",
        F.substring("role", 1, 1).alias("initial"),
        F.when(bare == "", 0).when(bare.rlike(ENDING), 1).otherwise(2).alias("end"),
        identity().alias("same"),
    )


def identity() -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


class _Conversation:
    """Counts and row bytes of the conversation at hand."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.rows, self.seen = conv_id, bytearray(), set()
        self.low = self.high = self.previous = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: str, end: int, same: bytes) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        row = INITIALS.get(initial, OTHER)
        # Roles outside the three have initials as well, which no pair allows.
        if self.previous is not None and (self.previous, row) not in LEGAL:
            self.illegal += 1
        self.previous = row
        if end == 0:
            self.blank, row = self.blank + 1, row | MUST_GO
        elif same in self.seen:
            self.duplicate, row = self.duplicate + 1, row | MUST_GO
        elif end == 2:
            self.truncated, row = self.truncated + 1, row | TRUNCATED
        self.seen.add(same)
        self.rows.append(row)

    def plan(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        cost, audit = solved(bytes(self.rows))
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _batches(made: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in made:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "end", "same", "gone")]
            for conv_id, turn, initial, end, same, gone in zip(*columns):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield now.plan()
                    now = _Conversation(conv_id)
                if not gone:
                    now.add(turn, initial, end, same)
        if now is not None:
            yield now.plan()

    yield from _batches(made(), PLANNED)


class _Repaired:
    """The digest of the repaired conversation, row by row."""

    def __init__(self, plan: tuple):
        self.plan, self.audit, self.at = plan, plan[-1], 0
        self.digest, self.out = hashlib.sha256(), 0
        # An odd number of rows starts with the system row.
        self.odd = (len(self.audit) - self.audit.count("D")) % 2

    def put(self, role: str | None, text: str) -> None:
        turn = self.out - self.odd
        role = role if role is not None else ("assistant" if turn % 2 else "user")
        self.digest.update(f"{chr(10) if self.out else ''}{role}:{text}".encode())
        self.out += 1

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.put(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.put(role if edit == "K" else None, text)

    def done(self) -> tuple:
        self.inserts()
        return (*self.plan, self.digest.hexdigest())


HASHED = PLANNED.append(pa.field("repaired_sha256", pa.string()))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*HASHED.names[:-1], "role", "text")]
            for *plan, role, text in zip(*columns):
                if plan[-1] is not None:
                    if now is not None:
                        yield now.done()
                    now = _Repaired(tuple(plan))
                else:
                    now.row(role, text)
        if now is not None:
            yield now.done()

    yield from _batches(made(), HASHED)


def op13(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conversation."""
    after = damaged(rows)
    order = ["turn", "role", "same"]
    plans = _faced(after).repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(_plans, PLANNED_DDL)
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in PLAN.items()]
    texts = after.where("NOT gone").select("conv_id", *nothing, "turn", "role", "text", identity().alias("same"), F.lit(1).alias("kind"))
    heads = plans.select("*", *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "same")], F.lit(0).alias("kind"))
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order)
    return both.select(*HASHED.names[:-1], "role", "text").mapInArrow(_digests, f"{PLANNED_DDL}, repaired_sha256 string")


_SQL_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

SQL = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {sql_crc32(_SQL_KEY)} % 20 AS d FROM conversations),
g AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '{ENDING}', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS again FROM c WHERE d <> 0),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again) AS i, substr(role, 1, 1) AS initial FROM g),
f AS (SELECT *, regexp_extract(text, '({VISIBLE})[\\x20\\x09-\\x0D]*\\z', 1) AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM k),
h AS (SELECT *, bare = '' AS blank, bare <> '' AND twice AS dup, bare <> '' AND NOT twice AND bare NOT IN ('.', '!', '?') AS cut FROM f),
m(q, q2, edit, initial) AS (VALUES (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (2, 3, 'K', 'a'), (3, 2, 'K', 'u'),
  (0, 2, 'R', NULL), (1, 2, 'R', NULL), (2, 3, 'R', NULL), (3, 2, 'R', NULL), (0, 0, 'D', NULL), (1, 1, 'D', NULL), (2, 2, 'D', NULL), (3, 3, 'D', NULL)),
ins(q, q2, edits) AS (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (2, 3, 'I'), (3, 2, 'I'), (0, 3, 'II'), (1, 3, 'II'), (2, 2, 'II'), (3, 3, 'II')),
o AS (SELECT DISTINCT conv_id FROM conversations),
s AS (SELECT conv_id, 0::BIGINT AS i, q2 AS q, {{'cost': 2 * length(edits), 'audit': edits}} AS best FROM o CROSS JOIN ins WHERE q = 0
  UNION ALL
  SELECT s.conv_id, h.i, ins.q2, min({{'cost': s.best.cost + CASE edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN cut AND edit <> 'D' THEN 1 ELSE 0 END + 2 * length(edits), 'audit': s.best.audit || edit || edits}})
  FROM s JOIN h ON h.conv_id IS NOT DISTINCT FROM s.conv_id AND h.i = s.i + 1 JOIN m ON m.q = s.q AND (m.initial IS NULL OR m.initial = h.initial) AND (edit = 'D' OR NOT (blank OR dup)) JOIN ins ON ins.q = m.q2
  GROUP BY s.conv_id, h.i, ins.q2),
n AS (SELECT conv_id, max(i) AS rows_, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
  count(*) FILTER (former IS NOT NULL AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM h GROUP BY conv_id),
e AS (SELECT s.conv_id, min(best) AS best FROM s LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.i = coalesce(n.rows_, 0) AND q IN (0, 3) GROUP BY s.conv_id),
a AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM e),
b AS (SELECT *, audit[p] AS edit, count(*) FILTER (audit[p] <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i, count(*) FILTER (audit[p] <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS place,
  count(*) FILTER (audit[p] <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM a),
t AS (SELECT b.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS sha
  FROM b LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM b.conv_id AND h.i = b.i WHERE edit <> 'D' GROUP BY b.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(e.best.cost AS BIGINT) AS cost, e.best.audit AS audit, coalesce(t.sha, sha256('')) AS repaired_sha256
FROM o LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""
