"""MinHash near-duplicates by a multi-index Hamming join.

A document's set are its distinct word shingles. Of SLOTS minimum hashes, b = 4 bits
each make its signature, kept as bit planes; the first KEYED slots are split into chunks of four. Two
documents that differ in at most 2 * CHUNKS - 1 = 31 of these slots have, by the
pigeonhole principle, a chunk with at most one differing slot; so each chunk gives
a key for each place where that one error may be (three of its four slots), and
every pair under the distance shares a key. At the similarity of 0.75 a pair
exceeds that distance with a probability near 1e-5, at 0.8 near 1e-8. Pairs that share
a key are compared by the whole signatures (MOST_DIFFERING is 4.3 standard
deviations above the mean at 0.75), and then confirmed on full sets.

Hot groups: documents with equal sets are one class from the beginning. In a
bucket, each class is first compared with some pivots only, the member that meets most
others and PIVOTS drawn by hash; this is linear in the bucket. Then only classes that
are not connected yet are compared with each other, with the distance inside the join (a few
operations on longs a pair, as buckets of dissimilar members stay open), and at the first key they share only. So a group of near copies costs about its size
and not its square, and no pair of the pigeonhole guarantee goes untested unless its
ends are connected already. Texts are read by scans, not shuffled; full sets are
made only for the classes in candidate pairs.

Defined cases: NULL texts and texts without words have an empty set, are linked
with nothing, and are their own component; a text of fewer words than a shingle is
one shingle; a NULL id takes part under its set; rows that repeat an id are judged by
their own text. Equal sets are told by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import RUN_BYTES, Words, components, lean, mix, same_columns, segments, signed, small_side, stored, text_runs

SHINGLE = 5
SLOTS, KEYED, CHUNK = 512, 64, 4
CHUNKS = KEYED // CHUNK
BITS = 4
PLANES = SLOTS // 64 * BITS  # longs of a signature: of every 64 slots one long for each bit
MOST_DIFFERING = 162
PIVOTS = 16
SIMILAR = (75, 100)

_draw = np.random.default_rng(20240229)
_XOR = _draw.integers(0, 1 << 63, KEYED, dtype=np.uint64)
_ODD = _draw.integers(0, 1 << 63, KEYED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# The slots without keys are told by 4 bits only, so 32-bit hashes do.
_XOR_MORE = _draw.integers(0, 1 << 32, SLOTS - KEYED, dtype=np.uint32)
_ODD_MORE = _draw.integers(0, 1 << 31, SLOTS - KEYED, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACE = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(found: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin."""
    h, first = found.hashes, found.first
    counts = np.diff(first)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(shingles)])
    text = np.repeat(np.arange(len(counts)), shingles)
    at = np.arange(starts[-1]) - starts[text] + first[text]
    value = np.zeros(len(at), dtype=np.uint64)
    left = np.minimum(counts, size)[text]
    for j in range(size):
        inside = left > j
        if inside.all():
            value += (h[at + j] if j else h[at]) * _PLACE[j]
        else:
            value[inside] += h[at[inside] + j] * _PLACE[j]
    value = mix(value ^ left.astype(np.uint64))
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        value[a:b].sort()
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    sizes = np.bincount(text[fresh], minlength=len(counts))
    return value[fresh], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _node(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each set."""
    return segments(mix(sets ^ _XOR[0]), first, np.add) + mix(np.diff(first).astype(np.uint64))


SKETCH = "row long, doc_id long, n_shingles long, node long, sketch array<long>, keys array<long>"


def _sketches(batches):
    """For each text: size and hash of its set, 4 bits per slot as longs, and its keys."""
    masks = [[i for i in range(CHUNK) if i != hole] for hole in range(CHUNK)]
    for batch in batches:
        for lo, hi, data, offsets in text_runs(batch.column("text"), RUN_BYTES):
            sets, first = shingle_sets(Words(data, offsets))
            n = np.diff(first)
            node = _node(sets, first)
            slots = np.zeros((hi - lo, SLOTS), dtype=np.uint64)
            for k in range(KEYED):
                slots[:, k] = segments((sets ^ _XOR[k]) * _ODD[k], first, np.minimum)
            short = sets.astype(np.uint32)
            for k in range(SLOTS - KEYED):
                slots[:, KEYED + k] = segments((short ^ _XOR_MORE[k]) * _ODD_MORE[k], first, np.minimum)
            slots = mix(slots)
            half = (slots >> np.uint64(64 - BITS)).astype(np.uint8)
            bits = np.hstack([np.packbits(half >> bit & 1, axis=1).view("<i8") for bit in range(BITS)])
            keys = np.zeros((hi - lo, KEYED), dtype=np.uint64)
            for c in range(CHUNKS):
                for hole, kept in enumerate(masks):
                    k = c * CHUNK + hole
                    a, b, d = (slots[:, c * CHUNK + i] for i in kept)
                    keys[:, k] = mix(a * _ODD[0] + b * _ODD[1] + d * _ODD[2] + _XOR[k])
            full = n > 0
            row, ids = (batch.column(c).slice(lo, hi - lo) for c in ("row", "doc_id"))
            yield pa.RecordBatch.from_arrays(
                [
                    row,
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(signed(node), mask=~full),
                    _lists(bits, full),
                    _lists(signed(keys.ravel()).reshape(-1, KEYED), full),
                ],
                names=["row", "doc_id", "n_shingles", "node", "sketch", "keys"],
            )


def _lists(rows: np.ndarray, full: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.where(full, rows.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows[full]).ravel(), pa.int64()))


def row_key() -> Column:
    """Tells rows apart by id and text; a NULL id is an id like others."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def sketches(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(_sketches), SKETCH)


def _full_sets(batches):
    for batch in batches:
        for lo, hi, data, offsets in text_runs(batch.column("text"), RUN_BYTES):
            sets, first = shingle_sets(Words(data, offsets))
            own = pa.array(signed(_node(sets, first)))
            yield pa.RecordBatch.from_arrays(
                [pc.if_else(pc.equal(own, batch.column("node").slice(lo, hi - lo)), own, None), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(signed(sets)))],
                names=["node", "shingles"],
            )


def flat(frame: DataFrame, prefix: str = "") -> DataFrame:
    """The frame with a column that is never NULL for each long of the sketch: a join compares these in compiled code."""
    planes = [F.coalesce(F.get("sketch", F.lit(k)), F.lit(0)).alias(f"s{k}") for k in range(PLANES)]
    out = frame.select(*[c for c in frame.columns if c != "sketch"], *planes)
    return out.toDF(*[prefix + c for c in out.columns])


def differing(prefix: str) -> Column:
    """Slots in which two flat sketches differ in any bit, the other's columns with a prefix. Each column is used once."""
    total = F.lit(0)
    for k in range(SLOTS // 64):
        some = None
        for plane in range(k, PLANES, SLOTS // 64):
            x = F.col(f"s{plane}").bitwiseXOR(F.col(f"{prefix}s{plane}"))
            some = x if some is None else some.bitwiseOR(x)
        total = total + F.bit_count(some)
    return total


class NearDuplicates:
    """The steps over one table; each result that is read twice is a written table."""

    def __init__(self, spark: SparkSession, docs: DataFrame, similar: tuple[int, int] = SIMILAR):
        self.spark, self.docs, self.similar = spark, docs, similar
        self.rows = stored(spark, sketches(docs), "sketches")
        full = self.rows.where("n_shingles > 0")
        # Equal sets: one class, held by its first document. A class of many copies is one row per task before the shuffle.
        self.classes = stored(
            spark,
            full.groupBy("node").agg(
                F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n"), F.any_value("sketch").alias("sketch")
            ),
            "classes",
        )

    def buckets(self) -> DataFrame:
        """(key, node, n, sketch, hub) of the classes in buckets of two or more; hub: members it meets in all its buckets."""
        keyed = self.rows.where("n_shingles > 0").groupBy("node").agg(F.any_value("keys").alias("keys"))
        keyed = keyed.select("node", F.explode("keys").alias("key"))
        shared = keyed.groupBy("key").agg(F.count("*").alias("met")).where("met > 1")
        members = keyed.join(shared, "key")
        hubs = members.groupBy("node").agg(F.sum("met").alias("hub"))
        return members.drop("met").join(self.classes.join(hubs, "node").select("node", "n", "sketch", "hub"), "node")

    def may_link(self, prefix: str) -> Column:
        """Of rows of two flat frames, the other's columns with a prefix."""
        part, whole = self.similar
        n1, n2 = F.col("n"), F.col(prefix + "n")
        return (n1 * whole >= n2 * part) & (n2 * whole >= n1 * part) & (differing(prefix) <= MOST_DIFFERING)

    def pivot_pairs(self, members: DataFrame) -> DataFrame:
        """Each member of a bucket with the member that meets most others, and with one
        drawn by hash; the draw depends on the key, so members meet several pivots."""
        one = F.struct("node", "n", "sketch")
        drawn = F.xxhash64("node", F.pmod("key", F.lit(PIVOTS)))
        lead = members.groupBy("key").agg(F.max_by(one, F.struct("hub", "node")).alias("h"), F.min_by(one, F.struct(drawn, "node")).alias("d"))
        both = F.explode(F.array_distinct(F.array("h", "d")))
        lead = flat(lead.select("key", both.alias("p")).select("key", "p.*"), "p_")
        ok = (F.col("node") != F.col("p_node")) & self.may_link("p_")
        pairs = flat(members.drop("hub")).join(lead, (F.col("key") == F.col("p_key")) & ok)
        return pairs.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()

    def open_pairs(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs within a bucket whose ends are not known to be connected, each at the first key it shares."""
        named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
        open_keys = named.select("key", "node", "n", "sketch", "root").join(split, "key")
        # Shared keys are told by 32 bits here: 64 short keys a row.
        own = open_keys.groupBy("node").agg(F.sort_array(F.collect_list(F.col("key").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))).alias("own"))
        open_rows = stored(self.spark, open_keys.join(own, "node"), "open")
        left, right = flat(open_rows, "l_"), flat(open_rows)
        ok = (F.col("l_root") < F.col("root")) & self.may_link("l_")
        first = F.get(F.array_intersect("l_own", "own"), 0) == F.col("key").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
        met = left.join(right, (F.col("l_key") == F.col("key")) & ok & first)
        return met.select(F.least("l_node", "node").alias("a"), F.greatest("l_node", "node").alias("b")).distinct()

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        pairs = stored(self.spark, pairs, "pairs")
        nodes = stored(self.spark, pairs.select("a").union(pairs.select("b")).distinct().toDF("node"), "nodes")
        holders = stored(
            self.spark, self.classes.join(nodes, "node", "left_semi").select("node", F.col("first_id").alias("holder")), "holders"
        )
        count = holders.count()
        if not count:
            return pairs
        texts = self.docs.select(F.col("doc_id").cast("long").alias("text_id"), "text")
        texts = texts.join(small_side(holders, count), F.col("text_id").eqNullSafe(F.col("holder"))).select("node", "text")
        sets = texts.mapInArrow(lean(_full_sets), "node long, shingles array<long>")
        # An id may stand for several texts: only the set that hashes to the class is its set.
        sets = stored(self.spark, sets.groupBy("node").agg(F.any_value("shingles").alias("shingles")).where("node IS NOT NULL"), "sets")
        both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        part, whole = self.similar
        return both.where(whole * common >= part * (F.size("sa") + F.size("sb") - common)).select("a", "b")

    def labels(self) -> DataFrame:
        """(node, root, component): the group of linked classes, and the smallest doc_id in it."""
        members = stored(self.spark, self.buckets(), "members")
        links = stored(self.spark, self.confirmed(self.pivot_pairs(members)), "links")
        # One row a class from here on, however many pivots it met.
        near = stored(self.spark, components(self.spark, links), "near")
        more = self.confirmed(self.open_pairs(members, near))
        roots = components(self.spark, near.toDF("a", "b").union(more))
        named = self.classes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        smallest = named.groupBy("root").agg(F.min("first_id").alias("component"))
        return named.join(smallest, "root").select("node", "root", "component")

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept for each document."""
        own = self.rows.select("doc_id", "n_shingles", "node")
        named = own.join(self.labels().drop("root"), "node", "left")
        component = F.coalesce("component", "doc_id")
        return named.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op3(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return NearDuplicates(spark, docs).result()


@same_columns
def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: the smallest doc_id's (NULL last), whatever ids its
    rows share with others. Rows without words all stay."""
    found = NearDuplicates(spark, docs)
    rows = stored(spark, found.rows.where("node IS NOT NULL").join(found.labels(), "node").select("row", "doc_id", "root"), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = rows.groupBy("root").agg(F.min(place)["row"].alias("keep"), F.count("*").alias("n")).where("n > 1")
    drop = stored(spark, rows.join(groups, "root").where("row <> keep").select(F.col("row").alias("_row")).distinct(), "dropped")
    copies = stored(spark, rows.groupBy(F.col("row").alias("_row")).agg(F.count("*").alias("n")).where("n > 1").select("_row"), "copies")
    left = docs.withColumn("_row", row_key()).join(small_side(drop), "_row", "left_anti")
    copies = small_side(copies)
    once = left.join(copies, "_row", "left_anti").select(*docs.columns)
    # Of rows that repeat id and text, the one that is first by all columns.
    one = left.join(copies, "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*docs.columns)).alias("one"))
    return once.unionByName(one.select("one.*"))


SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""
