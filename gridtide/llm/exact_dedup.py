"""Exact dedup of batches against immutable snapshots, screened by binary-fuse filters.

Texts are equal if they are identical after deleting every blank (space and \\t to \\r); this is
the normalised text. Documents arrive in batches. The rows of a batch are first grouped among
themselves, by the SHA-256 of the normalised text. Each class of equal texts is one digest, and
its 64-bit key is looked up in the filters of all earlier snapshots: a filter never misses a
key that it holds and lets about 1 in 65,536 others pass. What passes joins the exact buckets of
the snapshot, the classes of that key, and the normalised texts of both sides are compared byte
by byte. Classes confirmed by their bytes belong to the class in the snapshot; all others are
new and become the next snapshot, which is written once and never changed.

A filter is static: keys are dealt to shards by hash, and each shard's filter is built in one
task from at most about SHARD_KEYS keys and stored as one row. Screening meets digests and
filter by shard; a batch much larger than the snapshot is cut into several parts a shard, each
with its own copy of the small filter. Digests are distinct after the grouping, so shards are
even whatever is repeated in the texts, and a group of copies with a third of all rows is one
row per task before its shuffle. Texts move only for the byte check, one for each side of a pair
of classes. Any earlier table is read again rather than recomputed.

Of a group the row with the most code points stays, ties by the smallest doc_id (NULL last);
of rows that agree in both exactly one stays. NULL texts count as empty, and all texts without
a character other than blanks are one group. NULL ids are ids like others. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BLANKS, mix, small_side, stored

BATCHES = 3
SHARD_KEYS = 1 << 16
KEY_BITS = 64
SEEDS = 64


# --- binary-fuse filters ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Fuse:
    """A binary-fuse filter of three slots a key, in consecutive segments, with 16-bit fingerprints."""

    seed: int
    segment: int
    prints: np.ndarray

    @staticmethod
    def hashes(keys: np.ndarray, seed: int) -> np.ndarray:
        return mix(keys + mix(np.array([seed + 1], dtype=np.uint64)))

    @staticmethod
    def slots(hashes: np.ndarray, segment: int, size: int) -> np.ndarray:
        """Three slots of each key: one anywhere but in the last two segments, and one in each of the next two."""
        starts = np.uint64(size - 2 * segment)
        first = ((hashes >> np.uint64(32)) * starts) >> np.uint64(32)
        inside = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((hashes >> np.uint64(16)) & inside)
        third = (first + np.uint64(2 * segment)) ^ (hashes & inside)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def fingerprint(hashes: np.ndarray) -> np.ndarray:
        return (mix(hashes) >> np.uint64(48)).astype(np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> Fuse:
        """The filter of some keys. Sizes are those that the published analysis of these filters gives.

        Slots with a single key are peeled round by round, all of a round at once: no two
        keys of a round meet in the slots they are peeled from.
        """
        keys = np.unique(keys.astype(np.uint64, copy=False))
        n = len(keys)
        wide = max(n, 2)
        segment = 1 << min(18, int(math.log(wide) / math.log(3.33) + 2.25))
        slack = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(wide))
        size = (max(1, math.ceil(n * slack / segment) - 2) + 2) * segment
        for seed in range(SEEDS):
            h = cls.hashes(keys, seed)
            at = cls.slots(h, segment, size)
            held = np.bincount(at.ravel(), minlength=size)
            total = np.bincount(at.ravel(), np.tile(np.arange(n), 3), size).astype(np.int64)
            rounds, peeled = [], 0
            single = np.flatnonzero(held == 1)
            while len(single):
                key, place = np.unique(total[single], return_index=True)
                rounds.append((key, single[place]))
                peeled += len(key)
                gone = at[:, key].ravel()
                np.subtract.at(held, gone, 1)
                np.subtract.at(total, gone, np.tile(key, 3))
                single = np.unique(gone[held[gone] == 1])
            if peeled == n:
                prints, own = np.zeros(size, dtype=np.uint16), cls.fingerprint(h)
                for key, slot in reversed(rounds):
                    a, b, c = prints[at[:, key]]
                    prints[slot] = own[key] ^ a ^ b ^ c
                return cls(seed, segment, prints)
        raise ValueError(f"no binary-fuse filter for {n} keys in {SEEDS} seeds")

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that are surely not held."""
        h = self.hashes(keys.astype(np.uint64, copy=False), self.seed)
        a, b, c = self.prints[self.slots(h, self.segment, len(self.prints))]
        return (a ^ b ^ c) == self.fingerprint(h)


def _keys(frame: pd.DataFrame) -> np.ndarray:
    return frame["key"].to_numpy(np.int64).view(np.uint64)


def _build(shard: tuple, classes: pd.DataFrame) -> pd.DataFrame:
    found = Fuse.of(_keys(classes))
    return pd.DataFrame({"shard": [shard[0]], "seed": [found.seed], "segment": [found.segment], "prints": [found.prints.astype("<u2").tobytes()]})


def _screen(digests: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(digests) or not len(filters):
        return digests.iloc[:0][["node", "key"]]
    row = filters.iloc[0]
    held = Fuse(int(row["seed"]), int(row["segment"]), np.frombuffer(row["prints"], "<u2"))
    return digests.loc[held.may_hold(_keys(digests)), ["node", "key"]]


# --- batches and snapshots -------------------------------------------------------------------------


def normalised(text: Column) -> Column:
    """The text without its blanks; NULL is empty."""
    return reduce(lambda left, blank: F.replace(left, F.lit(blank), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def classes_of(rows: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """(sha, n, best, node, key): one row per distinct normalised text; ``best`` is the row that
    stays, smallest first, and ``node`` that row's number."""
    best = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    grouped = rows.groupBy("sha").agg(F.count("*").alias("n"), F.min(best).alias("best"))
    key = F.xxhash64("sha") if bits == 64 else F.shiftrightunsigned(F.xxhash64("sha"), 64 - bits)
    return grouped.select("*", F.col("best.row").alias("node"), key.alias("key"))


class Snapshot:
    """Classes that are there for good, and the filters over their keys."""

    def __init__(self, spark: SparkSession, classes: DataFrame, shard_keys: int = SHARD_KEYS):
        self.spark, self.classes = spark, stored(spark, classes, "snapshot")
        self.size = self.classes.count()
        self.shards = max(1, math.ceil(self.size / shard_keys))
        self.shard_keys = shard_keys

    @cached_property
    def filters(self) -> DataFrame:
        """One filter a shard, built when the first batch asks."""
        dealt = self.classes.select("key", F.pmod("key", F.lit(self.shards)).alias("shard"))
        built = dealt.groupBy("shard").applyInPandas(_build, "shard long, seed int, segment int, prints binary")
        return stored(self.spark, built, "filters")

    def screened(self, digests: DataFrame, n: int) -> DataFrame:
        """(node, key) of the ``n`` digests that the filters let pass."""
        if not self.size or not n:
            return digests.select("node", "key").limit(0)
        parts = max(1, math.ceil(n / self.shards / self.shard_keys))
        dealt = digests.select("node", "key", F.pmod("key", F.lit(self.shards)).alias("shard"), F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part"))
        copies = self.filters.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(_screen, "node long, key long")


class ExactDedup:
    """The batches of one table, one after the other."""

    def __init__(self, spark: SparkSession, docs: DataFrame, batches: int = BATCHES, bits: int = KEY_BITS, shard_keys: int = SHARD_KEYS, whole: bool = False):
        self.spark, self.shard_keys = spark, shard_keys
        given = [F.struct(*docs.columns).alias("given")] if whole else []
        body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("chars"), normalised(F.col("text")).alias("body"), *given)
        sha = F.unhex(F.sha2("body", 256))
        batch = F.pmod(F.xxhash64("doc_id", "sha"), F.lit(batches))
        rows = body.withColumn("sha", sha).withColumn("batch", batch).withColumn("row", F.monotonically_increasing_id())
        self.rows = stored(spark, rows, "staged")
        self.batches, self.bits = batches, bits
        self.snapshots: list[Snapshot] = []
        self.links: list[DataFrame] = []
        self.arrived: list[DataFrame] = []

    def byte_equal(self, pairs: DataFrame) -> DataFrame:
        """The pairs (node, owner) of rows whose normalised texts are the same bytes."""
        pairs = stored(self.spark, pairs, "candidates")
        wanted = pairs.select(F.col("node").alias("row"), "owner", F.lit(True).alias("new"))
        wanted = wanted.union(pairs.select("owner", "owner", F.lit(False)).distinct())
        texts = self.rows.select("row", "body").join(small_side(wanted), "row")
        new = texts.where("new").select(F.col("row").alias("node"), "owner", "body")
        old = texts.where("NOT new").select("owner", F.col("body").alias("kept_body"))
        return new.join(old, "owner").where("body = kept_body").select("node", "owner")

    def take(self, rows: DataFrame) -> None:
        """One batch: group it, screen it, check what passes, keep the rest as a new snapshot."""
        fresh = stored(self.spark, classes_of(rows.drop("body"), self.bits), "batch")
        n = fresh.count()
        found = []
        for snapshot in self.snapshots:
            exact = snapshot.classes.select("key", F.col("node").alias("owner"))
            passed = stored(self.spark, snapshot.screened(fresh, n), "passed")
            pairs = exact.join(small_side(passed), "key").select("node", "owner")
            found.append(self.byte_equal(pairs))
        if found:
            links = stored(self.spark, reduce(DataFrame.union, found), "links")
            self.links.append(links)
            new = fresh.join(small_side(links.select("node")), "node", "left_anti").select(*fresh.columns)
        else:
            new = fresh
        self.arrived.append(fresh)
        self.snapshots.append(Snapshot(self.spark, new, self.shard_keys))

    def result(self) -> DataFrame:
        """Each row with its number, its digest, its group's size and the row that stays."""
        for k in range(self.batches):
            self.take(self.rows.where(F.col("batch") == k))
        classes = reduce(DataFrame.union, [c.withColumn("batch", F.lit(k).cast("long")) for k, c in enumerate(self.arrived)])
        if self.links:
            classes = classes.join(reduce(DataFrame.union, self.links), "node", "left")
        else:
            classes = classes.withColumn("owner", F.lit(None).cast("long"))
        classes = classes.withColumn("owner", F.coalesce("owner", "node"))
        groups = classes.groupBy("owner").agg(F.sum("n").alias("size"), F.min("best").alias("stays")).where("size > 1")
        named = stored(self.spark, classes.select("batch", "sha", "owner").join(groups, "owner").select("batch", "sha", "size", "stays"), "groups")
        rows = self.rows.drop("body", "chars").join(small_side(named), ["batch", "sha"], "left")
        alone = F.col("size").isNull()
        return rows.select(
            "row",
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            (alone | (F.col("stays.row") == F.col("row"))).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
            *[c for c in ("given",) if c in rows.columns],
        )


def op12(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row."""
    return ExactDedup(spark, docs, **options).result().drop("row")


def deduplicated(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    return ExactDedup(spark, docs, whole=True, **options).result().where("kept").select("given.*")


SQL = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body, length(coalesce(text, '')) AS chars FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
"""
