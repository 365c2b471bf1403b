"""What several of these operators need: tables written on the way, checked
broadcasts, connected components, and word hashes of whole texts."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_path, pin, work_folder
from ..sources.tables import delete_folder

# The characters that end a word.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"

# Rows of a broadcast table; at some 50 bytes a row this stays far below what a
# driver and an executor hold. Beyond it the same join shuffles both sides.
BROADCAST_ROWS = 1_000_000


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Settings the results depend on; Python workers on this machine find the package where the driver has it
    (on a cluster it is installed or sent with ``--py-files``)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)
    return pin(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(spark: SparkSession, frame: DataFrame, purpose: str) -> tuple[str, DataFrame]:
    """Folder and frame of what is written. Its shuffles end with the write: else they stay on the executors'
    disks until the driver happens to collect its garbage, beside those of the steps after it."""
    path, schema = work_folder(spark, purpose), frame.schema
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return path, spark.read.schema(schema).parquet(path)


def stored(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read from there: what follows
    neither recomputes it nor depends on the executors that made it."""
    return _written(spark, frame, purpose)[1]


class Tables:
    """Tables written on the way, by purpose, that are deleted when their last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[tuple[str, str]] = []

    def stored(self, frame: DataFrame, purpose: str) -> DataFrame:
        path, found = _written(self.spark, frame, purpose)
        self.paths.append((purpose, path))
        return found

    def done(self, *purposes: str) -> None:
        """Delete the tables of these purposes, or all."""
        for purpose, path in list(self.paths):
            if not purposes or purpose in purposes:
                delete_folder(self.spark, path)
                self.paths.remove((purpose, path))


def same_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage that returns the columns it got. Its own names begin with ``_``, so columns of the
    documents that do are called otherwise while it runs."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, *args, **options) -> DataFrame:
        given = docs.columns
        if not any(name.startswith("_") for name in given):
            return stage(spark, docs, *args, **options)
        mark = "given"
        while any(name.startswith(mark) for name in given):
            mark += "_"
        aside = docs.toDF(*[f"{mark}{k}" if name.startswith("_") else name for k, name in enumerate(given)])
        return stage(spark, aside, *args, **options).select(*aside.columns).toDF(*given)

    return run


def small_side(frame: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` marked for broadcast if its counted rows are few; else as it is, for a shuffle join."""
    return F.broadcast(frame) if (frame.count() if rows is None else rows) <= limit else frame


def words(text: Column) -> Column:
    """Words of a text: runs of characters other than blanks. NULL: no words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps, so the number of rounds grows
    with the logarithm of the nodes. Each step groups with a partial minimum,
    and joins edges with one row per node, so that a node with a third of all
    edges is split like any skewed join side. Rounds are cut by written tables.
    NULLs and loops are no edges; without edges the result is empty.
    """
    ends = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    now = stored(spark, ends.where("lo < hi").distinct(), "edges")
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")), F.bit_xor(F.xxhash64("hi", "lo")))
    before, seen = None, now.agg(mark.alias("m")).first()["m"]
    while seen[0] and seen != before:
        both = now.union(now.select("hi", "lo")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stored(spark, root.toDF("hi", "lo").union(small).distinct().select("lo", "hi"), "edges")
        before, seen = seen, now.agg(mark.alias("m")).first()["m"]
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def least_within(links: DataFrame, steps: int) -> DataFrame:
    """(node, root): the smallest node within ``steps`` links of a node, in one job."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    for _ in range(steps - 1):
        least = both.join(least.toDF("v", "w"), "v").groupBy("u").agg(F.min(F.least("u", "w")).alias("m"))
    return least.toDF("node", "root")


# --- inside tasks: texts as bytes, words as 64-bit hashes ---------------------------------------


def lean(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A step over batches after which its worker, that stays for later stages, gives back the memory it freed."""

    def run(batches):
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return run


CHUNK_BYTES = 1 << 21
RUN_BYTES = 1 << 19  # of texts that one step looks at, where its arrays take many times that memory
PART_BYTES = 1 << 18  # of which words are told at once: the sums of their bytes fit a core's cache
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << (n - 1).bit_length(), 2 * PART_BYTES)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, factor in (("up", BASE), ("down", inverse)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


class Words:
    """Words of a run of texts: their hashes, byte spans, and the first word of each text.

    Hashes are of the bytes with A-Z in lower case, so equal words have equal
    hashes in every task. ``prefixes`` adds hashes of the first k bytes; ``folded``
    and ``blank`` are tables over bytes, for another folding and other separators; ``cut``
    tells the bytes at which a word is cut in two.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = (), folded=LOWER, blank=SPACE, cut=None):
        hashes, starts, ends, heads = [], [], [], []
        size, at = len(data), 0
        while at < size:
            to = min(at + PART_BYTES, size)
            if to < size:  # end at a blank or at the end of a text
                text_end = int(offsets[np.searchsorted(offsets, to)])
                gap = blank[data[to:text_end]]
                to = to + int(gap.argmax()) if gap.any() else text_end
            lo, hi = np.searchsorted(offsets, (at, to))
            part = self._part(data[at:to], offsets[lo:hi] - at, prefixes, folded, blank, cut)
            hashes.append(part[0])
            starts.append(part[1] + at)
            ends.append(part[2] + at)
            heads.append(part[3])
            at = to
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        self.hashes, self.starts, self.ends = join(hashes, np.uint64), join(starts, np.int64), join(ends, np.int64)
        self.prefixes = [join([h[k] for h in heads], np.uint64) for k in range(len(prefixes))]
        self.first = np.searchsorted(self.starts, offsets).astype(np.int64)

    @staticmethod
    def _part(data, cuts, prefixes, folded, blank, cut):
        low, word = folded[data], ~blank[data]
        start = word.copy()
        start[1:] &= ~word[:-1]
        if cut is not None:
            start |= cut(data)
        cuts = cuts[(cuts >= 0) & (cuts < len(data))]
        start[cuts] = word[cuts]
        end = np.zeros(len(data) + 1, dtype=bool)
        end[1:] = word
        end[1:-1] &= ~word[1:] | start[1:]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end)
        up, down = _tables(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        heads = [mix((total[np.minimum(starts + k, ends)] - total[starts]) * down[starts]) for k in prefixes]
        return mix((total[ends] - total[starts]) * down[starts]), starts, ends, heads


def text_runs(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) over a text column, about ``most`` bytes at a time; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        to = min(to, n)
        yield row, to, raw[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, a place of each, and for each place its number among them. ``np.unique``
    also looks for first places, which takes a stable sort."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(hashes), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def segments(values: np.ndarray, first: np.ndarray, how: np.ufunc, empty=0) -> np.ndarray:
    """``how`` over values[first[i]:first[i + 1]] for each i, also where that is empty."""
    counts = np.diff(first)
    out = np.full(len(counts), empty, dtype=values.dtype)
    full = counts > 0
    if full.any():
        out[full] = how.reduceat(values, first[:-1][full])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
