"""Merkle manifest of a dataset: leaf digests, one tree per source, a root over the sources, and a proof per row.

H is the lowercase hex SHA-256 of its inputs one after the other, digests as hex text. A row's
leaf is H of doc_id, source, lang, n_chars and text; a NULL is ``-``, any other value its count of
UTF-8 bytes, ``:`` and the value. Leaves of a source ascend by doc_id (NULL first, ties by leaf, so rows
that repeat are interchangeable). FAN consecutive nodes become their H until one is left; a
lone leaf is its own subroot. Subroots ascend by source (NULL first) and give the root likewise.

Ranks come without a global window: narrow leaves are range-partitioned, sorted and written
once; a row's number in its partition plus the counts of the partitions before it is its rank.
The base-16 digits of the rank name the path in the tree. Within a block of FAN ** DIGITS = 4,096
consecutive nodes the digits are grouped away one after the other, the last first: each grouping
nests its children as structs and adds their H. All of these groupings share one shuffle, by
block. A block's head is a node of the next table of blocks, until each tree is one block; a
table is 1/4,096 of the one below. Proofs go the other way: a block row meets the path above it
in one grouping on the block's key, without a join, and is unfolded digit by digit by transform
and explode, each child with its siblings to the left and right. So nothing is larger
than a block, and a source with a third of all rows is as many blocks as it needs.

Texts are read once, for the leaves. NULL columns, empty and very long texts are leaves as
others; an empty table has no rows and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_side, stored

FAN, DIGITS = 16, 3
BLOCK = FAN**DIGITS

# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    return digest(*[field(text if name == "text" else F.col(name)) for name in FIELDS])


def tampered(doc_id: Column) -> Column:
    """Rows whose text is tampered with, to try the proofs: 5 divides the CRC-32 of the id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, hash, altered): ``tree`` sorts like the source, NULL first; ``altered`` is the leaf of a tampered row."""
    lowered = F.translate("text", UPPER, LOWER_CASE)
    return docs.select(*FIELDS).select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(F.col("text")).alias("hash"),
        F.when(tampered(F.col("doc_id")) & F.col("text").isNotNull(), leaf_of(lowered)).alias("altered"),
    )


def ranked(spark: SparkSession, rows: DataFrame, *order: str) -> DataFrame:
    """Rows with ``pos``, their rank within ``tree`` by ``order``, and ``size``, the rows of the tree."""
    keys = ["tree", *order, "salt"]
    # Equal rows are told apart by a number, so that a run of them can be split between partitions.
    salted = stored(spark, rows.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    placed = salted.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    placed = stored(spark, placed.drop("salt").withColumn("at", F.monotonically_increasing_id()), "ordered")
    piece = F.shiftright("at", 33)
    # One row per partition and tree in it.
    counts = stored(spark, placed.groupBy("tree", piece.alias("piece")).agg(F.count("*").alias("n"), F.min("at").alias("first")), "pieces")
    before = "coalesce(sum(n) OVER (PARTITION BY tree ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    shifts = counts.selectExpr("tree", "piece", f"{before} - first AS shift", "sum(n) OVER (PARTITION BY tree) AS size")
    found = placed.withColumn("piece", piece).join(small_side(shifts, counts.count()), ["tree", "piece"])
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("piece", "shift", "at")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """(tree, block, size, hash, kids) from nodes (tree, pos, size, hash, own): digits grouped away, the last first."""
    digits = [F.pmod(F.call_function("div", F.col("pos"), F.lit(FAN**k)), F.lit(FAN)).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    block = F.call_function("div", F.col("pos"), F.lit(BLOCK)).alias("block")
    now = nodes.select("tree", block, "size", *digits, F.struct("hash", "own").alias("node")).repartition("tree", "block")
    for k in range(DIGITS):
        rest = [f"d{j}" for j in range(k + 1, DIGITS)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node.*"))).alias("kids")
        now = now.groupBy("tree", "block", "size", *rest).agg(kids)
        # A tree of at most FAN ** k nodes has ended below this level: its one node goes up as it is.
        joined = F.when(F.col("size") > FAN**k, digest(F.array_join("kids.hash", ""))).otherwise(F.col("kids")[0]["hash"])
        node = F.struct(joined.alias("hash"), "kids").alias("node")
        now = now.select("tree", "block", "size", *rest, node)
    return now.select("tree", "block", "size", "node.*")


def unfolded(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, pos, own, hash, path, tip) of the nodes in blocks, from (tree, block, path, tip) above them.

    ``path`` lists, from the node up, what stands left and right of it in its run; ``tip`` is passed on.
    """
    met = blocks.select("tree", "block", "size", "kids", F.lit(None).cast(above.schema["path"].dataType).alias("path"), F.lit(None).cast(above.schema["tip"].dataType).alias("tip"))
    tops = above.select("tree", "block", F.lit(None).cast("long").alias("size"), F.lit(None).cast(blocks.schema["kids"].dataType).alias("kids"), "path", "tip")
    one = [F.first(c, ignorenulls=True).alias(c) for c in ("size", "kids", "path", "tip")]
    now = met.unionByName(tops).groupBy("tree", "block").agg(*one).withColumn("at", F.col("block"))
    for k in reversed(range(DIGITS)):

        def placed(kid: Column, i: Column) -> Column:
            sides = [F.array_join(F.slice("kids.hash", F.lit(1), i), "").alias("l"), F.array_join(F.slice("kids.hash", i + 2, F.lit(FAN)), "").alias("r")]
            return F.struct(kid.alias("kid"), F.struct(*sides).alias("side"))

        now = now.select("tree", "size", "path", "tip", "at", F.explode(F.transform("kids", placed)).alias("e"))
        path = F.when(F.col("size") > FAN**k, F.concat(F.array("e.side"), "path")).otherwise(F.col("path"))
        inner = F.col("e.kid.kids") if k else F.lit(None)
        leaf = [F.col("e.kid.own").alias("own"), F.col("e.kid.hash").alias("hash")] if k == 0 else []
        now = now.select("tree", "size", path.alias("path"), "tip", (F.col("at") * FAN + F.col("e.kid.digit")).alias("at"), inner.alias("kids"), *leaf)
    return now.select("tree", F.col("at").alias("pos"), "own", "hash", "path", "tip")


@dataclass(frozen=True)
class Forest:
    """Tables of blocks, the nodes' own first; in the last one each tree is one block."""

    tables: list[DataFrame]

    @classmethod
    def of(cls, spark: SparkSession, nodes: DataFrame) -> Forest:
        tables = []
        while True:
            blocks = stored(spark, blocks_of(nodes), "blocks")
            tables.append(blocks)
            if blocks.where(F.col("size") > BLOCK).isEmpty():
                return cls(tables)
            heads = F.ceil(F.col("size") / BLOCK).cast("long").alias("size")
            nodes = blocks.select("tree", F.col("block").alias("pos"), heads, "hash", F.lit(None).cast("string").alias("own"))

    def tops(self) -> DataFrame:
        """(tree, hash): one row per tree."""
        return self.tables[-1].select("tree", "hash")

    def proofs(self, above: DataFrame) -> DataFrame:
        """``unfolded`` down to the nodes, from (tree, path, tip) above the trees."""
        rows = above.withColumn("block", F.lit(0).cast("long"))
        for blocks in reversed(self.tables):
            rows = unfolded(blocks, rows).withColumn("block", F.col("pos"))
        return rows.drop("block")


def folded(start: Column, path: Column) -> Column:
    """The top that a node and its path give."""
    return F.aggregate(path, start, lambda h, side: digest(side["l"], h, side["r"]))


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, leaf, altered, subroot, root, path for each row."""
    rows = ranked(spark, leaves(docs), "doc_id", "hash")
    trees = Forest.of(spark, rows.select("tree", "pos", "size", "hash", F.struct("doc_id", "altered").alias("own")))
    sources = trees.tops().select(F.lit("").alias("tree"), F.col("tree").alias("own"), "hash")
    top = Forest.of(spark, ranked(spark, sources, "own"))
    # The root's own path is empty; each source's path and subroot are what stands above its tree.
    none = F.array().cast(PATH)
    roots = top.tops().select("tree", none.alias("path"), F.struct(F.col("hash").alias("root")).alias("tip"))
    over = top.proofs(roots).select(F.col("own").alias("tree"), "path", F.struct("tip.root", F.col("hash").alias("subroot")).alias("tip"))
    return trees.proofs(over).select("own.doc_id", F.col("hash").alias("leaf"), "own.altered", "tip.subroot", "tip.root", "path")


def op11(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row; every fifth row or so is
    verified against a tampered text."""
    rows = manifest(spark, docs)
    siblings = F.array_join(F.transform("path", lambda side: F.concat(side["l"], side["r"])), "")
    refolded = folded(F.coalesce("altered", "leaf"), F.col("path"))
    out = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), refolded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql_crc32(text: str) -> str:
    """CRC-32 of the bytes of an ASCII text, bit by bit."""
    step = "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    octet = f"lambda a, b: list_reduce(list_transform(range(8), lambda x: x::UBIGINT), {step}, xor(a, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ord(x)::UBIGINT), {octet}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


def _sql_leaf(text: str) -> str:
    values = [text if name == "text" else f"CAST({name} AS VARCHAR)" for name in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


SQL = f"""
WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {_sql_leaf("text")} AS leaf,
    CASE WHEN {sql_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER_CASE}')")} END AS altered FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
t AS (SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM d UNION ALL
  SELECT tree, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM t WHERE n > 1 GROUP BY tree, lvl, pos // 16, n),
s AS (SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, h, n FROM s UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM u WHERE n > 1 GROUP BY lvl, pos // 16, n),
r AS (SELECT h AS root FROM u WHERE n = 1),
a AS (SELECT tree, lvl, pos, {{'l': coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
  'r': coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')}} AS side FROM t WHERE n > 1),
b AS (SELECT lvl, pos, {{'l': coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
  'r': coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')}} AS side FROM u WHERE n > 1),
p AS (SELECT d.tree, d.pos, list(a.side ORDER BY a.lvl) FILTER (a.lvl IS NOT NULL) AS low FROM d LEFT JOIN a ON a.tree = d.tree AND a.pos = d.pos // (16 ** a.lvl)::BIGINT GROUP BY d.tree, d.pos),
q AS (SELECT s.tree, s.h AS subroot, list(b.side ORDER BY b.lvl) FILTER (b.lvl IS NOT NULL) AS high FROM s LEFT JOIN b ON b.pos = s.pos // (16 ** b.lvl)::BIGINT GROUP BY s.tree, s.h),
w AS (SELECT doc_id, leaf, subroot, root, coalesce(altered, leaf) AS own, list_concat(coalesce(low, []), coalesce(high, [])) AS path
  FROM d JOIN p USING (tree, pos) JOIN q USING (tree) CROSS JOIN r),
x AS (SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda z: z.l || z.r), '')) AS proof_sha256,
  list_reduce(path, lambda m, z: {{'l': sha256(z.l || m.l || z.r), 'r': ''}}, {{'l': own, 'r': ''}}).l AS folded_root FROM w)
SELECT *, folded_root = root AS verified FROM x
"""
