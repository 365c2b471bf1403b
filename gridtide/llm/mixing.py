"""Mixing sources to target weights.

Sizes are summed per source, each source gets a target by weight, and a document
is taken floor(rate) times plus once more with the probability of the fraction,
by a hash of its id and the seed, so reruns and retried tasks agree.

Defined cases: a NULL text has size 0; a NULL source is a source of its own, the
last one; a source of size 0 has target 0 and is not taken; rows that repeat an id
are taken alike. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import BLANKS, BLANK_RUN, same_columns, stored

# Fixed values of the mix: weights in the order of the sources, and how often a
# source may be repeated at most.
WEIGHTS = (5, 2, 1)
MOST = 3


def n_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) with its target; one row per source.

    Shares by weight stop at ``most`` times a source's size, and the excess goes to
    the others by weight. In the order of room per weight the stopped sources are a
    prefix: a source is stopped if what is left for it and all after it would give
    it more than its room. That is the end of resharing again and again. The
    windows run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    fill = W.orderBy(F.col("room") / F.col("weight"), F.col("place"))
    after = fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    ahead = fill.rowsBetween(W.unboundedPreceding, W.currentRow)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("room", F.col("source_size") * float(most))
        .withColumn("left", F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("each", F.col("left") / F.sum("weight").over(after))
        .withColumn("stopped", F.min((F.col("each") * F.col("weight") > F.col("room")).cast("int")).over(ahead) == 1)
        .withColumn("level", F.max(F.when(~F.col("stopped"), F.struct(-F.col("room") / F.col("weight"), -F.col("place"), "each"))).over(W.partitionBy())["each"])
        .withColumn("target", F.when(F.col("stopped"), F.col("room")).otherwise(F.least("room", F.col("level") * F.col("weight"))))
        .select("source", "source_size", "target")
    )


def coin(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) by 52 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def copies(rate: Column, doc_id: Column, seed: int = 0) -> Column:
    whole = F.floor(rate)
    return whole + (coin(doc_id, seed) < rate - whole).cast("long")


def plan(spark: SparkSession, docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for each document.

    One pass over the texts counts the words; the narrow result is written, since
    it is read for the sums and again for the rates. The table of sources is
    joined NULL-safe; a source with a third of all rows is pre-aggregated in each
    task before its one row moves.
    """
    sized = stored(spark, docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sums).withColumnRenamed("source", "goal_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source")), "left")
        .select("doc_id", "source", "size", "source_size", "target", copies(rate, F.col("doc_id"), seed).alias("copies"))
    )


@same_columns
def mixed(spark: SparkSession, docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of the mix, all columns kept, each document as often as it is taken.

    The rates of the sources join the documents directly, and the coin is a
    function of the id, so texts are never shuffled for it.
    """
    sums = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    goal = stored(spark, targets(sums), "targets")
    rates = goal.select(
        F.col("source").alias("_goal_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_rate"),
    )
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("_goal_source")), "left")
    times = F.when(F.col("_rate") > 0, copies(F.col("_rate"), F.col("doc_id"), seed)).otherwise(F.lit(0))
    repeated = F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>"))
    return joined.withColumn("_copy", F.explode(repeated)).select(*docs.columns)


def op9(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return plan(spark, docs).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * F.col("copies")).alias("taken")
    )


SQL = """
WITH d AS (SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS room FROM p),
l AS (SELECT *, (sum(source_size) OVER ())::DOUBLE - coalesce(sum(room) OVER (ORDER BY room / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
  sum(weight) OVER (ORDER BY room / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
e AS (SELECT *, left_over / rest AS each FROM l),
f AS (SELECT *, min(CAST(each * weight > room AS INT)) OVER (ORDER BY room / weight, place) = 1 AS stopped FROM e),
g AS (SELECT *, (SELECT each FROM f WHERE NOT stopped ORDER BY room / weight, place LIMIT 1) AS level FROM f),
t AS (SELECT source, source_size, CASE WHEN stopped THEN room ELSE least(room, level * weight) END AS target FROM g),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 < rate - floor(rate) AS INT) AS BIGINT) AS taken
FROM r
"""
