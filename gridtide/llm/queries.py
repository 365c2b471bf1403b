"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    exact_dedup,
    line_dedup,
    lm,
    merkle,
    minhash,
    mixing,
    quality_rules,
    repair,
    repair_turns,
    toxicity,
    url_filter,
    vptree,
)
from .shared import ready, table

Run = Callable[[SparkSession, str], DataFrame]


def _over(name: str, run: Callable[[SparkSession, DataFrame], DataFrame]) -> Run:
    return lambda spark, sf_dir: run(ready(spark), table(spark, sf_dir, name))


QUERIES: dict[str, Run] = {
    "op1_quality_rules": _over("documents", quality_rules.op1),
    "op2_line_dedup": _over("documents", line_dedup.op2),
    "op3_minhash": _over("documents", minhash.op3),
    "op4_vp_trees": _over("embeddings", vptree.op4),
    "op5_url_filters": _over("pages", url_filter.op5),
    "op6_toxicity": lambda spark, sf_dir: toxicity.op6(ready(spark), table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op7_byte_bpe": _over("documents", bpe.op7),
    "op8_lm_scoring": _over("documents", lm.op8),
    "op9_mixing": _over("documents", mixing.op9),
    "op10_repair_shards": _over("documents", repair.op10),
    "op11_merkle_manifest": _over("documents", merkle.op11),
    "op12_exact_dedup": _over("documents", exact_dedup.op12),
    "op13_conversation_repair": _over("conversations", repair_turns.op13),
}

SQL: dict[str, str] = {
    "op3_minhash": minhash.SQL,
    "op4_vp_trees": vptree.SQL,
    "op5_url_filters": url_filter.SQL,
    "op9_mixing": mixing.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_exact_dedup": exact_dedup.SQL,
    "op13_conversation_repair": repair_turns.SQL,
}
