"""Named expectations on rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules every raw reading has to meet.
READING_RULES = {
    "Rule1": "startTime IS NOT NULL",
    "Rule2": "endTime IS NOT NULL",
}


def passes(rule: str) -> Column:
    """Verdict of one rule; an unknown (NULL) verdict counts as failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_all_or_drop(frame: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Keep the rows that pass every rule."""
    if not rules:
        return frame
    return frame.where(reduce(Column.__and__, (passes(rule) for rule in rules.values())))


def rule_counts(rules: dict[str, str]) -> list[Column]:
    """One aggregate per rule, the number of rows failing it, and the total."""
    failed = [F.count_if(~passes(rule)).alias(f"failed_{name}") for name, rule in rules.items()]
    return [F.count(F.lit(1)).alias("total"), *failed]


def expectation_metrics(frame: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Per rule the rows that passed and failed, from one aggregation pass."""
    counts = frame.agg(*rule_counts(rules))
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                (F.col("total") - F.col(f"failed_{name}")).alias("passed"),
                F.col(f"failed_{name}").alias("failed"),
            )
            for name in rules
        ]
    )
    return counts.select(F.inline(entries))


def observed(frame: DataFrame, name: str, rules: dict[str, str]) -> DataFrame:
    """Same rows; the counts ride along with the pass that writes them."""
    return frame.observe(name, *rule_counts(rules))
