"""Valid rows and rejects with reasons in one pass (FLT-1, DQ-9, DQ-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def tag_rejects(df: DataFrame, rules: Sequence[Rule], name: str = "reject_reason") -> DataFrame:
    """Adds the reason of the first rule that a row breaks, null for valid rows.

    A rule is (reason, condition that must hold); a condition that is null counts as broken, so valid
    rows and rejects together are always the input.
    """
    reason = F.lit(None).cast("string")
    for text, holds in reversed(rules):
        reason = F.when(~F.coalesce(holds, F.lit(False)), text).otherwise(reason)
    return df.withColumn(name, reason)


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with reject_reason); each is a filter on one tagged plan."""
    tagged = tag_rejects(df, rules)
    return tagged.where("reject_reason IS NULL").drop("reject_reason"), tagged.where("reject_reason IS NOT NULL")


def reject_rate(tagged: DataFrame) -> DataFrame:
    """n_valid, n_rejects and the share of rejects."""
    bad = F.count_if(F.col("reject_reason").isNotNull())
    return tagged.agg((F.count("*") - bad).alias("n_valid"), bad.alias("n_rejects"), F.round(bad * 100 / F.nullif(F.count("*"), F.lit(0)), 4).cast("double").alias("reject_percent"))


def in_range(name: str, low: float, high: float) -> Rule:
    return f"{name} out of range", F.col(name).between(low, high)


def one_of(name: str, values: Sequence[str]) -> Rule:
    return f"{name} not allowed", F.col(name).isin(list(values))


def not_null(name: str) -> Rule:
    return f"{name} missing", F.col(name).isNotNull()


def key_present(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name).cast("string")) != "", F.lit(False))


def constraint_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(constraint_name, violations) of all rules in one pass over the table."""
    names = [f"c{k}" for k in range(len(rules))]
    counts = df.agg(*(F.count_if(~F.coalesce(holds, F.lit(False))).alias(n) for n, (_, holds) in zip(names, rules, strict=True)))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(text).alias("constraint_name"), F.col(n).alias("violations")) for n, (text, _) in zip(names, rules, strict=True)))).alias("r")).select("r.*")
