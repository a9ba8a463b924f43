"""Deterministic deduplication (AGG-7 to AGG-9, WIN-1, WIN-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be total for a fixed result.

    Spark limits each task to the first rows of its keys before the shuffle, so a hot key sends few rows.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", first).where(F.col("_place") == 1).drop("_place")


def first_by(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The row of each key that comes first, by partial aggregation; keys, then the other columns."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*position)).alias("_r"))
    return picked.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
