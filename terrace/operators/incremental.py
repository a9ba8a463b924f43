"""Change detection and resumable work (INC-1 to INC-6)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detect_changes(pages: DataFrame, state: DataFrame, key: str | list[str] = "url", content: str = "html") -> DataFrame:
    """(key, content_sha256, status): NEW where the content's hash isn't that of the last state, else UNCHANGED.

    ``state`` holds (key, content_sha256), one row a key; several columns may be the key. Missing content has no hash.
    """
    keys = [key] if isinstance(key, str) else key
    now = pages.select(*keys, F.sha2(F.col(content), 256).alias("content_sha256"))
    last = state.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("content_sha256").alias("_last"), F.lit(True).alias("_known"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    status = F.when(F.col("_known") & F.col("_last").eqNullSafe(F.col("content_sha256")), "UNCHANGED").otherwise("NEW")
    return now.join(last, same, "left").select(*keys, "content_sha256", status.alias("status"))


def last_state(runs: DataFrame, key: str, at: str) -> DataFrame:
    """The run of each key that came last; of equals the one with the greatest other columns."""
    rest = [c for c in runs.columns if c not in (key, at)]
    last = runs.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("_r"))
    return last.select(key, F.col(f"_r.{at}").alias(at), *(F.col(f"_r.{c}").alias(c) for c in rest))


def run_log(changes: DataFrame, errors: DataFrame, key: str, at: str) -> DataFrame:
    """Rows for an append-only log: NEW and UNCHANGED from the changes, ERROR from (key, error_message)."""
    ok = changes.select(key, "status", F.lit(None).cast("string").alias("error_message"))
    bad = errors.select(key, F.lit("ERROR").alias("status"), "error_message")
    return ok.unionByName(bad).withColumn("scraped_at", F.lit(at))


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Units of work whose key isn't done; null keys stay."""
    return work.join(done.select(key).distinct(), key, "left_anti")
