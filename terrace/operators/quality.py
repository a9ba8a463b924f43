"""Data-quality checks and logs as DataFrames (DQ-1 to DQ-11, AGG-4, AGG-5, AGG-10, SET-2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.text import duration_ms


def _row(table: str, check: str, failing: Column, total: Column, status: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), status.alias("status"), failing.cast("bigint").alias("n_failing"), total.cast("bigint").alias("n_total"))


def _pass(failing: Column) -> Column:
    return F.when(failing == 0, "PASS").otherwise("FAIL")


def completeness(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One check a column, all in one pass: it has no nulls."""
    counts = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"m{k}") for k, c in enumerate(columns)))
    rows = [_row(table, f"{c} not null", F.col(f"m{k}"), F.col("n"), _pass(F.col(f"m{k}"))) for k, c in enumerate(columns)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def coverage(df: DataFrame, table: str, column: str, warn_below: float = 0.25) -> DataFrame:
    """PASS without missing values, WARN below a share of them, else FAIL."""
    counts = df.agg(F.count("*").alias("n"), F.count_if(F.col(column).isNull()).alias("m"))
    status = F.when(F.col("m") == 0, "PASS").when(F.col("m") < F.col("n") * warn_below, "WARN").otherwise("FAIL")
    return counts.select(_row(table, f"{column} coverage", F.col("m"), F.col("n"), status).alias("r")).select("r.*")


def uniqueness(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Failing: keys that occur more than once."""
    counts = df.groupBy(*keys).count().agg(F.count("*").alias("n"), F.count_if(F.col("count") > 1).alias("m"))
    return counts.select(_row(table, f"{'+'.join(keys)} unique", F.col("m"), F.col("n"), _pass(F.col("m"))).alias("r")).select("r.*")


def referential(parent: DataFrame, child: DataFrame, table: str, parent_key: str, child_key: str) -> DataFrame:
    """Failing: parents without any child."""
    known = child.select(F.col(child_key).alias("_c")).distinct().withColumn("_has", F.lit(1))
    counts = parent.join(known, F.col(parent_key) == F.col("_c"), "left").agg(F.count("*").alias("n"), F.count_if(F.col("_has").isNull()).alias("m"))
    return counts.select(_row(table, f"{parent_key} has children", F.col("m"), F.col("n"), _pass(F.col("m"))).alias("r")).select("r.*")


def validity(df: DataFrame, table: str, name: str, holds: Column) -> DataFrame:
    counts = df.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(holds, F.lit(False))).alias("m"))
    return counts.select(_row(table, name, F.col("m"), F.col("n"), _pass(F.col("m"))).alias("r")).select("r.*")


def cap_guard(df: DataFrame, partition: str, cap: int) -> DataFrame:
    """(partition, n_rows, status): CAPPED where a partition has as many rows as a request may return."""
    return df.groupBy(partition).agg(F.count("*").alias("n_rows")).withColumn("status", F.when(F.col("n_rows") >= cap, "CAPPED").otherwise("OK"))


def expected_counts(df: DataFrame, level: str, expected: DataFrame) -> DataFrame:
    """expected (level, n_expected) with n_found and status."""
    found = df.groupBy(level).agg(F.count("*").alias("n_found"))
    n = F.coalesce("n_found", F.lit(0))
    return expected.join(found, level, "left").select(level, "n_expected", n.alias("n_found"), F.when(n == F.col("n_expected"), "OK").otherwise("DIFFERS").alias("status"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) over layers."""
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()))


def load_log(events: DataFrame) -> DataFrame:
    """State of each load from its start and end events (load_key, started_at or ended_at, status, n_rows, message).

    The latest start of a key counts, with the first end after it; without one the load is RUNNING.
    """
    begun = events.withColumn("_s", F.max("started_at").over(Window.partitionBy("load_key"))).where(F.col("_s").isNotNull())
    after = F.col("ended_at") >= F.col("_s")
    state = begun.groupBy("load_key", F.col("_s").alias("started_at")).agg(F.min(F.when(after, F.struct("ended_at", "status", "n_rows", "message"))).alias("v"))
    ms = duration_ms(F.col("started_at"), F.col("v.ended_at"))
    return state.select("load_key", "started_at", F.col("v.ended_at").alias("ended_at"), F.coalesce("v.status", F.lit("RUNNING")).alias("status"), F.col("v.n_rows").alias("n_rows"), F.col("v.message").alias("message"), ms.alias("duration_ms"))
