"""Sinks and write modes: full load, keyed upserts, appends, ragged records (SNK-1 to SNK-9, AUD-3, AUD-4).

Parquet has no MERGE; an upsert is a new version of the table, and the version read is never the one written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.casts import INTEGER, NUMBER
from terrace.operators.dedup import dedup_latest
from terrace.sources.storage import stored


def full_load(df: DataFrame, path: str) -> DataFrame:
    """Replaces the table; running numbers begin anew."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def reload_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replaces the partitions that ``df`` has rows of, and leaves the files of all others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_snapshot(df: DataFrame, path: str, snapshot_ts: str) -> None:
    """Immutable archive: each snapshot is a partition of its own."""
    append(df.withColumn("snapshot_ts", F.lit(snapshot_ts)), path, ["snapshot_ts"])


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def upsert_update(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """Existing rows with ``columns`` overwritten where a row comes in, and the new rows.

    Of incoming rows with one key the first by ``order`` counts; null keys are equal.
    """
    columns = columns or [c for c in existing.columns if c not in keys]
    new = dedup_latest(incoming, keys, order).withColumn("_in", F.lit(True)).alias("n")
    old = existing.withColumn("_was", F.lit(True)).alias("o")
    joined = old.join(new, reduce(lambda x, y: x & y, (F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys)), "full_outer")
    arrived, was = F.col("n._in").isNotNull(), F.col("o._was").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.when(was, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        if c in columns and c in incoming.columns:
            return F.when(arrived, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        fresh = F.col(f"n.{c}") if c in incoming.columns else F.lit(None)
        return F.when(was, F.col(f"o.{c}")).otherwise(fresh)

    return joined.select(*(value(c).alias(c) for c in existing.columns))


def upsert_ignore(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Existing rows and those incoming ones whose key is new."""
    new = dedup_latest(incoming, keys, order)
    return existing.unionByName(new.join(existing, _same(new, existing, keys), "left_anti").select(*existing.columns))


def surrogate_key(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """Numbers 1, 2, ... in the order of ``order``, without one task that sees all rows.

    Rows are range partitioned; each partition numbers its own rows after the count of those before.
    The partitioned rows are stored, as a second computation might draw other bounds.
    """
    part, local = "_part", "_local"
    ranged = stored(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    numbered = ranged.withColumn(local, F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    sizes = numbered.groupBy(part).agg(F.max(local).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return numbered.join(before.select(part, "_before"), part).withColumn(name, F.col(local) + F.col("_before")).drop(part, local, "_before")


def ragged_columns(df: DataFrame, data: str = "data") -> list[str]:
    """Sorted union of the keys of a map column: as many as the table has distinct names."""
    return [r[0] for r in df.select(F.explode(F.map_keys(data)).alias("k")).distinct().orderBy("k").collect()]


def spread_ragged(df: DataFrame, base: list[str], data: str = "data") -> DataFrame:
    """Base columns, then one column for each key of the map."""
    return df.select(*base, *(F.try_element_at(data, F.lit(k)).alias(k) for k in ragged_columns(df, data)))


def ragged_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, sql_type) of text columns: INTEGER, REAL or TEXT, in one pass; columns of nulls are INTEGER."""
    checks = []
    for c in columns:
        x = F.col(c)
        checks.append(F.when(F.coalesce(F.bool_and(x.rlike(INTEGER)), F.lit(True)), "INTEGER").when(F.bool_and(x.rlike(NUMBER)), "REAL").otherwise("TEXT").alias(c))
    return df.agg(*checks).unpivot([], columns, "column_name", "sql_type")


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to what ``ragged_types`` found."""
    kinds = {"INTEGER": "bigint", "REAL": "double", "TEXT": "string"}
    return df.withColumns({c: F.col(c).try_cast(kinds[t]) for c, t in types.items()})
