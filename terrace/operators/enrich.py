"""Joins that enrich: existence markers, lookups, name and name-prefix matches (JN-1 to JN-12, JN-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.text import name_key, normalize_name
from terrace.operators.dedup import first_by
from terrace.sources.storage import stored

#: Rows of one key that a task joins.
CROWD = 100_000


def mark_existing(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Adds whether the row's key is among ``keys`` (a left join to distinct keys)."""
    known = keys.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    return df.join(known, key, "left").withColumn(name, F.col("_known").isNotNull()).drop("_known")


def lookup(df: DataFrame, dim: DataFrame | None, key: str, columns: list[str]) -> DataFrame:
    """Attributes of a dimension, null where it, or the whole dimension, is missing; of rows of one key the least counts."""
    if dim is None:
        return df.withColumns({c: F.lit(None).cast("string") for c in columns})
    return df.join(first_by(dim.select(key, *columns), [key], columns), key, "left")


def full_series(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two series side by side, rows without key dropped."""
    return a.join(b, key, "full_outer").where(F.col(key).isNotNull())


def violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; null keys are no violation."""
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(known, F.col(child_key) == F.col("_parent"), "left_anti")


#: First letters of folded names that must agree, for names that have so many.
PREFIX = 4


def prefix_match(zones: DataFrame, places: DataFrame, zone_name: str, place_name: str, level: str, place_id: str) -> DataFrame:
    """zones with the place of their level whose folded name begins with theirs: shortest name, then least id; null without one.

    ``startswith`` alone would need a nested loop. Names of PREFIX letters join on these letters; shorter
    ones join on their own length, so none is lost. Wildcard marks in names mean themselves.
    """
    z = zones.withColumn("_z", normalize_name(F.col(zone_name))).withColumn("_at", F.col(level))
    names = z.where(F.col("_z") != "").select("_z", "_at").distinct().withColumn("_k", F.substring("_z", 1, PREFIX))
    p = places.select(F.col(level).alias("_level"), F.col(place_id).alias("matched_id"), F.col(place_name).alias("matched_name"), normalize_name(F.col(place_name)).alias("_p"))
    p = p.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(PREFIX)))).where(F.length("_p") >= F.col("_n")).withColumn("_pk", F.col("_p").substr(F.lit(1), F.col("_n")))
    met = names.join(p, (F.col("_at") == F.col("_level")) & (F.col("_k") == F.col("_pk")) & F.col("_p").startswith(F.col("_z")))
    best = met.groupBy("_z", "_at").agg(F.min(F.struct(F.length("_p").alias("_l"), "matched_id", "matched_name")).alias("_m"))
    return z.join(best, ["_z", "_at"], "left").select(*zones.columns, "_m.matched_id", "_m.matched_name")


def match_by_name(df: DataFrame, dim: DataFrame, name: str, dim_name: str, dim_id: str) -> DataFrame:
    """Exact match on folded names of any script: adds dim_id and reason: null, 'absent' or 'ambiguous' (the id is then null)."""
    known = dim.groupBy(name_key(F.col(dim_name)).alias("_k")).agg(F.min(dim_id).alias("_id"), F.count("*").alias("_n"))
    joined = df.withColumn("_f", name_key(F.col(name))).join(known, F.col("_f") == F.col("_k"), "left")
    reason = F.when(F.col("_n").isNull(), "absent").when(F.col("_n") > 1, "ambiguous")
    return joined.withColumn("reason", reason).withColumn(dim_id, F.when(F.col("_n") == 1, F.col("_id"))).drop("_f", "_k", "_id", "_n")


def enrich_with_root(measures: DataFrame, zones: DataFrame, root: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(measures with zone attributes, measures without a zone); the root zone is added to the zones.

    Measures of one code, as the root's, are dealt to several tasks by their exact count, and their zones go to each of them.
    """
    crowded = measures.groupBy(key).count().where(F.col("count") > CROWD).select(key, F.ceil(F.col("count") / CROWD).alias("_tasks"))
    crowded, tasks = stored(crowded, "crowded"), F.coalesce("_tasks", F.lit(1).cast("bigint"))
    own = [c for c, kind in measures.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = measures.join(crowded, key, "left").withColumn("_task", F.pmod(F.xxhash64(*own), tasks)).drop("_tasks")
    every = zones.unionByName(root).join(crowded, key, "left").withColumn("_task", F.explode(F.sequence(F.lit(0).cast("bigint"), tasks - 1))).drop("_tasks")
    return dealt.join(every, [key, "_task"]).drop("_task"), dealt.join(every, [key, "_task"], "left_anti").drop("_task")


def work_grid(*frames: DataFrame, key: str = "work_key") -> DataFrame:
    """All combinations of a few small lists, keyed by their values. The product is the feature here."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, F.lit(True))
    return out.withColumn(key, F.concat_ws("|", *(F.col(c).cast("string") for c in out.columns)))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
