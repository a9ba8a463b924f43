"""Sources: all-text CSV, directories of it, GeoJSON, run logs, raw pages (SRC-1 to SRC-6)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.storage import stored


def _text(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_csv(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """Every column text, by position whatever the header says, so no row is lost at load; empty cells are null."""
    return spark.read.schema(_text(columns)).csv(path, header=True, enforceSchema=True, multiLine=True, escape='"', encoding="UTF-8")


def read_many_text_csv(spark: SparkSession, paths: list[str], columns: list[str], tag: str = "_source_file") -> DataFrame:
    """Files of one shape in one table, with the path of each row's file."""
    return read_text_csv(spark, paths, columns).withColumn(tag, F.col("_metadata.file_path"))


def read_theme_directory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files whose columns differ, united by name; absent columns are null. Paths are few: one for each theme."""
    frames = [spark.read.csv(p, header=True, multiLine=True, escape='"', inferSchema=False) for p in sorted(paths)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


GEOJSON = "type string, features array<struct<type:string, properties:map<string,string>, geometry:string>>"


def geojson_rows(collections: DataFrame, text: str, name_field: str, id_field: str, level: int, label: str) -> DataFrame:
    """One row for each feature of the collections in column ``text``; geometry stays JSON text."""
    feature = F.explode(F.from_json(F.col(text), GEOJSON)["features"])
    return collections.select(feature.alias("f")).select(
        F.try_element_at("f.properties", F.lit(id_field)).alias("osm_id"),
        F.try_element_at("f.properties", F.lit(name_field)).alias("name"),
        F.lit(level).alias("admin_level"),
        F.lit(label).alias("level_label"),
        F.col("f.geometry").alias("geojson_geom"),
    )


def read_geojson(spark: SparkSession, path: str, name_field: str, id_field: str, level: int, label: str) -> DataFrame:
    """The features of a folder of collections, one collection a file."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return geojson_rows(files, "value", name_field, id_field, level, label)


RUN_LOG = "dataset_key string, source_url string, file_name string, file_sha256 string, file_size_bytes bigint, http_status int, status string, n_rows bigint, error_message string, scraped_at string"


def read_run_log(spark: SparkSession, path: str, schema: str = RUN_LOG) -> DataFrame:
    """JSON lines of crawl runs."""
    return spark.read.schema(schema).json(path)


def read_json_kept(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``schema``, rejects) of JSON lines: rejects are the lines that don't parse, whole, with their file and a reason.

    Valid rows and rejects together are all lines but blank ones. A torn line would otherwise be a row of nulls.
    """
    kept = T.StructType.fromDDL(schema).add("_corrupt", T.StringType())
    lines = spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("_source_file", F.col("_metadata.file_path"))
    lines = stored(lines, "lines")  # parsed once for both
    torn = F.col("_corrupt").isNotNull()
    rejects = lines.where(torn).select(F.col("_corrupt").alias("line"), "_source_file", F.lit("ligne illisible").alias("reject_reason"))
    return lines.where(~torn).drop("_corrupt"), rejects


def read_csv_kept(spark: SparkSession, path: str | list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """As ``read_text_csv``, and the records with another number of cells as rejects, whole, with their file and a reason."""
    shape = _text([*columns, "_corrupt"])
    rows = spark.read.schema(shape).csv(path, header=True, enforceSchema=True, multiLine=True, escape='"', encoding="UTF-8", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt").withColumn("_source_file", F.col("_metadata.file_path"))
    rows = stored(rows, "records")
    torn = F.col("_corrupt").isNotNull()
    return rows.where(~torn).drop("_corrupt"), rows.where(torn).select(F.col("_corrupt").alias("line"), "_source_file", F.lit("nombre de colonnes inattendu").alias("reject_reason"))


def read_region(spark: SparkSession, path: str, schema: str, column: str, prefix: str) -> DataFrame:
    """The rows of a partitioned table whose partition begins with ``prefix``; other partitions' files aren't opened."""
    return spark.read.schema(schema).parquet(path).where(F.col(column).startswith(prefix))


def list_raw_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and what identifies a page's content."""
    return pages.select("page_id", "url", "html", F.sha2(F.coalesce("html", F.lit("")), 256).alias("content_sha256"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size_bytes"))


def new_batch_id() -> str:
    """One id for all rows of a run."""
    return str(uuid.uuid4())


def with_audit(df: DataFrame, batch_id: str, source: str | Column, at: Column | None = None) -> DataFrame:
    """Audit columns: one batch id for the run, the source, the time of ingest (AUD-1)."""
    return df.withColumns({"_ingested_at": F.current_timestamp() if at is None else at, "_batch_id": F.lit(batch_id), "_source_file": F.lit(source) if isinstance(source, str) else source})


def carry_batch(df: DataFrame) -> DataFrame:
    """Lineage of a silver row: the bronze batch it came from (AUD-2)."""
    return df.withColumnRenamed("_batch_id", "_bronze_batch_id").drop("_ingested_at", "_source_file")
