"""Stream upsert: small repeated loads merged into a keyed table (STR-1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from terrace.operators.quarantine import Rule, tag_rejects
from terrace.sources.merged import MergedTable


def stream_upsert(spark: SparkSession, landing: str, schema: StructType, table: str, checkpoint: str, keys: list[str], version: str, rules: list[Rule] = (), read_format: str = "parquet", prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Merges all files that landed since the last call into ``table``, a table merged on read, and returns it.

    Each batch of the stream adds a run of its own rows. Files of one batch have no order: the row of a key with the greatest
    ``version`` column wins, and a row older than the table's doesn't replace it, but one of the same version does. Rejects are
    appended beside the table. A repeated batch is committed once; the stream is known by its checkpoint folder.
    Without any row yet the result is an empty table.
    """
    shape = prepare(spark.createDataFrame([], schema)).schema
    merged = MergedTable(spark, table, shape, keys, version)

    def merge(batch: DataFrame, number: int) -> None:
        tagged = tag_rejects(prepare(batch), rules)
        if rules:
            tagged = tagged.persist()
            tagged.where("reject_reason IS NOT NULL").write.mode("overwrite").parquet(f"{table}_rejects/batch={number:012d}")
        merged.merge(tagged.where("reject_reason IS NULL").drop("reject_reason"), number, checkpoint)
        tagged.unpersist()

    query = spark.readStream.schema(schema).format(read_format).load(landing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return merged.read()
