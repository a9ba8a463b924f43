"""Operator 8: token ids as Parquet list columns.

Documents are put in ascending id order by a range partitioning of their texts, encoded, and
written one row each: id, n_tokens, first (ids before it in its file set), shard and the list of
ids. The writer is told the encoding of the ids (dictionary, or delta in version 2 pages), the size
of row groups and pages; it adds column and offset indexes, so readers of a few documents fetch a few
pages and readers of metadata alone never touch the ids.

Defined results: a null text is an empty one, whose only id is the end id; equal ids are ordered
by text; an empty table gives an empty store; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import new_path
from terrace.llm.tokens import encoder, text_blocks

#: Bytes of input that make a shard where there are more of them than shuffle partitions; shards at most, one number of each goes to the driver.
SHARD_BYTES, MOST_SHARDS = 64 << 20, 100_000
SCHEMA = "doc_id long, n_tokens long, first long, shard int, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10) -> None:
    """Writes the token ids of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    ``encoding`` of the ids: "dictionary" or "delta".
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, done = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer)
        for batch in (x for b in batches for x in text_blocks(b, "text", 4 << 20)):
            ids, begin = encode(batch.column(1))
            whole = np.insert(ids, begin[1:], end_id).astype(np.int32)
            begin = (begin + np.arange(len(begin))).astype(np.int32)
            n = batch.num_rows
            lists = pa.ListArray.from_arrays(pa.array(begin), pa.array(whole))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(begin), pa.int64()), pa.array(done + begin[:-1].astype(np.int64)), pa.array(np.full(n, shard, np.int32)), lists], ["doc_id", "n_tokens", "first", "shard", "ids"])
            done += int(begin[-1])

    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = int(str(ordered._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // SHARD_BYTES, MOST_SHARDS))
    ordered = ordered.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    options = {"compression": "zstd", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.enable.dictionary": "true"}
    if encoding == "delta":
        options |= {"parquet.writer.version": "v2", "parquet.enable.dictionary#ids.list.element": "false"}
    elif encoding != "dictionary":
        raise ValueError(f"unknown encoding {encoding!r}")
    ordered.mapInArrow(rows, SCHEMA).write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The store's rows, with ``start``: ids of all documents before each.

    The driver gets one number a shard, from the metadata columns alone.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    sizes = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    before = [0]
    for shard in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(shard, 0))
    # a literal of one number a shard: a join would shuffle the ids
    return rows.select("doc_id", (F.get(F.lit(before).cast("array<bigint>"), F.col("shard")) + F.col("first")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the rows of a store, n_tokens and the checksum from the ids as read."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = np.asarray(lists.offsets)
            data = memoryview(np.asarray(lists.flatten()).astype("<u4")).cast("B") if ends[-1] > ends[0] else memoryview(b"")
            at = (4 * (ends - ends[0])).tolist()
            crc = [zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_and_check(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents' ids to the shared folder and returns what is read back of them."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return checksums(read_tokens(docs.sparkSession, path))
