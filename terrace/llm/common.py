"""Helpers shared by the operators of this subpackage: table access, shared storage, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the data set at ``sf_dir``, read by Spark from whatever store that is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df``, a plain scan, dealt out to all cores where its files make fewer partitions than there are cores.

    Large tables have more partitions than cores and aren't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset, as in tests, a folder
    under the warehouse stands in for it.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


#: Rows that Spark hands to a Python worker at a time: of texts, some megabytes.
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS, which bounds what the JVM and the workers hold of long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


#: Whether shuffle files go as soon as the query that made them has ended; else they stay until the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The stored frames, and where they lie, of the innermost ``passing``.
_passing: ContextVar[dict[DataFrame, str] | None] = ContextVar("_passing", default=None)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs no recomputation of what lies before, and several
    consumers share one computation.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = new_path(spark, label)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")  # nothing else reads this query's shuffles
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(path)
    if (within := _passing.get()) is not None:
        within[out] = path
    return out


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes at its end what ``stored`` wrote meanwhile, but for the stored frames that the function given is called with.

    So what is kept must be stored itself; a frame that would still read others can't be.
    """
    outer, own = _passing.get(), {}

    def keep(df: DataFrame) -> DataFrame:
        path = own.pop(df)
        if outer is not None:
            outer[df] = path
        return df

    token = _passing.set(own)
    try:
        yield keep
    finally:
        _passing.reset(token)
        for path in own.values():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, beginning with ``name``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Ids that are sent to every executor at most; beyond it both sides of a join are shuffled.
SENT_IDS = 1 << 20


def _by_id(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    name = free_name(df, "_kept")
    ids = stored(ids.toDF(name).distinct(), "ids")
    few = ids.count() <= SENT_IDS
    return df.join(F.broadcast(ids) if few else ids, F.col(key).cast("long").eqNullSafe(F.col(name)), how)


def semi_join(df: DataFrame, kept: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose key, a number or null, is in the only column of ``kept``."""
    return _by_id(df, kept, key, "left_semi")


def anti_join(df: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose key, a number or null, isn't in the only column of ``dropped``."""
    return _by_id(df, dropped, key, "left_anti")


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that gives freed memory back, or one that does nothing."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def release() -> None:
    """Gives back what a worker has freed: workers outlive their tasks, and hold on to it otherwise."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def fresh() -> None:
    """Clears what the task before has left in a worker, as workers are used again."""
    gc.collect()
    release()


def binary_rows(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds what a task holds of long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
