"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends.

    The cluster names the folder in ``spark.checkpoint.dir``; where that is unset, as in tests, one
    under the warehouse stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: one computation for several consumers, none repeated if an executor is lost."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
