"""Logs that are kept: runs of loads, results of quality checks, counters that come with a write (DQ-6, DQ-8, DQ-11, FLT-5, AGG-12).

A log is a folder of Parquet files that is only ever appended to; each append is one file of its own, so writers don't
meet, and a reader sees a row wholly or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from terrace.operators.quality import load_log
from terrace.operators.quarantine import Rule, tag_rejects

RUNS = "run_id string, load_key string, started_at timestamp, ended_at timestamp, status string, n_rows long, message string"
CHECKS = "run_id string, checked_at timestamp, table_name string, check_name string, status string, n_failing long, n_total long"
#: Characters of an error's message that a log keeps.
MESSAGE = 1000


@dataclass
class Run:
    """What a load tells of itself while it runs."""

    run_id: str
    n_rows: int | None = None
    message: str | None = None


class RunLog:
    """Runs of loads: a row STARTED, then a row SUCCESS or FAILED; a run that was killed has the first alone."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, run: Run, load_key: str, started: datetime | None, ended: datetime | None, status: str) -> None:
        message = run.message[:MESSAGE] if run.message else None
        row = self.spark.createDataFrame([(run.run_id, load_key, started, ended, status, run.n_rows, message)], RUNS)
        row.coalesce(1).write.mode("append").parquet(self.path)

    @contextmanager
    def run(self, load_key: str) -> Iterator[Run]:
        """A run of ``load_key``; an exception is logged as FAILED and goes on."""
        run = Run(uuid.uuid4().hex)
        self._append(run, load_key, datetime.now(UTC), None, "STARTED")
        try:
            yield run
        except BaseException as error:
            run.message = f"{type(error).__name__}: {error}"
            self._append(run, load_key, None, datetime.now(UTC), "FAILED")
            raise
        self._append(run, load_key, None, datetime.now(UTC), "SUCCESS")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(self.path)

    def latest(self) -> DataFrame:
        """State of each load's latest run."""
        return load_log(self.rows())


class CheckLog:
    """Results of quality checks, run after run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, checks: DataFrame, run: Run, at: Column | None = None) -> None:
        """Appends the rows of ``checks`` (table_name, check_name, status, n_failing, n_total) under a run."""
        stamped = checks.select(F.lit(run.run_id).alias("run_id"), (F.current_timestamp() if at is None else at).alias("checked_at"), "table_name", "check_name", "status", "n_failing", "n_total")
        stamped.coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(CHECKS).parquet(self.path)

    def latest(self) -> DataFrame:
        """The last result of each check, and how often it was run and failed."""
        one = Window.partitionBy("table_name", "check_name")
        newest = F.row_number().over(one.orderBy(F.desc("checked_at"), F.desc("run_id")))
        counted = self.rows().withColumns({"_n": newest, "n_runs": F.count("*").over(one), "n_failed_runs": F.count_if(F.col("status") == "FAIL").over(one)})
        return counted.where("_n = 1").drop("_n")


def outcomes(tagged: DataFrame, column: str, names: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``tagged``, and an Observation of how many of its rows have each of ``names`` in ``column``.

    The numbers come with whatever action runs over the rows, without a job of their own.
    """
    seen = Observation()
    return tagged.observe(seen, *(F.count_if(F.col(column) == name).alias(f"n{k}") for k, name in enumerate(names))), seen


def counters(spark: SparkSession, seen: Observation, names: Sequence[str], column: str = "outcome") -> DataFrame:
    """(outcome, n) of an Observation by ``outcomes``, once an action has run."""
    told = seen.get
    return spark.createDataFrame([(name, told[f"n{k}"]) for k, name in enumerate(names)], f"{column} string, n long")


def write_split(df: DataFrame, rules: Sequence[Rule], path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(valid rows, rejects with reject_reason, rows by reason) of one job: both parts are written in one pass, and counted with it.

    The valid ones count under ''.
    """
    names = ["", *dict.fromkeys(text for text, _ in rules)]
    tagged = tag_rejects(df, rules).withColumn("_outcome", F.coalesce("reject_reason", F.lit("")))
    watched, seen = outcomes(tagged, "_outcome", names)
    schema = tagged.drop("_outcome").schema
    watched.withColumn("_rejected", F.col("reject_reason").isNotNull()).drop("_outcome").write.mode("overwrite").partitionBy("_rejected").parquet(path)
    told = seen.get
    back = df.sparkSession.read.schema(schema.add("_rejected", "boolean")).parquet(path)
    valid, rejects = (back.where(F.col("_rejected") == k).drop("_rejected") for k in (False, True))
    return valid.drop("reject_reason"), rejects, {name: told[f"n{k}"] for k, name in enumerate(names)}
