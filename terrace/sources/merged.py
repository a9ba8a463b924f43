"""A keyed table that is merged on read (STR-1, INC-4, SNK-2, SNK-3).

A batch adds one run of files: it writes as many bytes as it brings, whatever the table holds. A manifest lists the
live runs with their rows, bytes and range of the first key; each commit is a new manifest file, put in place by a rename.
Readers merge the runs by key. Where enough runs of like size have come together they are rewritten
as one, so a row is rewritten once for each size class that it passes.

One writer at a time. Layout (keys, version, mode, columns) is written with the first commit, and another one
is refused. A batch that was committed before isn't written again, so a repeated batch is harmless.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Runs of one size class that are rewritten as one; bytes below which all runs are of the lowest class; bytes of a file.
FAN, SMALL_BYTES, FILE_BYTES = 8, 1 << 20, 128 << 20
#: Column of the files that tells which commit a row came with.
SEQ = "_seq"


@dataclass
class Manifest:
    """State of a table after a commit; what ``dropped`` names is deleted with the commit after."""

    number: int = 0
    layout: dict = field(default_factory=dict)
    runs: list[dict] = field(default_factory=list)
    committed: dict[str, int] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)


class MergedTable:
    """``mode`` "update": of a key's rows the one with the greatest ``version`` counts, then the last committed; "ignore": the first committed."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], version: str | None = None, mode: str = "update"):
        if mode not in ("update", "ignore"):
            raise ValueError(f"unknown mode {mode!r}")
        self.spark, self.root, self.schema, self.keys, self.version, self.mode = spark, root.rstrip("/"), schema, list(keys), version, mode
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._layout = {"keys": self.keys, "version": version, "mode": mode, "columns": [[f.name, f.dataType.simpleString()] for f in schema]}
        held = self.manifest().layout
        if held and held != self._layout:
            raise ValueError(f"the table at {root} was written as {held}, not as {self._layout}")

    def _log(self, number: int) -> str:
        return f"{self.root}/_manifest/{number:012d}.json"

    def manifest(self) -> Manifest:
        """The last commit; the folder holds two of them at most."""
        folder = self._path(f"{self.root}/_manifest")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return Manifest()
        stream = self._fs.open(self._path(self._log(max(numbers))))
        try:
            return Manifest(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _commit(self, now: Manifest, gone: list[str]) -> None:
        """Puts ``now`` in place, then deletes ``gone`` and the manifest before the last."""
        final, draft = self._path(self._log(now.number)), self._path(f"{self.root}/_manifest/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        stream.write(json.dumps(now.__dict__).encode())
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"another writer committed {final}")
        for path in (*gone, self._log(now.number - 2)):
            self._fs.delete(self._path(path), True)

    def _wins(self) -> list[Column]:
        """Order of a key's rows; ties of one commit are decided by the whole row."""
        if self.mode == "ignore":
            return [F.asc(SEQ), F.xxhash64(*self.schema.names)]
        newest = [F.desc_nulls_last(self.version)] if self.version else []
        return [*newest, F.desc(SEQ), F.xxhash64(*self.schema.names)]

    def _one_a_key(self, rows: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self._wins()))
        return rows.withColumn("_place", place).where("_place = 1").drop("_place")

    def _files(self, runs: list[dict]) -> DataFrame:
        shape = StructType([*self.schema.fields, StructField(SEQ, LongType())])
        return self.spark.read.schema(shape).parquet(*(f"{self.root}/{r['path']}" for r in runs))

    def _write_run(self, rows: DataFrame, name: str, size: int = 0) -> dict:
        """Writes a run in key order; its statistics come with the write."""
        if size > FILE_BYTES:
            rows = rows.repartitionByRange(math.ceil(size / FILE_BYTES), *self.keys)
        seen, first = Observation(), F.col(self.keys[0])
        watched = rows.sortWithinPartitions(*self.keys).observe(seen, F.count(F.lit(1)).alias("rows"), F.min(first).alias("low"), F.max(first).alias("high"))
        watched.write.mode("overwrite").parquet(f"{self.root}/{name}")
        told, size = seen.get, int(self._fs.getContentSummary(self._path(f"{self.root}/{name}")).getLength())
        bound = lambda x: x if isinstance(x, int | str) and not isinstance(x, bool) else None
        return {"path": name, "rows": told["rows"], "bytes": size, "low": bound(told["low"]), "high": bound(told["high"])}

    def merge(self, rows: DataFrame, batch: int, writer: str = "") -> bool:
        """Adds a batch; False if ``writer`` has committed this number or a later one before."""
        last = self.manifest()
        if last.committed.get(writer, -1) >= batch:
            return False
        number = last.number + 1
        own = self._one_a_key(rows.select(*self.schema.names).withColumn(SEQ, F.lit(number).cast("long")))
        run = self._write_run(own, f"run-{number:012d}")
        runs = [*last.runs, run] if run["rows"] else last.runs
        dropped = [] if run["rows"] else [run["path"]]
        self._commit(Manifest(number, self._layout, runs, last.committed | {writer: batch}, dropped), [f"{self.root}/{p}" for p in last.dropped])
        while self._compact():
            pass
        return True

    def _compact(self) -> bool:
        """Rewrites the runs of the lowest size class that holds FAN of them; whether there was one."""
        last = self.manifest()
        by_class: dict[int, list[dict]] = {}
        for run in last.runs:
            by_class.setdefault(max(0, math.ceil(math.log(max(1, run["bytes"]) / SMALL_BYTES, FAN))), []).append(run)
        full = next((v for _, v in sorted(by_class.items()) if len(v) >= FAN), None)
        if not full:
            return False
        number, paths = last.number + 1, {r["path"] for r in full}
        run = self._write_run(self._one_a_key(self._files(full)), f"run-{number:012d}", sum(r["bytes"] for r in full))
        runs = [*(r for r in last.runs if r["path"] not in paths), run]
        self._commit(Manifest(number, self._layout, runs, last.committed, sorted(paths)), [f"{self.root}/{p}" for p in last.dropped])
        return True

    def read(self, low: int | str | None = None, high: int | str | None = None) -> DataFrame:
        """The table, or its rows with the first key in a range: runs that lie beside it aren't opened.

        Runs but the largest are merged by ``row_number``. The largest has one row a key, so it is only joined with
        what the others hold, and isn't shuffled where Spark can send those.
        """

        def beside(run: dict) -> bool:
            try:
                return (low is not None and run["high"] < low) or (high is not None and run["low"] > high)
            except TypeError:  # without a bound
                return False

        runs = sorted((r for r in self.manifest().runs if not beside(r)), key=lambda r: r["bytes"])
        if not runs:
            return self.spark.createDataFrame([], self.schema)

        def cut(rows: DataFrame) -> DataFrame:
            first = F.col(self.keys[0])
            rows = rows if low is None else rows.where(first >= low)
            return rows if high is None else rows.where(first <= high)

        base = cut(self._files(runs[-1:]))
        if len(runs) == 1:
            return base.select(*self.schema.names)
        few = self._one_a_key(cut(self._files(runs[:-1])))
        a, b = base.alias("a"), few.alias("b")
        same = reduce(lambda x, y: x & y, (F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys))
        wins = F.col(f"b.{SEQ}") > F.col(f"a.{SEQ}")
        if self.mode == "ignore":
            wins = ~wins
        elif self.version:
            x, y = F.col(f"a.{self.version}"), F.col(f"b.{self.version}")
            wins = F.coalesce(y > x, x.isNull() & y.isNotNull()) | (x.eqNullSafe(y) & wins)
        beaten = a.join(b, same & ~wins, "inner").select(*(F.col(f"b.{k}").alias(k) for k in self.keys)).alias("c")
        stays = a.join(b, same & wins, "left_anti").select(*self.schema.names)
        comes = b.join(beaten, reduce(lambda x, y: x & y, (F.col(f"b.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys)), "left_anti")
        return stays.unionByName(comes.select(*self.schema.names))
