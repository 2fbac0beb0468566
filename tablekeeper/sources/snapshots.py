"""Versioned tables as numbered snapshot folders.

`<table>/data/v=0000003/` holds one version as parquet and counts once its `_SUCCESS` file
exists; `<table>/history/0000003.json` says how it came about. A version is never changed,
so a plan may read one version while the next is written. One writer at a time; there is
no claim of transactions. Where a Delta package is installed, use Delta tables instead.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.functions.predicates import col, violations

HISTORY = (
    "version bigint, timestamp timestamp, operation string, parameters map<string,string>, "
    "rows_before bigint, rows_after bigint, schema string"
)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    # -- folders ------------------------------------------------------------------------

    def _file(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _data(self, version: int) -> str:
        return f"{self.path}/data/v={version:07d}"

    def _note(self, version: int) -> dict | None:
        place = self._file("history", f"{version:07d}.json")
        if not self._fs.exists(place):
            return None
        stream = self._fs.open(place)
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _published(self, version: int) -> datetime:
        return datetime.fromisoformat(self._note(version)["timestamp"])

    def _write_note(self, note: Mapping) -> None:
        stream = self._fs.create(self._file("history", f"{note['version']:07d}.json"), True)
        try:
            stream.write(bytearray(json.dumps(note).encode()))
        finally:
            stream.close()

    def _started(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the folders below one folder, finished or not: one listing."""
        root = self._file(folder)
        if not self._fs.exists(root):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(root)]
        return sorted(int(name[len(prefix) :]) for name in names if name.startswith(prefix))

    def complete_folders(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the finished folders `<prefix><number>` below a folder of this table."""
        return [
            number
            for number in self._started(folder, prefix)
            if self._fs.exists(self._file(folder, f"{prefix}{number:09d}", "_SUCCESS"))
        ]

    def remove_folder(self, folder: str) -> None:
        self._fs.delete(self._file(folder), True)

    def _numbers(self) -> list[int]:
        return self._started("data", "v=")

    def _complete(self, version: int) -> bool:
        return self._fs.exists(self._file("data", f"v={version:07d}", "_SUCCESS"))

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return [v for v in self._numbers() if self._complete(v)]

    def current_version(self) -> int | None:
        return next((v for v in reversed(self._numbers()) if self._complete(v)), None)

    def partition_columns(self, version: int | None = None) -> list[str]:
        version = self.current_version() if version is None else version
        note = None if version is None else self._note(version)
        return list((note or {}).get("partition_by") or [])

    # -- reading ------------------------------------------------------------------------

    def read(self, version: int | None = None, as_of: datetime | None = None) -> DataFrame:
        """The newest version, a numbered one, or the last one published at or before a time."""
        if as_of is not None:
            stamp = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
            version = next((v for v in reversed(self.versions()) if self._published(v) <= stamp), None)
        elif version is None:
            version = self.current_version()
        if version is None or not self._complete(version):
            raise ValueError(f"{self.path} has no such version; it has {self.versions()}")
        note = self._note(version)
        reader = self.spark.read
        if note and note.get("schema"):
            reader = reader.schema(T.StructType.fromJson(json.loads(note["schema"])))
        return reader.parquet(self._data(version))

    def history(self) -> DataFrame:
        """version, timestamp, operation, parameters, rows before and after, of complete versions."""
        complete = self.spark.createDataFrame([(v,) for v in self.versions()], "version bigint")
        if not self.versions():
            return self.spark.createDataFrame([], HISTORY).drop("schema")
        notes = self.spark.read.schema(HISTORY).json(f"{self.path}/history")
        return notes.join(F.broadcast(complete), "version", "left_semi").drop("schema")

    # -- writing ------------------------------------------------------------------------

    def publish(
        self,
        rows: DataFrame,
        operation: str = "write",
        parameters: Mapping | None = None,
        *,
        partition_by: Sequence[str] | None = None,
        constraints: Mapping[str, str] | None = None,
        expect_rows: int | None = None,
        rows_before: int | None = None,
        arranged: bool = False,
    ) -> int:
        """Write rows as the next version and return its number.

        Partition columns are those of the current version unless given. The rows are staged and counted from the written
        footers; if that is not `expect_rows`, an error is raised and no reader has seen anything. Rows that break a
        constraint are refused before anything is written. `arranged` rows keep their files and order.
        """
        if constraints and not self.violating(rows, constraints).isEmpty():
            raise ValueError(f"rows break a constraint of {sorted(constraints)}; see violating()")
        current = self.current_version()
        version = 0 if current is None else current + 1
        if partition_by is None:
            partition_by = [c for c in self.partition_columns() if c in rows.columns]
        ordered = [c for c in rows.columns if c not in partition_by] + list(partition_by)
        note = {
            "version": version,
            "timestamp": datetime.now(timezone.utc).isoformat(),
            "operation": operation,
            "parameters": {k: str(v) for k, v in (parameters or {}).items() if v is not None},
            "rows_before": rows_before,
            "rows_after": None,
            "partition_by": list(partition_by),
            "schema": json.dumps(rows.select(*[col(c) for c in ordered]).schema.jsonValue()),
        }
        if partition_by and not arranged:  # few files per partition value; one large value is split over several tasks
            rows = rows.hint("rebalance", *partition_by)
        staged = f"{self.path}/staging/v={version:07d}"
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
        schema = T.StructType.fromJson(json.loads(note["schema"]))
        written = self.spark.read.schema(schema).parquet(staged).count()
        if expect_rows is not None and written != expect_rows:
            self._fs.delete(self._file("staging", f"v={version:07d}"), True)
            raise ValueError(f"{written} rows were written where {expect_rows} were expected; nothing published")
        # The note goes first: a version that is complete always has its operation.
        self._write_note({**note, "rows_after": written})
        self._fs.delete(self._file("data", f"v={version:07d}"), True)  # of a run that broke off
        self._fs.mkdirs(self._file("data"))
        if not self._fs.rename(self._file("staging", f"v={version:07d}"), self._file("data", f"v={version:07d}")):
            raise ValueError(f"version {version} could not be put in place in {self.path}")
        return version

    def violating(self, rows: DataFrame, constraints: Mapping[str, str]) -> DataFrame:
        """Rows that break a constraint, with the names of the broken ones."""
        return rows.withColumn("broken", violations(constraints)).filter(F.size("broken") > 0)

    # -- versions -----------------------------------------------------------------------

    def restore(self, version: int) -> int:
        """Publish an old version's rows as a new version."""
        return self.publish(
            self.read(version), "restore", {"version": version}, partition_by=self.partition_columns(version)
        )

    def count_diff(self, previous: int, current: int | None = None) -> DataFrame:
        """One row: previous_rows, current_rows, diff (rows lost)."""
        before = self.read(previous).agg(F.count("*").alias("previous_rows"))
        after = self.read(current).agg(F.count("*").alias("current_rows"))
        both = before.join(F.broadcast(after), F.lit(True))  # one row each
        return both.withColumn("diff", F.col("previous_rows") - F.col("current_rows"))

    def diff(self, previous: int, current: int | None = None) -> DataFrame:
        """Rows removed from and added since a version, duplicates counted, with a `change` column.

        A column that only one version has is null in the other, so its values make rows differ.
        """
        sides = [self.read(v).withColumn("__sign", F.lit(sign)) for v, sign in ((previous, -1), (current, 1))]
        both = sides[0].unionByName(sides[1], allowMissingColumns=True)
        names = [c for c in both.columns if c != "__sign"]
        net = both.groupBy(*[col(c) for c in names]).agg(F.sum("__sign").alias("__net")).filter("__net <> 0")
        change = F.when(F.col("__net") < 0, "removed").otherwise("added").alias("change")
        times = F.explode(F.sequence(F.lit(1), F.abs("__net").cast("int"))).alias("__copy")
        return net.select(*[col(c) for c in names], change, times).drop("__copy")

    def compact(self, files: int | None = None) -> int:
        """The same rows in fewer files: a stated number, or as many as their size asks for.

        In a partitioned table the size decides per partition.
        """
        rows = self.read()
        if not self.partition_columns():
            rows = rows.hint("rebalance") if files is None else rows.repartition(files)
        return self.publish(rows, "compact", {"files": files})

    def cluster_by(self, columns: Sequence[str], files: int) -> int:
        """Sort rows over files by the columns, inside partitions if there are any, so that scans can skip files by min / max."""
        parts = self.partition_columns()
        keys = [col(c) for c in [*parts, *columns]]
        rows = self.read().repartitionByRange(files, *keys).sortWithinPartitions(*keys)
        return self.publish(rows, "cluster", {"columns": ",".join(columns)}, partition_by=parts, arranged=True)

    def purge(self, before: datetime | None = None, keep: int | None = None) -> list[int]:
        """Remove versions published before a time and / or all but the newest `keep`; never the current one."""
        known = self.versions()
        doomed = set(known[:-1])
        if before is not None:
            stamp = before if before.tzinfo else before.replace(tzinfo=timezone.utc)
            doomed = {v for v in doomed if self._published(v) < stamp}
        if keep is not None:
            doomed &= set(known[: -max(keep, 1)])
        if before is None and keep is None:
            raise ValueError("say which versions to purge: before= or keep=")
        for version in sorted(doomed):
            self._fs.delete(self._file("data", f"v={version:07d}"), True)
        return sorted(doomed)
