"""Streaming upsert by keyed state: what a micro-batch costs depends on its own keys, not on the table.

The state store holds, for each key, the order and a hash of the newest change seen. A change passes only if it is newer; what passes
is appended, a folder for each batch, so nothing is read back or rewritten. The table is the newest row of each key in those
folders; `fold` brings them into one when a reader asks for it. Removed keys keep their order, so a late change does not bring them
back, until a horizon that forgets idle keys; even then the folders decide, which hold the removal until it is folded away.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tablekeeper.functions.predicates import col, is_true, row_hash
from tablekeeper.session import drop_path, importable
from tablekeeper.streaming.upsert import GONE, latest_changes

BATCH, HASH = "__batch", "__hash"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Newest(StatefulProcessor):
    """Passes the newest change of a key if it is newer than all before it. Nulls are oldest; of equal orders the larger hash is newer."""

    def __init__(self, kinds: Sequence[T.DataType], horizon: int | None):
        self.kinds, self.horizon = list(kinds), horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField(f"o{i}", kind) for i, kind in enumerate(self.kinds)]
        schema = T.StructType([*fields, T.StructField("hash", T.LongType())])
        self.held = handle.getValueState("newest", schema, ttlDurationMs=self.horizon)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        count = len(self.kinds)
        names = [*(f"__order{i}" for i in range(count)), HASH]

        def rank(order) -> tuple:
            return tuple((v is not None, v) for v in order)

        best = rank(self.held.get()) if self.held.exists() else None
        newest = None
        for row in rows:
            own = rank(row[n] for n in names)
            if best is None or own > best:
                best, newest = own, row
        if newest is not None:
            self.held.update(tuple(newest[n] for n in names))
            yield newest

    def close(self) -> None:
        pass


def _carried(name: str, kind: T.DataType) -> Column:
    """A column as it goes through Python and back without a change: times as numbers or text."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col(name)).alias(name)
    if isinstance(kind, T.TimestampNTZType):
        return col(name).cast("string").alias(name)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) and "timestamp" in kind.simpleString():
        raise TypeError(f"column {name}: times inside {kind.simpleString()} are not carried; take them out into columns")
    return col(name)


def _back(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(col(name)).alias(name)
    return col(name).cast(kind).alias(name) if isinstance(kind, T.TimestampNTZType) else col(name)


class KeyedLog:
    """Newest change per key below `path`. `deleted(change)` marks changes that remove their key; `horizon` is in milliseconds."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        deleted: Callable[[Callable[[str], Column]], Column] | None = None,
        horizon: int | None = None,
    ):
        self.spark, self.path, self.horizon = spark, path.rstrip("/"), horizon
        self.keys, self.order, self.deleted = list(keys), list(order), deleted

    def passed(self, stream: DataFrame) -> DataFrame:
        """The changes of a stream that are newer than all before them of their key, with `__gone`."""
        importable(self.spark)
        gone = F.lit(False) if self.deleted is None else is_true(self.deleted(col))
        kinds = {f.name: f.dataType for f in stream.schema.fields}
        orders = [_carried(o, kinds[o]).alias(f"__order{i}") for i, o in enumerate(self.order)]
        carried = [_carried(n, k) for n, k in kinds.items()]
        rows = stream.withColumn(GONE, gone).select(*carried, GONE, row_hash(stream).alias(HASH), *orders)
        processor = Newest([rows.schema[f"__order{i}"].dataType for i in range(len(self.order))], self.horizon)
        found = rows.groupBy(*[col(k) for k in self.keys]).transformWithState(
            statefulProcessor=processor,
            outputStructType=rows.schema,
            outputMode="Update",
            timeMode="None" if self.horizon is None else "ProcessingTime",
        )
        return found.select(*[_back(n, k) for n, k in kinds.items()], GONE)

    def start(self, stream: DataFrame, checkpoint: str, *, trigger: Mapping | None = None) -> StreamingQuery:
        """Start a query that notes every micro-batch. Runs to the end of the input by default."""

        def note(batch: DataFrame, number: int) -> None:
            # A batch that runs again replaces its folder.
            batch.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={number}")

        before = self.spark.conf.get(STORE)
        self.spark.conf.set(STORE, ROCKS)  # a query keeps the settings it starts with
        try:
            writer = self.passed(stream).writeStream.outputMode("update").foreachBatch(note)
            return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
        finally:
            self.spark.conf.set(STORE, before)

    def _noted(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        """The rows that are not removed."""
        return latest_changes(self._noted().drop(BATCH), self.keys, self.order).filter(~F.col(GONE)).drop(GONE)

    def fold(self) -> int:
        """Bring all folders into one, and return how many there were. Rows that are in both meanwhile count once."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BATCH}=*")
        system = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        folders = [s.getPath().toString() for s in system.globStatus(place)]
        numbers = [int(f.rsplit("=", 1)[1]) for f in folders]
        rows = latest_changes(self._noted().drop(BATCH), self.keys, self.order)
        rows.write.parquet(f"{self.path}/{BATCH}={min(numbers) - 1}")
        for folder in folders:
            drop_path(self.spark, folder)
        return len(folders)
