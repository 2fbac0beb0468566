"""Streaming upsert into a folder partitioned by key hash.

Each key holds its newest change. A micro-batch reads and rewrites only the parts its keys fall into, and a removed key keeps
the time of its removal, so that an older change that arrives later does not bring it back. A batch that is applied again, or
whose rows arrive in another split or order, leads to the same rows: only newer changes count. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablekeeper.functions.predicates import col, is_true, row_hash
from tablekeeper.operators.select import first_per_key
from tablekeeper.plans.ranks import By
from tablekeeper.session import drop_path, scratch_path

PART, GONE = "__part", "__gone"


def read_file_stream(spark: SparkSession, folder: str, schema, glob: str | None = None, **options) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet").options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, schema, **options: str) -> DataFrame:
    """Kafka values decoded from JSON text; needs the connector package on the class path."""
    raw = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    ).load()
    value = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(value.alias("row")).select("row.*")


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last one by the order columns; of rows that tie, the one whose hash is largest."""
    return first_per_key(changes, keys, [*[f"-{name}" for name in order], By(row_hash(changes), True)])


class UpsertTable:
    """Newest change per key in parquet, `parts` partitions by key hash. `deleted(change)` marks changes that remove their key."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        deleted: Callable[[Callable[[str], Column]], Column] | None = None,
        parts: int = 64,
    ):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.keys, self.order, self.deleted = list(keys), list(order), deleted

    def _exists(self) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{PART}=*")
        system = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return bool(system.globStatus(place))

    def _stored(self) -> DataFrame:
        if not self._exists():
            raise ValueError(f"{self.path} holds nothing yet")
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        """The rows that are not removed."""
        return self._stored().filter(~F.col(GONE)).drop(PART, GONE)

    def apply(self, changes: DataFrame, batch_id: int | None = None) -> int:
        """Bring in changes and return how many parts were written. The batch number is not needed to apply it once."""
        gone = F.lit(False) if self.deleted is None else is_true(self.deleted(col))
        part = F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.parts)).cast("int")
        # The reduced batch tells the parts and is then merged; executors may recompute it.
        rows = latest_changes(changes, self.keys, self.order).withColumns({GONE: gone, PART: part}).persist()
        try:
            touched = [r[0] for r in rows.select(PART).distinct().collect()]  # at most `parts`
            if not touched:
                return 0
            merged = rows
            if self._exists():
                before = self._stored().filter(F.col(PART).isin(touched)).select(*[col(c) for c in rows.columns])
                merged = latest_changes(before.unionByName(rows), self.keys, self.order)
            self._rewrite(merged)
            return len(touched)
        finally:
            rows.unpersist()

    def forget(self, before: Column) -> int:
        """Drop the marks of keys removed before a point of the first order column: the stated horizon for late changes."""
        old = F.col(GONE) & is_true(col(self.order[0]) < before)
        touched = [r[0] for r in self._stored().filter(old).select(PART).distinct().collect()]
        if touched:
            self._rewrite(self._stored().filter(F.col(PART).isin(touched)).filter(~old), touched)
        return len(touched)

    def _rewrite(self, rows: DataFrame, touched: Sequence[int] = ()) -> None:
        """Put rows in place of their parts. They are staged first, because they were read from there."""
        staged = scratch_path(self.spark, "upsert")
        rows.hint("rebalance", PART).write.partitionBy(PART).parquet(staged)
        kept = self.spark.read.schema(rows.schema).parquet(staged)
        for part in set(touched) - {r[0] for r in kept.select(PART).distinct().collect()} if touched else ():
            drop_path(self.spark, f"{self.path}/{PART}={part}")
        writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART).parquet(self.path)
        drop_path(self.spark, staged)


def upsert_stream(stream: DataFrame, table: UpsertTable, checkpoint: str, *, trigger: Mapping | None = None) -> StreamingQuery:
    """Start a query that upserts every micro-batch into the table. Runs to the end of the input by default."""
    writer = stream.writeStream.foreachBatch(table.apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
