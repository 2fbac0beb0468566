"""The streaming upsert by keyed state: any split, order and restart of the changes leads to the same rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablekeeper.streaming.keyed import KeyedLog
from tablekeeper.streaming.upsert import read_file_stream

SCHEMA = "k int, name string, at timestamp, n int, local timestamp_ntz, tags array<string>, gone boolean"


def changes(seed):
    rng = random.Random(seed)
    base = dt.datetime(2024, 3, 31, 1, 30, 0, 123456)
    rows = []
    for i in range(120):
        at = rng.choice([base + dt.timedelta(minutes=rng.randint(0, 90), microseconds=rng.randint(0, 3)), None])
        tags = rng.choice([None, [], ["a", None], ["é"]])
        rows.append((rng.choice([1, 2, 3, 4, None]), rng.choice(["a", "b"]), at, rng.choice([None, 1, 2]), rng.choice([base, None]), tags, rng.random() < 0.2))
    return rows + rows[:7]


def newest(spark, rows):
    """Plain: per key the largest (at, n), nulls least; ties are told apart by Spark's hash of the row."""
    frame = spark.createDataFrame(rows, SCHEMA)
    hashed = frame.withColumn("h", F.xxhash64(*frame.columns)).collect()
    best = {}
    for r in hashed:
        rank = ((r["at"] is not None, r["at"] or dt.datetime.min), (r["n"] is not None, r["n"] or 0), r["h"])
        if (r["k"], r["name"]) not in best or rank > best[r["k"], r["name"]][0]:
            best[r["k"], r["name"]] = (rank, tuple(r)[:-1])
    return sorted((row for _, row in best.values() if not row[-1]), key=repr)


@pytest.mark.parametrize("split", [1, 5])
def test_any_split_restart_and_fold_leads_to_the_same_rows(spark, tmp_path, split):
    rows = changes(split)
    arrival, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    log = KeyedLog(spark, str(tmp_path / "log"), ["k", "name"], ["at", "n"], lambda s: s("gone"))
    for part in range(split):
        spark.createDataFrame(rows[part::split], SCHEMA).repartition(2).write.mode("append").parquet(arrival)
        stream = read_file_stream(spark, arrival, spark.createDataFrame([], SCHEMA).schema, maxFilesPerTrigger=1 + part % 2)
        log.start(stream, progress).awaitTermination()
        if part == 2:
            assert log.fold() > 1
    want = newest(spark, rows)
    assert sorted((tuple(r) for r in log.read().collect()), key=repr) == want
    log.fold()
    assert sorted((tuple(r) for r in log.read().collect()), key=repr) == want
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_batch_writes_only_what_is_newer(spark, tmp_path):
    arrival, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    log = KeyedLog(spark, str(tmp_path / "log"), ["k"], ["at"])
    first = spark.range(5_000).selectExpr("id AS k", "10L AS at")
    sizes = []
    for batch in (first, spark.range(7).selectExpr("id AS k", "id + 8 AS at"), first):
        batch.write.mode("append").parquet(arrival)
        log.start(read_file_stream(spark, arrival, first.schema), progress).awaitTermination()
        sizes.append(spark.read.parquet(log.path).count())
    assert sizes == [5_000, 5_004, 5_004]
    assert log.read().filter("at > 10").count() == 4


def test_times_inside_other_types_are_refused(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), ["k"], ["k"])
    with pytest.raises(TypeError, match="take them out"):
        log.passed(spark.createDataFrame([], "k int, x array<timestamp>"))
