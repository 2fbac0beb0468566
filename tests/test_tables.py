"""Snapshots and the streaming upsert."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tablekeeper.sources.snapshots import SnapshotTable
from tablekeeper.streaming.upsert import UpsertTable, read_file_stream, upsert_stream
from tests.conftest import ids, table


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "store"))


def test_versions_history_and_time_travel(spark, store, staff):
    assert store.versions() == [] and store.current_version() is None and store.history().count() == 0
    with pytest.raises(ValueError, match="no such version"):
        store.read()
    assert store.publish(staff, "load", {"from": "test"}) == 0
    between = dt.datetime.now(dt.timezone.utc)
    time.sleep(0.01)
    assert store.publish(store.read().filter("id > 2"), "trim") == 1
    assert ids(store.read()) == [3, 4, 5, 6, 7, 8]
    assert ids(store.read(version=0)) == ids(store.read(as_of=between)) == ids(staff)
    with pytest.raises(ValueError, match="no such version"):
        store.read(as_of=dt.datetime(2000, 1, 1))
    history = {r.version: r for r in store.history().collect()}
    assert [history[v].operation for v in (0, 1)] == ["load", "trim"]
    assert (history[0].rows_after, history[1].rows_after) == (8, 6) and history[0].parameters == {"from": "test"}


def test_diff_and_restore(store, staff):
    store.publish(staff)
    store.publish(staff.filter("id <> 4").unionAll(staff.filter("id = 1")))
    assert store.count_diff(0).first()[:] == (8, 8, 0)
    assert sorted((r.id, r.change) for r in store.diff(0).collect()) == [(1, "added"), (4, "removed")]
    assert store.restore(0) == 2
    assert table(store.read()) == table(staff)


def test_an_unfinished_version_is_invisible(store, staff, tmp_path):
    store.publish(staff)
    staff.limit(1).write.parquet(store._data(1))
    (tmp_path / "store" / "data" / "v=0000001" / "_SUCCESS").unlink()
    assert store.versions() == [0] and store.read().count() == 8
    assert store.publish(staff.limit(2)) == 1 and store.read().count() == 2


def test_upkeep(spark, store, staff):
    store.publish(staff)
    assert store.compact(1) == 1 and len(store.read().inputFiles()) == 1
    assert store.cluster_by(["salary"], 3) == 2
    assert table(store.read()) == table(staff)
    assert store.purge(keep=2) == [0] and store.versions() == [1, 2]
    assert store.purge(before=dt.datetime(2000, 1, 1)) == []
    assert store.purge(before=dt.datetime(2100, 1, 1)) == [1] and store.versions() == [2]
    with pytest.raises(ValueError, match="say which"):
        store.purge()


def test_partitions_and_empty_tables(store, staff):
    store.publish(staff, partition_by=["department"])
    filtered = store.read().filter("department = 'Sales'")
    assert ids(filtered) == [3, 4]
    assert "PartitionFilters: [isnotnull(department" in filtered._jdf.queryExecution().executedPlan().toString()
    store.compact()
    assert store.partition_columns() == ["department"] and table(store.read().select(*staff.columns)) == table(staff)
    store.publish(staff.limit(0))
    assert store.read().count() == 0 and set(store.read().columns) == set(staff.columns)


def test_constraints(store, staff):
    rules = {"paid": "salary > 0", "named": "name <> 'Bo'"}
    with pytest.raises(ValueError, match="break a constraint"):
        store.publish(staff, constraints=rules)
    broken = store.violating(staff.withColumn("salary", F.lit(0)), rules)
    assert {r.id: r.broken for r in broken.collect()}[2] == ["paid", "named"] and store.versions() == []
    store.publish(staff.filter("id <> 2"), constraints=rules)
    assert store.current_version() == 0


CHANGES = "k int, at int, v string, op string"
BATCHES = [
    [(1, 5, "e", "set"), (1, 7, "g", "set"), (2, 1, "a", "set")],
    [(1, 6, "late", "set"), (3, 1, "x", "set")],
    [(2, 9, None, "drop"), (3, 0, None, "drop"), (4, 1, None, "drop")],
    [(2, 3, "late", "set"), (5, 2, "n", "set"), (4, None, "untimed", "set")],
]


@pytest.mark.parametrize("split", ["as given", "backwards", "one by one", "all at once", "each twice"])
def test_changes_lead_to_the_same_rows_in_any_split(spark, rows, tmp_path, split):
    changes = [c for batch in BATCHES for c in batch]
    arrive = {
        "as given": BATCHES,
        "backwards": BATCHES[::-1],
        "one by one": [[c] for c in changes],
        "all at once": [changes],
        "each twice": [b for b in BATCHES for _ in range(2)],
    }[split]
    store = UpsertTable(spark, str(tmp_path / "t"), ["k"], ["at"], lambda s: s("op") == "drop", parts=3)
    for number, batch in enumerate(arrive):
        store.apply(rows(CHANGES, batch), number)
    assert table(store.read().select("k", "v")) == [(1, "g"), (3, "x"), (5, "n")]
    assert store.apply(rows(CHANGES, []), 99) == 0


def test_a_batch_rewrites_only_the_parts_of_its_keys(spark, tmp_path):
    store = UpsertTable(spark, str(tmp_path / "t"), ["k"], ["at"], parts=16)
    store.apply(spark.range(500).selectExpr("id AS k", "1 AS at", "'a' AS v"))
    files = lambda: set(store.read().inputFiles())
    before = files()
    assert store.apply(spark.range(1).selectExpr("id AS k", "2 AS at", "'b' AS v")) == 1
    assert len(before - files()) <= 2 and len(before & files()) >= len(before) - 2
    assert store.read().count() == 500 and store.read().filter("v = 'b'").count() == 1


def test_marks_of_removed_keys_are_kept_to_a_horizon(spark, rows, tmp_path):
    store = UpsertTable(spark, str(tmp_path / "t"), ["k"], ["at"], lambda s: s("op") == "drop", parts=2)
    store.apply(rows(CHANGES, [(1, 5, None, "drop"), (2, 9, None, "drop"), (3, 1, "x", "set")]))
    assert store.forget(F.lit(6)) == 1
    store.apply(rows(CHANGES, [(1, 2, "back", "set"), (2, 2, "late", "set")]))
    assert table(store.read().select("k", "v")) == [(1, "back"), (3, "x")]


def test_stream_over_several_batches(spark, tmp_path):
    folder, store = tmp_path / "in", UpsertTable(spark, str(tmp_path / "t"), ["k"], ["at"], parts=4)
    events = spark.range(900).select(
        (F.col("id") % 40).alias("k"), ((F.col("id") * 37) % 900).alias("at"), F.col("id").alias("v")
    )
    events.repartition(6).write.parquet(str(folder))
    stream = read_file_stream(spark, str(folder), events.schema, maxFilesPerTrigger=2)

    def run():
        upsert_stream(stream, store, str(tmp_path / "progress")).awaitTermination()

    run()
    expected = events.groupBy("k").agg(F.max("at").alias("at"), F.max_by("v", "at").alias("v"))
    assert table(store.read().select("k", "at", "v")) == table(expected)
    # New files are picked up where the stream left off.
    events.limit(10).select("k", (F.col("at") + 5000).alias("at"), F.lit(-1).cast("bigint").alias("v")).write.mode(
        "append"
    ).parquet(str(folder))
    run()
    assert store.read().filter("v = -1").count() == 10


def test_diff_shows_columns_that_came_and_went(store, staff):
    store.publish(staff.select("id", "name"))
    store.publish(staff.select("id", "salary"))
    changed = store.diff(0).collect()
    assert len([r for r in changed if r.change == "removed"]) == 8 and len(changed) == 16


def test_a_wrong_row_count_is_never_seen(store, staff):
    store.publish(staff)
    with pytest.raises(ValueError, match="nothing published"):
        store.publish(staff.limit(3), expect_rows=5)
    assert store.versions() == [0] and store.history().count() == 1


def test_clustering_keeps_the_partitions(store, staff):
    store.publish(staff, partition_by=["department"])
    store.cluster_by(["salary"], 2)
    assert store.partition_columns() == ["department"] and table(store.read().select(*staff.columns)) == table(staff)
