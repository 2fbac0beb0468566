"""Histories of changing rows against a plain version, and the transitive delete."""

import random

from pyspark.sql import functions as F

from tablekeeper.operators import delete, history
from tablekeeper.session import checkpoint_dir
from tests.conftest import ids

SCHEMA = "k int, t int, a string, b int, over boolean"


def plain_history(batches):
    """{(key): [(from, to, values or None)]} from batches of (k, t, a, b, over); a later batch wins at one key and time."""
    told = {}
    for batch in batches:
        best = {}
        for k, t, a, b, over in batch:
            if k is None or t is None:
                continue
            rank = (bool(over), (a is not None, a or ""), (b is not None, b or 0))
            if (k, t) not in best or rank > best[k, t][0]:
                best[k, t] = (rank, None if over else (a, b))
        for place, (_, row) in best.items():
            told[place] = row
    out = set()
    for k in {k for k, _ in told}:
        times = sorted(t for key, t in told if key == k)
        for t, to in zip(times, [*times[1:], None], strict=True):
            out.add((k, *(told[k, t] or (None, None)), t, to, told[k, t] is None, to is None))
    return out


def plain_steady(rows):
    out = []
    for row in sorted(rows, key=lambda r: (r[0], r[3])):
        if out and out[-1][0] == row[0] and out[-1][5] == row[5] and out[-1][1:3] == row[1:3]:
            out[-1] = (*out[-1][:4], row[4], *out[-1][5:6], row[6])
        else:
            out.append(row)
    return {(*r[:5], r[6]) for r in out if not r[5]}


def batches(seed, n=4):
    rng = random.Random(seed)
    pick = lambda: (rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(25)]), rng.choice(["x", "y", None]), rng.choice([0, 1]), rng.choice([True, False, False, None]))
    return [[pick() for _ in range(40)] for _ in range(n)]


def test_history_in_any_batches_equals_a_plain_version(spark, rows):
    checkpoint_dir(spark)
    for seed in range(3):
        told = batches(seed)
        kept = history.history_of(rows(SCHEMA, told[0]), ["k"], "t", ["a", "b"], F.col("over"))
        assert {tuple(r) for r in kept.collect()} == plain_history(told[:1])
        for batch in told[1:]:
            kept = history.apply_changes(kept, rows(SCHEMA, batch), ["k"], "t", ["a", "b"], F.col("over")).checkpoint()
        found = [tuple(r) for r in kept.collect()]
        assert set(found) == plain_history(told) and len(found) == len(set(found))
        smooth = history.steady(kept, ["k"], ["a", "b"])
        assert {tuple(r) for r in smooth.collect()} == plain_steady(plain_history(told))


def test_a_late_change_splits_the_interval_it_falls_into(rows):
    first = history.history_of(rows("k int, t int, a string", [(1, 1, "x"), (1, 9, "x"), (2, 4, "q")]), ["k"], "t", ["a"])
    late = history.apply_changes(first, rows("k int, t int, a string", [(1, 5, "y")]), ["k"], "t", ["a"])
    got = sorted(tuple(r) for r in history.steady(late, ["k"], ["a"]).collect())
    assert got == [(1, "x", 1, 5, False), (1, "x", 9, None, True), (1, "y", 5, 9, False), (2, "q", 4, None, True)]
    empty = rows("k int, t int, a string", [])
    assert history.history_of(empty, ["k"], "t", ["a"]).count() == 0
    assert history.apply_changes(first, empty, ["k"], "t", ["a"]).count() == 3


def test_a_busy_key_is_ordered_in_parts(spark):
    changes = spark.range(20_000).selectExpr("id % 3 * (id % 7) AS k", "id AS t", "cast(id % 5 AS string) AS a")
    kept = history.history_of(changes, ["k"], "t", ["a"])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [lead(__at" in line)
    assert "__part" in window.split("], [")[1]
    assert kept.count() == 20_000 and kept.filter("is_current").count() == changes.select("k").distinct().count()


def test_each_step_of_a_history_reads_its_rows_once(spark):
    changes = spark.range(3_000).selectExpr("id % 7 % 4 AS k", "id AS t", "cast(id % 5 AS string) AS a", "id % 11 = 0 AS over")
    leaves = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 3000")
    kept = history.history_of(changes, ["k"], "t", ["a"], F.col("over"))
    assert leaves(kept) == 1 and leaves(history.steady(kept, ["k"], ["a"])) == 1
    # The rows of keys with changes and those of others, each with the keys of the changes, and the changes.
    both = history.apply_changes(kept, changes.filter("t % 3 = 0"), ["k"], "t", ["a"], F.col("over"))
    assert leaves(both) == 5 and leaves(history.steady(both, ["k"], ["a"])) == 5


def test_rows_at_the_edges_of_parts_meet_their_neighbours(rows):
    rng = random.Random(5)
    # Key 1 has many rows in each part, key 2 one here and there, key 3 two far apart, key 4 all in one part, key 5 a single row.
    times = {1: range(0, 2_000, 2), 2: rng.sample(range(2_000), 40), 3: [3, 1_990], 4: range(1_000, 1_012), 5: [777]}
    told = [(k, t, rng.choice(["x", "y", None]), rng.choice([0, 1]), rng.random() < 0.2) for k, some in times.items() for t in some]
    kept = history.history_of(rows(SCHEMA, told), ["k"], "t", ["a", "b"], F.col("over"))
    found = [tuple(r) for r in kept.collect()]
    assert set(found) == plain_history([told]) and len(found) == len(told)
    smooth = [tuple(r) for r in history.steady(kept, ["k"], ["a", "b"]).collect()]
    assert set(smooth) == plain_steady(plain_history([told])) and len(smooth) == len(set(smooth))


def test_closure_follows_trees_chains_and_circles(spark):
    links = [("t", "t", {"parent": "id"})]
    rng = random.Random(2)
    parents = [None] + [rng.choice([i // 2, max(0, i - 1), None]) for i in range(1, 60)] + [61, 60, 62]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(parents)], "id int, parent int").union(spark.createDataFrame([(None, 3)], "id int, parent int"))
    for start in ("id = 3", "id = 0", "id = 60", "id = 62", "id < 0"):
        gone = {i for i in range(63) if (i, start) in {(3, "id = 3"), (0, "id = 0"), (60, "id = 60"), (62, "id = 62")}}
        while more := {i for i, p in enumerate(parents) if p in gone} - gone:
            gone |= more
        plan = delete.delete_closure({"t": frame}, links, "t", delete.delete_where(frame, F.expr(start)))["t"]
        lone = 1 if 3 in gone else 0
        assert sorted(r["id"] for r in plan.preview().collect() if r["id"] is not None) == sorted(gone)
        assert plan.report().first().rows_deleted == len(gone) + lone


def test_closure_through_a_circle_of_tables(spark):
    a = spark.createDataFrame([(i, i - 1) for i in range(12)], "a int, of_b int")
    b = spark.createDataFrame([(i, i - 1) for i in range(12)], "b int, of_a int")
    links = [("a", "b", {"of_a": "a"}), ("b", "a", {"of_b": "b"})]
    plans = delete.delete_closure({"a": a, "b": b}, links, "a", delete.delete_where(a, F.col("a") == 4))
    # a4 takes b5, b5 takes a6, and so on.
    assert ids(plans["a"].preview(), "a") == [4, 6, 8, 10] and ids(plans["b"].preview(), "b") == [5, 7, 9, 11]
