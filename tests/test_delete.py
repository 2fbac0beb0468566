import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import delete
from tablekeeper.sources.partitions import delete_in_place
from tablekeeper.sources.snapshots import SnapshotTable
from tests.conftest import ids

ALL = [1, 2, 3, 4, 5, 6, 7, 8]


def check(plan, gone):
    """Preview, kept, flags and report must tell the same story."""
    assert ids(plan.preview()) == gone
    assert ids(plan.kept()) == [i for i in ALL if i not in gone]
    assert ids(plan.flagged().filter("hit")) == gone
    report = plan.report().first()
    assert (report.rows_before, report.rows_deleted, report.rows_after) == (8, len(gone), 8 - len(gone))
    assert plan.preview().columns == plan.kept().columns == plan.target.columns


def test_by_keys_counts_rows_once(staff, rows):
    wanted = rows("k int", [(1,), (1,), (3,), (None,), (42,)])
    check(delete.delete_by_keys(staff, wanted, {"id": "k"}), [1, 3])
    check(delete.delete_by_keys(staff, wanted, {"id": "k"}, small=True), [1, 3])
    check(delete.delete_by_keys(staff, wanted.limit(0), {"id": "k"}), [])


def test_null_keys_never_match(staff, rows):
    wanted = rows("department string, level string", [(None, "Senior"), ("Design", None), ("Design", "Junior")])
    check(delete.delete_by_keys(staff, wanted, ["department", "level"]), [2])


def test_values_from_list_and_table(staff, rows):
    check(delete.delete_by_values(staff, "department", ["Design", None]), [1, 2, 7])
    check(delete.delete_by_values(staff, "department", rows("d string", [("Legal",), (None,)]), "d"), [6, 8])


def test_reasons_are_carried(staff, rows):
    reasons = rows("who int, reason string", [(2, "left"), (2, "moved"), (None, "none")])
    found = delete.explain_by_keys(staff, reasons, {"id": "who"}, ["reason"])
    assert sorted((r.id, r.reason) for r in found.collect()) == [(2, "left"), (2, "moved")]


def test_thresholds_lowest_wins_and_null_takes_the_group(staff, rows):
    limits = rows("d string, floor int", [("Design", 95000), ("Design", 90000), ("Legal", None), (None, 0)])
    check(delete.delete_by_thresholds(staff, limits, {"department": "d"}, "salary", "floor"), [1, 6, 7, 8])


def test_condition_text(staff, rows, spark):
    limits = rows("d string, floor int", [("Design", 80000), ("Design", 60000), ("Sales", 0)])
    plan = delete.delete_by_condition(staff, limits, "t.department = c.d AND t.salary >= c.floor", ["id"])
    check(plan, [1, 2, 3, 7])
    many = spark.range(5000)
    with pytest.raises(ValueError, match="no equality"):
        delete.delete_by_condition(staff, many, "t.salary <> c.id", ["id"])


def test_query_and_groups(staff):
    plan = delete.delete_by_query(
        staff, "SELECT department FROM {s} WHERE salary >= :floor", {"department": "department"}, {"floor": 99000}, s=staff
    )
    check(plan, [6, 8])
    check(delete.delete_groups(staff, ["department"], F.avg("salary") > 80000), [1, 2, 6, 7, 8])


def test_predicates_keep_unknown_rows(staff):
    check(delete.delete_where(staff, F.col("salary") > 70000), [1, 3, 5, 7, 8])
    check(delete.delete_where(staff, ~F.col("active")), [3, 6])
    check(delete.delete_query(staff, "department = 'Design' AND salary > 70000"), [1, 7])
    check(delete.delete_text_match(staff, "name", "A"), [1, 8])
    check(delete.delete_text_match(staff, "name", "A", ignore_case=False), [1])
    check(delete.delete_text_match(staff, "name", "^.[dy]$", regex=True), [3, 5])
    check(delete.delete_text_match(staff, "name", "^.[dy]$"), [])


def test_scope_limits_a_keyed_delete(staff, rows):
    wanted = rows("department string", [("Design",), ("Sales",)])
    check(delete.delete_scoped(staff, wanted, "department", "active = false"), [3])
    check(delete.delete_scoped(staff, wanted, "department", F.col("salary") > 80000), [1, 7])


def test_percentile(staff):
    check(delete.delete_above_percentile(staff, "salary", 0.75), [1, 7, 8])
    check(delete.delete_above_percentile(staff, "salary", 0.75, accuracy=1000), [1, 7, 8])
    check(delete.delete_above_percentile(staff.filter("id < 0").union(staff), "salary", 1.0), [8])


def test_retention_uses_the_shortest_rule(rows):
    logs = rows(
        "id int, kind string, at timestamp_ntz",
        [(i, k, dt.datetime(2024, 1, d)) for i, (k, d) in enumerate(
            [("a", 1), ("a", 8), ("b", 1), ("b", 9), ("c", 1), (None, 1), ("a", 5), ("b", 5)], 1)],
    )
    rules = rows("k string, days int", [("a", 5), ("a", 30), ("b", 1), (None, 0)])
    as_of = F.lit("2024-01-10").cast("timestamp_ntz")
    check(delete.delete_retention(logs, rules, kind={"kind": "k"}, time="at", days="days", as_of=as_of), [1, 3, 8])


def test_quality_rules(staff):
    check(delete.delete_quality(staff, [("name", "is_null"), ("salary", "negative")]), [6])
    check(delete.delete_quality(staff, [("department", "unknown", "Legal"), ("hired", "is_null")]), [6, 8])
    with pytest.raises(ValueError, match="unknown quality rule"):
        delete.delete_quality(staff, [("name", "odd")])


def test_soft_delete(staff, rows):
    marked = delete.soft_delete(staff, F.col("salary") > 90000)
    assert {r.id: r.active for r in marked.collect()} == {1: False, 2: True, 3: False, 4: True, 5: True, 6: False, 7: False, 8: False}
    keyed = delete.soft_delete_by_keys(staff.drop("active"), rows("id int", [(2,), (None,)]), "id", "live")
    assert [r.id for r in keyed.filter("not live").collect()] == [2] and keyed.count() == 8


def test_base_names_and_the_empty_listing(rows):
    catalogue = rows("id int, f string", [(1, "a/x.pdf"), (2, r"c:\d\y.pdf"), (3, None), (4, "z.pdf"), (5, "x.pdf"), (6, "q/"), (7, "X.pdf"), (8, "x.pdf.bak")])
    listing = rows("name string", [("deep/er/x.pdf",), ("y.pdf",), ("folder/",), (None,), ("x.pdf",)])
    check(delete.delete_base_names(catalogue, listing, "f"), [1, 2, 5])
    with pytest.raises(ValueError, match="refusing"):
        delete.delete_base_names(catalogue, listing.filter("name = 'folder/'"), "f")


def test_cascade_with_two_parents(rows):
    people = rows("id int", [(1,), (2,)])
    sites = rows("id int", [(10,), (20,)])
    owners = rows("id int, person int", [(100, 1), (200, 2)])
    visits = rows("id int, owner int, site int", [(i, o, s) for i, (o, s) in enumerate([(100, 10), (100, 20), (200, 10), (200, 20), (None, None)])])
    tables = {"people": people, "owners": owners, "visits": visits, "sites": sites}
    root = delete.delete_where(people, F.col("id") == 1)
    plans = delete.delete_cascade(tables, [("people", "owners", {"person": "id"}), ("owners", "visits", {"owner": "id"})], "people", root)
    assert list(plans) == ["visits", "owners", "people"]
    assert ids(plans["visits"].kept()) == [2, 3, 4]
    links = [("people", "owners", {"person": "id"}), ("people", "visits", {"site": "id"}), ("owners", "visits", {"owner": "id"})]
    plan = delete.delete_cascade(tables, links, "people", delete.delete_where(people, F.col("id") == 2))["visits"]
    both = delete._also_by_keys(delete.delete_where(visits, F.col("site") == 10), owners.filter("person = 1"), {"owner": "id"})
    assert ids(both.kept()) == [3, 4] and ids(both.preview()) == [0, 1, 2]
    assert both.report().first().rows_deleted == 3
    assert ids(plan.kept()) == [0, 1, 4]
    with pytest.raises(ValueError, match="from the root"):
        delete.delete_cascade(tables, [("owners", "visits", {"owner": "id"})], "people", root)


def test_apply_is_guarded(spark, staff, rows, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "staff"))
    store.publish(staff, "load")
    plan = delete.delete_by_keys(store.read(), rows("id int", [(1,), (2,)]), "id")
    assert plan.apply(store) == {"rows_before": 8, "rows_deleted": 2, "rows_after": 6, "pct_deleted": 25.0, "version": None}
    assert store.versions() == [0]
    assert plan.apply(store, dry_run=False)["version"] == 1
    assert ids(store.read()) == [3, 4, 5, 6, 7, 8] and ids(store.read(0)) == ALL
    nothing = delete.delete_by_values(store.read(), "department", ["none"])
    assert nothing.apply(store, dry_run=False)["version"] is None and store.versions() == [0, 1]
    with pytest.raises(ValueError, match="nothing published"):
        store.publish(staff, expect_rows=3)
    assert store.versions() == [0, 1] and ids(store.read()) == [3, 4, 5, 6, 7, 8]


def test_plans_stay_joins_on_keys(spark, staff, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100_000).select(F.col("id").cast("int").alias("id"))
        plan = delete.delete_by_keys(staff, big, "id")
        for frame, kind in ((plan.kept(), "LeftAnti"), (plan.preview(), "LeftSemi"), (plan.flagged(), "LeftOuter")):
            text = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and kind in text
            assert "CartesianProduct" not in text and "NestedLoop" not in text
            assert text.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_in_place_rewrites_touched_partitions_only(spark, staff, tmp_path):
    folder = tmp_path / "parts"
    staff.withColumn("place", F.concat(F.coalesce("department", F.lit("No one")), F.lit(" & co"))).write.partitionBy(
        "place", "level"
    ).parquet(str(folder))

    def run(dry_run, condition):
        return delete_in_place(
            spark, str(folder), ["place", "level"], lambda t: delete.delete_where(t, F.expr(condition)), dry_run
        )

    def files():
        return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}

    before = files()
    condition = "salary = 91000 OR id = 8"  # empties Design/Senior, Design/null and Legal/Senior
    assert run(True, condition) == {"rows_deleted": 3, "partitions": 3, "emptied": 0}
    assert files() == before
    assert run(False, condition) == {"rows_deleted": 3, "partitions": 3, "emptied": 3}
    assert ids(spark.read.parquet(str(folder))) == [2, 3, 4, 5, 6]
    after = files()
    assert len(after) == 5 and all(before[p] == t for p, t in after.items())
    assert run(False, "salary > 1000000") == {"rows_deleted": 0, "partitions": 0, "emptied": 0}


def test_in_place_keeps_the_rest_of_a_partition(spark, tmp_path):
    folder = str(tmp_path / "parts")
    spark.range(1000).select("id", (F.col("id") % 4).alias("p")).write.partitionBy("p").parquet(folder)
    doomed = spark.range(0, 400, 4).select("id")  # all in partition 0
    got = delete_in_place(spark, folder, ["p"], lambda t: delete.delete_by_keys(t, doomed, "id"), dry_run=False)
    assert got == {"rows_deleted": 100, "partitions": 1, "emptied": 0}
    left = spark.read.parquet(folder)
    assert left.count() == 900 and left.filter("p = 0").agg(F.min("id")).first()[0] == 400


def test_in_place_victims_come_from_the_whole_table(spark, tmp_path):
    folder = str(tmp_path / "parts")
    spark.range(1000).select("id", F.when(F.col("id") < 990, 0).otherwise(1).alias("p")).write.partitionBy("p").parquet(folder)
    got = delete_in_place(spark, folder, ["p"], lambda t: delete.delete_above_percentile(t, "id", 0.95), dry_run=False)
    assert got == {"rows_deleted": 51, "partitions": 2, "emptied": 1}
    assert spark.read.parquet(folder).agg(F.count("*"), F.max("id")).first()[:] == (949, 948)


def test_percentile_of_wide_integers_is_exact(rows):
    frame = rows("id int, x bigint", [(i, 2**53 + i) for i in range(8)])
    assert ids(delete.delete_above_percentile(frame, "x", 0.25).kept()) == [0]
    assert ids(delete.delete_above_percentile(frame, "x", 0.75).kept()) == [0, 1, 2, 3, 4]


def test_condition_without_equality_is_refused_at_any_size(rows):
    frame = rows("id int, x int", [(1, 5), (2, 9)])
    limits = rows("low int", [(6,)])
    with pytest.raises(ValueError, match="no equality"):
        delete.delete_by_condition(frame, limits, "t.x % 10 = 9 OR t.x > c.low", ["id"])
    assert ids(delete.delete_by_condition(frame, limits, "t.x % 10 = 9 OR t.x > c.low", ["id"], compare_all_pairs=True).kept()) == [1]
    for all_pairs in (False, True):
        plan = delete.delete_by_condition(frame, limits, "t.x > c.low", ["id"], compare_all_pairs=all_pairs)
        assert ids(plan.kept()) == [1] and ids(plan.preview()) == [2] and plan.report().first().rows_deleted == 1


def test_condition_counts_rows_whose_identity_is_null(rows):
    frame = rows("id int, x int", [(None, 5), (2, 5), (3, 1)])
    plan = delete.delete_by_condition(frame, rows("y int", [(5,)]), "t.x = c.y", ["id"])
    assert plan.report().first().rows_deleted == 2 and plan.kept().count() == 1
