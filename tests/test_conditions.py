"""Joins and deletes on conditions without an equality, against every pair compared."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import delete, select
from tablekeeper.plans import conditions, ranges
from tablekeeper.plans.ranges import range_join
from tests.conftest import ids


def pairs_of(target, criteria, test):
    left, right = target.alias("t"), criteria.alias("c")
    rows = left.join(right, F.expr(test)).select("t.id", "c.k")
    return sorted(map(tuple, rows.collect()))


def values(kind, rng):
    some = rng.randint(-8, 8)
    if kind == "double":
        return rng.choice([float(some), some / 3, float("nan"), float("inf"), None])
    if kind == "string":
        return rng.choice([f"https://example.org/{some:+d}", f"https://example.org/{abs(some)}x", "", None, "é", "h"])
    if kind == "timestamp_ntz":
        return rng.choice([dt.datetime(2024, 3, 31, 2, 30) + dt.timedelta(hours=some, microseconds=some), None])
    if kind == "timestamp":
        return rng.choice([dt.datetime(2024, 6, 1) + dt.timedelta(seconds=some), None])
    if kind == "date":
        return rng.choice([dt.date(2024, 2, 28) + dt.timedelta(days=some), None])
    return rng.choice([Decimal(some) / 4, None])


@pytest.fixture(scope="module")
def sides(spark):
    def make(kind, n=140, m=60, seed=3):
        rng = random.Random(seed)
        kind_ = "decimal(9,2)" if kind == "decimal" else kind
        target = [(i, values(kind, rng), values(kind, rng), rng.randint(0, 3)) for i in range(n)]
        criteria = [(i, values(kind, rng), values(kind, rng), rng.randint(0, 3)) for i in range(m)]
        return (
            spark.createDataFrame(target, f"id int, a {kind_}, b {kind_}, g int").repartition(3),
            spark.createDataFrame(criteria, f"k int, a {kind_}, b {kind_}, g int").repartition(3),
        )

    return make


TESTS = ["t.a > c.a AND t.b < c.b", "t.a <= c.a AND c.b <= t.b AND t.g <> c.g", "c.b < t.a AND t.a < c.a", "t.a <= c.b"]
CASES = [(kind, test) for kind in ("double", "string") for test in TESTS]
CASES += [(kind, TESTS[k % 4]) for k, kind in enumerate(["timestamp_ntz", "timestamp", "date", "decimal"])]


@pytest.mark.parametrize(("kind", "test"), CASES)
def test_joins_and_deletes_equal_all_pairs(sides, monkeypatch, kind, test):
    monkeypatch.setattr(conditions, "CELL_ROWS", 1)
    target, criteria = sides(kind)
    want = pairs_of(target, criteria, test)
    left, right = target.alias("t"), criteria.alias("c")
    found = conditions.ordered_join(left, right, F.expr(test), [F.col("t.id"), F.col("c.k")])
    assert sorted(map(tuple, found.collect())) == want
    plan = delete.delete_by_condition(target, criteria, test, ["id"])
    gone = sorted({i for i, _ in want})
    assert ids(plan.preview()) == gone and plan.report().first().rows_deleted == len(gone)
    assert ids(plan.kept()) == [i for i in range(140) if i not in gone]


def test_one_side_conjuncts_many_comparisons_and_empty_sides(sides):
    target, criteria = sides("double")
    for test in (
        "t.a > c.a AND t.b < c.b AND t.g < c.g",
        "t.a > c.a AND t.g = 2 AND c.g > 1",
        "t.a > c.a AND t.b >= c.b AND t.g = 1 AND c.g IN (0, 1)",
        "t.a BETWEEN c.a AND c.b",
        "c.a BETWEEN t.a AND t.b",
        "t.a + t.b > c.a - 1 AND lower(cast(t.g AS string)) < cast(c.g AS string)",
    ):
        want = sorted({i for i, _ in pairs_of(target, criteria, test)})
        assert ids(delete.delete_by_condition(target, criteria, test, ["id"]).preview()) == want
        assert ids(delete.delete_by_condition(target, criteria.limit(0), test, ["id"]).preview()) == []
        assert ids(delete.delete_by_condition(target.limit(0), criteria, test, ["id"]).preview()) == []


def test_rows_of_one_identity_are_told_apart(spark):
    frame = spark.createDataFrame([(1, 5, 9, 1), (1, 1, 1, 1), (2, 5, 9, 1), (None, 5, None, 1)], "id int, x int, y int, z int")
    criteria = spark.createDataFrame([(4, 8, 0)], "a int, b int, c int")
    plan = delete.delete_by_condition(frame, criteria, "t.x > c.a AND t.y > c.b AND t.z > c.c", ["id"])
    assert sorted(map(tuple, plan.preview().collect())) == [(1, 5, 9, 1), (2, 5, 9, 1)]
    assert plan.report().first().rows_deleted == 2 and plan.kept().count() == 2


def test_a_table_beside_itself(spark):
    frame = spark.createDataFrame([(1, 5, 1), (2, 7, 3), (3, 6, 0)], "id int, x int, y int")
    dominated = delete.delete_by_condition(frame, frame, "t.x < c.x AND t.y < c.y", ["id"])
    assert ids(dominated.preview()) == [1, 3]
    found = select.select_by_condition(frame, frame, lambda s, t: (t("x") < s("x")) & (t("y") > s("y")), {"id": "other"})
    assert sorted((r["id"], r["other"]) for r in found.collect()) == [(1, 3)]


def test_no_nested_loop_and_a_staircase_forms_no_pair(spark):
    target = spark.range(40_000).selectExpr("id", "id % 977 AS a", "id * 7 % 1009 AS b")
    criteria = spark.range(5_000).selectExpr("id AS k", "id % 991 AS x", "id * 11 % 1013 AS y")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = select.select_by_condition(target, criteria, lambda s, t: (t("a") < s("x") - 950) & (t("b") > s("y") + 980), {"k": "k"})
        text = found._jdf.queryExecution().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text
        want = sum(1 for i in range(40_000) if i % 977 < 40 and i * 7 % 1009 > 980 for k in range(5_000) if i % 977 < k % 991 - 950 and i * 7 % 1009 > k * 11 % 1013 + 980)
        assert found.count() == want > 0
        plan = delete.delete_by_condition(target, criteria, "t.a < c.x - 950 AND t.b > c.y + 980", ["id"])
        assert "Join" not in plan.kept()._jdf.queryExecution().optimizedPlan().toString()
        assert plan.preview().count() == found.select("id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_staircase_is_joined(spark, monkeypatch):
    monkeypatch.setattr(conditions, "STEPS", 10)
    target = spark.range(300).selectExpr("id", "id AS a", "300 - id AS b")
    criteria = spark.range(0, 300, 2).selectExpr("id AS x", "301 - id AS y")
    plan = delete.delete_by_condition(target, criteria, "t.a >= c.x AND t.b >= c.y", ["id"])
    assert plan.preview().count() == 0
    plan = delete.delete_by_condition(target, criteria, "t.a >= c.x AND t.b + 1 >= c.y", ["id"])
    assert ids(plan.preview()) == list(range(0, 300, 2))


def test_text_ranges_have_a_place_for_each_day(spark):
    days = spark.range(2_500).selectExpr("id", "cast(date_add(date '2018-01-01', cast(id AS int)) AS string) AS day")
    windows = days.select(F.col("id").alias("w"), F.col("day").alias("low"), F.col("day").alias("high"))
    joined = range_join(days, windows, "day", "low", "high", compare_rows=0)
    assert joined.filter("day = low").count() == 2_500 == joined.count()
    from tablekeeper.plans.places import steps_before, text_array, text_cuts

    cuts = text_cuts(days, F.col("day"), 2_048)
    placed = days.select(steps_before(F.col("day"), text_array(cuts), len(cuts), lambda c, v: c <= v).alias("at"))
    assert placed.distinct().count() > 2_000


def test_a_share_of_all_pairs_takes_few_bytes(spark, tmp_path):
    target = spark.range(3_000).selectExpr("id", "cast(id * 7919 % 3000 AS double) AS x")
    high = "cast(id % 500 + 1000 AS decimal(38, 14)) AS high"
    criteria = spark.range(2_000).selectExpr("id * 7 AS k", "cast(id % 500 AS string) AS low", high)
    found = range_join(target, criteria, "x", "low", "high", compare_rows=0).select("k", "id")
    joins = [j for j in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in j]
    assert len(joins) == 1 and "low" not in joins[0] and "__share" in joins[0]  # rows are cast before, pairs come out of lists
    found.write.parquet(str(tmp_path / "pairs"))
    assert spark.read.parquet(str(tmp_path / "pairs")).distinct().count() == 2_000 * 1_001
    size = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert size < 1.5 * 2_000 * 1_001


def test_pairs_do_not_depend_on_lists_and_shares(spark, monkeypatch):
    monkeypatch.setattr(ranges, "LIST_ROWS", 7)
    target = spark.range(500).selectExpr("id", "cast(id * 31 % 90 AS double) AS x")
    criteria = spark.range(60).selectExpr("id AS k", "id % 40 AS low", "id % 40 + id % 30 AS high")
    want = sorted((i, k) for i in range(500) for k in range(60) if k % 40 <= i * 31 % 90 <= k % 40 + k % 30)
    for shares in (1, 5):
        monkeypatch.setattr(ranges, "SHARES", shares)
        found = range_join(target, criteria, "x", "low", "high", compare_rows=0).select("id", "k")
        assert sorted(map(tuple, found.collect())) == want


def made_by(plan, kind):
    """Rows that the nodes of a kind have made."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec" or name.endswith("QueryStageExec"):
        return made_by(plan.executedPlan() if name == "AdaptiveSparkPlanExec" else plan.plan(), kind)
    own = plan.metrics().apply("numOutputRows").value() if name == kind and "inline" in plan.simpleString(100) else 0
    return own + sum(made_by(plan.children().apply(i), kind) for i in range(plan.children().size()))


@pytest.mark.parametrize("kind", ["doubles", "mixed types", "range in a condition", "grid"])
def test_pairs_are_handed_on_before_all_of_a_cell_are_made(spark, monkeypatch, kind):
    monkeypatch.setattr(ranges, "LIST_ROWS", 50)
    target = spark.range(1_000).selectExpr("id", "cast(id % 10 AS double) AS x", "id % 7 AS z")
    criteria = spark.range(2_000).selectExpr("id AS k", "cast(0 AS double) AS low", "cast(9 AS double) AS high", "id % 5 - 9 AS y")
    if kind == "mixed types":
        criteria = criteria.selectExpr("k", "cast(low AS string) AS low", "cast(high AS decimal(38, 14)) AS high")
    if kind in ("doubles", "mixed types"):
        found, want = range_join(target, criteria, "x", "low", "high", compare_rows=0).select("k", "id"), 2_000_000
    else:
        test, want = ("t.x > c.y AND t.z >= c.low", 2_000_000) if kind == "grid" else ("t.x BETWEEN c.low AND c.high AND t.z <> c.y + 9", 0)
        found = conditions.ordered_join(target.alias("t"), criteria.alias("c"), F.expr(test), [F.col("c.k"), F.col("t.id")])
        want = want or sum(i % 7 != k % 5 for i in range(1_000) for k in range(2_000))
    first = found.limit(1)
    assert first.count() == 1 and len(first.collect()) == 1
    # One asking row and a list of about 50 rows at a time in each task, not the 2,000,000 pairs of the cells.
    assert 0 < made_by(first._jdf.queryExecution().executedPlan(), "GenerateExec") < 10_000
    assert found.count() == want and found.distinct().count() == want


def test_many_rows_of_a_cell_are_dealt_to_lists(spark, monkeypatch):
    monkeypatch.setattr(ranges, "LIST_ROWS", 50)
    target = spark.range(3_000).selectExpr("id", "if(id % 3 = 0, 7, id) AS x")
    asked = spark.range(40).selectExpr("id AS k", "id AS span")
    lists = []
    kept = F.collect_list
    monkeypatch.setattr(ranges.F, "collect_list", lambda c: lists.append(c) or kept(c))
    joined = ranges.listed_join(asked, "span", target.withColumn("cell", F.col("x")), "cell", "x", 3_000, 3_000)
    assert joined.filter("span = x").count() == joined.count() == 1_000 + sum(k % 3 != 0 for k in range(40))
    assert len(lists) == 1


def test_a_grid_moves_only_rows_that_some_criteria_reach(spark, monkeypatch):
    seen = []
    kept = conditions.listed_join
    monkeypatch.setattr(conditions, "listed_join", lambda asked, to, placed, *more: seen.append(placed.count()) or kept(asked, to, placed, *more))
    target = spark.range(9_000).selectExpr("id", "id AS a", "id % 50 AS b")
    criteria = spark.range(2_000).selectExpr("id AS k", "id % 90 AS x", "id % 50 + 30 AS y")
    left, right = target.alias("t"), criteria.alias("c")
    found = conditions.ordered_join(left, right, F.expr("t.a < c.x AND t.b > c.y"), [F.col("t.id"), F.col("c.k")])
    assert sorted(map(tuple, found.collect())) == sorted((i, k) for i in range(90) for k in range(2_000) if i < k % 90 and i % 50 > k % 50 + 30)
    assert seen[0] <= 90


def test_needless_criteria_form_no_pairs(spark, monkeypatch):
    target = spark.range(2_000).selectExpr("id", "id % 97 AS a", "id % 89 AS b", "id AS d")
    criteria = spark.range(1_500).selectExpr("id AS k", "id % 50 AS x", "id % 70 + 10 AS y", "id + 100 AS z")
    test = "t.a < c.x AND t.b > c.y AND t.d >= c.z"
    seen, kept = [], conditions.ordered_join
    monkeypatch.setattr(delete, "ordered_join", lambda left, right, *more: seen.append(right.count()) or kept(left, right, *more))
    for strongest in (500, 3):
        monkeypatch.setattr(conditions, "STRONGEST", strongest)
        plan = delete.delete_by_condition(target, criteria, test, ["id"])
        want = {i for i in range(2_000) if any(i % 97 < k % 50 and i % 89 > k % 70 + 10 and i >= k + 100 for k in range(1_500))}
        assert set(ids(plan.preview())) == want and len(want) > 10
    assert seen[0] <= 300 and seen[1] < 1_500
