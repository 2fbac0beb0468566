import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import select
from tablekeeper.plans.grams import contains_join
from tablekeeper.plans import ranges as ranges_plan
from tablekeeper.plans.ranges import range_join
from tests.conftest import ids, table


def test_value_search_repeats_per_criteria_row(staff, rows):
    wanted = rows("d string", [("Design",), ("Design",), ("Legal",), (None,), ("None such",)])
    found = select.select_by_value(staff, wanted, "department", "d")
    assert found.columns == ["search_value", *staff.columns]
    assert ids(found) == [1, 1, 2, 2, 6, 7, 7, 8]
    assert table(found) == table(select.select_by_value(staff, wanted, "department", "d", small=True))


def test_two_columns_ignore_null_keys(staff, rows):
    wanted = rows("level string, d string", [("Senior", "Design"), (None, "Design"), ("Junior", None), ("Junior", "Sales")])
    found = select.select_by_columns(staff, wanted, {"department": "d", "level": "level"})
    assert ids(found) == [1, 4]
    assert found.columns[:2] == ["search_d", "search_level"]


def test_set_search_returns_each_row_once(staff, rows):
    wanted = rows("id int", [(1,), (1,), (3,), (None,), (99,)])
    assert ids(select.select_in_set(staff, wanted, "id")) == [1, 3]
    assert ids(select.select_in_set(staff, wanted, "id", small=True)) == [1, 3]
    assert ids(select.select_in_set(staff, wanted.limit(0), "id")) == []
    assert ids(select.select_values(staff, "department", ["Legal", None])) == [6, 8]


def test_keys_are_checked(staff, rows):
    with pytest.raises(ValueError, match="no column 'nope'"):
        select.select_in_set(staff, rows("id int", [(1,)]), {"nope": "id"})
    with pytest.raises(TypeError, match="key types differ"):
        select.select_in_set(staff, rows("id string", [("1",)]), "id")
    with pytest.raises(ValueError, match="at least one key"):
        select.select_in_set(staff, rows("id string", [("1",)]), [])


def test_join_keeps_one_key_column(staff, rows):
    rates = rows("dept string, rate double", [("Design", 1.5), ("Sales", 2.0), ("Sales", 3.0)])
    joined = select.select_join(staff.select("id", "department"), rates, {"department": "dept"})
    assert joined.columns == ["department", "rate", "id"]
    assert ids(joined) == [1, 2, 3, 3, 4, 4, 7]
    with pytest.raises(ValueError, match="two columns named"):
        select.select_join(staff, rates.withColumn("id", F.lit(1)), {"department": "dept"})


def test_condition_is_built_once_per_call(staff, rows):
    wanted = rows("dept string, floor int", [("Design", 90000), ("Sales", 0), ("Legal", 99001)])
    calls = []

    def condition(s, t):
        calls.append(1)
        return (t("department") == s("dept")) & (t("salary") >= s("floor"))

    found = select.select_by_condition(staff, wanted, condition)
    assert ids(found) == [1, 3, 7] and len(calls) == 1


def test_condition_without_equality_needs_few_criteria(spark, staff):
    many = spark.range(5000).select(F.col("id").alias("floor"))
    with pytest.raises(ValueError, match="no equality"):
        select.select_by_condition(staff, many, lambda s, t: t("salary") != s("floor"))
    assert select.select_by_condition(staff, many, lambda s, t: t("salary") < s("floor") + 57000).count() == 0


def _brute(values, ranges, strict=False):
    pairs = []
    for i, x in enumerate(values):
        for low, high in ranges:
            if x is None or (low is None and high is None):
                continue
            above = True if low == "open" else low is not None and (x > low if strict else x >= low)
            below = True if high == "open" else high is not None and (x < high if strict else x <= high)
            if above and below:
                pairs.append((i, None if low == "open" else low, None if high == "open" else high))
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("compare_rows", [0, 10_000])
def test_closed_ranges_match_brute_force(rows, compare_rows):
    rng = random.Random(5)
    values = [rng.choice([0.0, rng.uniform(-50, 50), None, 1e6]) for _ in range(300)] + [float("inf"), float("-inf")]
    ranges = [(None, 3.0), (2.0, None), (5.0, 4.0), (0.0, 0.0), (-1e9, 1e9), (7.0, float("inf"))]
    for width in (0.001, 0.3, 4.0, 60.0):
        for _ in range(20):
            low = rng.uniform(-60, 60)
            ranges.append((low, low + width))
    target = rows("i int, x double", list(enumerate(values)))
    criteria = rows("lo double, hi double", ranges)
    found = range_join(target, criteria, "x", "lo", "hi", compare_rows=compare_rows).select("i", "lo", "hi")
    assert table(found) == _brute(values, ranges)


@pytest.mark.parametrize("compare_rows", [0, 10_000])
def test_open_ranges_match_brute_force(rows, compare_rows):
    rng = random.Random(6)
    values = [rng.randint(0, 40) for _ in range(200)]
    limits = [rng.randint(-5, 45) for _ in range(30)] + [None]
    target, criteria = rows("i int, x int", list(enumerate(values))), rows("t int", [(t,) for t in limits])
    above = select.select_greater(target, criteria, "x", "t", compare_rows=compare_rows).select("i", "t", F.lit(None))
    below = select.select_less(target, criteria, "x", "t", compare_rows=compare_rows).select("i", F.lit(None), "t")
    assert table(above) == _brute(values, [(t, "open") for t in limits if t is not None], True)
    assert table(below) == _brute(values, [("open", t) for t in limits if t is not None], True)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_time_windows_of_every_kind(spark, kind):
    days = spark.range(400).select(
        F.col("id").alias("i"), F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    cast = (lambda c: F.col(c).cast("string")) if kind == "string" else (lambda c: F.col(c).cast(kind))
    target = days.select("i", cast("d").alias("d"))
    windows = days.filter("i < 50").select(
        (F.col("i") * 7).alias("n"), F.date_add("d", (F.col("i") * 6).cast("int")).alias("a")
    )
    windows = windows.select("n", "a", F.date_add("a", 9).alias("b")).select(cast("a").alias("a"), cast("b").alias("b"))
    few = select.select_time_range(target, windows, "d", "a", "b")
    grid = select.select_time_range(target, windows, "d", "a", "b", compare_rows=0)
    assert table(few) == table(grid) and few.count() == 50 * 10 - _beyond(kind)


def _beyond(kind):
    # Window i starts at day 7 * i and covers ten days; days from 400 on do not exist.
    return sum(max(0, 7 * i + 10 - 400) if 7 * i < 400 else 10 for i in range(50))


def test_grid_plan_is_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(1000).select(F.col("id").alias("x"))
        criteria = spark.range(100).select(F.col("id").alias("lo"), (F.col("id") + 1).alias("hi"))
        plan = range_join(target, criteria, "x", "lo", "hi", compare_rows=0)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_contains_join_matches_brute_force(rows):
    texts = ["banana", "band", "an", "a", "", None, "nab", "BANANA", "ñandú", "a.b"]
    terms = ["an", "ana", "nana", "", "x", None, "b", "ñan", "a.b", "an"]
    target, wanted = rows("i int, s string", list(enumerate(texts))), rows("t string", [(t,) for t in terms])
    expected = sorted(
        ((i, t) for i, s in enumerate(texts) for t in terms if s is not None and t is not None and t in s), key=repr
    )
    for bound, automaton in ((0, 0), (0, 1000), (1000, 0)):
        found = contains_join(target, wanted, "s", "t", compare_rows=bound, automaton_terms=automaton).select("i", "t")
        assert table(found) == expected


def test_dispatch_skips_unknown_kinds(staff, rows):
    rules = rows(
        "kind string, v string, lo int, hi int",
        [("exact_match", "Legal", None, None), ("range", None, 60000, 70000), ("contains", "a", None, None), ("odd", "x", 1, 2)],
    )
    found = select.select_dispatch(
        staff, rules, kind="kind", value="v", lower="lo", upper="hi",
        exact_column="department", range_column="salary", contains_column="name", columns=["id"],
    )
    assert table(found) == sorted(
        [("exact_match", 6), ("exact_match", 8), ("range", 2), ("range", 6), ("contains", 1), ("contains", 8)], key=repr
    )


def test_caps_are_exact_for_a_hot_value(spark, rows):
    target = spark.range(6000).select(F.col("id"), F.when(F.col("id") < 5000, "hot").otherwise("cold").alias("k"))
    wanted = rows("k string", [("hot",), ("cold",), ("hot",)])
    capped = select.select_capped(target, wanted, "k", "-id", per_value=1500, max_results=None)
    assert {r["k"]: (r["n"], r["lo"]) for r in capped.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("lo")).collect()} == {
        "hot": (1500, 3500), "cold": (1000, 5000),
    }
    assert select.select_capped(target, wanted, "k", "id", per_value=100, max_results=150).count() == 150


def test_errors_split_criteria(rows):
    criteria = rows("i int, v string", [(0, "a"), (1, None), (2, "b")])
    good, bad = select.selection_errors(criteria, "v", "i")
    assert ids(good, "i") == [0, 2] and table(bad) == [(1, "null value")]
    good, bad = select.selection_errors(criteria, "w", "i")
    assert ids(good, "i") == [] and len(table(bad)) == 3


def test_summary_counts_repeated_criteria(staff, rows):
    wanted = rows("d string", [("Design",), ("Design",), ("Legal",), ("none",), (None,)])
    assert table(select.selection_summary(staff, wanted, {"department": "d"})) == [("Design", 6), ("Legal", 2)]
    totals = select.selection_totals(staff, wanted, {"department": "d"}).first()
    assert (totals[0], totals[1], totals[2]) == (8, 2, staff.columns)


def test_join_aggregate_equals_plain_join(staff, rows, spark):
    groups = rows("dept string, area string", [("Design", "N"), ("Design", "S"), ("Sales", "N"), ("Legal", "N")])
    ours = select.select_join_agg(
        staff, groups, {"department": "dept"}, ["area"], {"avg_salary": "salary"}, {"n": "id"}
    )
    plain = staff.join(groups, staff.department == groups.dept).groupBy("area").agg(F.avg("salary"), F.count("id"))
    assert table(ours) == table(plain)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = select.select_join_agg(
            staff, groups, {"department": "dept"}, ["area"], {"avg_salary": "salary"}, {"n": "id"}
        )
        assert table(shuffled) == table(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_validation_and_enrichment(staff, rows):
    asked = rows("k int, note string", [(1, "a"), (1, "b"), (77, "c"), (None, "d")])
    assert table(select.validate_exists(asked, staff, {"k": "id"})) == sorted(
        [(1, "a", True), (1, "b", True), (77, "c", False), (None, "d", False)], key=repr
    )
    source = rows("dept string, name string", [("Design", "x"), ("Legal", "y"), ("Ops", "z"), (None, "w")])
    enriched = select.enrich_first(source, staff, {"dept": "department"}, ["name", "salary"], order=["-salary", "id"])
    assert table(enriched) == [("Design", "Ada", 91000), ("Legal", "Hal", 99000)]


def test_audit_breakdown(rows):
    def day(n):
        return dt.datetime(2024, 1, n)

    log = rows(
        "u int, t timestamp_ntz, a string",
        [(1, day(1), "in"), (1, day(2), "in"), (1, day(3), "out"), (2, day(2), "in"), (1, None, "in"), (None, day(1), "in")],
    )
    periods = rows("who int, a timestamp_ntz, b timestamp_ntz", [(1, day(1), day(2)), (1, day(2), day(9)), (3, day(1), day(9))])
    got = select.audit_breakdown(periods, log, {"u": "who"}, time="t", start="a", end="b", action="a")
    assert table(got.drop("a", "b")) == sorted([(1, "in", 2, 2), (1, "in", 1, 2), (1, "out", 1, 2)], key=repr)


def test_overlapping_periods_equal_a_plain_count(rows):
    rng = random.Random(12)
    log = [(rng.choice([1, 2, 2, 2, None]), rng.choice([rng.randint(0, 60), rng.randint(0, 9), None]), rng.choice(["in", "out", None])) for _ in range(600)]
    spans = [(rng.choice([1, 2, 3, None]), rng.choice([rng.randint(-5, 60), None]), rng.randint(0, 70)) for _ in range(120)]
    want = set()
    for who, a, b in set(spans):
        if None in (who, a, b):
            continue
        held = [x for u, t, x in log if u == who and t is not None and a <= t <= b]
        want |= {(who, a, b, x, held.count(x), len(held)) for x in set(held)}
    found = select.audit_breakdown(
        rows("w int, a int, b int", spans), rows("u int, t int, x string", log), {"u": "w"}, time="t", start="a", end="b", action="x"
    )
    assert {tuple(r) for r in found.collect()} == want and found.count() == len(want)
    assert "SortMergeJoin" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("compare_rows", [0, 10_000])
def test_ranges_of_other_types_match_at_every_size(rows, compare_rows):
    target = rows("i int, x double, s string", [(i, i / 2, str(i)) for i in range(40)] + [(99, float("nan"), "x"), (98, None, None)])
    bounds = rows("lo string, hi decimal(9,2), a int, b int", [("3", 5, 3, 11), ("x", 5, 0, 1), ("-1", 0, 38, 50), (None, 2, 5, None)])
    found = range_join(target, bounds, "x", "lo", "hi", compare_rows=compare_rows).select("i")
    assert ids(found, "i") == sorted([6, 7, 8, 9, 10, 0])
    found = range_join(target, bounds, "s", "a", "b", compare_rows=compare_rows).select("i")
    assert ids(found, "i") == [0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 38, 39]


def test_an_outlier_does_not_fill_one_cell(spark):
    target = spark.range(2000).selectExpr("id", "cast(id AS double) AS x").union(spark.range(1).selectExpr("-1L AS id", "1e30 AS x"))
    ranges = spark.range(300).selectExpr("id * 6 + 0.5 AS lo", "id * 6 + 2.5 AS hi")
    places = {name: F.col(name) for name in ("x", "lo", "hi")}
    found = ranges_plan._cell_join(target, ranges, places, "x", "lo", "hi", F.col("x") >= F.col("lo"))
    # Pairs that share a cell and pass half of the test: near the 600 that match, not the 300 000 that a single cell would give.
    assert 600 <= found.count() <= 3000
    assert range_join(target, ranges, "x", "lo", "hi", compare_rows=0).count() == 600


def test_substrings_of_many_terms_match_brute_force(rows):
    texts = ["the cat sat", "cat", "", "a", None, "thethe", "sat the", "cat", "xyz" * 40]
    terms = ["the", "cat", "at s", "", "a", "zz", "yz", "the cat sat", None, "the"]
    target = rows("i int, s string", list(enumerate(texts)))
    wanted = rows("j int, t string", list(enumerate(terms)))
    expected = sorted((i, j) for i, s in enumerate(texts) for j, t in enumerate(terms) if s is not None and t is not None and t in s)
    for bound, automaton in ((0, 0), (0, 1000), (1000, 0)):
        found = contains_join(target, wanted, "s", "t", compare_rows=bound, automaton_terms=automaton).select("i", "j").collect()
        assert sorted(map(tuple, found)) == expected
