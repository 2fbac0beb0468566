"""A third of all rows on one key: adaptive execution must split it, or it must shrink before it moves."""

import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import clean, delete, select
from tablekeeper.operators.merge import Merge
from tablekeeper.plans.ranges import range_join

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
ROWS = 120_000


@pytest.fixture(autouse=True)
def settings(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.fixture
def hot(spark):
    """Key 7 holds a third of the rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, ROWS, 1, 16).select(F.col("id"), key.alias("k"), F.xxhash64("id").alias("v"))


@pytest.fixture
def many_keys(spark):
    return spark.range(0, 60_000, 1, 8).select(F.col("id").alias("c"), (F.col("id") * 2).alias("w"))


def final_plan(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_keyed_delete_splits_the_hot_key(hot, many_keys):
    plan = delete.delete_by_keys(hot, many_keys.filter("c <> 7"), {"k": "c"})
    rows, text = final_plan(plan.kept())
    assert "skew=true" in text
    assert len(rows) == hot.filter("k = 7 OR k >= 60000").count()
    _, text = final_plan(plan.flagged())
    assert "skew=true" in text


def test_selection_splits_the_hot_key(hot, many_keys):
    rows, text = final_plan(select.select_by_columns(hot, many_keys, {"k": "c"}))
    assert "skew=true" in text and len(rows) == hot.filter("k < 60000").count()


def test_merge_splits_the_hot_target_key(hot, many_keys):
    merge = Merge(hot, many_keys, {"k": "c"}).when_matched_update({"v": "w"}).when_not_matched_insert({"k": "c", "v": "w"})
    rows, text = final_plan(merge.result())
    assert "skew=true" in text
    held = {r.k for r in hot.select("k").distinct().collect()}
    assert len(rows) == ROWS + sum(1 for c in range(60_000) if c not in held)
    assert sum(r.v == 14 for r in rows if r.k == 7) >= ROWS // 3


def test_range_join_splits_the_hot_cell(hot, many_keys):
    ranges = many_keys.select(F.col("c").alias("lo"), (F.col("c") + 1).alias("hi")).filter("lo < 5000")
    rows, text = final_plan(range_join(hot, ranges, "k", "lo", "hi", compare_rows=0))
    assert "skew=true" in text
    expected = hot.filter("k <= 5000").count() * 2 - hot.filter("k = 0 OR k = 5000").count()
    assert len(rows) == expected


def test_groupings_shrink_the_hot_key_first(spark, hot):
    firsts = clean.drop_duplicates(hot, ["k"], "first", "id")
    text = firsts._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in text[text.index("Exchange") :]
    assert firsts.count() == hot.select("k").distinct().count()
    counts = select.selection_summary(hot, hot.select("k"), "k")
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_count") == 2
    assert counts.filter("search_value = 7").first().matches == hot.filter("k = 7").count() ** 2


def test_capped_selection_cuts_in_every_task_first(hot, many_keys):
    capped = select.select_capped(hot, many_keys, {"k": "c"}, "id", per_value=5, max_results=None)
    text = capped._jdf.queryExecution().executedPlan().toString()
    assert text.index("SortMergeJoin") < text.index("WindowGroupLimit")
    assert capped.filter("k = 7").count() == 5


def test_audit_counts_a_busy_key_in_parts(hot, spark):
    periods = spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("a"), F.lit(ROWS).alias("b"))
    log = hot.withColumn("act", F.lit("x"))
    got = select.audit_breakdown(periods, log, "k", time="id", start="a", end="b", action="act")
    text = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [sum(__one" in line]
    assert len(windows) == 1 and "__part" in windows[0].split("], [")[1]
    assert got.filter("k = 7").first().n == hot.filter("k = 7").count()
