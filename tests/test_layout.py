"""Clustering along a curve and sketches that merge."""

import glob
import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import sketches
from tablekeeper.plans import digests
from tablekeeper.plans.curve import place, write_clustered


def files_for(folder, column, low, high):
    """How many of the files may hold a value between the two, by their footers."""
    found = []
    for name in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found.append(min(s.min for s in stats) <= high and max(s.max for s in stats) >= low)
    return sum(found), len(found)


def test_a_filter_on_either_column_skips_most_files(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "cast(pmod(hash(id), 5000) AS int) AS x", "concat('2024-', pmod(hash(id + 7), 9000)) AS y")
    write_clustered(rows, str(tmp_path / "curve"), ["x", "y"], 16)
    rows.repartitionByRange(16, "x").sortWithinPartitions("x", "y").write.parquet(str(tmp_path / "line"))
    for column, low, high in (("x", 100, 160), ("y", "2024-3100", "2024-3150")):
        hit, all_ = files_for(tmp_path / "curve", column, low, high)
        assert all_ >= 12 and hit <= all_ * 0.45
    assert files_for(tmp_path / "line", "y", "2024-3100", "2024-3150")[0] == 16
    back = spark.read.parquet(str(tmp_path / "curve"))
    assert back.columns == ["id", "x", "y"] and back.exceptAll(rows).isEmpty() and back.count() == 20_000
    with pytest.raises(ValueError, match="a column"):
        write_clustered(rows, str(tmp_path / "none"), [], 4)


def test_places_of_nulls_hot_values_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, None)] * 5 + [(7, 1.0)] * 900 + [(i, float(i)) for i in range(100)], "a int, b double")
    placed = rows.select("a", "b", place(rows, ["a", "b"]).alias("at"))
    assert placed.filter("a IS NULL").select("at").distinct().collect()[0]["at"] == 0
    assert placed.filter("a = 7 AND b = 1.0").select("at").distinct().count() == 1
    empty = rows.limit(0)
    assert empty.select(place(empty, ["a"]).alias("at")).count() == 0


def test_merged_sketches_keep_the_bound_of_one(spark):
    rows = spark.range(60_000).selectExpr("id % 13 AS g", "id % 7 AS h", "cast(id * 37 % 20011 AS int) AS n", "cast(id % 3001 AS string) AS s", "if(id % 10 = 0, null, timestamp_micros(id * 1000000)) AS t")
    parts = sketches.sketch(rows, ["n", "s", "t"], ["g", "h"])
    assert parts.count() == 3 * 13 * 7
    whole = {r["column_name"]: r for r in sketches.estimates(sketches.merged(sketches.merged(parts, ["g"])), [0.1, 0.5, 0.9]).collect()}
    once = {r["column_name"]: r for r in sketches.estimates(sketches.sketch(rows, ["n", "s", "t"]), [0.1, 0.5, 0.9]).collect()}
    exact = {"n": 20_011, "s": 3_001, "t": 54_000}
    for found in (whole, once):
        for name, distinct in exact.items():
            assert abs(found[name]["distinct_values"] - distinct) <= 0.04 * distinct
            assert (found[name]["rows"], found[name]["missing"]) == (60_000, 6_000 if name == "t" else 0)
        assert found["s"]["quantiles"] is None
        for share, value in zip((0.1, 0.5, 0.9), found["n"]["quantiles"], strict=True):
            assert abs(rows.filter(F.col("n") <= value).count() / 60_000 - share) < 0.02
        assert abs(found["t"]["quantiles"][1] - 30_000) < 0.03 * 60_000
    empty = sketches.estimates(sketches.sketch(rows.limit(0), ["n", "s"])).collect()
    assert [(r["rows"], r["distinct_values"], r["quantiles"]) for r in empty] == [(0, 0, None)] * 2
    assert not math.isnan(whole["n"]["quantiles"][0])


KEYS = {"int": "cast(id % 700 AS int)", "string": "concat('k', id % 700)", "timestamp": "timestamp_micros(id % 700 * 1000001)", "double": "if(id % 90 = 0, double('NaN'), id % 700 / 3)"}


@pytest.mark.parametrize("kind", list(KEYS))
def test_difference_by_digests_equals_every_row_compared(spark, kind):
    before = spark.range(3_000).selectExpr(f"if(id % 400 = 1, null, {KEYS[kind]}) AS k", "id % 11 AS a", "cast(id % 3 AS string) AS b")
    after = before.filter("a <> 4 OR k IS NULL OR b <> '1'").unionAll(before.filter("b = '2' AND a = 7").limit(5)).selectExpr("k", "if(a = 9 AND b = '0', null, a) AS a", "b")
    for one, two in ((before, after), (after, before), (before, before), (before, before.limit(0)), (before.limit(0), before)):
        found = digests.table_diff(one, two, "k", ranges=16, few=10)
        want = one.exceptAll(two).withColumn("change", F.lit("removed")).unionAll(two.exceptAll(one).withColumn("change", F.lit("added")))
        rows = lambda f: sorted(map(repr, f.select("k", "a", "b", "change").collect()))
        assert rows(found) == rows(want)


def test_one_changed_row_reads_one_range(spark):
    before = spark.range(200_000).selectExpr("id", "id % 13 AS v")
    after = before.withColumn("v", F.when(F.col("id") == 123_456, 99).otherwise(F.col("v")))
    scope = digests.differing(before, after, "id", few=10)
    assert before.filter(scope).count() <= 200 and digests.table_diff(before, after, "id").count() == 2
    repeated = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id int, v string")
    swapped = spark.createDataFrame([(1, "z"), (1, "z"), (2, "y")], "id int, v string")
    assert digests.table_diff(repeated, swapped, "id").count() == 4
