import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import clean
from tablekeeper.operators.select import first_per_key
from tablekeeper.plans import ranks
from tablekeeper.plans.ranks import By, order_by
from tests.conftest import ids, table

# Bounds small enough that a few hundred rows take the sampled path.
TIGHT = {"top_rows": 0, "rest_rows": 20, "sample_rows": 50}


@pytest.fixture(scope="module")
def numbers(spark):
    """800 rows; a third share the value 7, some are null."""
    from tablekeeper.sources.files import literal_rows

    rng = random.Random(11)
    data = []
    for i in range(800):
        value = 7.0 if i % 3 == 0 else None if i % 37 == 0 else round(rng.uniform(-100, 100), 3)
        data.append((i, value, rng.choice("abc")))
    return literal_rows(spark, "id int, x double, tag string", data).repartition(5).cache(), data


def _sorted(data, descending=False):
    """Nulls first ascending, last descending; ties by id."""
    sign = -1 if descending else 1
    return sorted(data, key=lambda r: ((r[1] is not None) * sign, sign * (r[1] or 0.0), r[0]))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("bounds", [TIGHT, {}])
def test_key_at_every_kind_of_rank(numbers, descending, bounds):
    frame, data = numbers
    ordered = _sorted(data, descending)
    spec = [By(F.col("x"), descending), By(F.col("id"))]
    for rank in (0, 22, 300, 500, 799):
        found = ranks.key_at(frame, spec, rank, **bounds)
        value = None if found.key[0] is None else float(found.key[0])
        assert (value, int(found.key[1])) == (ordered[rank][1], ordered[rank][0])
        assert found.last
    assert ranks.key_at(frame, spec, 800, **bounds) is None


@pytest.mark.parametrize("bounds", [TIGHT, {}])
def test_key_at_knows_ties(numbers, bounds):
    frame, data = numbers
    values = [r[1] for r in _sorted(data)]
    for rank in (0, 300, 450, values.index(7.0), len(values) - 1 - values[::-1].index(7.0)):
        found = ranks.key_at(frame, order_by("x"), rank, **bounds)
        assert found.last == (rank + 1 == len(values) or values[rank + 1] != values[rank])


@pytest.mark.parametrize("bounds", [TIGHT, {}])
@pytest.mark.parametrize("rows", [0, 3, 500, 800, 900])
def test_split_at_is_exact_on_ties(numbers, bounds, rows):
    frame, data = numbers
    values = sorted((r[1] is not None, r[1] or 0.0) for r in data)
    first, rest = ranks.split_at(frame, order_by("x"), rows, **bounds)
    kept = [(r.x is not None, r.x or 0.0) for r in first.collect()]
    assert sorted(kept) == values[:rows]
    assert sorted(ids(first) + ids(rest)) == list(range(800))


def test_split_at_handles_equal_rows(rows):
    frame = rows("a int, b string", [(1, "x")] * 10 + [(1, "y")] * 3 + [(0, "z"), (2, "w")])
    for n in range(16):
        first, rest = ranks.split_at(frame, order_by("a"), n)
        assert first.count() == min(n, 15) and first.count() + rest.count() == 15


@pytest.mark.parametrize("bounds", [TIGHT, {}])
@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.6, 0.995, 1.0])
def test_quantiles_equal_numpy(numbers, bounds, fraction):
    frame, data = numbers
    values = np.array([r[1] for r in data if r[1] is not None])
    assert ranks.quantile(frame, "x", fraction, **bounds) == pytest.approx(np.quantile(values, fraction), abs=1e-9)
    disc = np.sort(values)[max(0, math.ceil(fraction * len(values)) - 1)]
    assert ranks.quantile(frame, "x", fraction, linear=False, **bounds) == disc
    assert ranks.quantile(frame.filter("id < 0"), "x", fraction) is None


def test_positions_without_a_global_sort(numbers):
    frame, data = numbers
    placed = ranks.with_positions(frame, [By(F.col("x"), True), By(F.col("id"))], parts=4)
    assert [r.id for r in placed.orderBy("position").collect()] == [r[0] for r in _sorted(data, True)]
    assert ids(placed, "position") == list(range(800))


@pytest.mark.parametrize("many", [[], list(range(100, 400, 20))])
@pytest.mark.parametrize("bounds", [TIGHT, {}])
def test_delete_positions(numbers, bounds, many):
    frame, data = numbers
    ordered = [r[0] for r in _sorted(data)]
    wanted = [0, 2, 4, 333, 799] + many
    left = clean.delete_positions(frame, ["x", "id"], wanted, key="id", **bounds)
    assert ids(left) == sorted(set(ordered) - {ordered[p] for p in wanted})
    with pytest.raises(IndexError):
        clean.delete_positions(frame, "id", [3, 800], key="id", **bounds)
    with pytest.raises(IndexError):
        clean.delete_positions(frame, "id", [-1], key="id")
    assert clean.delete_positions(frame, "id", [], key="id") is frame


@pytest.mark.parametrize("bounds", [TIGHT, {}])
def test_ranges_pages_and_tops(numbers, bounds):
    frame, data = numbers
    ordered = [r[0] for r in _sorted(data)]
    for start, stop in ((2, 5), (0, 3), (790, 9999), (400, 700), (5, 5), (-3, 1)):
        left = clean.delete_position_range(frame, ["x", "id"], start, stop, **bounds)
        a = max(start, 0)
        assert ids(left) == sorted(ordered[:a] + ordered[max(stop, a):]), (start, stop)
    assert [r.id for r in clean.page(frame, ["x", "id"], 10, 7, **bounds).collect()] == ordered[10:17]
    assert [r.id for r in clean.tail(frame, ["x", "id"], 6, **bounds).collect()] == ordered[-6:]
    largest = sorted((r for r in data if r[1] is not None), key=lambda r: (-r[1], r[0]))[:9]
    assert ids(clean.delete_top_n(frame, "x", 9, "id", **bounds)) == sorted(set(range(800)) - {r[0] for r in largest})


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_exact_sample(numbers, method):
    frame, _ = numbers
    bounds = {**TIGHT, "method": method}
    kept = ids(clean.sample_exact(frame, "id", 0.7, **bounds))
    assert len(kept) == 560 and kept == ids(clean.sample_exact(frame, "id", 0.7, method=method))
    assert kept != ids(clean.sample_exact(frame, "id", 0.7, seed=1))
    assert clean.sample_exact(frame, "tag", 0.5, **bounds).count() == 400
    assert 0 < clean.sample_about(frame, 0.5).count() < 800


def test_fractions_and_outliers(numbers):
    frame, data = numbers
    values = np.array([r[1] for r in data if r[1] is not None])
    top, low = np.quantile(values, 0.8), np.quantile(values, 0.2)
    assert clean.drop_top_fraction(frame, "x").count() == (values <= top).sum()
    assert clean.drop_bottom_fraction(frame, "x").count() == (values > low).sum()
    mean, sd = values.mean(), values.std(ddof=1)
    assert clean.drop_outliers(frame, "x", 1.0, "upper").count() == (values <= mean + sd).sum()
    assert clean.drop_outliers(frame, "x", 1.0).count() == (abs(values - mean) <= sd).sum()
    assert clean.drop_outliers(frame.limit(1), "x").count() == 0


def test_duplicates(rows):
    data = [(1, "a", 1), (2, "a", 1), (3, None, 1), (4, None, 1), (5, "b", None), (6, "c", 2), (6, "c", 2)]
    frame = rows("id int, k string, n int", data)
    assert frame.count() - clean.drop_duplicates(frame).count() == 1
    assert ids(clean.drop_duplicates(frame, ["k", "n"], "first", "id")) == [1, 3, 5, 6]
    assert ids(clean.drop_duplicates(frame, ["k", "n"], "last", "id")) == [2, 4, 5, 6]
    assert ids(clean.drop_duplicates(frame, ["k", "n"], "none")) == [5]
    assert ids(clean.drop_duplicates(frame, keep="none")) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="order key is required"):
        clean.drop_duplicates(frame, ["k"])
    with pytest.raises(ValueError, match="keep must"):
        clean.drop_duplicates(frame, ["k"], "some")


def test_first_per_key_is_limited_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = clean.drop_duplicates(frame, ["k"], "first", "id")._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    # The plan is printed from the last step to the first: the partial step stands below the exchange.
    assert "partial_min_by" in plan[exchange:] and "partial_min_by" not in plan[:exchange]
    frame = frame.withColumn("x", -F.col("id"))
    plan = clean.drop_duplicates(frame, ["k"], "first", ["id", "-x"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]


@pytest.mark.parametrize("descending", [False, True])
def test_first_row_and_window_agree(numbers, descending):
    frame, _ = numbers
    sign = "-" if descending else ""
    one = clean.drop_duplicates(frame, ["tag"], "first", [f"{sign}x", f"{sign}id"])
    window = first_per_key(frame, ["tag"], [f"{sign}x", f"{sign}id"], rows=2)
    assert set(table(one)) < set(table(window)) and one.count() == 3
    mixed = first_per_key(frame, ["tag"], [f"{sign}x", f"{sign}id", ("" if descending else "-") + "tag"])
    assert table(mixed) == table(one)


def test_missing(staff):
    assert ids(clean.drop_missing(staff)) == [1, 2, 3]
    assert ids(clean.drop_missing(staff, subset=["salary", "hired"])) == [1, 2, 3, 5, 6, 7]
    assert clean.drop_missing(staff.select("level", "active"), how="all").count() == 7
    assert dict(table(clean.missing_counts(staff))) == {
        "id": 0, "name": 1, "department": 1, "level": 1, "salary": 1, "hired": 1, "active": 1,
    }
    assert ids(clean.keep_where(staff, F.col("salary") <= 72000)) == [2, 3, 6]


def test_profiles(staff):
    profile = {r.column_name: (r.type, r.distinct_values, r.missing) for r in clean.profile_criteria(staff).collect()}
    assert profile["department"] == ("string", 3, 1) and profile["salary"] == ("int", 6, 1)
    stats = {r.column_name: r for r in clean.column_stats(staff).collect()}
    assert (stats["salary"].minimum, stats["salary"].maximum, stats["salary"].missing) == ("61000", "99000", 1)
    assert clean.table_counts(staff, ["department"]).first()[:] == (8, 4)
    assert clean.table_counts(staff.limit(0)).first()[:] == (0, 0)


def test_rank_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).write.parquet(path)
    frame = spark.read.parquet(path)
    first, rest = ranks.split_at(frame, order_by("id"), 100)
    for part in (first, rest):
        plan = part._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert "(id," in pushed.split("]")[0]


def test_top_n_by_every_orderable_type(spark):
    frame = spark.range(40).selectExpr(
        "id",
        "unhex(hex(id)) AS b",
        "timestamp_micros(id * 1000003) AS t",
        "cast(id AS decimal(20,3)) AS d",
        "date_add(date'2020-01-01', cast(id AS int)) AS day",
        "lpad(cast(id AS string), 5, 'ü') AS s",
        "id % 2 = 0 AS flag",
        "cast(id AS float) / 3 AS f",
    )
    for name in ("b", "t", "d", "day", "s", "flag", "f"):
        order = sorted(((r[name], -r["id"]) for r in frame.collect()), reverse=True)[:7]
        left = clean.delete_top_n(frame, name, 7, "id", top_rows=0, rest_rows=5, sample_rows=50)
        assert ids(left) == sorted(set(range(40)) - {-i for _, i in order}), name


def test_positions_are_searched_together(spark):
    frame = spark.range(5000).selectExpr("id", "id * 7919 % 5000 AS x", "id % 3 AS tied")
    for order in ("x", ["tied", "id"]):
        wanted = [0, 17, 1666, 1667, 2500, 4999]
        key = (lambda r: r.x) if order == "x" else (lambda r: (r.tied, r.id))
        rows_ = sorted(frame.collect(), key=key)
        left = clean.delete_positions(frame, order, wanted, key="id", top_rows=0, rest_rows=40, sample_rows=400)
        assert ids(left) == sorted(r.id for i, r in enumerate(rows_) if i not in wanted)
