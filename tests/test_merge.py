import pytest
from pyspark.sql import functions as F

from tablekeeper.operators.merge import Merge, source_checks, upsert
from tests.conftest import table

SCHEMA = "id int, name string, qty int"


@pytest.fixture(params=["broadcast", "shuffle"])
def either_join(spark, request):
    """Run a test with broadcast joins and with shuffled joins."""
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def target(rows):
    """Key 2 repeats, one key is null, key 5 is unknown to the source."""
    return rows(SCHEMA, [(1, "a", 10), (2, "b", 20), (2, "bb", 22), (3, "c", None), (5, "e", 50), (None, "n", 0)])


@pytest.fixture
def source(rows):
    return rows("id int, name string, qty int", [(1, "A", 5), (2, "B", 99), (3, "C", 7), (8, "H", 1), (9, None, -1), (None, "N", 3)])




def test_every_clause_kind(either_join, target, source):
    merged = (
        Merge(target, source, "id")
        .when_matched_delete(lambda t, s: s("qty") < 6)
        .when_matched_update({"qty": lambda t, s: t("qty") + s("qty")}, when=lambda t, s: t("qty") > 20)
        .when_matched_update({"name": "name", "qty": F.lit(0)}, when=lambda t, s: t("qty").isNotNull())
        .when_not_matched_insert({"id": "id", "qty": "qty"}, when=lambda t, s: s("qty") > 2)
        .when_not_matched_insert(when=lambda t, s: s("name") == "H")
        .when_not_matched_by_source_update({"name": F.lit("old")}, when=lambda t, s: t("qty") == 0)
        .when_not_matched_by_source_delete(lambda t, s: t("id") == 5)
        .result()
    )
    assert merged.schema == target.schema
    assert table(merged) == sorted(
        [
            (2, "B", 0),  # 20 is not above 20: the next clause takes it
            (2, "bb", 121),
            (3, "c", None),  # no clause is true: unchanged
            (None, "old", 0),  # a null key matches nothing
            (None, None, 3),  # and is inserted
            (8, "H", 1),
        ],
        key=repr,
    )


def test_update_and_insert_all_columns(either_join, target, rows):
    source = rows("key int, qty bigint, name string", [(1, 7, "x"), (4, 8, "y")])
    merged = Merge(target, source, {"id": "key"}).when_matched_update().when_not_matched_insert().result()
    assert table(merged) == sorted(
        [(1, "x", 7), (2, "b", 20), (2, "bb", 22), (3, "c", None), (5, "e", 50), (None, "n", 0), (4, "y", 8)], key=repr
    )


def test_without_inserts(either_join, target, source):
    merged = Merge(target, source, "id").when_matched_delete().result()
    assert table(merged) == [(5, "e", 50), (None, "n", 0)]
    synced = Merge(target, source, "id").when_not_matched_by_source_delete().result()
    assert table(synced) == sorted([(1, "a", 10), (2, "b", 20), (2, "bb", 22), (3, "c", None)], key=repr)


def test_expressions_use_old_values(either_join, target, rows):
    source = rows("id int, d int", [(1, 1)])
    merged = Merge(target, source, "id").when_matched_update(
        {"qty": lambda t, s: t("qty") + s("d"), "name": lambda t, s: F.concat(t("name"), t("qty").cast("string"))}
    )
    assert (1, "a10", 11) in table(merged.result())


@pytest.mark.parametrize("inserts", [True, False])
def test_repeated_source_key_fails_only_if_it_matches(either_join, target, rows, inserts):
    def merge(data):
        plan = Merge(target, rows(SCHEMA, data), "id").when_matched_update()
        return plan.when_not_matched_insert() if inserts else plan

    with pytest.raises(Exception, match="merge source holds 2 rows for key"):
        merge([(1, "x", 1), (1, "y", 2)]).result().collect()
    with pytest.raises(Exception, match="merge source holds 2 rows for key"):
        merge([(1, "x", 1), (1, "y", 2)]).result().count()
    unmatched = merge([(1, "x", 1), (7, "y", 2), (7, "z", 3), (None, "p", 0), (None, "q", 0)]).result()
    assert unmatched.count() == (10 if inserts else 6)


def test_composite_keys(either_join, rows):
    target = rows("a int, b string, n int", [(1, "x", 1), (1, "y", 1), (2, "x", 1)])
    source = rows("a int, b string, n int", [(1, "x", 5), (2, "y", 6), (2, None, 7)])
    merged = (
        Merge(target, source, ["a", "b"])
        .when_matched_update({"n": lambda t, s: t("n") + s("n")})
        .when_not_matched_insert()
        .result()
    )
    assert table(merged) == sorted([(1, "x", 6), (1, "y", 1), (2, "x", 1), (2, "y", 6), (2, None, 7)], key=repr)


def test_unknown_columns_are_refused(target, source):
    with pytest.raises(ValueError, match="no columns"):
        Merge(target, source, "id").when_matched_update({"nope": "qty"}).result()


def test_upsert_equals_the_merge(either_join, target, source):
    expected = Merge(target.filter("id <> 2 or id is null"), source, "id").when_matched_update().when_not_matched_insert()
    assert table(upsert(target.filter("id <> 2 or id is null"), source, "id")) == table(expected.result())


def test_source_checks(rows):
    source = rows("k int, j int", [(1, 1), (1, 1), (2, None), (3, 1), (None, None)])
    assert table(source_checks(source, ["k", "j"])) == sorted([(1, 1, 2), (2, None, 1), (None, None, 1)], key=repr)
    assert table(Merge(source, source, ["k", "j"]).source_problems()) == table(source_checks(source, ["k", "j"]))


def test_small_source_does_not_shuffle_the_target(spark, rows, tmp_path):
    path = str(tmp_path / "big")
    spark.range(200_000).select("id", F.lit(0).alias("n")).write.parquet(path)
    big, source = spark.read.parquet(path), rows("id bigint, n int", [(3, 1), (900_000, 1)])
    merged = Merge(big, source, "id").when_matched_update().when_not_matched_insert().result()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert merged.filter("n = 1").count() == 2 and merged.count() == 200_001


def test_upsert_refuses_a_repeated_key(rows):
    target = rows("k int, v string", [(1, "a"), (2, "b")])
    source = rows("k int, v string", [(1, "x"), (1, "y"), (3, "z"), (None, "n"), (None, "m")])
    with pytest.raises(Exception, match="2 rows for key"):
        upsert(target, source, "k").collect()
    with pytest.raises(Exception, match="2 rows for key"):
        upsert(target.limit(0), source, "k").collect()
    assert upsert(target, source, "k", check=False).count() == 6
    assert upsert(target, source.filter("v <> 'y'"), "k").count() == 5
