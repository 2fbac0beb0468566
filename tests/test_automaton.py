"""The automaton against plain substring tests."""

import random
import time

import pyarrow as pa
import pytest

from tablekeeper.plans import automaton, grams
from tablekeeper.plans.automaton import Automaton, held_terms
from tablekeeper.plans.grams import contains_join


def test_every_pair_is_found_whatever_the_lanes(monkeypatch):
    rng = random.Random(1)
    for _ in range(200):
        letters = rng.choice(["ab", "abc", "aé", "abcdefgh"])
        some = lambda most: "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))  # noqa: E731, B023
        terms = sorted({some(rng.choice([2, 5, 30])) for _ in range(rng.randint(0, 30))} - {""})
        texts = [rng.choice([some(5), some(100), some(800), None]) for _ in range(rng.randint(0, 12))]
        monkeypatch.setattr(automaton, "LANES", rng.choice([1, 3, 4096]))
        monkeypatch.setattr(automaton, "LANE_BYTES", rng.choice([1, 2, 7, 64]))
        monkeypatch.setattr(automaton, "TABLE_BYTES", rng.choice([0, 1 << 20]))
        monkeypatch.setattr(automaton, "BATCH_BYTES", rng.choice([1, 50, 1 << 20]))
        got = held_terms(pa.array(texts, pa.string()), Automaton([t.encode() for t in terms])).to_pylist()
        assert got == [[i for i, t in enumerate(terms) if t in (x or "")] for x in texts]


@pytest.mark.parametrize("table", [0, 1 << 25])
def test_time_is_linear_in_the_text_where_terms_and_text_repeat(monkeypatch, table):
    monkeypatch.setattr(automaton, "TABLE_BYTES", table)
    machine = Automaton([("ab" * 500).encode(), b"b", b"ba" * 300, b"a" * 400])
    spent = []
    for size in (200_000, 1_600_000):
        start = time.perf_counter()
        assert held_terms(pa.array(["ab" * size]), machine).to_pylist() == [[0, 1, 2]]
        spent.append(time.perf_counter() - start)
    assert spent[1] < 24 * spent[0]


def test_terms_must_differ():
    for terms in ([b"a", b"a"], [b""]):
        with pytest.raises(ValueError, match="differ"):
            Automaton(terms)


def test_join_by_automaton_does_not_move_the_texts(spark, rows):
    wanted = rows("t string, kind int", [(f"w{i}", i % 3) for i in range(500)] + [("", 9), (None, 9), ("w7", 8)])
    texts = spark.range(2000).selectExpr("id", "if(id % 50 = 0, null, concat('x w', id % 600, '!')) AS s")
    found = contains_join(texts, wanted, "s", "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "row_hash" not in plan and "xxhash64" not in plan
    want = []
    for i in range(2000):
        if i % 50:
            text = f"x w{i % 600}!"
            want += [(f"w{k}", k % 3, i) for k in range(500) if f"w{k}" in text] + [("", 9, i)] + ([("w7", 8, i)] if "w7" in text else [])
    assert sorted(tuple(r) for r in found.select("t", "kind", "id").collect()) == sorted(want)


def test_grams_of_a_small_file_are_made_by_all_tasks(spark):
    names = spark.range(500).selectExpr("id", "concat('Customer#', lpad(id, 9, '0')) AS name").coalesce(1)
    terms = spark.range(50).selectExpr("concat('Customer#', lpad(id, 8, '0')) AS term")
    found = contains_join(names, terms, "name", "term", compare_rows=0, automaton_terms=0)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 500


def test_grams_of_texts_are_not_broadcast(spark, tmp_path, monkeypatch):
    spark.range(500).selectExpr("id", "concat('Customer#', lpad(id, 9, '0')) AS name").write.parquet(str(tmp_path / "names"))
    names = spark.read.parquet(str(tmp_path / "names"))
    terms = spark.range(50).selectExpr("concat('Customer#', lpad(id, 8, '0')) AS term")
    for most in (10_000, 0):
        monkeypatch.setattr(grams, "BROADCAST_ROWS", most)
        found = contains_join(names, terms, "name", "term", compare_rows=0, automaton_terms=0)
        joins = [j for j in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in j and "__gram" in j]
        assert joins and all("strategy=broadcast" in j for j in joins[:1]) if most else all("strategy=merge" in j for j in joins)
        assert found.count() == 500
