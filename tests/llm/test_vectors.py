"""Whitening against exact fractions and numpy."""

import math
import random

import numpy as np
import pytest

from tablekeeper.llm import whitening
from tablekeeper.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_whitening(vectors):
    """n, deviations, V's falling eigenvalues with their vectors, and x, of equally long vectors without nulls."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(row[k] for row in x) for k in range(d)]
    z = [[n * row[k] - total[k] for k in range(d)] for row in x]
    v = np.array([[sum(r[i] * r[j] for r in z) / n**3 for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(v)
    return n, [sum(c * c for c in r) for r in z], values[::-1], axes[:, ::-1], np.array(z) / n


def compare(found, vectors, key):
    n, deviations, values, axes, centred = plain_whitening(vectors)
    k = min(8, len(values))
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    got = np.full_like(want, np.nan)
    for r in found:
        row, at = key[r["vec_id"]], r["component"] - 1
        got[row, at] = r["whitened"]
        assert r["n"] == n and int(r["deviation_exact"]) == deviations[row]
        assert r["deviation"] == (deviations[row] if deviations[row] < 2**63 else None)
        assert r["explained"] == pytest.approx(values[at] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-6 * np.abs(want).max()


def test_whitening_query_equals_plain(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    found = QUERIES["op11_whitening"](spark, SMALL).collect()
    assert len(found) == 8 * len(rows)
    compare(found, [r["embedding"] for r in rows], {r["vec_id"]: i for i, r in enumerate(rows)})


def test_whitening_of_wide_values_and_odd_rows(spark, monkeypatch, tmp_path):
    """Values past 64-bit squares, nulls, other lengths, repeated rows, clashing names."""
    rng = random.Random(4)
    good = [[rng.uniform(-1, 1) * 10 ** rng.randint(0, 11) for _ in range(5)] for _ in range(60)]
    good += [good[3], good[3]]
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [math.nan] * 5, [math.inf, 1.0, 1.0, 1.0, 1.0], [1.0], [2.0, 3.0]]
    rows = [(i, v, i, "x") for i, v in enumerate(good)] + [(1000 + i, v, i, None) for i, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, _n int, _rest string").repartition(5)
    found = whitening.whiten(frame)
    assert found.columns == ["vec_id", "_rest", *whitening.ADDED]
    flat = [
        {"vec_id": r["vec_id"], "component": k + 1, "n": r["_n"], "deviation_exact": r["_deviation"], "whitened": w,
         "deviation": int(r["_deviation"]) if r["_deviation"] < 2**63 else None,
         "explained": r["_explained"][k], "identity_error": r["_identity_error"]}
        for r in found.collect() for k, w in enumerate(r["_whitened"])
    ]
    assert {r["vec_id"] for r in flat} == set(range(len(good)))
    compare(flat, good, {i: i for i in range(len(good))})


@pytest.mark.parametrize("scale", [1, 1e6, 1e9, 1e15])
def test_deviations_are_exact_at_every_size(scale):
    rng = np.random.default_rng(3)
    y = (rng.normal(size=(20, 7)) * scale).astype(np.int64)
    left = [int(v) for v in y.sum(axis=0)]
    want = [sum((20 * int(c) - s) ** 2 for c, s in zip(row, left, strict=True)) for row in y]
    got = whitening.deviations(y, 20, np.array(left, object)).to_pylist()
    assert got == [w if w < 10**38 else None for w in want]


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["_n"], int(r["_deviation"]), r["_whitened"], r["_explained"], r["_identity_error"]) for r in one] == [
        (2, 0, [None, None], [0.0, 0.0], 0.0)
    ] * 2
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 5.0]) for i in range(9)], schema)).collect()
    assert all(r["_whitened"][1] is None and r["_explained"] == [1.0, 0.0] and r["_identity_error"] < 1e-9 for r in line)
    for rows in ([], [(1, None), (2, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
