"""Operators that compare texts or vectors with each other, the mix, and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from tablekeeper.llm import components, licences, mixing, passages, repeats, simhash, suffixes, vectors
from tablekeeper.llm.queries import ORACLES, QUERIES
from tests.check_oracles import connect, differences
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


def shared_rows(seed=3):
    """Texts that share passages, copies, repeats inside a text, nulls, ties and one long text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    common = [" ".join(word() for _ in range(60)) for _ in range(3)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 50)))]
        if rng.random() < 0.6:
            parts.append(rng.choice(common)[: rng.randint(10, 400)])
        if rng.random() < 0.2:
            parts.append(parts[0])
        rng.shuffle(parts)
        rows.append((i, "  ".join(parts)))
    rows += [(70 + i, rows[5][1]) for i in range(5)]
    rows += [(80, "ab" * 200), (81, "a" * 300), (82, "a" * 120), (83, " ".join(["x"] * 200)), (84, " ".join(common * 30))]
    return rows + [(90, None), (91, ""), (92, " \n"), (None, rows[7][1]), (5, rows[5][1]), (6, rows[9][1])]


@pytest.fixture(scope="module")
def shared(spark):
    return shared_rows(), spark.createDataFrame(shared_rows(), "doc_id long, text string")


def test_passages_equal_brute_force(spark, shared):
    rows, docs = shared
    for window in (35, 8, 1):
        odd = docs.selectExpr("*", "doc_id AS _id", "1 AS _at", "text AS _kept")
        found = passages.remove_repeats(odd, window=window).collect()
        got = sorted(((r["doc_id"], r["text"]), (r["_n_words"], r["_n_removed"], r["_kept"]), r["_id"]) for r in found if r["doc_id"] is not None)
        want = sorted((row, out, row[0]) for row, out in zip(rows, plain.passages(rows, window)) if row[0] is not None)
        assert len(found) == len(rows) and sorted(got, key=str) == sorted(want, key=str)
        for r in found:
            assert sum(s["end"] - s["start"] for s in r["_spans"]) == r["_n_removed"]
    assert passages.remove_repeats(docs.limit(0)).count() == 0


def test_covers_hold_every_difference():
    for period, cover in passages.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_earlier_strings_equal_brute_force(spark, shared):
    rows, docs = shared
    odd = docs.selectExpr("*", "doc_id AS _th", "1 AS _spans", "text AS bucket")
    found = suffixes.remove_earlier(odd).collect()
    got = [((r["doc_id"], r["text"]), (r["_n_bytes"], r["_n_removed"], len(r["_spans"]), bytes(r["_kept"]))) for r in found]
    assert sorted(got, key=str) == sorted(zip(rows, plain.earlier(rows, 50)), key=str)
    assert suffixes.remove_earlier(docs.limit(0)).count() == 0


def test_suffix_strings_of_a_hot_key_are_dealt_out_by_their_bytes(spark, shared):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    line, edges = "A line of boilerplate, which all documents hold", [noise(70) for _ in range(40)]
    rows = [(i, rng.choice([noise(70), rng.choice(edges)]) + line + rng.choice([noise(70), rng.choice(edges)])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = suffixes.repeats.keyed(docs, "doc_id", "text")
    hot = suffixes.hot_keys(keyed, "text", 50, 1, 5000)
    assert len(hot) and not len(suffixes.hot_keys(keyed, "text", 50, 1, suffixes.HOT_BYTES))
    data, bounds = suffixes.raw(pa.array([t for _, t in rows]))
    most = lambda key: np.unique(key, return_counts=True)[1].max()
    before, after = (suffixes._stretches(data, bounds, None, 50, h) for h in (None, hot))
    assert most(before[0]) > 200 > 60 > most(after[0]) and before[4].sum() == after[4].sum()
    for some, most_ in ((rows, 5000), (shared[0], 500)):
        found = suffixes.remove_earlier(spark.createDataFrame(some, "doc_id long, text string"), most=most_).collect()
        got = sorted((str(r["doc_id"]), r["_n_bytes"], r["_n_removed"], len(r["_spans"]), bytes(r["_kept"])) for r in found)
        assert got == sorted((str(i), n, k, s, b) for (i, _), (n, k, s, b) in zip(some, plain.earlier(some, 50)))


def test_suffix_order_sorts_inside_groups_even_if_hashes_collide(monkeypatch):
    rng = random.Random(2)
    text = np.array([rng.choice(b"ab") for _ in range(3000)], np.uint8)
    at, first = np.array(rng.sample(range(2900), 900)), np.array([0, 1, 5, 300, 900])

    def check():
        order, equal = suffixes.suffix_order(text, at, first, 12)
        for a, b in zip(first, first[1:]):
            found = [text[p : p + 12].tobytes() for p in at[order[a:b]]]
            assert found == sorted(found) and sorted(order[a:b]) == list(range(a, b))
            assert [x == y for x, y in zip(found, found[1:])] == equal[a + 1 : b].tolist()

    check()
    # Sums that never differ make all suffixes look alike.
    monkeypatch.setattr(suffixes, "prefix", lambda values, base: np.zeros(len(values) + 1, np.uint64))
    check()


def test_simhash_classes_equal_brute_force(spark, shared):
    rows, _ = shared
    rows = rows + [(200 + i, rows[5][1].replace("a", "b", i)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _root", "2 AS node", "3 AS _fp")
    prints = [plain.fingerprint(t) for _, t in rows]
    label = plain.groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[label[k]] = min(least.get(label[k], i), i)
    want = sorted((str(i), f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, label))
    found = simhash.classes(docs).select("doc_id", simhash.hexadecimal(simhash.F.col("_fp")), "_component").collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in found) == want
    assert simhash.classes(docs.limit(0)).count() == 0


def test_trie_walk_finds_every_near_pair():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)
    values = np.unique(np.concatenate([base, base.repeat(2) ^ flips, base[:100] ^ flips[:100] ^ flips[100:200]]))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    want = {(values[i], values[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)))}
    a, b = simhash.near_pairs(values, None, 0, 2)
    assert set(zip(a, b)) == want and len(a) == len(want)
    top = values >> np.uint64(62)
    across = {(x, y) for x, y in want if x >> np.uint64(62) == 1 and y >> np.uint64(62) == 3}
    a, b = simhash.near_pairs(values[top == 1], values[top == 3], 2, 2)
    assert set(zip(a, b)) == across


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1050)] + [(5, 5), (None, 3)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    nodes = sorted({n for a, b in links if a is not None and a != b for n in (a, b)})
    index = {n: k for k, n in enumerate(nodes)}
    a, b = (np.array([index[x[s]] for x in links if x[0] is not None and x[0] != x[1]]) for s in (0, 1))
    want = {nodes[k]: nodes[r] for k, r in enumerate(components.least(len(nodes), a, b))}
    assert {r["node"]: r["root"] for r in components.components(frame).collect()} == want
    assert components.components(frame.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(scale=s, size=16)).tolist(), int(i % 3)) for i, s in enumerate(rng.uniform(0, 0.4, 150))]
    rows += [(200 + i, rows[4][1], rows[4][2]) for i in range(9)] + [(300, (np.array(rows[4][1]) * 1e200).tolist(), rows[4][2])]
    bad = [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] * 16, 1), (404, rows[1][1], None), (405, [], 1), (406, [1.0, 2.0], 1), (407, [float("inf")] * 16, 1)]
    table = spark.createDataFrame(rows + bad, "vec_id long, v array<double>, label int").selectExpr("*", "1 AS class", "2 AS _root")
    x = np.array([np.array(r[1]) / np.abs(r[1]).max() for r in rows])
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    near = (unit @ unit.T >= 0.93) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None, :])
    label = plain.groups(len(rows), lambda i, j: near[i, j])
    want = [(r[0], int(near[k].sum()) - 1, rows[label[k]][0]) for k, r in enumerate(rows)] + [(r[0], 0, r[0]) for r in bad]
    for block in (8192, 7):
        found = vectors.near_vectors(table, vec="v", block=block).collect()
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == sorted(want)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert vectors.near_vectors(table.limit(0), vec="v").count() == 0


def test_quantisation_error_stays_in_its_bound():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(200, 24))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    codes, scale, error = vectors.quantised(unit)
    product = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale
    bound = error[:, None] + (1 + error[:, None]) * error
    assert (np.abs(unit @ unit.T - product) <= bound + 1e-12).all()


def test_mix_hits_targets_and_emits_copies(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 9)), rng.choice(["a", "b", "ü", None])) for i in range(4000)]
    rows += [(5000, None, "a"), (5001, "", "empty"), (None, "x y", "b"), (7, "w w", "b"), (7, "w w", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "9 AS _size", "8 AS _copies")
    mixed = mixing.mix(docs)
    found = mixed.collect()
    assert len(found) == len(rows) and all(0 <= r["_copies"] <= 3 for r in found)
    for source in ("a", "b", "ü", None):
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["_size"] * r["_copies"] for r in own) / own[0]["_target"] - 1) < 0.1
    assert abs(sum({r["source"]: r["_target"] for r in found}.values()) - sum(r["_size"] for r in found)) < 1e-6
    assert mixing.emit(mixed).count() == sum(r["_copies"] for r in found)
    assert sorted(mixing.mix(docs).select("doc_id", "_copies").collect(), key=str) == sorted(((r["doc_id"], r["_copies"]) for r in found), key=str)
    assert mixing.emit(mixing.mix(docs.limit(0))).count() == 0


def test_targets_stop_at_the_cap_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), ("d", 3), (None, 1)], "source string, size long")
    got = {r["_source"]: r["target"] for r in mixing.targets(sizes).collect()}
    total, left, want = 1514, {"a": (5, 30), "b": (2, 3000), "c": (1, 1500), "d": (5, 9), None: (2, 3)}, {}
    while True:
        rest, weights = total - sum(want.values()), sum(w for w, _ in left.values())
        over = {s: cap for s, (w, cap) in left.items() if rest * w / weights > cap}
        if not over:
            want |= {s: rest * w / weights for s, (w, _) in left.items()}
            break
        want |= over
        left = {s: v for s, v in left.items() if s not in over}
    assert got == pytest.approx(want)


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    assert differences(db, QUERIES[name](spark, SMALL), ORACLES[name]) == ""


def test_queries_of_the_pair_operators_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op7_passage_anchors"](spark, SMALL).collect()}
    assert got == {i: (n, k, plain.sha(t)) for (i, _), (n, k, t) in zip(rows, plain.passages(rows, 35))}
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op6_suffix_sort"](spark, SMALL).collect()}
    assert got == {i: (n, k, s, plain.sha(b)) for (i, _), (n, k, s, b) in zip(rows, plain.earlier(rows, 50))}
    prints = [plain.fingerprint(t) for _, t in rows]
    label = plain.groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op9_simhash_trie"](spark, SMALL).collect()}
    assert got == {i: (f"{p:016x}", rows[c][0]) for (i, _), p, c in zip(rows, prints, label)}


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", None, 0), (None, "the and that is of it", None, "src1", 9)], docs.schema)
    docs = docs.union(odd).union(docs.limit(3)).withColumn("_id", docs.doc_id)
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        sizes.append(docs.count())
        if name != "tokens":
            assert docs.columns == corpus_pipeline.COLUMNS
        empty = stage(spark, docs.limit(0) if name != "tokens" else odd.limit(0), SMALL)
        assert empty.count() == 0
    assert sizes[1] == sizes[0] - 2 and sizes[2] < sizes[1] and sizes[3] <= sizes[2]


def test_pipeline_equals_plain_stages(spark):
    """Near-duplicates and passages of the pipeline against brute force, on what its first stage keeps."""
    docs = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    prints = [plain.fingerprint(t) for _, t in rows]
    label = plain.groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    rows = [row for k, row in enumerate(rows) if label[k] == k]
    docs = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == rows
    seen = plain.windows(rows, 35)
    left = [(i, plain.as_it_stands(t, 35, seen)) for (i, t), (n, k, _) in zip(rows, plain.passages(rows, 35)) if not n or k < n]
    assert any("\n" in t for _, t in left)
    cut = corpus_pipeline.repeated_passages(spark, docs, SMALL)
    assert sorted((r["doc_id"], r["text"]) for r in cut.collect()) == sorted(left)


def one_name_before():
    """Two word lists whose texts agree in the 31 bits that once told texts of one id apart."""
    seen, rng = {}, random.Random(11)
    while True:
        text = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(30))
        bits = xxhash.xxh64_intdigest(text.encode(), 42) & 0x7FFFFFFF
        if bits in seen and seen[bits] != text:
            return seen[bits], text
        seen[bits] = text


def test_rows_without_an_id_keep_their_own_results(spark):
    a, b = one_name_before()
    licence = "SPDX-License-Identifier: MIT"
    rows = [(None, a, "en"), (None, b, "en"), (1, a, "en"), (None, licence, "en"), (None, "plain text", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert repeats.keyed(docs, "doc_id", "text").select(*corpus_pipeline.KEY).distinct().count() == 5
    cut = {(r["doc_id"], r["text"]): (r["_n_removed"], r["_kept"]) for r in passages.remove_repeats(docs, window=20).collect()}
    assert cut[None, a] == cut[1, a] == (30, "") and cut[None, b] == (0, b)
    gone = {(r["doc_id"], r["text"]): r["_n_removed"] for r in suffixes.remove_earlier(docs).collect()}
    assert gone == {(None, a): len(a), (None, b): 0, (1, a): 0, (None, licence): 0, (None, "plain text"): 0}
    found = licences.scan(docs, licences.known_licences(spark)).collect()
    assert sorted(r["licences"] for r in found) == ["", "", "", "", "MIT"]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.near_duplicates(spark, frame, SMALL).select("doc_id", "text").collect()
    assert sorted(map(tuple, once), key=str) == sorted([(1, a), (None, b), (None, licence), (None, "plain text")], key=str)


def test_rows_without_an_id_draw_their_own_copies(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, 5]), f"w{i} " * rng.randint(1, 5), rng.choice("abc")) for i in range(6000)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in "abc":
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["_size"] * r["_copies"] for r in own) / own[0]["_target"] - 1) < 0.1


def test_passages_leave_the_rest_as_it_stands(spark):
    shared = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"A line.\n\n  {shared}\n\tdef f():\n\t\treturn 1\n"), (2, f"{shared}  end"), (3, f" start \n{shared} \n"), (4, " no \n words  lost "), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["_kept"] for r in passages.remove_repeats(frame, as_it_stands=True).collect()}
    assert found == {1: "A line.\n\n  def f():\n\t\treturn 1\n", 2: "end", 3: " start \n", 4: " no \n words  lost ", 5: ""}


def test_a_third_of_all_rows_alike_is_dealt_out(spark):
    """Equal rows send each known place once a piece, and not all to one bucket."""
    n, places = 3000, 20
    ids = np.where(np.arange(n) % 3 == 0, 7, np.arange(n) * 1_000_003).astype(np.int64)
    row, at = np.repeat(np.arange(n), places), np.tile(np.arange(places), n)
    batch = repeats.packed([np.tile(np.arange(places, dtype=np.uint64), n)], row, at, ids, np.zeros(n, np.int32), 16)
    sent = zip(batch["bucket"].to_pylist(), batch["items"].to_pylist(), strict=True)
    known = [len(repeats.unpack(v)[4]) for b, v in sent if b >= 16]
    assert len(known) == 16 and sum(known) == len({*zip(ids[row].tolist(), at.tolist(), strict=True)})
    assert max(known) < 2 * sum(known) / 16
