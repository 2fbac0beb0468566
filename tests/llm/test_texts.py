"""Operators on single texts: words, repetition, BPE, quality, language, licences."""

import base64
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tablekeeper.llm import bpe, language, licences, quality, repetition
from tablekeeper.llm.queries import QUERIES
from tablekeeper.llm.words import chunks, words_of
from tests.llm import plain

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "\n\t \r\x0b\x0c", "a", "a" * 3000, "é" * 500, "ab " * 700, "\x00\x1c x\x85y z", "<|endoftext|>", "😀" * 40]


def texts(seed=1, count=60):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choice(["a ", "b ", "é", "c\n", "# ", "1", ".", "  "]) for _ in range(rng.randint(0, 90))) for _ in range(count)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "x y"), (3, "x y"), (None, "no id here"), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_words_equal_the_pattern():
    found = words_of(pa.array(texts(), pa.string()))
    bounds, data = found.offsets, found.data.tobytes()
    ours = [[data[bounds[k] : bounds[k + 1]].decode() for k in range(a, b)] for a, b in zip(found.rows, found.rows[1:])]
    assert ours == [plain.words(t) for t in texts()]
    assert found.joined().to_pylist() == [" ".join(plain.words(t)) for t in texts()]


def test_chunks_hold_all_rows_in_bounded_slices():
    batch = pa.record_batch({"text": pa.array(["x" * 10, None, "y" * 100, "", "z" * 9])})
    parts = list(chunks([batch], "text", 12))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert list(chunks([batch.slice(0, 0)], "text")) == []


def brute_repetition(text, least):
    w, lines = plain.words(text), [x for x in (text or "").split("\n") if plain.words(x)]

    def covered(size):
        seen = Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
        return sum(plain.cover([k for k in range(len(w) - size + 1) if seen[tuple(w[k : k + size])] > 1], len(w), size))

    longest, repeats = 0, 0
    for size in range(least, len(w)):
        at = defaultdict(list)
        for k in range(len(w) - size + 1):
            at[tuple(w[k : k + size])].append(k)
        for places in at.values():
            if len(places) > 1:
                longest = size
                left = {w[k - 1] if k else ("start", k) for k in places}
                right = {w[k + size] if k + size < len(w) else ("end", k) for k in places}
                repeats += len(left) > 1 and len(right) > 1
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return [len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), covered(3), covered(least), repeats, longest]


def test_repetition_equals_brute_force():
    rows = [t for t in texts() if len(t or "") < 2500]
    found = [c.to_pylist() for c in repetition.measured(pa.array(rows, pa.string()), 4)]
    for k, text in enumerate(rows):
        assert [c[k] for c in found[:8]] == brute_repetition(text, 4), text


def test_repetition_judges_every_row(spark, docs):
    clean, noisy = " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i % 40}" for i in range(160))
    more = docs.union(spark.createDataFrame([(900, clean), (901, noisy)], docs.schema)).withColumn("_spans", docs.doc_id)
    found = repetition.judged(repetition.measure(more)).collect()
    assert len(found) == more.count()
    kept = {r["doc_id"]: (r["_base_failed"], r["_kept"]) for r in found if r["doc_id"] is not None}
    assert kept[900] == (False, True)
    assert kept[901] == (True, False) and kept[1] == (True, False)
    assert repetition.measure(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def reference():
    lines = open(RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_comes_back(docs, reference):
    wide = docs.withColumn("ids", docs.doc_id)
    coded = bpe.encode(wide, RANKS, public_tokenizers.PATTERN, back="bytes").collect()
    assert len(coded) == docs.count()
    for row in coded:
        assert row["ids"] == reference.encode_ordinary(row["text"] or "")
        assert bytes(row["bytes"]) == (row["text"] or "").encode()
    alone = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert all(bytes(r["bytes"]) == (r["text"] or "").encode() for r in alone)
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_merges_one_by_one_where_ranks_fall():
    tokens = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 290, b"aa": 310, b"aaa": 305}
    ranks = bpe.Ranks(tokens)
    for text in (b"abc", b"aabcbc", b"aaaaaaa", b"abcabc", b""):
        parts = [bytes([b]) for b in text]
        while True:
            known = [(tokens[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in tokens]
            if not known:
                break
            k = min(known)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        ids, _ = bpe.merge(ranks, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == [tokens[p] for p in parts], text


def test_rank_queue_gives_ranks_in_order():
    queue, rng = bpe.RankQueue(50_257), random.Random(5)
    pushed = [rng.randrange(50_257) for _ in range(500)]
    for k, r in enumerate(pushed):
        queue.push(r, np.array([k]))
    got = []
    while (found := queue.pop()) is not None:
        got.append(found[0])
        assert {pushed[k] for k in found[1]} == {found[0]}
    assert got == sorted(set(pushed))


def test_quality_learns_from_rows_not_held_out(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice("der and tree lake walk sun over".split()) for _ in range(60)) + "." for _ in range(150)]
    bad = [" | ".join(rng.choice("der and tree lake walk sun over".split()) for _ in range(60)) for _ in range(150)]
    rows = list(enumerate(good + bad)) + [(900, None), (901, ""), (None, "x"), (5, good[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(7, None)], "doc_id long, quality int")
    found = quality.scored(docs, labels).collect()
    assert len(found) == len(rows)
    right = [r["predicted"] == (r["doc_id"] < 150) for r in found if r["held_out"] and r["doc_id"] < 300]
    assert len(right) > 30 and sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    # Labels of held-out rows are never read: turned round they change nothing.
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    again = {(r["doc_id"], round(r["score"], 9)) for r in quality.scored(docs, turned).collect()}
    assert again == {(r["doc_id"], round(r["score"], 9)) for r in found}
    assert {r["score"] for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scored(docs.limit(0), labels).count() == 0


def test_language_fuses_text_and_evidence(spark):
    folder = "/root/testdata/sf0.001"
    docs, pages = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "pages"))
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "12 34", "en", "src0", 5), (None, "the and that", None, None, 12)], docs.schema)
    found = language.identify_documents(docs.union(odd).withColumn("host", docs.lang), pages).collect()
    assert len(found) == docs.count() + 4
    said = {r["doc_id"]: r for r in found}
    assert not any(said[i]["kept"] for i in (9001, 9002, 9003))
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert np.mean([said[i]["language"] == lang for i, lang in truth.items()]) > 0.97
    assert language.identify_documents(docs.limit(0), pages.limit(0)).count() == 0


def test_language_prior_of_a_host_decides_what_text_leaves_open(spark):
    classes = ["de", "en", "und"]
    rows = [(i, -5.0, -1.0, -60.0, None, None, "h", "d") for i in range(40)] + [(99, -1.0, -1.0, -9.0, None, None, "h", "d"), (100, -1.0, -1.0, -9.0, "de", None, None, None)]
    rows += [(200 + i, -1.0, -9.0, -60.0, "de", "com", "g", "d") for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, t_de double, t_en double, t_und double, declared string, suffix string, host string, domain string")
    said = {r["id"]: r["language"] for r in language.fused(frame, classes).collect()}
    assert said[99] == "en" and said[100] == "de"


def test_licences_whole_texts_only(spark):
    mit = next(t for n, t in licences.TEXTS if n == "MIT")
    rows = [
        (1, "Copyright (c) 2020 Some One\n" + mit.upper().replace("SUBLICENSE", "sub-licence")),
        (2, "first line\nLicenced under CC-BY-NC 4.0\nlast line"),
        (3, "we say it is released under the MIT License. or so"),
        (4, None),
        (5, ""),
        (6, "Released under the MIT licence!\n\nLicensed under the Apache Licence, version 2.0"),
        (6, "Released under the MIT licence!\n\nLicensed under the Apache Licence, version 2.0"),
        (None, "SPDX-License-Identifier: MIT"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS licences", "2 AS _names")
    found = sorted(map(tuple, licences.scan(docs, licences.known_licences(spark)).collect()), key=str)
    assert found == sorted(
        [
            (1, "MIT", 1, True),
            (2, "CC-BY-NC-4.0", 1, False),
            (3, "", 0, False),
            (4, "", 0, False),
            (5, "", 0, False),
            (6, "Apache-2.0,MIT", 2, False),
            (6, "Apache-2.0,MIT", 2, False),
            (None, "MIT", 1, True),
        ],
        key=str,
    )
    assert licences.scan(docs.limit(0), licences.known_licences(spark)).count() == 0


def test_licences_with_titles_in_runs_of_paragraphs_and_beyond_copyright_lines(spark):
    text = dict(licences.TEXTS)
    gpl = (licences.FOLDER / "GPL-3.0.txt").read_text()
    apache = (licences.FOLDER / "Apache-2.0.txt").read_text()
    holder = "Copyright (c) 2020 Some One"
    cases = {
        1: (f"MIT License\n\n{holder}\n\n{text['MIT']}", "MIT", True),
        2: (f"BSD 3-Clause License\n\n{holder}\nAll rights reserved.\n\n{text['BSD-3-Clause']}", "BSD-3-Clause", True),
        3: (f"Read me\n\nSome words.\n\n{text['MIT']}\n\nMore words.", "MIT", False),
        4: (f"A file\n{holder}. Licensed under the MIT License.\ncode", "MIT", False),
        5: (f"{holder}. All rights reserved. Released under the MIT License.", "MIT", True),
        6: (text["MIT"].replace("The above copyright", "The above\ncopyright"), "MIT", True),
        7: ("# SPDX-License-Identifier: LGPL-2.1-or-later\nimport os", "LGPL-2.1-or-later", False),
        8: (gpl, "GPL-3.0", True),
        9: (f"Preface\n\n{apache}\n\nAppended", "Apache-2.0", False),
        10: ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License "
             "as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\n"
             "x", "GPL-3.0-or-later", False),
        11: (f"MIT License\n\n{holder}\n\n{text['MIT'][:-20]}", "", False),
        12: ("Copyright law is in dispute. Some words on it.", "", False),
    }
    docs = spark.createDataFrame([(i, c[0]) for i, c in cases.items()], "doc_id long, text string")
    found = {r["doc_id"]: (r["licences"], r["whole_text"]) for r in licences.scan(docs, licences.known_licences(spark)).collect()}
    assert found == {i: c[1:] for i, c in cases.items()}


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_query_of_bpe_equals_the_library(spark, small, reference):
    found = {r[0]: tuple(r[1:]) for r in QUERIES["op2_byte_bpe"](spark, SMALL).collect()}
    assert found.keys() == small.keys()
    for i, text in small.items():
        ids = reference.encode_ordinary(text or "")
        assert found[i] == (len(ids), plain.sha(" ".join(map(str, ids))), plain.sha((text or "").encode()))


def test_query_of_repetition_equals_brute_force(spark, small):
    found = {r["doc_id"]: r for r in QUERIES["op1_suffix_repetition"](spark, SMALL).collect()}
    assert found.keys() == small.keys()
    for i, text in small.items():
        if len(text or "") < 2500:
            n, chars, symbols, lines, again, covered, repeats, longest = brute_repetition(text, repetition.LEAST_REPEAT)
            failed = n < 50 or 100 * again > 50 * n
            kept = not failed and covered <= repetition.MOST_COVERED * n and longest <= repetition.LONGEST_REPEAT
            got = found[i]
            assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == (n, chars, symbols, lines, again)
            assert (got.base_failed, got.kept) == (failed, kept)
            assert (got.n_covered_words, got.n_maximal_repeats, got.longest_repeat) == (covered, repeats, longest)


def test_query_of_quality_is_right_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [r for r in QUERIES["op4_random_indexing"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in found]) > 0.93


def test_spdx_expressions_count_as_their_identifiers(spark):
    cases = {
        "// SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
        "# spdx-license-identifier: (BSD-3-Clause and ISC) or MIT": "BSD-3-Clause,ISC,MIT",
        "/* SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0 */\nint x;": "GPL-2.0-or-later",
        "SPDX-License-Identifier: MPL-2.0+": "MPL-2.0",
        "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1+ OR (Zlib AND Unknown-9)\nSPDX-License-Identifier: 0BSD": "0BSD,LGPL-2.1-or-later,Zlib",
        "SPDX-License-Identifier: MIT": "MIT",
        "SPDX-License-Identifier: ": "",
        "MIT OR Apache-2.0": "",
    }
    rows = list(enumerate(cases))
    found = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences.known_licences(spark)).collect()
    assert {rows[r["doc_id"]][1]: r["licences"] for r in found} == cases


def test_repetition_of_a_text_beyond_the_slice(spark):
    """Two and a half MB in one text: the figures of a text that repeats one word, and of one whose halves are equal."""
    rng = random.Random(4)
    half = " ".join(str(rng.randint(0, 10**9)) for _ in range(130_000))
    texts = ["word " * 500_000, f"{half} {half}", None]
    found = {r["doc_id"]: r for r in repetition.judged(repetition.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert (found[0]["_n_words"], found[0]["_n_covered"], found[0]["_longest"]) == (500_000, 500_000, 499_999)
    assert (found[1]["_n_words"], found[1]["_n_covered"], found[1]["_longest"], found[1]["_n_repeats"]) == (260_000, 260_000, 130_000, 1)
    assert not found[0]["_kept"] and not found[1]["_kept"] and found[2]["_n_words"] == 0
