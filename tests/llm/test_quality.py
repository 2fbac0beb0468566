"""Random-indexing vectors and pooled texts against a plain version, and what the score gains by them."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablekeeper.llm import quality
from tablekeeper.llm.registry import importable, table


def plain_tokens(text):
    """Runs of letters, of digits, of one symbol and of line ends; digits are alike, letters are folded."""
    found = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|\n+|([^A-Za-z0-9\x80-\xff \t\x0b\x0c\r\n])\1*", (text or "").encode())
    every = [m.group() for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|\n+|([^A-Za-z0-9\x80-\xff \t\x0b\x0c\r\n])\1*", (text or "").encode())]
    assert len(found) == len(every)
    return [re.sub(rb"[0-9]", b"0", t.lower() if t[:1].isalpha() or t[0] >= 128 else t) for t in every]


def slot_of(token):
    slots, _ = quality.tokens(pa.array([token], pa.binary()))
    assert len(slots) == 1
    return int(slots[0])


def plain_pooled(texts):
    """Mean and deviation of the vectors of each text's tokens, by loops over tokens."""
    places, signs = quality.index_vectors()
    vectors, counts, docs = {}, {}, [[slot_of(t) for t in plain_tokens(x)] for x in texts]
    for doc in docs:
        for i, word in enumerate(doc):
            counts[word] = counts.get(word, 0) + 1
            own = vectors.setdefault(word, np.zeros(quality.DIMENSIONS))
            for j in range(max(0, i - quality.REACH), min(len(doc), i + quality.REACH + 1)):
                if j != i:
                    for place, sign in zip(places[doc[j]], signs[doc[j]], strict=True):
                        own[place] += sign
    total = sum(counts.values())
    unit = {w: v / max(np.linalg.norm(v), 1e-12) for w, v in vectors.items()}
    middle = sum(counts[w] / total * v for w, v in unit.items())
    final = {w: (v - middle) * 1e-3 / (1e-3 + counts[w] / total) for w, v in unit.items()}
    out = np.zeros((len(docs), 2 * quality.DIMENSIONS))
    for k, doc in enumerate(docs):
        if doc:
            held = np.array([final[w] for w in doc])
            out[k] = np.concatenate([held.mean(0), held.std(0)])
    return out


def test_pooled_texts_equal_plain(spark):
    importable(spark)
    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").limit(25).collect()]
    texts += [None, "", " \n", "A b  C99 é!!\n\nx", "same same same"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    vectors = quality.word_vectors(docs)
    assert quality.pooled(pa.array(texts, pa.string()), vectors) == pytest.approx(plain_pooled(texts), abs=2e-4)


def test_sums_do_not_depend_on_how_tasks_are_put_together(spark, monkeypatch):
    importable(spark)
    docs = spark.createDataFrame([(f"word{i % 7} and other{i % 5}, {i}",) for i in range(200)], "text string")
    one = quality.word_vectors(docs.coalesce(1))
    assert quality.word_vectors(docs.repartition(9)) == pytest.approx(one, abs=1e-5)


def test_the_score_comes_from_the_vectors(spark, monkeypatch):
    """Without them nothing tells the rows apart; with them held-out rows are told apart."""
    importable(spark)
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))

    def right():
        found = quality.scored(docs, labels).filter("held_out").join(labels.select("doc_id", "quality").dropna(), "doc_id")
        return found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]

    rate = labels.filter(quality.held_out(F.col("doc_id"))).agg(F.greatest(F.avg("quality"), 1 - F.avg("quality"))).first()[0]
    assert right() >= 0.95
    monkeypatch.setattr(quality, "word_vectors", lambda docs, text="text": np.zeros((quality.TOKENS, quality.DIMENSIONS), np.float32))
    assert right() <= rate + 1e-9
