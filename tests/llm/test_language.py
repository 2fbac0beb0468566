"""Language identification against a plain version, and languages it was not told of."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablekeeper.llm import language
from tablekeeper.llm.queries import QUERIES, table

SMALL = "/root/testdata/sf0.001"


def plain_trigrams(text):
    fold = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    out = []
    for g in zip(fold, fold[1:], fold[2:]):
        if g != (32, 32, 32):
            out.append((((g[0] << 16 | g[1] << 8 | g[2]) * 2654435761) % 2**32) >> (32 - 15))
    return out


def plain_language(docs, pages):
    """{doc row number: (language, posterior)} by dictionaries; docs are (doc_id, text, lang, source)."""
    counts = Counter(d[2] for d in docs if d[2] and re.match(language.LABEL, d[2]))
    langs = sorted(x for x, n in counts.items() if n >= language.LEAST_ROWS)
    sample = {}
    for _, text, lang, _ in docs:
        if lang in langs and text is not None:
            h = xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(text.encode(), 42))
            sample[h - 2**64 if h >= 2**63 else h] = (text, lang)
    grams = {lang: Counter() for lang in langs}
    for h, (text, lang) in sample.items():
        if (h >> 7) % 2 == 0:
            grams[lang].update(plain_trigrams(text))
    logs = {}
    for lang, c in grams.items():
        total = sum(c.values()) + language.SLOTS * language.SMOOTHING
        logs[lang] = defaultdict(lambda t=total: np.float32(math.log(language.SMOOTHING / t)), {s: np.float32(math.log((n + language.SMOOTHING) / t)) for s, n in c.items() for t in [total]})
    means, every = {x: [] for x in langs}, {x: [] for x in langs}
    for h, (text, lang) in sample.items():
        slots = plain_trigrams(text)
        if (h >> 7) % 2 and len(slots) >= language.USUAL_TRIGRAMS:
            each = [float(logs[lang][s]) for s in slots]
            means[lang].append(sum(each) / len(each))
            every[lang] += each
    usual = {x: np.percentile(means[x], 100 * language.OUTSIDE) - language.MARGIN if means[x] else -math.inf for x in langs}
    spread = {x: np.std(every[x]) if every[x] else 1.0 for x in langs}

    def told(text):
        slots = plain_trigrams(text or "")
        n = len(slots)
        if not n:
            return {**dict.fromkeys(langs, -float(language.MOST_EVIDENCE)), "und": 0.0}
        out = {x: sum(float(logs[x][s]) for s in slots) for x in langs}
        best = max(langs, key=lambda x: out[x])
        out["und"] = max(usual[best] - language.ERRORS * spread[best] / math.sqrt(n), -1e3) * n
        return {x: v * min(n, language.MOST_EVIDENCE) / n for x, v in out.items()}

    classes = [*langs, "und"]

    def shares(scores):
        top = max(scores.values())
        w = {x: math.exp(v - top) for x, v in scores.items()}
        return {x: v / sum(w.values()) for x, v in w.items()}

    evidence, first = [], {}
    for page_id, url, source in sorted(pages):
        host = re.match(r"[A-Za-z]+://([^/:?#]+)", url)
        host = host[1].lower() if host else None
        declared = re.search(r'<html[^>]*\slang="?([A-Za-z]+)', source)
        suffix = re.search(r"\.([a-z]+)$", host or "")
        domain = re.search(r"([^.]+\.[^.]+)$", host or "")
        keys = (declared and declared[1].lower(), suffix and suffix[1], host, domain and domain[1])
        text = re.sub(r"(?is)<(script|style)\b.*?</\1|<[^>]*>", " ", source)
        evidence.append((*keys, shares(told(text))))
        of = re.match(r"[a-z]+://[^/]+/[a-z-]+/([0-9]+)", url)
        if of:
            first.setdefault(int(of[1]), keys)
    rows = []
    for doc_id, text, _, source in docs:
        keys = first.get(doc_id)
        where = f"source:{source}" if source is not None else None
        full = (None, None, where, where) if keys is None else (*keys[:2], keys[2] or where, keys[3] or where)
        scores = told(text)
        rows.append((*full, scores))
        if keys is None:
            evidence.append((*full, shares(scores)))

    def summed(place, want=lambda e: True):
        out = defaultdict(lambda: dict.fromkeys(classes, 0.0))
        for e in evidence:
            if want(e) and place(e) is not None:
                for x in classes:
                    out[place(e)][x] += e[4][x]
        return out

    base = summed(lambda e: "all")["all"]
    whole = sum(base.values())
    base = {x: (base[x] + 1) / (whole + len(classes)) for x in classes}
    toward = lambda own, parent: {x: (own[x] + language.STRENGTH * parent[x]) / (sum(own.values()) + language.STRENGTH) for x in classes}
    both = lambda e: e[2] is not None and e[3] is not None
    domains = {k: toward(v, base) for k, v in summed(lambda e: e[3], both).items()}
    hosts = {k: toward(v, domains[k[1]]) for k, v in summed(lambda e: (e[2], e[3]), both).items()}
    marks = [{k: toward(v, base) for k, v in summed(lambda e, i=i: e[i]).items()} for i in (0, 1)]
    out = []
    for row in rows:
        prior = hosts.get((row[2], row[3]), base)
        logs_ = {x: row[4][x] + math.log(prior[x]) for x in classes}
        for i in (0, 1):
            if row[i] in marks[i]:
                logs_ = {x: v + math.log(marks[i][row[i]][x] / base[x]) for x, v in logs_.items()}
        post = shares(logs_)
        best = max(classes, key=lambda x: (logs_[x], -classes.index(x)))
        out.append((best, post[best]))
    return out


def rows_of(spark, size):
    folder = f"/root/testdata/sf{size}"
    docs = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text", "lang", "source").collect()]
    return folder, docs, [tuple(r) for r in table(spark, folder, "pages").select("page_id", "url", "html").collect()]


def test_query_equals_plain(spark):
    folder, docs, pages = rows_of(spark, "0.001")
    found = {r["doc_id"]: r for r in QUERIES["op3_language_fusion"](spark, folder).collect()}
    for (doc_id, *_), (best, posterior) in zip(docs, plain_language(docs, pages), strict=True):
        assert found[doc_id]["language"] == best
        assert found[doc_id]["posterior"] == pytest.approx(posterior, abs=1e-4)
        assert found[doc_id]["kept"] == (best != "und" and found[doc_id]["posterior"] >= language.LEAST_POSTERIOR)


@pytest.mark.parametrize("left_out", ["fr", "de", "es", "en"])
def test_a_language_without_labels_is_rejected(spark, left_out):
    folder, docs, _ = rows_of(spark, "0.01")
    frame = table(spark, folder, "documents").withColumn("lang", F.when(F.col("lang") != left_out, F.col("lang")))
    found = {r["doc_id"]: r for r in language.identify_documents(frame, table(spark, folder, "pages").limit(0)).collect()}
    long = [d for d in docs if len(d[1] or "") >= 200]
    strange = [found[d[0]]["kept"] for d in long if d[2] == left_out]
    known = [found[d[0]]["kept"] and found[d[0]]["language"] == d[2] for d in long if d[2] not in (left_out, None)]
    assert np.mean(strange) <= 0.1 and np.mean(known) >= 0.95


def test_any_label_is_a_language_and_copies_count_once(spark):
    folder, docs, _ = rows_of(spark, "0.01")
    frame = table(spark, folder, "documents").withColumn("lang", F.when(F.col("lang") == "fr", "x-new").otherwise(F.col("lang")))
    many = frame.union(frame.filter("doc_id < 5").crossJoin(spark.range(2000)).drop("id"))
    model = language.fit(many, most=400)
    assert model.languages == ("de", "en", "es", "x-new") and np.isfinite(model.usual).all()
    found = {r["doc_id"]: r["language"] for r in language.identify_documents(frame, table(spark, folder, "pages")).collect()}
    assert np.mean([found[d[0]] == "x-new" for d in docs if d[2] == "fr"]) > 0.95


def test_the_sample_does_not_vanish_in_large_tables():
    for rows in (10, 10**6, 2 * 10**10, 10**14):
        share = (language.drawn_below(rows, 20_000) + 2**63) / 2**64
        assert share == pytest.approx(min(1.0, 20_000 / rows), rel=1e-3)
