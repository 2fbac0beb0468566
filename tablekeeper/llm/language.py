"""Language by Bayesian fusion of text, declared language, address suffix and host.

The classes are the languages that labelled rows name. The text's likelihood under each comes from hashed byte trigrams of its
letters, fitted on a bounded sample of different labelled texts; texts of the sample that the fit has not seen tell how likely a text
of each language is, and a text less likely than nearly all of them is `und`, in no known language. Grouped aggregation of the
text-only posteriors over all pages, and over the documents that have none, tells how languages are spread on each host, on each domain
(where a host has few rows its domain fills in, and the whole corpus the domain), under each declared language and under each
address suffix. These four are fused row by row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.llm import repeats
from tablekeeper.llm.storage import stored
from tablekeeper.llm.words import chunks, raw

NONE = "und"
#: Labels of so many rows are languages, the most frequent MOST_LANGUAGES of them, if they look like one.
LEAST_ROWS, MOST_LANGUAGES, LABEL = 10, 200, r"^[A-Za-z][A-Za-z0-9-]{1,19}$"
#: Different labelled texts read, half of them to count trigrams; hash slots of trigrams; their smoothing.
MOST_FITTED, SLOTS, SMOOTHING = 20_000, 1 << 15, 0.5
#: A text is in no known language if a trigram of it is less likely, on the mean, than in all but this share of the best language's
#: texts, by this margin and by as many standard errors of its own mean.
OUTSIDE, MARGIN, ERRORS = 0.005, 0.25, 3.0
#: Texts shorter than this say nothing about what is usual.
USUAL_TRIGRAMS = 40
#: Trigrams of one text depend on each other: together they count as at most so many.
MOST_EVIDENCE = 60
#: Tasks that count the sample.
FIT_TASKS = 8
#: Rows that a parent's spread counts as, and the least posterior of an accepted language.
STRENGTH, LEAST_POSTERIOR = 20.0, 0.5

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams that hold a letter, with where each text's begin, and the end."""
    data, bounds = raw(texts)
    data = _LETTER[data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    grams = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    inside = np.ones(len(grams), bool)
    for back in (1, 2):  # none runs over the end of its text
        at = bounds[1:-1] - back
        inside[at[(at >= 0) & (at < len(grams))]] = False
    inside &= grams != 0x202020
    starts = np.flatnonzero(inside)
    slots = (grams[starts] * np.uint32(2654435761)) >> np.uint32(32 - int(SLOTS).bit_length() + 1)
    return slots.astype(np.int64), np.searchsorted(starts, bounds)


class Model(NamedTuple):
    """Log likelihoods of SLOTS trigrams, a row for each language, and of each language the least usual mean and the spread."""

    languages: tuple[str, ...]
    trigrams: np.ndarray
    usual: np.ndarray
    spread: np.ndarray


def languages_of(labelled: DataFrame, label: str = "lang") -> tuple[str, ...]:
    """The labels that enough rows bear, in order."""
    rows = labelled.groupBy(F.col(label).alias("label")).count().filter(F.col("label").rlike(LABEL) & (F.col("count") >= LEAST_ROWS))
    found = rows.filter(F.col("label") != NONE).orderBy(F.desc("count"), "label").limit(MOST_LANGUAGES).collect()
    return tuple(sorted(r["label"] for r in found))


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", languages=None, most: int = MOST_FITTED) -> Model:
    """A model of the languages, by default those of the labels; rows of other or null labels are left out.

    At most `most` different texts are read, those of the least 64-bit hashes, so that copies count once and the table's size is
    no matter.
    """
    languages = languages_of(labelled, label) if languages is None else tuple(languages)
    known = labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).filter(F.col("label").isin(*languages))
    hashed = known.withColumn("hash", F.xxhash64("text", "label"))
    # Copies fall together and are dropped.
    chosen = hashed.filter(F.col("hash") <= drawn_below(known.count(), most)).dropDuplicates(["hash"]).orderBy("hash").limit(most)
    sample = stored(chosen.repartition(FIT_TASKS, "hash"), "language-sample")
    fitted = F.pmod(F.shiftright("hash", 7), F.lit(2)) == 0
    counts = _sums(sample.filter(fitted), languages) + SMOOTHING
    logs = np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)
    usual, spread = _usual(sample.filter(~fitted), languages, logs)
    return Model(languages, logs, usual, spread)


def drawn_below(rows: int, most: int) -> int:
    """The 64-bit hash up to which about `most` of so many rows are; it names some however many there are."""
    return -(2**63) + min(2**64 - 1, 2**64 * most // max(1, rows))


def _sums(sample: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Counts of trigrams by language; FIT_TASKS tasks send a row for each language."""

    def count(batches):
        total = np.zeros((len(languages), SLOTS), np.int64)
        for part in chunks(batches, "text"):
            slots, bounds = trigrams(part.column("text"))
            which = np.array([languages.index(x) for x in part.column("label").to_pylist()], np.int64)
            total += np.bincount(np.repeat(which, np.diff(bounds)) * SLOTS + slots, minlength=total.size).reshape(total.shape)
        names = [i for i in range(len(languages)) if total[i].any()]
        values = [total[i].tobytes() for i in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.binary())], names=["lang", "counts"])

    def add(key, group):
        total = sum(np.frombuffer(v.as_py(), np.int64) for c in group.column("counts").chunks for v in c)
        return pa.table([pa.array([key[0].as_py()]), pa.array([total.tobytes()], pa.binary())], names=["lang", "counts"])

    kind = "lang long, counts binary"
    counts = np.zeros((len(languages), SLOTS))
    for row in sample.mapInArrow(count, kind).groupBy("lang").applyInArrow(add, kind).collect():
        counts[row["lang"]] = np.frombuffer(row["counts"], np.int64)
    return counts


def _usual(sample: DataFrame, languages: tuple[str, ...], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each language the mean log likelihood of a trigram that nearly all of its texts exceed, and a trigram's deviation."""

    def run(batches):
        for part in chunks(batches, "text"):
            slots, bounds = trigrams(part.column("text"))
            n, which = np.diff(bounds), np.array([languages.index(x) for x in part.column("label").to_pylist()], np.int64)
            each = logs[np.repeat(which, n), slots].astype(np.float64)
            sums, squares = (np.concatenate([[0.0], np.cumsum(v)])[bounds] for v in (each, each * each))
            columns = [pa.array(which), pa.array(n), pa.array(np.diff(sums)), pa.array(np.diff(squares))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "s", "q"])

    rows = sample.mapInArrow(run, "lang long, n long, s double, q double").filter(F.col("n") >= USUAL_TRIGRAMS)
    mean, least = F.col("s") / F.col("n"), F.percentile(F.col("s") / F.col("n"), F.lit(OUTSIDE))
    over = F.sum("s") / F.sum("n")
    found = rows.groupBy("lang").agg(least.alias("least"), F.sqrt(F.greatest(F.sum("q") / F.sum("n") - over * over, F.lit(0.0))).alias("sd"), F.min(mean)).collect()
    # A language without texts to go by takes nothing for unusual.
    usual, spread = np.full(len(languages), -np.inf), np.ones(len(languages))
    for row in found:
        usual[row["lang"]], spread[row["lang"]] = row["least"] - MARGIN, row["sd"]
    return usual, spread


def likelihoods(texts: pa.Array, model: Model) -> np.ndarray:
    """Log likelihood of each text under each language and, last, under none of them.

    The last is what a text just usual for its best language would have. All are 0 for a text without letters, but less for languages.
    """
    slots, bounds = trigrams(texts)
    n = np.diff(bounds)
    out = np.zeros((len(n), len(model.languages) + 1))
    filled = np.flatnonzero(n)
    for k, row in enumerate(model.trigrams):
        if len(filled):
            out[filled, k] = np.add.reduceat(row[slots].astype(np.float64), bounds[:-1][filled])
    if len(model.languages):
        best = out[:, :-1].argmax(axis=1)
        # A mean over few trigrams strays from its language's by chance.
        least = model.usual[best] - ERRORS * model.spread[best] / np.sqrt(np.maximum(n, 1))
        out[:, -1] = np.maximum(least, -1e3) * n
    out *= (np.minimum(n, MOST_EVIDENCE) / np.maximum(n, 1))[:, None]
    out[n == 0, :-1] = -MOST_EVIDENCE  # nothing to tell a language by
    out[n == 0, -1] = 0.0
    return out


def _spread(rows: DataFrame, keys: list[str], classes: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(f"p_{c}").alias(f"n_{c}") for c in classes])


def _toward(parent: dict[str, Column], classes: list[str], own: str = "n_") -> dict[str, Column]:
    """Shares of the classes, drawn toward the parent's where there are few rows."""
    total = sum((F.col(f"{own}{c}") for c in classes), F.lit(0.0))
    return {c: (F.col(f"{own}{c}") + STRENGTH * parent[c]) / (total + STRENGTH) for c in classes}


def _greatest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def fused(scored: DataFrame, classes: list[str], evidence: DataFrame | None = None) -> DataFrame:
    """Adds `language`, `posterior` and `kept` to rows with log likelihoods t_<class>, `declared`, `suffix`, `host` and `domain`.

    Null, empty and letterless texts are `und` and not kept. Ties go to the first language. A null key brings no evidence. All keys are joined as tables that grouped aggregation makes from the rows of
    `evidence`, which has the same columns; by default the rows themselves.
    """
    top = _greatest([F.col(f"t_{c}") for c in classes])
    weights = {c: F.exp(F.col(f"t_{c}") - top) for c in classes}
    total = sum(weights.values(), F.lit(0.0))
    shares = {f"p_{c}": weights[c] / total for c in classes}
    told = (scored if evidence is None else evidence).withColumns(shares)
    rows = scored.withColumns(shares)
    sums = told.agg(*[F.sum(f"p_{c}") for c in classes]).first()
    whole = sum(x or 0.0 for x in sums)
    base = {c: F.lit(((x or 0.0) + 1.0) / (whole + len(classes))) for c, x in zip(classes, sums, strict=True)}

    hosts = _spread(told.filter("host IS NOT NULL AND domain IS NOT NULL"), ["host", "domain"], classes)
    domains = hosts.groupBy("domain").agg(*[F.sum(f"n_{c}").alias(f"d_{c}") for c in classes])
    share = _toward(base, classes, "d_")
    domains = domains.select("domain", *[share[c].alias(f"d_{c}") for c in classes])
    share = _toward({c: F.col(f"d_{c}") for c in classes}, classes)
    hosts = hosts.join(domains, "domain").select("host", "domain", *[share[c].alias(f"h_{c}") for c in classes])
    rows = rows.join(hosts, ["host", "domain"], "left")
    for key in ("declared", "suffix"):
        table = _spread(told.filter(f"{key} IS NOT NULL"), [key], classes)
        share = _toward(base, classes)
        rows = rows.join(table.select(key, *[(share[c] / base[c]).alias(f"{key}_{c}") for c in classes]), key, "left")

    logs = {
        c: F.col(f"t_{c}")
        + F.log(F.coalesce(F.col(f"h_{c}"), base[c]))
        + F.log(F.coalesce(F.col(f"declared_{c}"), F.lit(1.0)))
        + F.log(F.coalesce(F.col(f"suffix_{c}"), F.lit(1.0)))
        for c in classes
    }
    rows = rows.withColumns({f"l_{c}": v for c, v in logs.items()})
    best = _greatest([F.col(f"l_{c}") for c in classes])
    language = F.coalesce(*[F.when(F.col(f"l_{c}") == best, F.lit(c)) for c in classes])
    posterior = 1 / sum((F.exp(F.col(f"l_{c}") - best) for c in classes), F.lit(0.0))
    rows = rows.withColumns({"language": language, "posterior": posterior})
    return rows.withColumn("kept", (F.col("language") != NONE) & (F.col("posterior") >= LEAST_POSTERIOR))


def scored(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows without their text and with t_<class>, the text's log likelihood under each class of the model."""
    classes = [*model.languages, NONE]
    kept = [c for c in rows.columns if c != text]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = rows.select(*kept, *[F.lit(0.0).alias(f"t_{c}") for c in classes]).schema

    def run(batches):
        for part in chunks(batches, text):
            found = likelihoods(part.column(text), shared.value)
            columns = [part.column(c) for c in kept] + [pa.array(found[:, k].copy()) for k in range(len(classes))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def page_evidence(pages: DataFrame) -> DataFrame:
    """Of every page: the document number in its address, declared markup language, address suffix, host, domain and its text."""
    address = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/:?#]+)", 1))
    return pages.select(
        "page_id",
        F.expr(r"try_cast(regexp_extract(url, '^[a-z]+://[^/]+/[a-z-]+/([0-9]+)', 1) AS BIGINT)").alias("_of"),
        F.nullif(F.lower(F.regexp_extract("html", r'<html[^>]*\slang="?([A-Za-z]+)', 1)), F.lit("")).alias("declared"),
        F.nullif(F.regexp_extract(address, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
        F.nullif(address, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(address, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1|<[^>]*>", " ").alias("text"),
    )


EVIDENCE = ["declared", "suffix", "host", "domain"]


def identify_documents(docs: DataFrame, pages: DataFrame, languages=None) -> DataFrame:
    """`doc_id`, `_id`, `_th` (see `repeats.keyed`), `language`, `posterior` and `kept` of every document.

    The languages are those of the label lang unless given. A document takes its evidence from the first page whose address bears
    its doc_id; without one, its source stands for the host. The spreads of languages come from all pages, and from the documents
    without one.
    """
    keyed = repeats.keyed(docs.select("doc_id", "text", "lang", "source"), "doc_id", "text")
    model = fit(keyed, languages=languages)
    told = page_evidence(pages)
    first = told.filter("_of IS NOT NULL").groupBy("_of").agg(F.min_by(F.struct(*EVIDENCE), "page_id").alias("_page")).select("_of", "_page.*")
    named = keyed.select("doc_id", "_id", "_th", "text", F.concat(F.lit("source:"), "source").alias("source"))
    # The evidence joins the scores, not the texts.
    rows = scored(named, model).join(first, F.col("doc_id") == F.col("_of"), "left")
    rows = rows.withColumn("_paged", F.col("_of").isNotNull()).drop("_of")
    rows = stored(rows.withColumns({k: F.coalesce(F.col(k), F.col("source")) for k in ("host", "domain")}), "language")
    marks = [f"t_{c}" for c in (*model.languages, NONE)]
    seen = scored(told.select(*EVIDENCE, "text"), model).select(*EVIDENCE, *marks)
    evidence = stored(seen.unionByName(rows.filter("NOT _paged").select(*EVIDENCE, *marks)), "language-evidence")
    done = fused(rows, [*model.languages, NONE], evidence)
    return done.select("doc_id", "_id", "_th", "language", "posterior", "kept")
