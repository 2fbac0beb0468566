"""Substring joins: which target texts contain which search terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import col, row_hash
from tablekeeper.plans.automaton import Automaton, held_terms, texts_as_bytes
from tablekeeper.plans.keys import without_clash
from tablekeeper.plans.sizing import BROADCAST_ROWS, small_enough
from tablekeeper.session import importable

#: So few terms are compared with every text by Spark itself.
COMPARE_TERMS = 8
#: Different terms of one automaton, and their bytes: it takes some 20 bytes of memory for each.
TERMS, TERM_BYTES = 200_000, 4 << 20
#: Bytes of a gram.
GRAM = 8
#: Tables of fewer bytes are dealt to all tasks before their grams are made; larger ones have tasks enough.
SPREAD_BYTES = 1 << 30


def contains_join(
    target: DataFrame,
    terms: DataFrame,
    column: str,
    term: str,
    *,
    compare_rows: int = COMPARE_TERMS,
    automaton_terms: int = TERMS,
) -> DataFrame:
    """Inner join on `contains(column, term)`, every pair once. An empty term is in every text, a null one in none.

    Few terms are broadcast and compared. Up to TERMS different ones of TERM_BYTES an automaton of all terms is broadcast and reads
    each text once, whatever the terms share; the target is not shuffled. Beyond that a term is keyed by the rarest of its grams
    of up to eight bytes, and dropped if a gram occurs in no text. Texts are looked up by key without their rows: only a hash of the
    row goes with its grams, of which only those that are keys go on. The rows are joined back once, and each candidate is tested.
    """
    terms = terms.withColumnRenamed(term, "__term").filter("__term is not null")
    without_clash(target, terms.columns)
    text = col(column)
    if small_enough(terms, compare_rows):
        joined = F.broadcast(terms).join(target, F.contains(text, F.col("__term")))
        return joined.withColumnRenamed("__term", term)
    importable(target.sparkSession)
    wanted = terms.select("__term").distinct()
    if small_enough(wanted, automaton_terms, TERM_BYTES):
        return _automaton_join(target, terms, wanted, text).withColumnRenamed("__term", term)
    return _gram_join(target, terms, wanted, text).withColumnRenamed("__term", term)


def _automaton_join(target: DataFrame, terms: DataFrame, wanted: DataFrame, text: Column) -> DataFrame:
    spark = target.sparkSession
    listed = sorted(r[0] for r in wanted.collect())
    held = [t.encode() for t in listed if t]
    # The empty term, if there is one, is the first.
    shared, empty = spark.sparkContext.broadcast(Automaton(held)), len(listed) - len(held)

    @F.arrow_udf("array<int>")
    def numbers(texts: pa.Array) -> pa.Array:
        return held_terms(texts, shared.value)

    found = F.when(text.isNotNull(), numbers(text.cast("string")))
    if empty:
        found = F.concat(F.array(F.lit(-1)), found)
    numbered = spark.createDataFrame([(i - empty, t) for i, t in enumerate(listed)], "__no int, __text string")
    asked = terms.join(F.broadcast(numbered), F.col("__term") == F.col("__text")).drop("__text")
    hits = target.withColumn("__hit", F.explode(found))
    columns = [*[col(c) for c in terms.columns], *[col(c) for c in target.columns]]
    return asked.join(hits, F.col("__no") == F.col("__hit")).select(*columns)


def grams(texts: pa.Array, sizes: list[int]) -> pa.Array:
    """For each text its different runs of so many bytes, up to eight, as numbers; runs of different lengths may share one."""
    data, bounds = texts_as_bytes(texts)
    rows, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in sizes:
        if n == 0:
            rows.append(np.arange(len(texts)))
            values.append(np.zeros(len(texts), np.int64))
            continue
        fits = np.maximum(np.diff(bounds) - n + 1, 0)
        starts = np.arange(int(fits.sum())) + np.repeat(bounds[:-1] - (np.cumsum(fits) - fits), fits)
        value = np.full(len(starts), n % GRAM, np.uint64)
        for k in range(n):
            value = value << np.uint64(8) | data[starts + k]
        rows.append(np.repeat(np.arange(len(texts)), fits))
        values.append(value.view(np.int64))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    lists = np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(texts)))])
    return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(value[new], pa.int64()))


def _grams_of(text: Column, sizes: list[int]) -> Column:
    @F.arrow_udf("array<long>")
    def held(texts: pa.Array) -> pa.Array:
        return grams(texts, sizes)

    return held(text.cast("string"))


def _gram_join(target: DataFrame, terms: DataFrame, wanted: DataFrame, text: Column) -> DataFrame:
    size = F.least(F.octet_length("__term"), F.lit(GRAM))
    sizes = sorted(r[0] for r in wanted.select(size.alias("n")).distinct().collect())
    own = F.coalesce(*[F.when(size == n, _grams_of(F.col("__term"), [n])) for n in sizes])
    parts = wanted.select("__term", F.explode(own).alias("__gram"))

    hashed = target.filter(text.isNotNull()).withColumn("__row", row_hash(target))
    if hashed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < SPREAD_BYTES:
        # A small file is read by one task, which would hold and sort all its grams, some fifty times the texts.
        tasks = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hashed = hashed.repartition(tasks, "__row")
    narrow = hashed.select("__row", F.explode(_grams_of(text, sizes)).alias("__gram"))
    asked = parts.select("__gram").distinct()
    # Spark takes the grams of a small file to be as small as the file, and would broadcast them. The terms' side goes, if it is small.
    few = small_enough(asked, BROADCAST_ROWS)
    counts = narrow.join(F.broadcast(asked) if few else asked.hint("merge"), "__gram", "left_semi").groupBy("__gram").agg(F.count("*").alias("__n"))
    ranked = (parts if few else parts.hint("merge")).join(counts, "__gram", "left").groupBy("__term")
    often = F.coalesce("__n", F.lit(0))
    keys = ranked.agg(F.min_by("__gram", F.struct(often, "__gram")).alias("__gram"), F.min(often).alias("__n"))
    keys = keys.filter("__n > 0").drop("__n")
    found = narrow.join(F.broadcast(keys) if few else keys.hint("merge"), "__gram").select("__row", F.col("__term").alias("__hit")).distinct()
    joined = hashed.join(found, "__row").filter(F.contains(text, F.col("__hit"))).drop("__row")
    return terms.join(joined, F.col("__term") == F.col("__hit")).drop("__hit")
