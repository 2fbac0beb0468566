"""A corpus pipeline over the table documents: language, near-duplicates, repeated passages, mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
documents. `run` applies them in order and writes each stage's rows below the folder in spark.checkpoint.dir.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeeper.llm import bpe, language, mixing, passages, repeats, simhash
from tablekeeper.llm.registry import importable, table
from tablekeeper.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = ["_id", "_th"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in no known language, or in none with enough certainty; text is not changed."""
    importable(spark)
    docs = docs.select(*COLUMNS)
    found = language.identify_documents(docs, table(spark, sf_dir, "pages"))
    # Written, so that its size is known: few are rejected, and a small table is broadcast to the texts.
    rejected = stored(found.filter("NOT kept").select(*KEY).distinct(), "rejected")
    return repeats.keyed(docs, "doc_id", "text").join(rejected, KEY, "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least doc_id of each group of near-duplicates; a repeated row stays once."""
    importable(spark)
    keyed = repeats.keyed(docs.select(*COLUMNS), "doc_id", "text")
    groups = simhash.classes(keyed, "doc_id", "text", more=KEY)
    first = F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", *KEY)  # a null doc_id is the last
    kept = groups.groupBy("_root").agg(F.min(first).alias("_least")).select(*[f"_least.{k}" for k in KEY])
    once = keyed.join(kept, KEY, "left_semi").dropDuplicates(KEY)
    return once.select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur more than once out of the text, whose lines and spaces stay.

    A document of which nothing is left goes, one that loses nothing is unchanged.
    """
    importable(spark)
    cut = passages.remove_repeats(docs.select(*COLUMNS), as_it_stands=True).filter("_n_removed = 0 OR _n_removed < _n_words")
    changed = F.col("_n_removed") > 0
    text = F.when(changed, F.col("_kept")).otherwise(F.col("text"))
    length = F.when(changed, F.length("_kept").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": length}).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it; some not at all."""
    return mixing.emit(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def byte_pair_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the token ids of each document's text."""
    importable(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs.select("doc_id", "source", "text"), path, pattern)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", near_duplicates),
    ("passages", repeated_passages),
    ("mix", source_mix),
    ("tokens", byte_pair_tokens),
]

#: SQL cannot express byte-pair merges; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
