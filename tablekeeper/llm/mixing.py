"""Mixing of sources to target weights by whole copies, in DataFrame functions only.

Each source gets a target number of words. A document is taken floor(rate) times, and once more with
a probability equal to the fraction of its source's rate, drawn from a hash of the document, so that
every run takes the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekeeper.llm.words import WORD

#: Weights dealt to the sources in code point order, again and again.
WEIGHTS = (5, 2, 1)
#: A source is repeated this often at most.
MOST_REPEATS = 3
#: Columns that `mix` adds, or replaces where the documents have them.
ADDED = ("_size", "_source_size", "_target", "_copies", "_plan_source", "_copy", "_draw")


def size_of(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str = "source", size: str = "size", weights=WEIGHTS, most=MOST_REPEATS):
    """One row per source: `source`, `source_size` and `target`, its words in the mix.

    `sizes` is one row per document. Sources are dealt `weights` in code point order, null last, and share the
    whole size by them. A source that would exceed `most` times its size stops there, and what it leaves is
    shared among the others by weight until none is above. That end state has a closed form: in the order of
    (cap / weight), a source stops at its cap if an even share of what the sources before it leave is above the cap.
    The windows run over one row per source.
    """
    totals = sizes.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    dealt = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("_weight", dealt[((F.row_number().over(order) - 1) % len(weights)).cast("int")]).withColumn(
        "_cap", F.col("source_size") * most
    )
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        ranked.withColumn("_total", F.sum("source_size").over(every))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("_weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_capped", F.col("_cap") * F.col("_weights") <= F.col("_left") * F.col("_weight"))
    )
    rest = shared.withColumn(
        "_left", F.col("_total") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(every), F.lit(0))
    ).withColumn("_weights", F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(every))
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(
        F.col("_left").cast("double") * F.col("_weight") / F.col("_weights")
    )
    return rest.select("_source", "source_size", target.alias("target"))


def draw(*columns: Column) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 7) -> DataFrame:
    """The documents with `_size`, `_source_size`, `_target` and `_copies`, how often the mix takes each.

    Null text has size 0; a null source is a source of its own. A source of size 0 has target 0 and its
    documents, all without words, are taken 0 times. A row draws by its id and text, so rows that are alike in both draw alike,
    while others under a null or shared id do not. An empty table gives an empty result. The per-source table has one row per source and is joined with whatever join fits its size.
    """
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    # Drawn before the join, so that it need not carry the texts.
    drawn = draw(F.lit(seed), F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select(*own, size_of(F.col(text)).alias("_size"), drawn.alias("_draw"))
    plan = targets(sized.select(F.col(source).alias("_s"), "_size"), "_s", "_size").select(
        F.col("_source").alias("_plan_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )
    # Sources that no longer carry words cannot divide.
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    once_more = F.col("_draw") < rate - whole
    joined = sized.join(plan, sized[source].eqNullSafe(plan["_plan_source"]), "inner").drop("_plan_source")
    return joined.withColumn("_copies", (whole + once_more.cast("long")).cast("long")).drop("_draw")


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, in the columns it came with."""
    own = [c for c in mixed.columns if c not in ADDED]
    times = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")
    return mixed.filter("_copies > 0").select(*[F.col(f"`{c}`") for c in own], times).drop("_copy")
