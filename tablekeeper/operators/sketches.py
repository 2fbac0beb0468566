"""Column statistics that combine: sketches per group, kept as binary columns and merged into those of larger groups.

A sketch of distinct values (HyperLogLog) and one of quantiles (KLL) have a bounded size whatever they stand for, so a table's
statistics are those of its partitions merged, and a new partition is read alone. Merged sketches have the error of one sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.functions.predicates import col
from tablekeeper.plans.ranges import axis

#: Bits of the distinct sketch (a relative error of 1.04 / 2^(bits / 2)), and K of the quantile sketch (200: 1.7 % of the ranks).
DISTINCT_BITS, QUANTILE_K = 14, 400
HOLDS = ["rows", "missing", "distinct_sketch", "quantile_sketch"]


def sketch(frame: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row for each group and column: `column_name`, `rows`, `missing`, and the two sketches of its values.

    Values that cannot be put on a number line, such as texts, have no quantile sketch. NaN is the largest number. An empty table
    has one row per column without groups, and none with them.
    """
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    aggregates, rows = [F.count("*").alias("__rows")], []
    for i, name in enumerate(columns):
        value, kind = col(name), kinds[name]
        plain = value if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else value.cast("string")
        ordered = isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
        quantiles = F.kll_sketch_agg_double(axis(value, kind), F.lit(QUANTILE_K)) if ordered else F.lit(None).cast("binary")
        aggregates += [
            F.count_if(value.isNull()).alias(f"__missing{i}"),
            F.hll_sketch_agg(plain, F.lit(DISTINCT_BITS)).alias(f"__distinct{i}"),
            quantiles.alias(f"__quantile{i}"),
        ]
        parts = [F.col("__rows"), F.col(f"__missing{i}"), F.col(f"__distinct{i}"), F.col(f"__quantile{i}")]
        rows.append(F.struct(F.lit(name).alias("column_name"), *[p.alias(n) for p, n in zip(parts, HOLDS, strict=True)]))
    groups = [col(c) for c in by]
    return frame.groupBy(*groups).agg(*aggregates).select(*groups, F.inline(F.array(*rows)))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of larger groups, by some of the group columns or none, from those of smaller ones."""
    return sketches.groupBy(*[col(c) for c in by], "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def estimates(sketches: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches' groups with `rows`, `missing`, `distinct_values` and `quantiles`, on the number line of `plans.ranges.axis`."""
    groups = [col(c) for c in sketches.columns if c not in ("distinct_sketch", "quantile_sketch")]

    def quantile(share: float) -> Column:
        return F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(share)))

    found = F.when(F.kll_sketch_get_n_double("quantile_sketch") > 0, F.array(*[quantile(s) for s in shares]))
    return sketches.select(*groups, F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), found.alias("quantiles"))
