"""The difference of two tables by digests of key ranges, so that only ranges that differ are read row by row.

Both tables are cut at the same keys, and each range has a digest: its number of rows and the sums of two hashes of them, which stand
for a range's rows whatever their order and however often they repeat. Ranges whose digests differ are cut again, down to where that
no longer pays. The rows of the others are neither moved nor compared; a scan sorted by the key skips them by a plain filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.functions.predicates import any_of, col
from tablekeeper.plans.conditions import literal_of
from tablekeeper.plans.places import steps_before, text_cuts

#: Ranges at each level, levels, and rows of differing ranges that are not cut again.
RANGES, LEVELS, FEW_ROWS = 256, 4, 50_000


def table_diff(before: DataFrame, after: DataFrame, key: str, ranges: int = RANGES, few: int = FEW_ROWS) -> DataFrame:
    """The rows that are in one table only, as often as they are, with `change`: removed or added. Nulls are equal.

    `key` is the column by which ranges are formed; it need not be unique. Both tables have the same columns.
    """
    if before.columns != after.columns:
        raise ValueError(f"the tables differ in their columns: {before.columns} and {after.columns}")
    scope = differing(before, after, key, ranges, few)
    names = before.columns
    signed = [t.filter(scope).withColumn("__sign", F.lit(s)) for t, s in ((before, -1), (after, 1))]
    net = signed[0].unionByName(signed[1]).groupBy(*[col(c) for c in names]).agg(F.sum("__sign").alias("__net")).filter("__net <> 0")
    change = F.when(F.col("__net") < 0, "removed").otherwise("added").alias("change")
    times = F.explode(F.sequence(F.lit(1), F.abs("__net").cast("int"))).alias("__copy")
    return net.select(*[col(c) for c in names], change, times).drop("__copy")


def differing(before: DataFrame, after: DataFrame, key: str, ranges: int = RANGES, few: int = FEW_ROWS) -> Column:
    """A predicate of the key that holds for all rows that are in one table only, and for few others."""
    kind, value = before.schema[key].dataType, col(key)
    scope, rows = F.lit(True), math.inf
    for _ in range(LEVELS):
        inside = before.filter(scope), after.filter(scope)
        cuts = _cuts(inside[0].select(value).unionAll(inside[1].select(value)), value, kind, ranges)
        edges = F.array(*[literal_of(c, kind) for c in cuts]) if cuts else F.array()
        number = steps_before(value, edges, len(cuts), lambda cut, v: cut <= v).alias("__range")
        digests = [t.groupBy(number).agg(*_digest(t)) for t in inside]
        joined = digests[0].alias("b").join(digests[1].alias("a"), F.col("b.__range") == F.col("a.__range"), "full_outer")
        same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("n", "one", "two")]
        size = F.coalesce("b.n", F.lit(0)) + F.coalesce("a.n", F.lit(0))
        found = joined.filter(~(same[0] & same[1] & same[2])).select(F.coalesce("b.__range", "a.__range").alias("at"), size.alias("n")).collect()
        if not found:
            return F.lit(False)
        left = sum(r["n"] for r in found)
        scope = scope & any_of(_within(value, cuts, kind, first, last) for first, last in _runs(sorted(r["at"] for r in found)))
        if left <= few or left > rows / 2 or not cuts:
            break
        rows = left
    return scope


def _digest(table: DataFrame) -> list[Column]:
    held = [col(c) for c, kind in table.dtypes if not kind.startswith(("map", "variant"))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *held).cast("decimal(20,0)")) for seed in (1, 2)]
    return [F.count("*").alias("n"), sums[0].alias("one"), sums[1].alias("two")]


def _cuts(keys: DataFrame, value: Column, kind: T.DataType, ranges: int) -> list:
    """Different keys in order, with about equally many rows between them."""
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return text_cuts(keys, value, ranges)
    found = keys.agg(F.percentile_approx(value, [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0] or []
    kept = []
    for cut in found:  # in order; NaN, the last, is no cut
        if cut == cut and (not kept or cut != kept[-1]):
            kept.append(cut)
    return kept


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for n in numbers:
        if out and out[-1][1] == n - 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def _within(value: Column, cuts: list, kind: T.DataType, first: int, last: int) -> Column:
    """Keys of the ranges from one number to another; a null key is in the first range."""
    inside = value >= literal_of(cuts[first - 1], kind) if first else F.lit(True)
    if last < len(cuts):
        inside = inside & (value < literal_of(cuts[last], kind))
    return F.coalesce(inside, F.lit(False)) | value.isNull() if first == 0 else inside
