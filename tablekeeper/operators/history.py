"""Slowly changing rows: what held for a key from when to when, kept up with changes in any order.

A history has a row for each change: the keys, the values, `valid_from`, `valid_to` (not included; null for the last), `is_gone` for
the time in which a key does not exist, and `is_current`. A change row says what holds from a time on, or that the key is gone from
then on. Changes that come late split the interval they fall into. Since a change that brings nothing new is kept too, and so is
the end of a key, changes lead to the same history in whatever batches they come. Only keys with changes are worked on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import all_of, col, is_true
from tablekeeper.operators.select import first_per_key
from tablekeeper.plans.conditions import Parts
from tablekeeper.plans.keys import without_clash
from tablekeeper.plans.ranks import By

FROM, TO, GONE, CURRENT = "valid_from", "valid_to", "is_gone", "is_current"
#: Parts of time in which the changes of a key are put in order apart.
TIME_PARTS = 64


def history_of(changes: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], gone: Column | None = None) -> DataFrame:
    """The history that change rows tell. `gone` is true for rows that end a key; unknown is not.

    Rows with a null key or time say nothing. Of rows of one key and time one that ends the key counts, else the last by `values`.
    """
    without_clash(changes.select(*[col(c) for c in [*keys, *values]]), [FROM, TO, GONE, CURRENT])
    return _intervals(_told(changes, keys, time, values, gone, 0), keys, values)


def apply_changes(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], gone: Column | None = None
) -> DataFrame:
    """The history after more changes, whenever they took effect; of one key and time the new change counts."""
    new = _told(changes, keys, time, values, gone, 1)
    touched = new.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    same = all_of(col(k) == F.col(f"__k{i}") for i, k in enumerate(keys))
    own = _told(history.join(touched, same, "left_semi"), keys, FROM, values, F.col(GONE), 0)
    line = own.unionByName(new.withColumn("__at", F.col("__at").cast(history.schema[FROM].dataType)))
    rest = history.join(touched, same, "left_anti")
    return rest.unionByName(_intervals(line, keys, values).select(*[col(c) for c in rest.columns]))


def steady(history: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The history with adjacent intervals of equal values as one, and without the times in which a key is gone. Nulls are equal."""
    line = _parted(_told(history, keys, FROM, values, F.col(GONE), 0), keys)
    names = [f"__k{i}" for i in range(len(keys))]
    line = line.withColumn("__said", F.struct("__gone", F.when(~F.col("__gone"), F.col("__row")).alias("r")))
    changed = _beside(line, names, "__said", "__before", after=False).filter(~F.col("__before").eqNullSafe(F.col("__said")))
    return _shown(changed, keys, values).filter(~col(GONE)).drop(GONE)


def _told(changes: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], gone: Column | None, new: int) -> DataFrame:
    over = F.lit(False) if gone is None else is_true(gone)
    row = F.struct(*[col(v) for v in values])
    rows = changes.select(*[col(k) for k in keys], col(time).alias("__at"), row.alias("__row"), over.alias("__gone"), F.lit(new).alias("__new"))
    return rows.filter(all_of(col(c).isNotNull() for c in [*keys, "__at"]))


def _parted(line: DataFrame, keys: Sequence[str]) -> DataFrame:
    line = line.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__at", "__row", "__gone", "__new")
    parts = Parts(line, F.col("__at"), line.schema["__at"].dataType, TIME_PARTS)
    return line.withColumn("__part", parts.number(F.col("__at")))


def _intervals(line: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    rank = [By(F.col("__new"), True), By(F.col("__gone"), True), By(F.col("__row"), True)]
    return _shown(_parted(first_per_key(line, [*keys, "__at"], rank), keys), keys, values)


def _shown(line: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    names = [f"__k{i}" for i in range(len(keys))]
    return _beside(line, names, "__at", TO, after=True).select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)],
        *[F.when(~F.col("__gone"), F.col("__row").getField(v)).alias(v) for v in values],
        F.col("__at").alias(FROM),
        TO,
        F.col("__gone").alias(GONE),
        F.col(TO).isNull().alias(CURRENT),
    )


def _beside(line: DataFrame, names: Sequence[str], value: str, name: str, after: bool) -> DataFrame:
    """The value of the row before or after each, by key and time. Inside parts by a window; the first and last row of a key in each part
    then make a part of their own, at most two rows for each of TIME_PARTS. One pass: the line stands once in the plan, so steps add up."""
    inside = Window.partitionBy(*names, "__part").orderBy("__at")
    next_to, far = (F.lead, F.lag) if after else (F.lag, F.lead)
    own = [c for c in line.columns if c != name]
    line = line.withColumns({"__step": next_to(value).over(inside), "__far": far("__at").over(inside)})
    at_edge = F.col("__step").isNull() | F.col("__far").isNull()
    line = line.withColumn("__part_or_edge", F.when(at_edge, -1).otherwise(F.col("__part")))
    across = Window.partitionBy(*names, "__part_or_edge").orderBy("__at")
    return line.withColumn("__edge", next_to(value).over(across)).select(*own, F.coalesce("__step", "__edge").alias(name))
