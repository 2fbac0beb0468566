"""Cleaning of one table: duplicates, missing values, positions, quantiles, outliers, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import all_of, col
from tablekeeper.operators.delete import delete_by_keys
from tablekeeper.operators.select import first_per_key
from tablekeeper.plans import ranks
from tablekeeper.plans.ranks import By, order_by
from tablekeeper.sources.files import literal_rows


# Fixed value: positions searched together before all are assigned.
FEW_POSITIONS = 12


def keep_where(target: DataFrame, condition: Column | str) -> DataFrame:
    """Keep rows for which the condition is true; unknown goes."""
    return target.filter(condition)


def drop_duplicates(
    target: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str = "first",
    order: Sequence[str] | str | None = None,
) -> DataFrame:
    """Drop rows that repeat. Nulls count as equal.

    `keep` is `first` or `last` by the order key, or `none` to drop every copy. Without a
    subset the copies are equal, so no order is needed.
    """
    if keep not in ("first", "last", "none"):
        raise ValueError("keep must be 'first', 'last' or 'none'")
    if keep == "none":
        return _drop_all_copies(target, subset or target.columns)
    if subset is None:
        return target.dropDuplicates()
    spec = order_by(order or [])
    if keep == "last":
        spec = [By(by.value, not by.descending) for by in spec]
    return first_per_key(target, subset, spec)


def _drop_all_copies(target: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Keys are counted map-side first; rows then join the keys that occur once, nulls alike."""
    single = (
        target.groupBy(*[col(c).alias(f"__g{i}") for i, c in enumerate(subset)])
        .agg(F.count("*").alias("__n"))
        .filter("__n = 1")
    )
    same = all_of(col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(subset))
    return target.join(single, same, "left_semi")


def drop_missing(target: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    return target.dropna(how=how, subset=list(subset) if subset else None)


def missing_counts(target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`column_name, missing` per column, from one pass."""
    columns = list(columns or target.columns)
    counts = target.agg(*[F.count_if(col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("missing")) for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*rows)))


def column_stats(target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, rows, nulls, approximate distinct values, minimum and maximum as text; one pass."""
    columns = list(columns or target.columns)
    kinds = dict(target.dtypes)
    aggs = []
    for i, c in enumerate(columns):
        ordered = not kinds[c].startswith(("map", "variant"))
        aggs += [
            F.count_if(col(c).isNull()).alias(f"__null{i}"),
            (F.approx_count_distinct(col(c)) if ordered else F.lit(None).cast("bigint")).alias(f"__distinct{i}"),
            (F.min(col(c)).cast("string") if ordered else F.lit(None).cast("string")).alias(f"__min{i}"),
            (F.max(col(c)).cast("string") if ordered else F.lit(None).cast("string")).alias(f"__max{i}"),
        ]
    flat = target.agg(F.count("*").alias("__rows"), *aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds[c]).alias("type"),
            F.col("__rows").alias("rows"),
            F.col(f"__null{i}").alias("missing"),
            F.col(f"__distinct{i}").alias("distinct_values"),
            F.col(f"__min{i}").alias("minimum"),
            F.col(f"__max{i}").alias("maximum"),
        )
        for i, c in enumerate(columns)
    ]
    return flat.select(F.inline(F.array(*rows)))


def profile_criteria(criteria: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per criteria column: type, exact distinct values and nulls, to look at before acting.

    One pass: values go as text under their column's name and are counted map-side, so a frequent value is one partial
    row. An empty table has no rows here.
    """
    columns = list(columns or criteria.columns)
    kinds = dict(criteria.dtypes)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("type"), col(c).cast("string").alias("v")) for c in columns]
    by_value = criteria.select(F.inline(F.array(*rows))).groupBy("column_name", "type", "v").agg(F.count("*").alias("n"))
    return by_value.groupBy("column_name", "type").agg(
        F.count("v").alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    )


def table_counts(target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`row_count` and `distinct_rows`; rows with nulls count as rows. One pass over the table."""
    names = list(columns or target.columns)
    groups = target.groupBy(*[col(c) for c in names]).agg(F.count("*").alias("__n"))
    return groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"), F.count("*").alias("distinct_rows"))


def delete_positions(
    target: DataFrame, order: Sequence[str] | str, positions: Sequence[int], key: Sequence[str] | str, **bounds: int
) -> DataFrame:
    """Delete rows at 0-based positions of the given order. A position outside the table is an error.

    `key` names the columns that identify a row. Low positions come from one bounded
    top-k, a few others are searched together, and many are assigned partition by partition.
    """
    wanted = sorted(set(positions))
    if not wanted:
        return target
    total = target.count()
    if wanted[0] < 0 or wanted[-1] >= total:
        raise IndexError(f"positions {wanted[0]} to {wanted[-1]} do not all lie in the table")
    names = [key] if isinstance(key, str) else list(key)
    spec = [*order_by(order), *order_by(names)]
    low = wanted[-1] < bounds.get("top_rows", ranks.TOP_ROWS)
    if not low and len(wanted) <= FEW_POSITIONS:
        found = [f.key for f in ranks.keys_at(target, spec, wanted, total, **bounds)]
        return target.filter(ranks.not_at(target, spec, found))
    keys = target.select(*[col(n) for n in names], *[by.value.alias(f"__o{i}") for i, by in enumerate(spec)])
    sorting = [By(F.col(f"__o{i}"), by.descending) for i, by in enumerate(spec)]
    if low:
        columns = [s.value.desc() if s.descending else s.value.asc() for s in sorting]
        lowest = keys.orderBy(*columns).limit(wanted[-1] + 1)
        one_task = Window.partitionBy(F.lit(0)).orderBy(*columns)
        keys = lowest.withColumn("__position", F.row_number().over(one_task) - 1)
    else:
        keys = ranks.with_positions(keys, sorting, "__position")
    asked = literal_rows(target.sparkSession, "__wanted long", [(p,) for p in wanted])
    victims = keys.join(F.broadcast(asked), F.col("__position") == F.col("__wanted")).select(*[col(n) for n in names])
    return delete_by_keys(target, victims, names, small=True).kept()


def delete_position_range(target: DataFrame, order: Sequence[str] | str, start: int, stop: int, **bounds: int) -> DataFrame:
    """Delete positions `start` (inclusive) to `stop` (exclusive), clipped to the table."""
    start, stop = max(start, 0), max(stop, 0)
    if stop <= start:
        return target
    spec = order_by(order)
    _, after = ranks.split_at(target, spec, stop, **bounds)
    if start == 0:
        return after
    before, _ = ranks.split_at(target, spec, start, **bounds)
    return before.unionAll(after)


def page(target: DataFrame, order: Sequence[str] | str, offset: int, rows: int, **bounds: int) -> DataFrame:
    """`rows` rows after skipping `offset`, in order."""
    spec = order_by(order)
    _, rest = ranks.split_at(target, spec, offset, **bounds)
    kept, _ = ranks.split_at(rest, spec, rows, **bounds)
    return kept.orderBy(*[by.value.desc() if by.descending else by.value.asc() for by in spec])


def tail(target: DataFrame, order: Sequence[str] | str, rows: int, **bounds: int) -> DataFrame:
    """The last `rows` rows of the given order, in that order."""
    spec = [By(by.value, not by.descending) for by in order_by(order)]
    return page(target, spec, 0, rows, **bounds).orderBy(
        *[by.value.asc() if by.descending else by.value.desc() for by in spec]
    )


def delete_top_n(target: DataFrame, column: str, n: int, tie_order: Sequence[str] | str, **bounds: int) -> DataFrame:
    """Delete the n rows with the largest values; ties go in `tie_order`."""
    _, rest = ranks.split_at(target, [By(col(column), True), *order_by(tie_order)], n, **bounds)
    return rest


def drop_top_fraction(target: DataFrame, column: str, fraction: float = 0.2, **bounds: int) -> DataFrame:
    """Keep rows up to the `1 - fraction` quantile (interpolated)."""
    cut = ranks.quantile(target, column, round(1.0 - fraction, 12), **bounds)
    return target.filter(F.lit(False) if cut is None else col(column) <= F.lit(cut))


def drop_bottom_fraction(target: DataFrame, column: str, fraction: float = 0.2, **bounds: int) -> DataFrame:
    """Keep rows above the `fraction` quantile (interpolated)."""
    cut = ranks.quantile(target, column, fraction, **bounds)
    return target.filter(F.lit(False) if cut is None else col(column) > F.lit(cut))


def drop_outliers(target: DataFrame, column: str, deviations: float = 2.0, sides: str = "both") -> DataFrame:
    """Keep rows within some sample standard deviations of the mean, on both sides or the upper one."""
    if sides not in ("both", "upper"):
        raise ValueError("sides must be 'both' or 'upper'")
    mean, spread = target.agg(F.avg(col(column)), F.stddev_samp(col(column))).first()
    if mean is None or spread is None:
        return target.filter(F.lit(False))
    reach = deviations * spread
    if sides == "upper":
        return target.filter(col(column) <= F.lit(mean + reach))
    return target.filter(F.abs(col(column) - F.lit(mean)) <= F.lit(reach))


def sample_exact(
    target: DataFrame,
    key: Sequence[str] | str,
    fraction: float,
    seed: int = 42,
    method: str = "xxhash64",
    **bounds: int,
) -> DataFrame:
    """Keep exactly `round(fraction * n)` rows, chosen by a hash of key and seed; repeatable.

    `method="md5"` chooses rows that other systems can choose too, at many times the cost per row.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    names = [key] if isinstance(key, str) else list(key)
    if method == "xxhash64":
        mixed = F.xxhash64(*[col(n) for n in names], F.lit(seed))
    elif method == "md5":
        parts = [F.coalesce(col(n).cast("string"), F.lit("")) for n in names]
        mixed = F.md5(F.concat_ws(":", *parts, F.lit(str(seed))).cast("binary"))
    else:
        raise ValueError("method must be 'xxhash64' or 'md5'")
    total = target.count()
    kept, _ = ranks.split_at(target, [By(mixed), *order_by(names)], round(fraction * total), total, **bounds)
    return kept


def sample_about(target: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Keep each row with the given probability; the count varies."""
    return target.sample(fraction=fraction, seed=seed)
