"""Selection of target rows by a criteria table. Every operator returns one lazy DataFrame.

Operators that tag a row with its search values are inner joins and keep multiplicity: a
target row appears once per criteria row it matches. Set selections are semi joins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import all_of, col, row_hash
from tablekeeper.plans.conditions import Parts, ordered_join
from tablekeeper.plans.grams import contains_join
from tablekeeper.plans.keys import KEY, Keys, distinct_keys, key_pairs, keys_match, rename_keys, without_clash
from tablekeeper.plans.ranges import comparison_type, range_join
from tablekeeper.plans.ranks import By, order_by
from tablekeeper.plans.sizing import (
    COMPARE_ROWS,
    broadcast_if_small,
    compares_all_pairs,
    prefilter,
)

# Row count up to which a window keeps only the leading rows of a group before it shuffles.
WINDOW_LIMIT = 1_000
# Fixed value: parts of time in which the events of a key are counted apart.
TIME_PARTS = 64


def select_by_value(
    target: DataFrame,
    criteria: DataFrame,
    target_column: str,
    criteria_column: str | None = None,
    search_as: str = "search_value",
    small: bool = False,
) -> DataFrame:
    """Rows whose column equals a search value, tagged with that value."""
    return select_by_columns(
        target, criteria, {target_column: criteria_column or target_column}, [search_as], small
    )


def select_by_columns(
    target: DataFrame,
    criteria: DataFrame,
    on: Keys,
    search_as: Sequence[str] | None = None,
    small: bool = False,
) -> DataFrame:
    """Rows that match a criteria row on all mapped columns, tagged with the search values.

    `small=True` asks for a broadcast of the criteria behind a size check; otherwise the
    optimizer decides from sizes it knows or measures.
    """
    pairs = key_pairs(on, target, criteria)
    search_as = list(search_as or [f"search_{name}" for _, name in pairs])
    if len(search_as) != len(pairs):
        raise ValueError("search_as needs one name per key column")
    without_clash(target, search_as)
    keys = criteria.select(*rename_keys(pairs, criteria)).dropna()
    if small:
        keys = broadcast_if_small(keys)
    tags = [F.col(f"{KEY}{i}").alias(name) for i, name in enumerate(search_as)]
    return keys.join(target, keys_match(pairs)).select(*tags, *[col(c) for c in target.columns])


def select_between(target: DataFrame, criteria: DataFrame, column: str, lower: str, upper: str, **options) -> DataFrame:
    """Rows with `lower <= column <= upper`, both ends closed, tagged with the range."""
    return range_join(target, criteria.select(col(lower), col(upper)), column, lower, upper, **options)


def select_greater(target: DataFrame, criteria: DataFrame, column: str, threshold: str, **options) -> DataFrame:
    return range_join(target, criteria.select(col(threshold)), column, lower=threshold, strict=True, **options)


def select_less(target: DataFrame, criteria: DataFrame, column: str, threshold: str, **options) -> DataFrame:
    return range_join(target, criteria.select(col(threshold)), column, upper=threshold, strict=True, **options)


def select_in_set(target: DataFrame, criteria: DataFrame, on: Keys, small: bool = False) -> DataFrame:
    """Rows whose key is in the criteria, once each, whatever the criteria repeat."""
    pairs = key_pairs(on, target, criteria)
    keys = distinct_keys(criteria, pairs)
    return target.join(broadcast_if_small(keys) if small else keys, keys_match(pairs), "left_semi")


def select_values(target: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Keep only rows whose column is one of a few literal values."""
    return target.filter(col(column).isin([v for v in values if v is not None]))


def select_join(target: DataFrame, criteria: DataFrame, on: Keys) -> DataFrame:
    """Inner join; each key column appears once, under its target name, criteria columns first."""
    pairs = key_pairs(on, target, criteria)
    renamed = criteria.withColumnsRenamed({c: t for t, c in pairs})
    keys = [t for t, _ in pairs]
    without_clash(target.drop(*keys), [c for c in renamed.columns if c not in keys])
    if len(set(renamed.columns)) < len(renamed.columns):
        raise ValueError(f"criteria hold a column that is named like a target key already: {renamed.columns}")
    return renamed.join(target, keys)


def select_by_condition(
    target: DataFrame,
    criteria: DataFrame,
    condition: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    search_as: Mapping[str, str] | None = None,
    compare_all_pairs: bool = False,
) -> DataFrame:
    """Rows that satisfy `condition(search, target)` for a criteria row.

    `condition` gets two functions from a column name to a Column and is called once.
    Equalities in it become join keys; without one, comparisons become a range join, or place both sides on a grid. With neither,
    every pair has to be compared, which is refused at any size unless asked for; substrings have a join of their own.
    """
    search_as = dict(search_as or {name: name for name in criteria.columns})
    without_clash(target, search_as.values())
    held = {name: f"__search{i}" for i, name in enumerate(criteria.columns)}
    sides = criteria.select(*[col(name).alias(alias) for name, alias in held.items()])
    test = condition(lambda name: F.col(held[name]), col)
    tags = [F.col(held[name]).alias(alias) for name, alias in search_as.items()]
    columns = [*tags, *[col(c) for c in target.columns]]
    if not compare_all_pairs and compares_all_pairs(sides.join(target, test)):
        found = ordered_join(target, sides, test, columns)
        if found is None:
            raise ValueError(
                "no equality or comparison of both sides in the condition: add one, use select_dispatch for substrings, "
                "or ask for compare_all_pairs"
            )
        return found
    return broadcast_if_small(sides, COMPARE_ROWS).join(target, test).select(*columns)


def select_dispatch(
    target: DataFrame,
    criteria: DataFrame,
    *,
    kind: str,
    value: str,
    lower: str,
    upper: str,
    exact_column: str,
    range_column: str,
    contains_column: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Match kind chosen per criteria row: `exact_match`, `range` or `contains`; other kinds are skipped.

    Each kind is its own join, because an OR over kinds would leave no key to join on.
    """
    wanted = [col(kind), *[col(c) for c in (columns or target.columns)]]

    def rows(name: str, *needed: str) -> DataFrame:
        return criteria.filter(col(kind) == name).select(col(kind), *[col(c) for c in needed])

    exact = rows("exact_match", value).withColumnRenamed(value, "__value")
    exact = exact.join(target, F.col("__value") == col(exact_column)).select(*wanted)
    ranged = range_join(target, rows("range", lower, upper), range_column, lower, upper).select(*wanted)
    inside = contains_join(target, rows("contains", value), contains_column, value).select(*wanted)
    return exact.unionByName(ranged).unionByName(inside)


def select_time_range(target: DataFrame, criteria: DataFrame, column: str, start: str, end: str, **options) -> DataFrame:
    """Rows inside closed time windows, tagged with the window."""
    return range_join(target, criteria.select(col(start), col(end)), column, start, end, **options)


def first_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str | By] | str, rows: int = 1) -> DataFrame:
    """The first `rows` rows of each key. No task passes on more than that many per key."""
    spec = order_by(order)
    if rows == 1 and len({by.descending for by in spec}) == 1:
        return _first_row(frame, keys, spec)
    sorting = [by.value.desc() if by.descending else by.value.asc() for by in spec]
    names = [col(k) for k in keys]

    def leading(data: DataFrame, groups: Sequence[Column]) -> DataFrame:
        window = Window.partitionBy(*groups).orderBy(*sorting)
        return data.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= rows).drop("__rank")

    if rows > WINDOW_LIMIT:
        # Beyond the built-in limit, cut inside salted parts of a group first, then per group.
        salt = F.pmod(row_hash(frame), F.lit(64))
        frame = leading(frame.withColumn("__salt", salt), [*names, F.col("__salt")]).drop("__salt")
    return leading(frame, names)


def _first_row(frame: DataFrame, keys: Sequence[str], spec: Sequence[By]) -> DataFrame:
    """One row per key as an aggregate, which is combined map-side. Struct order puts nulls smallest, as sorting does."""
    pick = F.max_by if spec[0].descending else F.min_by
    row = F.struct(*[col(c) for c in frame.columns])
    chosen = pick(row, F.struct(*[by.value.alias(f"o{i}") for i, by in enumerate(spec)]))
    return frame.groupBy(*[col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(chosen.alias("__row")).select("__row.*")


def select_capped(
    target: DataFrame,
    criteria: DataFrame,
    on: Keys,
    order: Sequence[str] | str,
    per_value: int = 1_000,
    max_results: int | None = 10_000,
) -> DataFrame:
    """At most `per_value` rows per search value, then at most `max_results` in all, in the given order.

    Search values are taken once each; repeats would only repeat rows.
    """
    pairs = key_pairs(on, target, criteria)
    keys = [name for name, _ in pairs]
    # The cap comes before a join that shuffles, so a hot value is cut in every task first.
    asked = _asked_rows(target, criteria, pairs)
    kept = select_in_set(first_per_key(asked, keys, order, per_value), criteria, on)
    if max_results is None:
        return kept
    sorting = [by.value.desc() if by.descending else by.value.asc() for by in order_by(order)]
    return kept.orderBy(*[col(k) for k in keys], *sorting).limit(max_results)


def selection_errors(criteria: DataFrame, column: str, index: str) -> tuple[DataFrame, DataFrame]:
    """(usable criteria, rejected criteria as `index, error`). A missing column rejects every row."""
    if column not in criteria.columns:
        missing = criteria.select(col(index), F.lit(f"missing column {column}").alias("error"))
        return criteria.filter(F.lit(False)), missing
    null = criteria.filter(col(column).isNull())
    return criteria.filter(col(column).isNotNull()), null.select(col(index), F.lit("null value").alias("error"))


def selection_summary(target: DataFrame, criteria: DataFrame, on: Keys, search_as: Sequence[str] | None = None) -> DataFrame:
    """Matches per search value. Both sides are counted per key before they meet."""
    pairs = key_pairs(on, target, criteria)
    search_as = list(search_as or (["search_value"] if len(pairs) == 1 else [f"search_{c}" for _, c in pairs]))
    asked = criteria.select(*rename_keys(pairs, criteria)).dropna()
    asked = asked.groupBy(*asked.columns).agg(F.count("*").alias("__asked"))
    held = _asked_rows(target, criteria, pairs)
    held = held.groupBy(*[col(t).alias(f"__t{i}") for i, (t, _) in enumerate(pairs)]).agg(
        F.count("*").alias("__held")
    )
    on_keys = [F.col(f"{KEY}{i}") == F.col(f"__t{i}") for i in range(len(pairs))]
    tags = [F.col(f"{KEY}{i}").alias(name) for i, name in enumerate(search_as)]
    return asked.join(held, on_keys).select(*tags, (F.col("__asked") * F.col("__held")).alias("matches"))


def _asked_rows(target: DataFrame, criteria: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    return prefilter(target, distinct_keys(criteria, pairs), keys_match(pairs))


def selection_totals(target: DataFrame, criteria: DataFrame, on: Keys) -> DataFrame:
    """One row: total matches, distinct search values that matched, and the target columns seen."""
    summary = selection_summary(target, criteria, on)
    return summary.agg(
        F.coalesce(F.sum("matches"), F.lit(0)).alias("total_matches"),
        F.count("*").alias("unique_search_values"),
        F.array(*[F.lit(c) for c in target.columns]).alias("target_columns"),
    )


def select_join_agg(
    target: DataFrame,
    criteria: DataFrame,
    on: Keys,
    by: Sequence[str],
    average: Mapping[str, str],
    count: Mapping[str, str],
) -> DataFrame:
    """Averages and counts of target columns, grouped by criteria columns, over the join.

    Sums and counts per key are built before the join, so a hot key joins as one row.
    `average` and `count` map the output name to a target column.
    """
    pairs = key_pairs(on, target, criteria)
    partial = []
    for name, source in average.items():
        partial += [F.sum(col(source)).alias(f"__sum_{name}"), F.count(col(source)).alias(f"__n_{name}")]
    partial += [F.count(col(source)).alias(f"__n_{name}") for name, source in count.items()]
    held = _asked_rows(target, criteria, pairs)
    held = held.groupBy(*[col(t).alias(f"__t{i}") for i, (t, _) in enumerate(pairs)]).agg(*partial)
    asked = criteria.groupBy(*rename_keys(pairs, criteria), *[col(b) for b in by]).agg(F.count("*").alias("__times"))
    on_keys = [F.col(f"{KEY}{i}") == F.col(f"__t{i}") for i in range(len(pairs))]
    times = F.col("__times")
    final = [
        (F.sum(F.col(f"__sum_{name}") * times) / F.sum(F.col(f"__n_{name}") * times)).alias(name)
        for name in average
    ]
    final += [F.sum(F.col(f"__n_{name}") * times).alias(name) for name in count]
    return asked.join(held, on_keys).groupBy(*[col(b) for b in by]).agg(*final)


def validate_exists(rows: DataFrame, target: DataFrame, on: Keys, flag: str = "found") -> DataFrame:
    """Each input row with a flag: does the target hold its key? `on` maps input -> target columns."""
    pairs = key_pairs(on, rows, target)
    without_clash(rows, [flag])
    held = _asked_rows(target, rows, [(t, r) for r, t in pairs])
    known = distinct_keys(held, pairs).withColumn("__known", F.lit(True))
    joined = rows.join(known, keys_match(pairs), "left")
    return joined.select(*[col(c) for c in rows.columns], F.coalesce("__known", F.lit(False)).alias(flag))


def enrich_first(
    source: DataFrame,
    lookup: DataFrame,
    on: Keys,
    columns: Sequence[str],
    order: Sequence[str] | str,
) -> DataFrame:
    """Add columns of the first lookup row per key; the lookup wins on a name clash, unmatched rows drop.

    `on` maps source -> lookup columns. "First" is by the lookup order given.
    """
    pairs = key_pairs(on, source, lookup)
    spec = order_by(order)
    held = _asked_rows(lookup, source, [(right, left) for left, right in pairs]).select(
        *rename_keys(pairs, lookup),
        *[col(c).alias(f"__new_{c}") for c in columns],
        *[by.value.alias(f"__o{i}") for i, by in enumerate(spec)],
    )
    keys = [f"{KEY}{i}" for i in range(len(pairs))]
    first = first_per_key(held.dropna(subset=keys), keys, [By(F.col(f"__o{i}"), by.descending) for i, by in enumerate(spec)])
    joined = source.join(first, keys_match(pairs))
    kept = [F.col(f"`__new_{c}`").alias(c) if c in columns else col(c) for c in source.columns]
    added = [F.col(f"`__new_{c}`").alias(c) for c in columns if c not in source.columns]
    return joined.select(*kept, *added)


def audit_breakdown(
    criteria: DataFrame,
    log: DataFrame,
    on: Keys,
    *,
    time: str,
    start: str,
    end: str,
    action: str,
) -> DataFrame:
    """Actions per criteria row (keys and period): `n` per action and `total_actions` over the period, both ends included.

    `on` maps log -> criteria columns. No event meets its periods: events and ends of periods are put in one order per key and
    action and counted through, and a period's count is the difference at its two ends. So an event is counted once, however many
    periods hold it. Counting goes in parts of time, so that a busy key is spread over tasks.
    """
    pairs = key_pairs(on, log, criteria)
    names, keys = [name for _, name in pairs], [f"{KEY}{i}" for i in range(len(pairs))]
    kinds = [log.schema[time].dataType, criteria.schema[start].dataType, criteria.schema[end].dataType]
    common = comparison_type(kinds) or kinds[0]
    ends = col(start).alias("__start"), col(end).alias("__end")
    periods = criteria.select(*rename_keys(pairs, criteria), *ends).distinct()
    periods = periods.filter(all_of(F.col(c).isNotNull() for c in [*keys, "__start", "__end"]))
    own = [col(t).alias(k) for (t, _), k in zip(pairs, keys, strict=True)]
    events = _asked_rows(log, criteria, pairs).select(*own, col(action).alias("__action"), col(time).try_cast(common).alias("__at"))
    events = events.filter(all_of(F.col(c).isNotNull() for c in [*keys, "__at"]))
    group = [*keys, "__action"]

    # The ends of a period are counted at for every action of its key: a start before events of its time, an end behind them.
    edges = periods.join(events.select(*group).distinct(), keys)
    edges = edges.select("*", F.explode(F.array(F.lit(0), F.lit(2))).alias("__side"))
    edges = edges.withColumn("__at", F.when(F.col("__side") == 0, F.col("__start").try_cast(common)).otherwise(F.col("__end").try_cast(common)))
    parts = Parts(events, F.col("__at"), common, TIME_PARTS)
    line = events.withColumn("__side", F.lit(1)).unionByName(edges.filter("__at IS NOT NULL"), allowMissingColumns=True)
    line = line.withColumns({"__part": parts.number(F.col("__at")), "__one": (F.col("__side") == 1).cast("long")})
    through = Window.partitionBy(*group, "__part").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    counted = line.withColumn("__n", F.sum("__one").over(through)).filter("__side <> 1")
    # What the parts before hold: a row for each key, action and part.
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    held = line.groupBy(*group, "__part").agg(F.sum("__one").alias("__all"))
    held = held.select(*[F.col(c).alias(f"__of{c}") for c in [*group, "__part"]], F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__before"))
    counted = counted.join(held, all_of(F.col(c).eqNullSafe(F.col(f"__of{c}")) for c in [*group, "__part"]))
    signed = (F.col("__n") + F.col("__before")) * (F.col("__side") - 1)
    counts = counted.groupBy(*keys, "__start", "__end", "__action").agg(F.sum(signed).alias("n")).filter("n > 0")
    period = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    whole = Window.partitionBy(*keys, "__start", "__end")
    total = F.sum("n").over(whole).alias("total_actions")
    return counts.select(*period, F.col("__start").alias(start), F.col("__end").alias(end), F.col("__action").alias("action"), "n", total)
