"""Deletes as plans: preview, report and kept rows come from one definition of the victims.

Nothing runs until a result is used, and nothing is written until :meth:`DeletePlan.apply`.
A delete by a criteria table is a semi / anti join on distinct criteria keys; a delete by a
predicate is a filter. Rows whose test is unknown stay.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.functions.paths import base_name, days_before
from tablekeeper.functions.predicates import all_of, any_of, col, is_true, quality_rule, text_match
from tablekeeper.plans import ranks
from tablekeeper.plans.conditions import any_fits, ordered_join, target_names, undominated
from tablekeeper.plans.keys import KEY, Keys, distinct_keys, key_pairs, keys_match, rename_keys, without_clash
from tablekeeper.plans.sizing import COMPARE_ROWS, broadcast_if_small, compares_all_pairs
from tablekeeper.session import scratch_path

HIT = "hit"


@dataclass
class DeletePlan:
    """A delete that has been described but not carried out."""

    target: DataFrame
    operation: str
    victims: Callable[[], DataFrame]
    remaining: Callable[[], DataFrame]
    marked: Callable[[], DataFrame]
    parameters: dict = field(default_factory=dict)

    def preview(self) -> DataFrame:
        """The rows that would go."""
        return self.victims()

    def kept(self) -> DataFrame:
        """The table after the delete."""
        return self.remaining()

    def flagged(self) -> DataFrame:
        """Every target row with a boolean `hit`."""
        return self.marked()

    def report(self) -> DataFrame:
        """One row: rows before, deleted, after, and the percentage. A row counts once."""
        hits = self.flagged()
        total, deleted = F.count("*"), F.count_if(F.col(HIT))
        share = F.when(total > 0, F.round(100.0 * deleted / total, 1))
        return hits.agg(
            total.alias("rows_before"),
            deleted.alias("rows_deleted"),
            (total - deleted).alias("rows_after"),
            share.alias("pct_deleted"),
        )

    def apply(self, table, dry_run: bool = True, **options) -> dict:
        """Publish the kept rows as a new version of `table`; the default only reports.

        A delete that hits nothing publishes nothing. The new version is checked: it must
        hold exactly the rows the report announced, or it is not published.
        """
        counts = self.report().first().asDict()
        if dry_run or counts["rows_deleted"] == 0:
            return {**counts, "version": None}
        version = table.publish(
            self.kept(),
            operation=self.operation,
            parameters=self.parameters,
            expect_rows=counts["rows_after"],
            rows_before=counts["rows_before"],
            **options,
        )
        return {**counts, "version": version}


def delete_where(target: DataFrame, condition: Column, operation: str = "delete_where", **parameters) -> DeletePlan:
    """Delete rows for which the condition is true; unknown stays."""
    doomed = is_true(condition)
    return DeletePlan(
        target,
        operation,
        victims=lambda: target.filter(doomed),
        remaining=lambda: target.filter(~doomed),
        marked=lambda: target.withColumn(HIT, doomed),
        parameters=parameters,
    )


def _delete_joined(target: DataFrame, side: DataFrame, test: Column, operation: str, **parameters) -> DeletePlan:
    """`side` must hold at most one matching row per target row."""
    without_clash(target, [HIT])

    def marked() -> DataFrame:
        joined = target.join(side.withColumn("__side", F.lit(True)), test, "left")
        return joined.select(*[col(c) for c in target.columns], F.col("__side").isNotNull().alias(HIT))

    return DeletePlan(
        target,
        operation,
        victims=lambda: target.join(side, test, "left_semi"),
        remaining=lambda: target.join(side, test, "left_anti"),
        marked=marked,
        parameters=parameters,
    )


def delete_by_keys(target: DataFrame, criteria: DataFrame, on: Keys, small: bool = False) -> DeletePlan:
    """Delete rows whose key, of one or several columns, is in the criteria. Null keys never match.

    `small=True` broadcasts the keys behind a size check; otherwise the optimizer decides.
    """
    pairs = key_pairs(on, target, criteria)
    keys = distinct_keys(criteria, pairs)
    if small:
        keys = broadcast_if_small(keys)
    return _delete_joined(target, keys, keys_match(pairs), "delete_by_keys", on=dict(pairs))


def explain_by_keys(target: DataFrame, criteria: DataFrame, on: Keys, carry: Sequence[str]) -> DataFrame:
    """Delete candidates with columns of the criteria row that condemns them, such as a reason."""
    pairs = key_pairs(on, target, criteria)
    without_clash(target, carry)
    reasons = criteria.select(*rename_keys(pairs, criteria), *[col(c) for c in carry]).dropna(
        subset=[f"{KEY}{i}" for i in range(len(pairs))]
    )
    joined = target.join(reasons, keys_match(pairs))
    return joined.select(*[col(c) for c in target.columns], *[col(c) for c in carry])


def delete_by_values(
    target: DataFrame, column: str, values: Sequence | DataFrame, value_column: str | None = None
) -> DeletePlan:
    """Delete rows whose column is in a literal list, or in a column of a criteria table."""
    if isinstance(values, DataFrame):
        return delete_by_keys(target, values, {column: value_column or column})
    wanted = [v for v in values if v is not None]
    return delete_where(target, col(column).isin(wanted), "delete_by_values", column=column, values=len(wanted))


def delete_by_thresholds(
    target: DataFrame, criteria: DataFrame, on: Keys, column: str, threshold: str
) -> DeletePlan:
    """Per group, delete rows at or above a threshold; a null threshold condemns the whole group.

    Only the lowest threshold of a group matters, so the criteria shrink to one row per key.
    """
    pairs = key_pairs(on, target, criteria)
    names = [f"{KEY}{i}" for i in range(len(pairs))]
    limits = (
        criteria.select(*rename_keys(pairs, criteria), col(threshold).alias("__limit"))
        .dropna(subset=names)
        .groupBy(*names)
        .agg(F.min("__limit").alias("__lowest"), F.bool_or(F.col("__limit").isNull()).alias("__whole"))
    )
    test = keys_match(pairs) & (F.col("__whole") | (col(column) >= F.col("__lowest")))
    return _delete_joined(target, limits, test, "delete_by_thresholds", on=dict(pairs), column=column)


def delete_by_condition(
    target: DataFrame, criteria: DataFrame, condition: str, unique: Sequence[str], compare_all_pairs: bool = False
) -> DeletePlan:
    """Delete rows matched by a condition text over `t` (target) and `c` (criteria).

    Equalities in the text become join keys. Without one, one or two comparisons come down to a predicate of the target by the best
    criteria; more make a range join or a grid. With neither, every pair has to be compared, which is refused at any size unless
    asked for. `unique` names the columns that identify a target row, nulls included; reports use it to count a row
    once when several criteria rows hit it.
    """
    # Renamed columns have no lineage in common with the target's.
    left, right = target.alias("t"), criteria.select(*[col(c).alias(c) for c in criteria.columns]).alias("c")
    test = F.expr(condition)
    parameters = {"condition": condition}
    if compare_all_pairs or not compares_all_pairs(left.join(right, test, "left_semi")):
        right = broadcast_if_small(right, COMPARE_ROWS)
        victims, remaining = (lambda: left.join(right, test, "left_semi")), (lambda: left.join(right, test, "left_anti"))
    else:
        fits = any_fits(left, right, test)
        if fits is not None:
            plan = delete_where(left, fits, "delete_by_condition")
            return DeletePlan(target, plan.operation, plan.victims, plan.remaining, plan.marked, parameters)
        # Rows that agree in the columns of the condition go together, whatever identifies them.
        asked = target_names(left, right, test)
        # To know whether any fits, criteria that others make needless form no pairs.
        deciding = undominated(left, right, test).alias("c")
        pairs = ordered_join(left, deciding, test, [F.col(f"t.`{u}`").alias(f"{KEY}{i}") for i, u in enumerate(asked)])
        if pairs is None:
            raise ValueError("no equality or comparison of both sides in the condition: add one, or ask for compare_all_pairs")
        own = pairs.distinct()
        hit = all_of(col(u).eqNullSafe(F.col(f"{KEY}{i}")) for i, u in enumerate(asked))
        return _delete_joined(target, own, hit, "delete_by_condition", **parameters)

    def marked() -> DataFrame:
        names = victims().select(*[col(u).alias(f"{KEY}{i}") for i, u in enumerate(unique)]).distinct()
        same = all_of(col(u).eqNullSafe(F.col(f"{KEY}{i}")) for i, u in enumerate(unique))
        return _delete_joined(target, names, same, "").flagged()

    return DeletePlan(target, "delete_by_condition", victims, remaining, marked, parameters)


def delete_by_query(target: DataFrame, query: str, on: Keys, args: Mapping | None = None, **frames: DataFrame) -> DeletePlan:
    """Delete rows whose key is returned by an analysis query. Frames are named as `{name}` in the text."""
    found = target.sparkSession.sql(query, args=dict(args or {}), **frames)
    return delete_by_keys(target, found, on)


def delete_groups(target: DataFrame, groups: Sequence[str], having: Column) -> DeletePlan:
    """Delete all rows of the groups for which an aggregate condition holds."""
    chosen = target.groupBy(*[col(g) for g in groups]).agg(is_true(having).alias("__chosen"))
    return delete_by_keys(target, chosen.filter("__chosen"), list(groups))


def delete_query(target: DataFrame, predicate: str) -> DeletePlan:
    """Delete by a SQL predicate given as text."""
    return delete_where(target, F.expr(predicate), "delete_query", predicate=predicate)


def delete_text_match(target: DataFrame, column: str, term: str, **options) -> DeletePlan:
    return delete_where(target, text_match(column, term, **options), "delete_text_match", column=column, term=term)


def delete_scoped(target: DataFrame, criteria: DataFrame, on: Keys, scope: Column | str) -> DeletePlan:
    """Delete keyed matches, but only inside an extra scope such as `status = 'inactive'`."""
    pairs = key_pairs(on, target, criteria)
    inside = is_true(F.expr(scope) if isinstance(scope, str) else scope)
    test = keys_match(pairs) & inside
    return _delete_joined(target, distinct_keys(criteria, pairs), test, "delete_scoped", on=dict(pairs))


def delete_above_percentile(
    target: DataFrame, column: str, fraction: float, accuracy: int | None = None
) -> DeletePlan:
    """Delete rows at or above a percentile. Exact in the column's own type, or from a sketch when an accuracy is given."""
    if accuracy is None:
        cut = ranks.quantile_value(target, column, fraction)
    else:
        found = target.agg(F.percentile_approx(col(column), fraction, accuracy)).first()[0]
        cut = None if found is None else F.lit(found)
    condition = F.lit(False) if cut is None else col(column) >= cut
    return delete_where(target, condition, "delete_above_percentile", column=column, fraction=fraction)


def delete_retention(
    target: DataFrame,
    rules: DataFrame,
    *,
    kind: Keys,
    time: str,
    days: str,
    as_of: Column | None = None,
) -> DeletePlan:
    """Delete rows older than the retention of their kind. `kind` maps target -> rules columns."""
    pairs = key_pairs(kind, target, rules)
    names = [f"{KEY}{i}" for i in range(len(pairs))]
    limits = (
        rules.select(*rename_keys(pairs, rules), col(days).cast("int").alias("__days"))
        .dropna()
        .groupBy(*names)
        .agg(F.min("__days").alias("__days"))
    )
    now = F.current_timestamp() if as_of is None else as_of
    test = keys_match(pairs) & (col(time) < days_before(now, F.col("__days")))
    return _delete_joined(target, limits, test, "delete_retention", time=time)


def delete_quality(target: DataFrame, rules: Sequence[tuple], **options) -> DeletePlan:
    """Delete rows that break a quality rule: `(column, rule)` or `(column, "unknown", sentinel)`."""
    return delete_where(target, any_of(quality_rule(*rule) for rule in rules), "delete_quality", **options)


def soft_delete(target: DataFrame, condition: Column, flag: str = "active") -> DataFrame:
    """Mark instead of delete: the flag turns false on hits and is otherwise kept (or true if new)."""
    current = col(flag) if flag in target.columns else F.lit(True)
    return target.withColumn(flag, F.when(is_true(condition), F.lit(False)).otherwise(current))


def soft_delete_by_keys(target: DataFrame, criteria: DataFrame, on: Keys, flag: str = "active") -> DataFrame:
    hits = delete_by_keys(target, criteria, on).flagged()
    return soft_delete(hits, F.col(HIT), flag).select(
        *[col(c) for c in target.columns], *([] if flag in target.columns else [col(flag)])
    )


def delete_base_names(target: DataFrame, listing: DataFrame, column: str, path: str = "name") -> DeletePlan:
    """Delete catalogue rows whose base name is in a file listing. An empty listing is an error."""
    names = listing.select(base_name(col(path)).alias(f"{KEY}0")).filter(F.col(f"{KEY}0") != "").distinct()
    if names.isEmpty():
        raise ValueError("the listing holds no file names; refusing to clean the catalogue from it")
    return _delete_joined(
        target, names, base_name(col(column)) == F.col(f"{KEY}0"), "delete_base_names", column=column
    )


def delete_cascade(
    tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, Mapping[str, str]]], root: str, plan: DeletePlan
) -> dict[str, DeletePlan]:
    """Delete children of deleted parents. `links` hold (parent, child, {child column: parent column}).

    Links are listed from the root downwards; plans come back children first, which is
    the order to apply them in. A child with several deleted parents goes once.
    """
    plans = {root: plan}
    for parent, child, on in links:
        if parent not in plans:
            raise ValueError(f"no delete is known for {parent!r}; list links from the root downwards")
        doomed = plans[parent].preview()
        if child in plans:
            plans[child] = _also_by_keys(plans[child], doomed, on)
        else:
            plans[child] = delete_by_keys(tables[child], doomed, on)
    return dict(reversed(plans.items()))


def delete_closure(
    tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, Mapping[str, str]]], root: str, plan: DeletePlan
) -> dict[str, DeletePlan]:
    """Delete what depends on deleted rows, through links that may come back to a table, to any depth.

    `links` hold (parent, child, {child column: parent column}); a table may link to itself, and tables in a circle. Rounds follow
    the keys found last, each key once, until none is new; every round is written below the checkpoint folder. There are as many
    rounds as the longest way down. Null keys lead nowhere. Plans come back for every table a link leads to, and the root.
    """
    spark = plan.target.sparkSession
    known = [scratch_path(spark, "closure") for _ in links]

    def keys_of(rows: DataFrame, link: int) -> DataFrame:
        columns = [col(p).alias(f"{KEY}{i}") for i, p in enumerate(links[link][2].values())]
        return rows.select(*columns).filter(all_of(F.col(f"{KEY}{i}").isNotNull() for i in range(len(columns)))).distinct()

    def hits(link: int, keys: DataFrame) -> DataFrame:
        test = all_of(col(c) == F.col(f"{KEY}{i}") for i, c in enumerate(links[link][2]))
        return tables[links[link][1]].join(keys, test, "left_semi")

    def noted(link: int, keys: DataFrame, first: bool) -> DataFrame:
        """The keys that are new, written down; the known ones include them from then on."""
        if not first:
            keys = keys.join(spark.read.parquet(known[link]), [f"{KEY}{i}" for i in range(len(links[link][2]))], "left_anti")
        path = scratch_path(spark, "closure-round")
        keys.write.parquet(path)
        new = spark.read.schema(keys.schema).parquet(path)
        new.write.mode("append").parquet(known[link])
        return new

    open_ = {}
    for k, (parent, _, _) in enumerate(links):
        start = keys_of(plan.preview() if parent == root else tables[parent].limit(0), k)
        open_[k] = noted(k, start, True)
    while open_ := {k: keys for k, keys in open_.items() if not keys.isEmpty()}:
        found = {}
        for k, (parent, _, _) in enumerate(links):
            above = [keys_of(hits(j, keys), k) for j, keys in open_.items() if links[j][1] == parent]
            if above:
                found[k] = noted(k, reduce(DataFrame.unionAll, above).distinct(), False)
        open_ = found

    plans = {root: plan}
    for k, (_, child, on) in enumerate(links):
        keys = spark.read.parquet(known[k])
        renamed = keys.withColumnsRenamed({f"{KEY}{i}": f"__link{i}" for i in range(len(on))})
        own = {c: f"__link{i}" for i, c in enumerate(on)}
        plans[child] = _also_by_keys(plans[child], renamed, own) if child in plans else delete_by_keys(tables[child], renamed, own)
    return dict(reversed(plans.items()))


def _also_by_keys(plan: DeletePlan, criteria: DataFrame, on: Keys) -> DeletePlan:
    """The rows of a plan, or those keyed by further criteria: one more join per key set, no OR."""
    columns = [col(c) for c in plan.target.columns]

    def both() -> DataFrame:
        earlier = plan.flagged().withColumnRenamed(HIT, "__earlier")
        marked = delete_by_keys(earlier, criteria, on).flagged()
        return marked.select(*columns, (F.col(HIT) | F.col("__earlier")).alias(HIT))

    return DeletePlan(
        plan.target,
        plan.operation,
        victims=lambda: both().filter(F.col(HIT)).select(*columns),
        remaining=lambda: delete_by_keys(plan.kept(), criteria, on).kept(),
        marked=both,
        parameters=plan.parameters,
    )
