"""MERGE as two joins: every clause kind, first true clause wins.

Target rows meet the source in a left outer join; source rows without a target row are
found by an anti join on keys. Unlike one full outer join, both may broadcast a small
source, so the big target is not shuffled, and adaptive execution may split a hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import all_of, col, is_true
from tablekeeper.plans.keys import KEY, Keys, distinct_keys, key_pairs, keys_match, rename_keys
from tablekeeper.plans.sizing import broadcasts

Side = Callable[[str], Column]
Values = Mapping[str, Callable[[Side, Side], Column] | Column | str]
Test = Callable[[Side, Side], Column] | None


@dataclass(frozen=True)
class _Clause:
    action: str
    when: Test
    values: Values | None = None


@dataclass(frozen=True)
class Merge:
    """Builder: `Merge(target, source, on).when_matched_update(...).when_not_matched_insert(...).result()`.

    `on` maps target -> source columns. Conditions and values are functions
    `(t, s) -> Column`, where `t` and `s` turn a column name into the target's or the
    source's Column; a value may also be a Column (a literal) or a source column name.
    """

    target: DataFrame
    source: DataFrame
    on: Keys
    matched: tuple[_Clause, ...] = field(default=())
    inserts: tuple[_Clause, ...] = field(default=())
    target_only: tuple[_Clause, ...] = field(default=())

    def when_matched_update(self, values: Values | None = None, when: Test = None) -> Merge:
        """Set columns; None sets every column from the source column of the same name."""
        return replace(self, matched=(*self.matched, _Clause("update", when, values)))

    def when_matched_delete(self, when: Test = None) -> Merge:
        return replace(self, matched=(*self.matched, _Clause("delete", when)))

    def when_not_matched_insert(self, values: Values | None = None, when: Test = None) -> Merge:
        """Insert source rows; columns that are not given are null."""
        return replace(self, inserts=(*self.inserts, _Clause("insert", when, values)))

    def when_not_matched_by_source_delete(self, when: Test = None) -> Merge:
        return replace(self, target_only=(*self.target_only, _Clause("delete", when)))

    def when_not_matched_by_source_update(self, values: Values, when: Test = None) -> Merge:
        return replace(self, target_only=(*self.target_only, _Clause("update", when, values)))

    # -- checks -------------------------------------------------------------------------

    def source_problems(self) -> DataFrame:
        """Source keys that repeat or hold a null, with their row count `n`."""
        pairs = key_pairs(self.on, self.target, self.source)
        return source_checks(self.source, [name for _, name in pairs])

    def _pairs(self) -> list[tuple[str, str]]:
        return key_pairs(self.on, self.target, self.source)

    # -- result -------------------------------------------------------------------------

    def result(self, check: bool = True, unique: bool = False) -> DataFrame:
        """The merged table. A source key that repeats and matches a target row fails the job.

        `check=False` leaves that test out, for a source known to be unique (an aggregate).
        `unique=True` says that both sides hold each key at most once, as two aggregates do:
        no key can be hot then, and one full outer join does all the work.
        """
        if unique:
            both = self._marked_target().join(self._held_source(), keys_match(self._pairs()), "full")
            return self._resolve(both)
        check = check and bool(self.matched)
        held = self._held_source().dropna(subset=[f"{KEY}{i}" for i in range(len(self._pairs()))])
        merged = self._resolve(self._marked_target().join(held, keys_match(self._pairs()), "left"))
        if self.inserts:
            merged = merged.unionAll(self._resolve(self._source_only(check)))
        elif check:
            merged = merged.unionAll(self._no_rows_but_checked())
        return merged

    def _marked_target(self) -> DataFrame:
        return self.target.withColumn("__target", F.lit(True))

    def _held_source(self) -> DataFrame:
        return self.source.select(
            *rename_keys(self._pairs(), self.source),
            *[col(c).alias(f"__s_{c}") for c in self.source.columns],
            F.lit(True).alias("__source"),
        )

    def _source_only(self, check: bool) -> DataFrame:
        """Source rows without a target row, beside empty target columns."""
        count = len(self._pairs())
        same = all_of(F.col(f"{KEY}{i}") == F.col(f"__held{i}") for i in range(count))
        new = self._held_source().join(self._matched_keys(check), same, "left_anti")
        empty = {f.name: F.lit(None).cast(f.dataType) for f in self.target.schema.fields}
        return new.withColumns({**empty, "__target": F.lit(None).cast("boolean")})

    def _resolve(self, joined: DataFrame) -> DataFrame:
        """Give each joined row its action and the values that action sets."""
        s, t = _sides()
        old, new = F.col("__target").isNotNull(), F.col("__source").isNotNull()
        clauses = [(old & new, c) for c in self.matched]
        clauses += [(old & ~new, c) for c in self.target_only]
        clauses += [(new & ~old, c) for c in self.inserts]
        action = F.lit(None).cast("int")
        for i, (side, clause) in reversed(list(enumerate(clauses))):
            test = side if clause.when is None else side & is_true(clause.when(t, s))
            action = F.when(test, F.lit(i)).otherwise(action)
        joined = joined.withColumn("__action", action).filter(old | F.col("__action").isNotNull())
        deletes = [i for i, (_, clause) in enumerate(clauses) if clause.action == "delete"]
        if deletes:
            joined = joined.filter(~is_true(F.col("__action").isin(deletes)))
        columns = []
        for name in self.target.columns:
            value = col(name)
            for i, (_, clause) in enumerate(clauses):
                if clause.action != "delete":
                    value = F.when(F.col("__action") == i, self._value(clause, name, t, s)).otherwise(value)
            columns.append(value.alias(name))
        return joined.select(*columns)

    def _matched_keys(self, check: bool) -> DataFrame:
        """Keys both sides hold, once each; only key columns are read from the target.

        With `check`, reading a key that the source repeats fails the job. The test names
        counts of both sides, so no optimizer rule can move it below their join.
        """
        pairs = self._pairs()
        names = [name for name, _ in pairs]
        asked = (
            self.source.select(*rename_keys(pairs, self.source))
            .dropna()
            .groupBy(*[f"{KEY}{i}" for i in range(len(pairs))])
            .agg(F.count("*").alias("__asked"))
        )
        held = self.target.select(*[col(n) for n in names])
        groups = [col(n) for n in names]
        both = held.join(asked, keys_match(pairs))
        if broadcasts(both):
            both = both.groupBy(*groups).agg(F.count("*").alias("__held"), F.max("__asked").alias("__asked"))
        else:  # keys are counted map-side before they are shuffled, so that a hot one is not
            both = held.groupBy(*groups).agg(F.count("*").alias("__held")).join(asked, keys_match(pairs))
        keys = [col(n) for n in names]
        if check:
            text = F.concat(
                F.lit("merge source holds "), F.col("__asked"), F.lit(" rows for key "), F.to_json(F.struct(*keys))
            )
            failed = (F.col("__asked") > 1) & (F.col("__held") > 0)
            kind = self.target.schema[names[0]].dataType
            keys[0] = F.when(failed, F.raise_error(text).cast(kind)).otherwise(keys[0])
        return both.select(*[key.alias(f"__held{i}") for i, key in enumerate(keys)])

    def _no_rows_but_checked(self) -> DataFrame:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.target.schema.fields]
        return self._matched_keys(True).filter(F.col("__held0").isNull()).select(*nothing)

    def _value(self, clause: _Clause, name: str, t: Side, s: Side) -> Column:
        """What the clause sets; a column it does not name keeps its value, which is null on insert."""
        kind = self.target.schema[name].dataType
        if clause.values is None:
            named = dict(self._pairs()).get(name, name)
            return s(named).cast(kind) if named in self.source.columns else col(name)
        unknown = set(clause.values) - set(self.target.columns)
        if unknown:
            raise ValueError(f"the target has no columns {sorted(unknown)}")
        if name not in clause.values:
            return col(name)
        value = clause.values[name]
        if isinstance(value, str):
            value = s(value)
        elif not isinstance(value, Column):
            value = value(t, s)
        return value.cast(kind)


def _sides() -> tuple[Side, Side]:
    return (lambda name: col(f"__s_{name}")), col


def upsert(target: DataFrame, source: DataFrame, on: Keys, check: bool = True) -> DataFrame:
    """Replace target rows by source rows with the same key and add the others.

    Columns are taken by name in the target's order. A key that the source repeats fails the job, as the result would hold it
    twice; `check=False` leaves that test out, for a source known to be unique. Null keys match nothing and are added.
    """
    pairs = key_pairs(on, target, source)
    renamed = source.withColumnsRenamed({c: t for t, c in pairs})
    rows = renamed.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    if not check:
        return target.join(distinct_keys(source, pairs), keys_match(pairs), "left_anti").unionByName(rows)
    names = [f"{KEY}{i}" for i in range(len(pairs))]
    counted = source.select(*rename_keys(pairs, source)).dropna().groupBy(*names).agg(F.count("*").alias("__n"))
    text = F.concat(F.lit("source holds "), F.col("__n"), F.lit(" rows for key "), F.to_json(F.struct(*names)))
    # A branch of its own that gives no rows, so that the test runs whatever happens to the join.
    repeated = counted.filter(F.when(F.col("__n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(False)))
    nothing = repeated.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return target.join(counted.drop("__n"), keys_match(pairs), "left_anti").unionByName(rows).unionByName(nothing)


def source_checks(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that repeat or hold a null, with their row count `n`."""
    counts = source.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n"))
    null = F.lit(False)
    for k in keys:
        null = null | col(k).isNull()
    return counts.filter((F.col("n") > 1) | null)
