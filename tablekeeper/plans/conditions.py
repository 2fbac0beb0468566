"""Join conditions without an equality: taken apart into comparisons, and joined by their order.

Spark itself resolves a condition; its conjuncts are then read off the plan. What compares a value of one side with a value of the
other is a comparison `target <, <=, > or >= criteria`. Two that bound one value make a range join. Two of different values place
both sides on a grid: a target row lies in one cell, a criteria row goes to the cells beyond its own that hold rows, and they are
joined on the cell, with the whole condition checked again. To know only whether any criteria row fits, as a delete does, two
comparisons come down to a staircase of the best criteria, and every target row finds its step by a binary search.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.column import Column as ClassicColumn

from tablekeeper.functions.predicates import all_of, col
from tablekeeper.plans.places import steps_before, text_array, text_cuts
from tablekeeper.plans.ranges import axis, listed_join, range_join, within_bounds
from tablekeeper.session import checkpoint_dir

OPERATORS = {"GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<="}
FLIPPED = {">": "<", ">=": "<=", "<": ">", "<=": ">="}
TESTS: dict[str, Callable] = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}
#: Parts of each side of the grid, at least and at most; rows of a cell aimed at.
LEAST_PARTS, MOST_PARTS, CELL_ROWS = 16, 512, 64
#: Steps of a staircase, and the parts in which criteria that cannot be a step are dropped first.
STEPS, STAIR_PARTS = 1_000, 512
#: Criteria that all others are compared with.
STRONGEST = 500


@dataclass(frozen=True)
class Comparison:
    """`target operator criteria`; the names say which comparisons are of the same value."""

    target: Column
    operator: str
    criteria: Column
    kind: T.DataType
    target_name: str
    criteria_name: str

    def greater(self) -> bool:
        return self.operator in (">", ">=")


@dataclass
class Condition:
    comparisons: list[Comparison] = field(default_factory=list)
    of_target: list[Column] = field(default_factory=list)
    of_criteria: list[Column] = field(default_factory=list)
    others: int = 0


def taken_apart(target: DataFrame, criteria: DataFrame, test: Column) -> Condition | None:
    """The conjuncts of a condition by what they speak of; None if the two sides are not told apart."""
    join = target.join(criteria, test)._jdf.queryExecution().analyzed()
    if join.getClass().getSimpleName() != "Join" or not join.condition().isDefined():
        return None
    known = join.left().outputSet(), join.right().outputSet()
    own = target._jdf.queryExecution().analyzed().outputSet(), criteria._jdf.queryExecution().analyzed().outputSet()
    if not (known[0].subsetOf(own[0]) and known[1].subsetOf(own[1])):
        return None  # one table on both sides, of which Spark has renamed one
    column = target.sparkSession._jvm.org.apache.spark.sql.classic.ExpressionUtils.column

    def side(*expressions) -> int | None:
        return next((k for k in (0, 1) if all(e.references().subsetOf(known[k]) for e in expressions)), None)

    found = Condition()
    sides = found.of_target, found.of_criteria
    todo = [join.condition().get()]
    while todo:
        part = todo.pop()
        name = part.getClass().getSimpleName()
        if name == "And":
            todo += [part.right(), part.left()]
            continue
        if not part.deterministic():
            found.others += 1
            continue
        if side(part) is not None:
            sides[side(part)].append(ClassicColumn(column(part)))
            continue
        tests = []
        if name in OPERATORS:
            tests = [(part.left(), OPERATORS[name], part.right())]
        elif name == "Between":
            value, low, high = (part.parameters().apply(k) for k in range(3))
            tests = [(value, ">=", low), (value, "<=", high)]
        found.others += not tests
        for left, operator, right in tests:
            ends, of = (left, right), (side(left), side(right))
            if side(left, right) is not None:
                sides[side(left, right)].append(TESTS[operator](*(ClassicColumn(column(e)) for e in ends)))
                continue
            if of == (1, 0):
                ends, operator = ends[::-1], FLIPPED[operator]
            elif of != (0, 1):
                found.others += 1
                continue
            kind = T._parse_datatype_json_string(ends[0].dataType().json())
            if _ordered(kind):
                names = (e.canonicalized().toString() for e in ends)
                found.comparisons.append(Comparison(ClassicColumn(column(ends[0])), operator, ClassicColumn(column(ends[1])), kind, *names))
            else:
                found.others += 1
    return found


def _ordered(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.CharType, T.VarcharType, T.DateType, T.TimestampType, T.TimestampNTZType))


def ordered_join(target: DataFrame, criteria: DataFrame, test: Column, columns: Sequence[Column]) -> DataFrame | None:
    """These columns of the inner join on a condition, by its comparisons; None if it holds none.

    The condition and the columns are by names, of which the sides share none, or by the aliases of the sides.
    """
    condition = taken_apart(target, criteria, test)
    if condition is None or not condition.comparisons:
        return None
    if condition.of_target:
        target = target.filter(all_of(condition.of_target))
    if condition.of_criteria:
        criteria = criteria.filter(all_of(condition.of_criteria))
    found = _bounded(condition.comparisons)
    first = condition.comparisons[0]
    second = next((c for c in condition.comparisons[1:] if c.target_name != first.target_name), None)
    sides = _Side(target, "__t"), _Side(criteria, "__c")
    if found is not None:
        joined = _ranged(*sides, *found)
    elif second is None:
        joined = _ranged(*sides, "target", *((first, None) if first.greater() else (None, first)))
    else:
        joined = _grid_join(*sides, first, second)
    return _named(joined, *sides).filter(test).select(*columns)


class _Side:
    """A side of a join, its columns named by number, and what they and the whole side are called in conditions."""

    def __init__(self, frame: DataFrame, mark: str):
        plan = frame._jdf.queryExecution().analyzed()
        while plan.getClass().getSimpleName() == "Filter":
            plan = plan.child()
        self.alias = plan.alias() if plan.getClass().getSimpleName() == "SubqueryAlias" else None
        self.frame, self.names = frame, frame.columns
        self.numbered = [f"{mark}{i}" for i in range(len(self.names))]

    def with_values(self, **values: Column) -> DataFrame:
        own = [col(n).alias(m) for n, m in zip(self.names, self.numbered, strict=True)]
        return self.frame.select(*own, *[v.alias(n) for n, v in values.items()])


def _named(joined: DataFrame, *sides: _Side) -> DataFrame:
    """The columns of both sides by their names, where one side alone has them, and by the alias of their side."""
    aliases = {s.alias for s in sides}
    every = [n for s in sides for n in s.names]
    out = []
    for s in sides:
        named = [F.col(m).alias(n) for n, m in zip(s.names, s.numbered, strict=True)]
        out += [c for n, c in zip(s.names, named, strict=True) if every.count(n) == 1 and n not in aliases]
        if s.alias is not None:
            out.append(F.struct(*named).alias(s.alias))
    return joined.select(*out)


def _bounded(comparisons: list[Comparison]) -> tuple[str, Comparison, Comparison] | None:
    """Two comparisons that bound one value from both sides, and the side that value is of."""
    for of, name in (("target", lambda c: c.target_name), ("criteria", lambda c: c.criteria_name)):
        for low in comparisons:
            for high in comparisons:
                if low.greater() and not high.greater() and name(low) == name(high):
                    return of, low, high
    return None


def _ranged(target: _Side, criteria: _Side, of: str, low: Comparison | None, high: Comparison | None) -> DataFrame:
    """The rows whose value is inside, both ends closed."""
    some = low or high
    if of == "criteria":  # target > c and target < c: ranges of the target around values of the criteria
        low, high = high, low
        target, criteria = criteria, target
    value, ends = (some.target, "criteria") if of == "target" else (some.criteria, "target")
    bounds = {n: getattr(end, ends) for n, end in (("__low", low), ("__high", high)) if end is not None}
    points, ranges = target.with_values(__point=value), criteria.with_values(**bounds)
    return range_join(points, ranges, "__point", *(n if n in bounds else None for n in ("__low", "__high")))


class Parts:
    """Parts of about equally many rows of a frame along a value, numbered in order."""

    def __init__(self, target: DataFrame, value: Column, kind: T.DataType, parts: int):
        self.texts = isinstance(kind, (T.StringType, T.CharType, T.VarcharType))
        self.kind = kind
        if self.texts:
            cuts = text_cuts(target, value, parts)
            self.array = text_array(cuts)
        else:
            place = axis(value, kind)
            finite = F.when(F.abs(place) < F.lit(float("inf")), place)
            found = target.agg(F.percentile_approx(finite, [k / parts for k in range(1, parts)], 100 * parts)).first()[0]
            cuts = sorted(set(found or []))
            self.array = F.from_json(F.lit(json.dumps(cuts)), "array<double>")
        self.count = len(cuts)

    def number(self, value: Column) -> Column:
        """How many cuts are not after the value: 0 to `count`."""
        return steps_before(value if self.texts else axis(value, self.kind), self.array, self.count, lambda cut, v: cut <= v)


def _grid_join(target: _Side, criteria: _Side, first: Comparison, second: Comparison) -> DataFrame:
    """Pairs of which both comparisons may hold: all that do, and others only from the cells at a criteria row's edge."""
    target = target.with_values(__a=first.target, __b=second.target).filter("__a IS NOT NULL AND __b IS NOT NULL")
    asked = criteria.with_values(__x=first.criteria, __y=second.criteria).filter("__x IS NOT NULL AND __y IS NOT NULL")
    ends = ((first, "__a", "__x"), (second, "__b", "__y"))
    target = within_bounds(target, asked, [(F.col(v), F.col(w), c.greater(), c.kind) for c, v, w in ends])
    count = target.count()
    parts = min(MOST_PARTS, max(LEAST_PARTS, math.isqrt(count // CELL_ROWS)))
    a, b = (Parts(target, F.col(n), c.kind, parts) for n, c in (("__a", first), ("__b", second)))
    placed = target.withColumns({"__i": a.number(F.col("__a")), "__j": b.number(F.col("__b"))}).drop("__b")
    held: dict[int, list[int]] = {}
    for i, j in placed.select("__i", "__j").distinct().collect():  # at most (parts + 1)^2
        held.setdefault(i, []).append(j)
    wide = b.count + 1
    cells = F.from_json(F.lit(json.dumps([sorted(held.get(i, [])) for i in range(a.count + 1)])), "array<array<int>>")
    asked = asked.withColumns({"__x": a.number(F.col("__x")), "__y": b.number(F.col("__y"))})
    rows = F.sequence(F.col("__x"), F.lit(a.count)) if first.greater() else F.sequence(F.lit(0), F.col("__x"))

    def beyond(j: Column) -> Column:
        return j >= F.col("__y") if second.greater() else j <= F.col("__y")

    reached = F.flatten(F.transform(rows, lambda i: F.transform(F.filter(F.get(cells, i), beyond), lambda j: i * wide + j)))
    asked = asked.withColumn("__to", F.explode(reached)).drop("__x", "__y")
    placed = placed.withColumn("__cell", F.col("__i") * wide + F.col("__j")).drop("__i", "__j")
    return listed_join(asked, "__to", placed, "__cell", "__a", sum(map(len, held.values())), count)


def undominated(target: DataFrame, criteria: DataFrame, test: Column) -> DataFrame:
    """Criteria that decide whether any fits, as far as the strongest tell: a row is dropped if one of those is met as easily by every
    target row in all comparisons, and not the same. All stay if the condition is more than comparisons and tests of one side."""
    condition = taken_apart(target, criteria, test)
    if condition is None or condition.others or not condition.comparisons:
        return criteria
    own = criteria.filter(all_of(condition.of_criteria)) if condition.of_criteria else criteria
    marks = [f"__m{i}" for i in range(len(condition.comparisons))]
    rows = own.withColumns({m: c.criteria for m, c in zip(marks, condition.comparisons, strict=True)})
    rows = rows.filter(all_of(F.col(m).isNotNull() for m in marks))
    ranks = []
    for mark, c in zip(marks, condition.comparisons, strict=True):
        number = Parts(rows, F.col(mark), c.kind, STAIR_PARTS).number(F.col(mark))
        ranks.append(number if c.greater() else -number)
    best = rows.orderBy(sum(ranks, F.lit(0)), *marks).select(*[F.col(m).alias(f"{m}_") for m in marks]).limit(STRONGEST).distinct()
    ends = [(F.col(f"{m}_"), F.col(m), c.greater()) for m, c in zip(marks, condition.comparisons, strict=True)]
    easier = all_of(a <= b if greater else a >= b for a, b, greater in ends)
    same = all_of(a == b for a, b, _ in ends)
    left = rows.join(F.broadcast(best), easier & ~same, "left_anti").drop(*marks)
    checkpoint_dir(criteria.sparkSession)
    return left.checkpoint()  # read several times from here on


def target_names(target: DataFrame, criteria: DataFrame, test: Column) -> list[str]:
    """The target columns that a condition speaks of: rows that agree in them fit alike."""
    join = target.join(criteria, test)._jdf.queryExecution().analyzed()
    own, used = join.left().output(), join.condition().get().references()
    return [own.apply(i).name() for i in range(own.size()) if used.contains(own.apply(i))]


def any_fits(target: DataFrame, criteria: DataFrame, test: Column) -> Column | None:
    """A predicate of the target alone: does any criteria row satisfy the condition? None if it does not come down to one.

    It does for conditions of one or two comparisons, and others of one side, unless the staircase has over STEPS steps.
    """
    condition = taken_apart(target, criteria, test)
    if condition is None or condition.others or not 1 <= len(condition.comparisons) <= 2:
        return None
    if condition.of_criteria:
        criteria = criteria.filter(all_of(condition.of_criteria))
    first, *more = condition.comparisons
    if more:
        fits = _staircase(criteria, first, more[0])
    else:
        best = F.min(first.criteria) if first.greater() else F.max(first.criteria)
        fits = TESTS[first.operator](first.target, literal_of(criteria.agg(best).first()[0], first.kind))
    if fits is None:
        return None
    return F.coalesce(all_of([*condition.of_target, fits]), F.lit(False))


def _staircase(criteria: DataFrame, first: Comparison, second: Comparison) -> Column | None:
    best, better = (F.min, TESTS["<"]) if second.greater() else (F.max, TESTS[">"])
    rows = criteria.select(first.criteria.alias("x"), second.criteria.alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    rows = rows.groupBy("x").agg(best("y").alias("y"))
    # Of the criteria that are as easily met in x as any in the parts before, only better ones in y can be a step.
    parts = Parts(rows, F.col("x"), first.kind, STAIR_PARTS)
    placed = rows.withColumn("part", parts.number(F.col("x")))
    known = sorted(map(tuple, placed.groupBy("part").agg(best("y")).collect()), reverse=not first.greater())
    bound, bounds = None, []
    for part, y in known:
        if bound is not None:
            bounds.append((part, bound))
        bound = y if bound is None or _before(y, bound, second.greater()) else bound
    limits = criteria.sparkSession.createDataFrame(bounds, T.StructType([T.StructField("at", T.IntegerType()), T.StructField("bound", rows.schema["y"].dataType)]))
    kept = placed.join(F.broadcast(limits), F.col("part") == F.col("at"), "left")
    kept = kept.filter(F.col("bound").isNull() | better(F.col("y"), F.col("bound"))).select("x", "y")
    found = [tuple(r) for r in kept.limit(64 * STEPS + 1).collect()]
    if len(found) > 64 * STEPS:
        return None
    steps: list[tuple] = []
    for x, y in sorted(found, key=lambda r: _rank(r[0]), reverse=not first.greater()):
        if not steps or _before(y, steps[-1][1], second.greater()):
            steps.append((x, y))
    if len(steps) > STEPS:
        return None
    if not steps:
        return F.lit(False)
    xs, ys = (F.array(*[literal_of(s[k], c.kind) for s in steps]) for k, c in enumerate((first, second)))
    at = steps_before(first.target, xs, len(steps), lambda cut, value: TESTS[first.operator](value, cut))
    return TESTS[second.operator](second.target, F.get(ys, at - 1))


def literal_of(value, kind: T.DataType) -> Column:
    # A time without a zone must not go through one.
    return F.lit(str(value) if isinstance(kind, T.TimestampNTZType) and value is not None else value).cast(kind)


def _rank(value):
    """Python's order of values as Spark's, in which NaN is the largest number."""
    return (1, 0) if isinstance(value, float) and math.isnan(value) else (0, value)


def _before(a, b, least: bool) -> bool:
    return _rank(a) < _rank(b) if least else _rank(a) > _rank(b)
