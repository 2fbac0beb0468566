"""Joins of a target value against criteria ranges.

Both sides are first brought to one comparison type, whatever happens next. Few ranges are broadcast and compared.
Beyond that the target's values are cut into cells of about equally many rows: by approximate quantiles of numbers and times, with
even parts between them, so that an outlier or a crowded region does not fill one cell; by sampled values of texts, so that what
they begin with alike does not matter. A target row lies in one cell and a range in all cells it spans; the join is an equi join on
the cell with the exact comparison re-checked. A cell is about half as wide as the mean range, so that a range is copied about three
times and its end cells hold no more rows than it matches, on the mean. Only target rows between the least and the greatest bound move.

The result may hold a share of all pairs, far more than both sides. So the rows of a cell go as short lists, in order of their value,
and each range is copied for the lists of its cells and meets one of them at a time: no pair is moved, a task holds the pairs of one
range and one list at most, and equal stretches of the result lie side by side, where columnar files keep them in few bytes.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.functions.predicates import all_of, col, row_hash
from tablekeeper.plans.keys import without_clash
from tablekeeper.plans.places import steps_before, text_array, text_cuts
from tablekeeper.plans.sizing import COMPARE_ROWS, small_enough

# Quantiles that shape the cells, and how exact they are.
QUANTILES = 1_000
ACCURACY = 10_000
# Fixed value: cells of texts at most; a range's two end cells hold that share of the rows each.
TEXT_CELLS = 2_048
# Rows of a list on the mean at most, into how many shares at most the ranges of a list are dealt, and how many such
# pieces a task should have, so that tasks are alike. Spark holds all pairs of a range and a list before it passes them on.
LIST_ROWS, SHARES, PIECES = 10_000, 64, 8
# Fixed value: bytes of a cell in a broadcast table of cells.
CELL_BYTES = 32


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    raise TypeError(f"cannot order values of type {kind.simpleString()} on a range axis")


def comparison_type(kinds: list[T.DataType]) -> T.DataType | None:
    """The type all are cast to before they are compared; None where Spark compares them as they are.

    Text beside numbers is read as a number, text or dates beside times as a time; what cannot be read is null.
    """
    families = {_family(k) for k in kinds}
    if len(families) == 1:
        return None if families != {"time"} or len(set(kinds)) == 1 else T.TimestampType()
    if families == {"number", "text"}:
        return T.DoubleType()
    if families == {"date", "text"}:
        return T.DateType()
    if "number" not in families:
        times = {type(k) for k in kinds if _family(k) == "time"}
        return T.TimestampNTZType() if times == {T.TimestampNTZType} else T.TimestampType()
    raise TypeError(f"cannot compare {', '.join(sorted(k.simpleString() for k in kinds))} on one range axis")


def axis(value: Column, kind: T.DataType) -> Column:
    """A double that never decreases when the value increases; NaN, the largest, is infinite. Ties are fine, cells are re-checked."""
    family = _family(kind)
    if family == "number":
        number = value.cast("double")
        return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)
    if family == "date":
        return F.unix_date(value) * F.lit(86400.0)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value) / F.lit(1e6)
    clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    return F.unix_date(value.cast("date")) * F.lit(86400.0) + clock


def in_range(value: Column, lower: Column | None, upper: Column | None, strict: bool = False) -> Column:
    parts = []
    if lower is not None:
        parts.append(value > lower if strict else value >= lower)
    if upper is not None:
        parts.append(value < upper if strict else value <= upper)
    return all_of(parts)


def range_join(
    target: DataFrame,
    criteria: DataFrame,
    column: str,
    lower: str | None = None,
    upper: str | None = None,
    *,
    strict: bool = False,
    compare_rows: int = COMPARE_ROWS,
) -> DataFrame:
    """Inner join on `lower <= column <= upper`; one side may be open. Every pair appears once.

    An open range matches a share of all pairs by its nature; for "above any threshold" semi-join the least one instead.
    """
    if lower is None and upper is None:
        raise ValueError("a range needs a lower or an upper column")
    without_clash(target, criteria.columns)
    named = [name for name in (lower, upper) if name]
    kinds = [target.schema[column].dataType, *[criteria.schema[n].dataType for n in named]]
    untyped = any(isinstance(k, T.NullType) for k in kinds)
    kinds = [kinds[0] if isinstance(k, T.NullType) else k for k in kinds]
    common = comparison_type(kinds) or (kinds[0] if untyped else None)

    def same(name: str) -> Column:
        return col(name) if common is None else col(name).try_cast(common)

    if small_enough(criteria, compare_rows):
        matches = in_range(same(column), same(lower) if lower else None, same(upper) if upper else None, strict)
        return F.broadcast(criteria).join(target, matches)
    # Cast once for each row, not for each pair.
    points = target.withColumn("__value", same(column)).filter("__value IS NOT NULL")
    bounds = {bound: same(name) for name, bound in ((lower, "__lower"), (upper, "__upper")) if name}
    ranges = criteria.withColumns(bounds).filter(all_of(F.col(b).isNotNull() for b in bounds))
    kind = common or kinds[0]
    points = within_bounds(points, ranges, [(F.col("__value"), F.col(b), b == "__lower", kind) for b in bounds])
    texts = _family(kind) == "text"
    places = {name: F.col(name) if texts else axis(F.col(name), kind) for name in ("__value", *bounds)}
    low, high = (b if b in bounds else None for b in ("__lower", "__upper"))
    matches = in_range(F.col("__value"), *(F.col(b) if b else None for b in (low, high)), strict)
    return _cell_join(points, ranges, places, "__value", low, high, matches, texts).drop("__value", "__lower", "__upper")


class _Quantiles:
    """Places of numbers: the quantile below, and how far the value is on the way to the next."""

    def __init__(self, target: DataFrame, place: Column):
        finite = F.when(F.abs(place) < F.lit(float("inf")), place)
        shares = [i / QUANTILES for i in range(QUANTILES + 1)]
        self.rows, found = target.agg(F.count(finite), F.percentile_approx(finite, shares, ACCURACY)).first()
        cuts = sorted(set(found or [0.0]))
        cuts = cuts if len(cuts) > 1 else [cuts[0], cuts[0] + 1.0]
        self.last = len(cuts) - 1
        self.finest = max(1, self.rows // 2 // len(cuts))
        self.buckets = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__place", outputCol="__bucket")
        self.edges = F.array(*[F.lit(c) for c in cuts])

    def placed(self, frame: DataFrame, place: Column, name: str) -> DataFrame:
        held = self.buckets.transform(frame.withColumn("__place", place))
        below = F.col("__bucket").cast("int") - 1
        low = self.edges[F.greatest(F.lit(0), F.least(F.lit(self.last - 1), below))]
        high = self.edges[F.greatest(F.lit(1), F.least(F.lit(self.last), below + 1))]
        part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("__place") - low) / (high - low)))
        whole = F.when(below < 0, F.lit(-1.0)).when(below >= self.last, F.lit(float(self.last))).otherwise(below + part)
        return held.withColumn(name, whole).drop("__place", "__bucket")


class _Texts:
    """Places of texts: how many cut points are not after the value."""

    finest, rows = 1, 0

    def __init__(self, target: DataFrame, place: Column):
        cuts = text_cuts(target, place, TEXT_CELLS)
        self.last, self.cuts = len(cuts), text_array(cuts)

    def placed(self, frame: DataFrame, place: Column, name: str) -> DataFrame:
        at = steps_before(place, self.cuts, self.last, lambda cut, value: cut <= value)
        return frame.withColumn(name, at.cast("double"))


def _cell_join(
    target: DataFrame,
    ranges: DataFrame,
    places: dict[str, Column],
    column: str,
    lower: str | None,
    upper: str | None,
    matches: Column,
    texts: bool = False,
) -> DataFrame:
    """Pairs of rows that share a cell and match. `places` has where the columns, none of them null, lie on the axis."""
    axis_ = (_Texts if texts else _Quantiles)(target, places[column])
    for name, bound, default in ((lower, "__from", -1.0), (upper, "__to", float(axis_.last))):
        ranges = axis_.placed(ranges, places[name], bound) if name else ranges.withColumn(bound, F.lit(default))
    ranges = ranges.filter("__from <= __to")
    # Cells to each unit of places: two to the mean range.
    mean = ranges.agg(F.avg(F.col("__to") - F.col("__from"))).first()[0] or 0.0
    each = 2 / mean if mean else float("inf")
    each = min(float(axis_.finest), each if each < 1 else float(int(min(each, 2**31))))

    def cell(place: str) -> Column:
        return F.floor(F.col(place) * each).cast("long")

    ranges = ranges.withColumn("__span", F.explode(F.sequence(cell("__from"), cell("__to")))).drop("__from", "__to")
    placed = axis_.placed(target, places[column], "__cell").withColumn("__cell", cell("__cell"))
    return listed_join(ranges, "__span", placed, "__cell", column, (axis_.last + 1) * each, axis_.rows).filter(matches)


def within_bounds(target: DataFrame, criteria: DataFrame, ends: list[tuple[Column, Column, bool, T.DataType]]) -> DataFrame:
    """The target rows within the least or the greatest bound of all, for each (value, bound, is it a lower one, kind)."""

    def place(value: Column, kind: T.DataType) -> Column:
        return value if _family(kind) == "text" else axis(value, kind)

    last = criteria.agg(*[(F.min if low else F.max)(place(bound, kind)) for _, bound, low, kind in ends]).first()
    for (value, _, low, kind), best in zip(ends, last, strict=True):
        at, cut = place(value, kind), F.lit(best).cast("string" if _family(kind) == "text" else "double")
        target = target.filter(at >= cut if low else at <= cut)
    return target


def listed_join(asked: DataFrame, to: str, placed: DataFrame, cell: str, order: str, cells: float, rows: int) -> DataFrame:
    """The columns of both sides, which share no name, for all pairs of rows of equal cells: some `cells` that hold `rows` rows.

    The rows placed in a cell are dealt by their hash into lists of LIST_ROWS or so, each in order, and an asking row goes once to each
    list of its cell: pairs come list by list, and those of one asking row and one list are all that is held at once. Where lists are
    few, the asking rows of each are dealt into shares with copies of the list, for each of them makes far more pairs than there are copies.
    """
    spark = asked.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = max(1, min(SHARES, int(PIECES * tasks // max(cells, rows // LIST_ROWS, 1))))
    # Spark carries what it knows of a cell to the other side of the join, where it can't be computed; not what it knows of an element.
    placed = placed.withColumn(cell, F.explode(F.array(col(cell))))
    held = placed.groupBy(col(cell).alias("__of")).agg(F.ceil(F.count("*") / LIST_ROWS).alias("__lists"))
    if cells * CELL_BYTES <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        held = F.broadcast(held)
    lists = placed.withColumn("__hash", row_hash(placed)).join(held, col(cell) == F.col("__of"), "left")
    lists = lists.withColumn("__list", F.coalesce(F.pmod("__hash", "__lists"), F.lit(0))).withColumn("__copy", F.explode(F.array(*[F.lit(k) for k in range(shares)])))
    # A number of partitions that is given stays: few bytes in may be many pairs out.
    lists = lists.repartition(tasks, cell, "__list", "__copy").sortWithinPartitions(cell, "__list", "__copy", order)
    values = F.collect_list(F.struct(*[col(c) for c in placed.columns if c != cell])).alias("__rows")
    lists = lists.groupBy(cell, "__list", "__copy").agg(values)
    names = [c for c in asked.columns if c != to]
    asked = asked.withColumn("__share", F.pmod(row_hash(asked), F.lit(shares)).cast("int"))
    asked = asked.join(held, col(to) == F.col("__of"), "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__lists") - 1)))
    asked = asked.repartition(tasks, to, "__part", "__share")
    same = (col(to) == col(cell)) & (F.col("__part") == F.col("__list")) & (F.col("__share") == F.col("__copy"))
    # The asking rows come first: Spark streams that side, and passes on after each of its rows what that row has met.
    return asked.join(lists.hint("merge"), same).select(*[col(c) for c in names], F.inline("__rows"))
