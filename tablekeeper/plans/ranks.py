"""Exact order statistics without a global sort.

The row at a given rank is found by narrowing: a bounded sample of the sort keys gives a
bracket around the rank, one aggregate counts what lies below and inside it, and the
search goes on inside until few rows are left. The driver sees sample keys and counts
only. The found key then splits the table with a plain filter, which reaches the scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.functions.predicates import all_of, any_of, col, row_hash
from tablekeeper.session import checkpoint_dir

# A rank this low, or a rest this small, is answered by one bounded top-k.
TOP_ROWS = 10_000
REST_ROWS = 100_000
SAMPLE_ROWS = 100_000


@dataclass(frozen=True)
class By:
    """One sort column: an expression and its direction. Nulls go first ascending, last descending."""

    value: Column
    descending: bool = False


def order_by(spec: Sequence[str | By] | str) -> list[By]:
    """Sort spec from names; a leading `-` means descending."""
    if isinstance(spec, (str, By)):
        spec = [spec]
    if not spec:
        raise ValueError("an order key is required: rows have no position of their own")
    result = []
    for item in spec:
        if isinstance(item, By):
            result.append(item)
        else:
            result.append(By(col(item.removeprefix("-")), item.startswith("-")))
    return result


class _Order:
    """Sort keys as columns `k0..kn`, and comparisons of a row with a fetched key."""

    def __init__(self, frame: DataFrame, spec: Sequence[By]):
        self.spec = list(spec)
        self.keys = frame.select(*[by.value.alias(f"k{i}") for i, by in enumerate(spec)])
        self.kinds = [field.dataType for field in self.keys.schema.fields]
        self.own = [F.col(f"k{i}") for i in range(len(spec))]
        for kind in self.kinds:
            _check_kind(kind)

    def sorting(self) -> list[Column]:
        return [k.desc() if by.descending else k.asc() for k, by in zip(self.own, self.spec)]

    def as_text(self) -> list[Column]:
        """Keys as text that comes back as the same value: bytes in hex, instants as microseconds, others as Spark writes them."""
        return [_to_text(k, kind).alias(f"k{i}") for i, (k, kind) in enumerate(zip(self.own, self.kinds))]

    def literals(self, key: Sequence[str | None]) -> list[Column | None]:
        return [None if v is None else _from_text(v, kind) for v, kind in zip(key, self.kinds)]

    def _compare(self, key: Sequence[str | None], columns: Sequence[Column] | None, earlier: bool, equal: bool) -> Column:
        """Rows before (or after) the key, nested so that a column is read again only on a tie.

        Plain comparisons, which scans can use; nulls sort smallest.
        """
        result = F.lit(equal)
        for column, literal, by in reversed(list(zip(columns or self.own, self.literals(key), self.spec))):
            if earlier != by.descending:
                test = F.lit(False) if literal is None else column.isNull() | (column < literal)
            else:
                test = column.isNotNull() if literal is None else column.isNotNull() & (column > literal)
            tie = column.isNull() if literal is None else column.eqNullSafe(literal)
            result = test | (tie & result)
        return result

    def before(self, key: Sequence[str | None], columns: Sequence[Column] | None = None) -> Column:
        return self._compare(key, columns, earlier=True, equal=False)

    def up_to(self, key: Sequence[str | None], columns: Sequence[Column] | None = None) -> Column:
        return self._compare(key, columns, earlier=True, equal=True)

    def after(self, key: Sequence[str | None], columns: Sequence[Column] | None = None) -> Column:
        return self._compare(key, columns, earlier=False, equal=False)

    def same(self, key: Sequence[str | None], columns: Sequence[Column] | None = None) -> Column:
        pairs = zip(columns or self.own, self.literals(key))
        return all_of(c.isNull() if v is None else c.eqNullSafe(v) for c, v in pairs)

    def counts(self, keys: DataFrame, low: Sequence[str | None], high: Sequence[str | None]) -> list[int]:
        """Rows before low, at low, between, and at high; each row is placed once."""
        place = (
            F.when(self.before(low), 0)
            .when(self.same(low), 1)
            .when(self.before(high), 2)
            .when(self.same(high), 3)
        )
        found = {r["p"]: r["n"] for r in keys.groupBy(place.alias("p")).agg(F.count("*").alias("n")).collect()}
        return [found.get(i, 0) for i in range(4)]


# Fixed value: bytes of sample keys that may reach the driver at once.
SAMPLE_BYTES = 32 << 20


def _check_kind(kind: T.DataType) -> None:
    plain = (T.NumericType, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not isinstance(kind, plain):
        raise TypeError(f"cannot search ranks by values of type {kind.simpleString()}")


def _to_text(key: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.hex(key)
    return (F.unix_micros(key) if isinstance(kind, T.TimestampType) else key).cast("string")


def _from_text(value: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.lit(value))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(value)))
    return F.lit(value).cast(kind)


def _sample_bound(order: _Order, keys: DataFrame, rows: int) -> int:
    """Rows of a sample whose keys stay within SAMPLE_BYTES; only keys of open length are measured."""
    open_ended = [k for k, kind in zip(order.own, order.kinds) if isinstance(kind, (T.StringType, T.BinaryType))]
    if not open_ended:
        return rows
    width = sum((F.coalesce(F.octet_length(k), F.lit(0)) for k in open_ended), F.lit(32))
    return max(50, min(rows, int(SAMPLE_BYTES / (2 * (keys.agg(F.avg(width)).first()[0] or 1)))))


@dataclass(frozen=True)
class Found:
    """Sort key at a rank, as text, and whether it is the last row with that key."""

    key: tuple
    last: bool


def _at(order: _Order, keys: DataFrame, rank: int) -> Found | None:
    rows = keys.orderBy(*order.sorting()).select(*order.as_text()).offset(rank).limit(2).collect()
    return Found(tuple(rows[0]), len(rows) == 1 or tuple(rows[1]) != tuple(rows[0])) if rows else None


def key_at(
    frame: DataFrame,
    spec: Sequence[By],
    rank: int,
    total: int | None = None,
    *,
    top_rows: int = TOP_ROWS,
    rest_rows: int = REST_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> Found | None:
    """Sort key of the row at 0-based `rank`; None when there is no such row. `total` saves a count."""
    if rank < 0:
        raise ValueError("rank must not be negative")
    order = _Order(frame, spec)
    if rank < top_rows:
        return _at(order, order.keys, rank)
    total = order.keys.count() if total is None else total
    if rank >= total:
        return None
    held: list[DataFrame] = []
    try:
        return _narrow(order, order.keys, total, rank, rest_rows, sample_rows, held)
    finally:
        for frame in held:
            frame.unpersist()


def _narrow(order, inside, total, rank, rest_rows, sample_rows, held) -> Found:
    seed = 17
    sample_rows = _sample_bound(order, inside, sample_rows) if total > rest_rows else sample_rows
    while total > rest_rows:
        # Enough sample keys for the bracket to fall below rest_rows at once, within bounds.
        wanted = min(sample_rows, max(sample_rows // 25, 50, math.ceil((3 * total / rest_rows) ** 2)))
        seed += 1
        picked = (
            inside.sample(min(1.0, wanted / total), seed)
            .orderBy(*order.sorting())
            .select(*order.as_text())
            .limit(2 * wanted)
            .collect()
        )
        if not picked:
            continue
        middle = rank / total * len(picked)
        margin = 1.5 * math.sqrt(len(picked)) + 1
        low = tuple(picked[min(len(picked) - 1, max(0, math.floor(middle - margin)))])
        high = tuple(picked[min(len(picked) - 1, math.ceil(middle + margin))])
        below, at_low, between, at_high = order.counts(inside, low, high)
        below_high = below + at_low + between
        # A key that repeats a lot ends the search at once: its ranks are known from the counts.
        if below <= rank < below + at_low:
            return Found(low, rank + 1 == below + at_low)
        if below_high <= rank < below_high + at_high:
            return Found(high, rank + 1 == below_high + at_high)
        if rank < below:
            inside, total = inside.filter(order.before(low)), below
        elif rank < below_high:
            inside = inside.filter(order.after(low) & order.before(high))
            total, rank = between, rank - below - at_low
        else:
            inside, skipped = inside.filter(order.after(high)), below_high + at_high
            total, rank = total - skipped, rank - skipped
        # Keys inside the bracket only; later rounds need not scan the table again.
        inside = inside.persist()
        held.append(inside)
    return _at(order, inside, rank)


def keys_at(
    frame: DataFrame,
    spec: Sequence[By],
    wanted: Sequence[int],
    total: int,
    *,
    top_rows: int = TOP_ROWS,
    rest_rows: int = REST_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> list[Found]:
    """Sort keys of a few ranks below `total`, searched together: one sample brackets all of them, one aggregate counts
    between the brackets, and one pass keeps the keys inside."""
    order = _Order(frame, spec)
    if max(wanted) < top_rows or total <= rest_rows:
        return [_at(order, order.keys, rank) for rank in wanted]
    size = _sample_bound(order, order.keys, sample_rows)
    picked = order.keys.sample(min(1.0, size / total), 17).orderBy(*order.sorting()).select(*order.as_text()).limit(2 * size).collect()
    margin = 1.5 * math.sqrt(len(picked)) + 1
    edges: list[tuple] = []
    for rank in sorted(wanted):
        middle = rank / total * len(picked)
        for place in (math.floor(middle - margin), math.ceil(middle + margin)):
            key = tuple(picked[min(len(picked) - 1, max(0, place))]) if picked else None
            edges += [key] if key is not None and key not in edges else []
    edges = [key for key in dict.fromkeys(map(tuple, picked)) if key in edges]  # in their order
    place = F.when(F.lit(False), F.lit(0))
    for j, edge in enumerate(edges):
        place = place.when(order.before(edge), 2 * j).when(order.same(edge), 2 * j + 1)
    numbered = order.keys.withColumn("__place", place.otherwise(2 * len(edges)))
    counts = {r["__place"]: r["n"] for r in numbered.groupBy("__place").agg(F.count("*").alias("n")).collect()}
    found: dict[int, Found] = {}
    open_ranks, start = {}, 0
    for j in range(2 * len(edges) + 1):
        end = start + counts.get(j, 0)
        for rank in wanted:
            if start <= rank < end and j % 2:
                found[rank] = Found(edges[j // 2], rank + 1 == end)
            elif start <= rank < end:
                open_ranks[rank] = (j, rank - start, end - start)
        start = end
    if open_ranks:
        inside = numbered.filter(F.col("__place").isin(sorted({j for j, _, _ in open_ranks.values()}))).persist()
        held: list[DataFrame] = [inside]
        try:
            for rank, (j, own, size) in open_ranks.items():
                part = inside.filter(F.col("__place") == j).drop("__place")
                found[rank] = _narrow(order, part, size, own, rest_rows, sample_rows, held)
        finally:
            for kept in held:
                kept.unpersist()
    return [found[rank] for rank in wanted]


def not_at(frame: DataFrame, spec: Sequence[By], keys: Sequence[tuple]) -> Column:
    """Rows whose sort key is none of the fetched ones."""
    order, values = _Order(frame, spec), [by.value for by in spec]
    return ~any_of(order.same(key, values) for key in keys)


def split_at(
    frame: DataFrame, spec: Sequence[By], rows: int, total: int | None = None, **bounds: int
) -> tuple[DataFrame, DataFrame]:
    """(first `rows` rows, all others) in the given order; exact, also when keys repeat.

    Rows that tie on the order are told apart by a hash of all columns; what still ties is
    the same row, so any of the copies may go to either side.
    """
    if rows <= 0:
        return frame.filter(F.lit(False)), frame
    found = key_at(frame, spec, rows - 1, total, **bounds)
    if found is None:
        return frame, frame.filter(F.lit(False))
    order, values = _Order(frame, spec), [by.value for by in spec]
    before, same, after = (test(found.key, values) for test in (order.before, order.same, order.after))
    if found.last:
        return frame.filter(order.up_to(found.key, values)), frame.filter(after)
    ties, part = frame.filter(same), rows - frame.filter(before).count()
    some, others = _split_ties(ties, part, bounds)
    return frame.filter(before).unionAll(some), frame.filter(after).unionAll(others)


def _split_ties(ties: DataFrame, rows: int, bounds: dict) -> tuple[DataFrame, DataFrame]:
    spec = [By(row_hash(ties))]
    found = key_at(ties, spec, rows - 1, **bounds)
    order, values = _Order(ties, spec), [by.value for by in spec]
    before, same, after = (test(found.key, values) for test in (order.before, order.same, order.after))
    if found.last:
        return ties.filter(order.up_to(found.key, values)), ties.filter(after)
    below, equal = ties.agg(F.count_if(before), F.count_if(same)).first()
    copies = ties.filter(same)
    return (
        ties.filter(before).unionAll(copies.limit(rows - below)),
        ties.filter(after).unionAll(copies.limit(below + equal - rows)),
    )


def quantile_value(frame: DataFrame, column: str, fraction: float, **bounds: int) -> Column | None:
    """The value at the rank of a fraction, as a literal in the column's own type; nulls are left out."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    values = frame.select(col(column).alias("v")).filter("v is not null")
    n = values.count()
    if n == 0:
        return None
    spec = [By(F.col("v"))]
    found = key_at(values, spec, max(0, math.ceil(fraction * n) - 1), n, **bounds)
    return _Order(values, spec).literals(found.key)[0]


# Fixed value: whole numbers beyond this are not all doubles.
EXACT_DOUBLE = 2**53


def quantile(frame: DataFrame, column: str, fraction: float, *, linear: bool = True, **bounds: int) -> float | None:
    """Exact quantile of the non-null values as a double: interpolated, or the value at its rank (`linear=False`).

    Whole numbers and decimals beyond 2^53 do not fit a double and are refused; see :func:`quantile_value`.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    values = frame.select(col(column).cast("double").alias("v")).filter("v is not null")
    wide = isinstance(frame.schema[column].dataType, (T.LongType, T.DecimalType))
    n, most = values.agg(F.count("*"), F.max(F.abs("v")) if wide else F.lit(0.0)).first()
    if n == 0:
        return None
    if (most or 0.0) > EXACT_DOUBLE:
        raise ValueError(f"{column} holds values beyond 2^53, which a double cannot interpolate; use quantile_value")
    spec = [By(F.col("v"))]
    if not linear:
        return float(key_at(values, spec, max(0, math.ceil(fraction * n) - 1), n, **bounds).key[0])
    place = (n - 1) * fraction
    rank = math.floor(place)
    found = key_at(values, spec, rank, n, **bounds)
    low = float(found.key[0])
    if place == rank or not found.last:
        return low
    high = values.filter(_Order(values, spec).after(found.key, [F.col("v")])).agg(F.min("v")).first()[0]
    return (rank + 1 - place) * low + (place - rank) * high


def with_positions(frame: DataFrame, spec: Sequence[By], name: str = "position", parts: int | None = None) -> DataFrame:
    """Add the 0-based position of every row in the given order, without a one-task sort.

    Range partitions are sorted locally and written to the shared checkpoint folder once,
    so the partition numbers cannot change under a retry; the offsets table has one row
    per partition.
    """
    spark = frame.sparkSession
    checkpoint_dir(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorting = [by.value.desc() if by.descending else by.value.asc() for by in spec]
    sorting.append(row_hash(frame))  # lets a range boundary fall inside ties
    local = (
        frame.repartitionByRange(parts, *sorting)
        .sortWithinPartitions(*sorting)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumns({"__part": F.shiftright("__id", 33), "__local": F.col("__id").bitwiseAND((1 << 33) - 1)})
        .drop("__id")
        .checkpoint()
    )
    # One row per partition, so one task is enough for the running sum.
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        local.groupBy("__part")
        .agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    )
    return (
        local.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__local"))
        .drop("__part", "__local", "__offset")
    )
