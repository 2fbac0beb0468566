"""Repair of the turn structure of conversations by a run-length dynamic programme.

A row is a symbol: its role (system, user, assistant, other) and its fault (none, truncated, must go). Edits lead through four
states, the role of the last row that stays: none yet, system, user, assistant. Equal symbols in a row are one run; a run takes the
costs-to-go of the four states across its whole length by cached binary powers of the symbol's min-plus transition. The cheapest
edits are then read off forwards, by the least letter that still reaches the least cost.

A conversation may be any share of all rows, so it is never gathered. Rows are range-partitioned in order; a conversation that lies
inside one partition is done there at once. One that crosses a boundary, or is long, is cut into pieces. Each partition sends one
4 x 4 matrix for such a conversation, a task composes these (as many as there are partitions) into the costs-to-go at each
partition's end, and in a second round the states in which the cheapest edits enter each partition; pieces are then unrolled apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablekeeper.llm.repeats import plain
from tablekeeper.llm.storage import stored
from tablekeeper.llm.words import chunks

SPACE = " \t\n\x0b\x0c\r"
#: A piece of a conversation holds at most so many different rows and bytes of text (one row at least).
PIECE_ROWS, PIECE_BYTES = 1 << 14, 4 << 20
#: Rows of a run whose choices are unrolled together.
UNROLLED = 1 << 10
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CLEAN, CUT, GONE = 0, 1, 2
STATES = 4
NEVER = 1 << 60
#: What it costs to end in a state: a conversation is empty or ends with the assistant.
END = (0, 2 * INSERT, INSERT, 0)
#: The state after an inserted or reroled row; users follow all but users.
NEXT = (2, 2, 3, 2)
LEGAL = frozenset(("su", "ua", "au"))
NAMES = {2: "user", 3: "assistant"}
KEPT = "array<struct<role:string,text:string>>"
COUNTS = ["_blank", "_duplicate", "_truncated", "_illegal"]
PIECES = (
    "_part long, _run long, _seq long, _whole boolean, _last boolean, _audit string, _kept " + KEPT + ", _cost long, "
    "_blank long, _duplicate long, _truncated long, _illegal long, _gaps long, _low long, _high long, _turns long, "
    "_first string, _end string, _matrix array<long>, _symbols binary, _times binary, _roles array<string>, _texts array<string>"
)
TOLD = "_gaps long, _blank long, _duplicate long, _truncated long, _illegal long, _cost long"
COSTS = "_part long, _run long, _after array<long>, " + TOLD
ENTRIES = "_part long, _run long, _seq long, _after array<long>, _enter array<int>, _exit array<int>"
STARTS = "_part long, _run long, _state int, _final boolean"
PLACE = [("_part", pa.int64()), ("_run", pa.int64())]
ENTRIES_ARROW = pa.schema(
    [*PLACE, ("_seq", pa.int64()), ("_after", pa.list_(pa.int64())), ("_enter", pa.list_(pa.int32())), ("_exit", pa.list_(pa.int32()))]
)
STARTS_ARROW = pa.schema([*PLACE, ("_state", pa.int32()), ("_final", pa.bool_())])
UNROLLED_PIECES = "_part long, _seq long, _audit string, _kept " + KEPT + ", _report boolean, " + TOLD


# --- one symbol, one run -------------------------------------------------------------------------------------------------------


def symbol(initial: str, fault: int) -> int:
    """Rows that must go are one symbol, whatever their role."""
    return GONE if fault == GONE else 3 * (1 + "sua".find(initial) if initial else 0) + fault


def kept_in(kind: int, state: int) -> int | None:
    """The state after a row of this role is kept in `state`, if it may be."""
    if kind == 1:
        return 1 if state == 0 else None
    return kind if kind and NEXT[state] == kind else None


@lru_cache(maxsize=1 << 16)
def across(one: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs-to-go before a row of this symbol, rows inserted before it included, from those after it."""
    kind, fault = divmod(one, 3)
    out = []
    for state in range(STATES):
        best = DELETE + after[state]
        if fault != GONE:
            more = TRUNCATED if fault == CUT else 0
            best = min(best, REROLE + more + after[NEXT[state]])
            stays = kept_in(kind, state)
            if stays is not None:
                best = min(best, more + after[stays])
        out.append(best)
    for _ in range(2):  # further inserted rows would only go round in a circle
        out = [min(c, INSERT + out[NEXT[state]]) for state, c in enumerate(out)]
    return tuple(out)


Matrix = tuple[tuple[int, ...], ...]
UNIT: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(STATES)) for i in range(STATES))


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(STATES)), NEVER) for j in range(STATES)) for i in range(STATES))


@lru_cache(maxsize=1 << 12)
def power(one: int, bit: int) -> Matrix:
    """The transition of 2^bit rows of this symbol."""
    if bit:
        return times(power(one, bit - 1), power(one, bit - 1))
    columns = [across(one, tuple(0 if j == k else NEVER for k in range(STATES))) for j in range(STATES)]
    return tuple(tuple(min(columns[j][i], NEVER) for j in range(STATES)) for i in range(STATES))


def apply(matrix: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(m + v for m, v in zip(row, after, strict=True)) for row in matrix)


@lru_cache(maxsize=1 << 16)
def _advanced(one: int, count: int, after: tuple[int, ...]) -> tuple[int, ...]:
    for bit in range(count.bit_length()):
        if count >> bit & 1:
            after = apply(power(one, bit), after) if bit else across(one, after)
    return after


def advanced(one: int, count: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs-to-go before `count` rows of this symbol."""
    least = min(after)
    return tuple(least + v for v in _advanced(one, count, tuple(v - least for v in after)))


def transition(runs: list[tuple[int, int]]) -> Matrix:
    out = UNIT
    for one, count in runs:
        for bit in range(count.bit_length()):
            if count >> bit & 1:
                out = times(out, power(one, bit))
    return out


@lru_cache(maxsize=1 << 16)
def choice(one: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The letters up to and with this row's own, and the state behind it: the least letter on a cheapest way, again and again."""
    kind, fault = divmod(one, 3)
    before, letters = across(one, after), ""
    while True:
        cost = before[state]
        if DELETE + after[state] == cost:
            return letters + "D", state
        if INSERT + before[NEXT[state]] == cost:
            letters, state = letters + "I", NEXT[state]
            continue
        more = TRUNCATED if fault == CUT else 0
        stays = kept_in(kind, state)
        if stays is not None and more + after[stays] == cost:
            return letters + "K", stays
        return letters + "R", NEXT[state]


def unrolled(one: int, count: int, after: tuple[int, ...], state: int) -> Iterator[tuple[str, int]]:
    """`choice` for each row of a run in turn."""
    if count > UNROLLED:
        half = count // 2
        for letters, state in unrolled(one, half, advanced(one, count - half, after), state):
            yield letters, state
        yield from unrolled(one, count - half, after, state)
        return
    least = min(after)
    behind = [tuple(v - least for v in after)]
    for _ in range(count - 1):
        costs = across(one, behind[-1])
        least = min(costs)
        behind.append(tuple(v - least for v in costs))
    for costs in reversed(behind):
        letters, state = choice(one, costs, state)
        yield letters, state


def runs_of(symbols: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """Adjacent rows of one symbol as (symbol, number of rows)."""
    out: list[tuple[int, int]] = []
    for one, n in zip(symbols, counts, strict=True):
        if out and out[-1][0] == one:
            out[-1] = (one, out[-1][1] + n)
        else:
            out.append((one, n))
    return out


def before_runs(runs: list[tuple[int, int]], after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs-to-go behind each run, and before the first at the end."""
    out = [after]
    for one, count in reversed(runs):
        out.append(advanced(one, count, out[-1]))
    return out


def edits(runs: list[tuple[int, int]], after: tuple[int, ...], state: int) -> Iterator[tuple[str, int]]:
    """The letters of each row and the state behind it."""
    behind = before_runs(runs, after)
    for k, (one, count) in enumerate(runs):
        for letters, state in unrolled(one, count, behind[len(runs) - 1 - k], state):
            yield letters, state


def ending(state: int) -> str:
    """The rows inserted at the end."""
    return "I" * (END[state] // INSERT)


def repaired(runs, counts, roles, texts, after, state, last) -> tuple[str, list[dict], int]:
    """The letters, the rows that stay or are inserted, and the state behind the last, of rows given once with their number."""
    letters, out = [], []
    steps = edits(runs, after, state)

    def insert(made: str, at: int) -> int:
        for _ in made:
            at = NEXT[at]
            out.append({"role": NAMES[at], "text": ""})
        return at

    for count, role, text in zip(counts, roles, texts, strict=True):
        for _ in range(count):
            made, then = next(steps)
            letters.append(made)
            state = insert(made[:-1], state)
            if made[-1] == "K":
                out.append({"role": role, "text": text})
            elif made[-1] == "R":
                out.append({"role": NAMES[then], "text": text})
            state = then
    if last:
        letters.append(ending(state))
        state = insert(letters[-1], state)
    return "".join(letters), out, state


# --- the table -----------------------------------------------------------------------------------------------------------------


def faulty(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """`_c`, `_t`, `_r`, `_x` once for each different row, `_m` how often it occurs, `_f` the fault of the first of them, `_blank`."""
    base = rows.select(
        plain(conv).alias("_c"),
        plain(turn).cast("long").alias("_t"),
        F.coalesce(plain(role).cast("string"), F.lit(" ")).alias("_r"),
        F.coalesce(plain(text).cast("string"), F.lit(" ")).alias("_x"),
    ).withColumn("_d", F.unhex(F.sha2("_x", 256)))
    # Rows of equal role and text are counted without their texts, map-side; only those that repeat are joined back.
    again = (
        base.groupBy(F.col("_c").alias("_c2"), F.col("_r").alias("_r2"), F.col("_d").alias("_d2"))
        .agg(F.min(F.struct("_t")).alias("_earliest"), F.count("*").alias("_n"))
        .filter("_n > 1")
    )
    same = F.col("_c").eqNullSafe(F.col("_c2")) & (F.col("_r") == F.col("_r2")) & (F.col("_d") == F.col("_d2"))
    joined = base.join(again, same, "left")
    names = ["_c", "_t", "_r", "_x"]
    single = joined.filter("_n IS NULL").select(*names, F.lit(1).cast("long").alias("_m"), F.lit(False).alias("_later"))
    later = ~F.col("_t").eqNullSafe(F.col("_earliest._t"))
    copies = joined.filter("_n IS NOT NULL").groupBy(*names, later.alias("_later")).agg(F.count("*").alias("_m"))
    stripped = F.rtrim("_x", F.lit(SPACE))
    blank = stripped == ""
    whole = F.right(stripped, F.lit(1)).isin(".", "!", "?")
    fault = F.when(blank | F.col("_later"), GONE).when(whole, CLEAN).otherwise(CUT)
    every = single.select(*names, "_m", "_later").union(copies.select(*names, "_m", "_later"))
    return every.select(*names, "_m", blank.alias("_blank"), fault.alias("_f"))


class _Run:
    """Rows of one conversation in one partition, in order."""

    def __init__(self, part: int, number: int, conv, first: bool, most: int):
        self.part, self.number, self.conv, self.edge, self.most = part, number, conv, first, most
        self.done: list[dict] = []
        self.sent = 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.low = self.high = None
        self.turns = 0
        self.first = self.end = None
        self.matrix = UNIT
        self._open()

    def _open(self) -> None:
        self.symbols, self.times, self.roles, self.texts, self.bytes = [], [], [], [], 0

    def add(self, turn, role: str, text: str, count: int, blank: bool, fault: int) -> None:
        if len(self.times) >= self.most or (self.times and self.bytes + len(text) > PIECE_BYTES):
            self._close()
        initial = role[:1]
        counts = self.counts
        if blank:
            counts["_blank"] += count
        else:
            counts["_duplicate"] += count - 1 + (fault == GONE)
            counts["_truncated"] += fault == CUT
        if self.end is None:
            self.first = initial
        else:
            counts["_illegal"] += self.end + initial not in LEGAL
        counts["_illegal"] += count - 1
        self.end = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        one = symbol(initial, fault)
        for s, n in ((one, 1), (GONE, count - 1)):
            if n:
                self.symbols.append(s)
                self.times.append(n)
                self.roles.append(role)
                self.texts.append("" if s == GONE else text)
        self.bytes += len(self.texts[-1]) + len(text)

    def _close(self) -> None:
        """Turn the open rows into a piece that others will finish."""
        self.matrix = times(self.matrix, transition(runs_of(self.symbols, self.times)))
        self.done.append(
            self._row(
                _symbols=np.array(self.symbols, np.uint8).tobytes(),
                _times=np.array(self.times, np.int64).tobytes(),
                _roles=self.roles,
                _texts=self.texts,
            )
        )
        self._open()

    def _row(self, **more) -> dict:
        self.sent += 1
        return {"_c": self.conv, "_part": self.part, "_run": self.number, "_seq": self.sent, "_whole": False, "_last": False} | more

    def ready(self) -> list[dict]:
        """Pieces that can leave before the run is over."""
        out, self.done = self.done, []
        return out

    def finished(self, last: bool) -> list[dict]:
        """The rest; `last` if it ends the partition, so that the conversation may go on elsewhere."""
        known = self.counts | {"_low": self.low, "_high": self.high, "_turns": self.turns, "_first": self.first, "_end": self.end}
        if self.edge or last or self.sent:
            self._close()
            out = self.ready()
            out[-1] |= known | {"_last": True, "_matrix": [v for row in self.matrix for v in row]}
            return out
        runs = runs_of(self.symbols, self.times)
        cost = before_runs(runs, END)[-1][0]
        audit, kept, _ = repaired(runs, self.times, self.roles, self.texts, END, 0, True)
        gaps = gaps_of(self.low, self.high, self.turns)
        return [self._row(_audit=audit, _kept=kept, _cost=cost, _gaps=gaps, **known) | {"_whole": True, "_last": True}]


def gaps_of(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, 2**63 - 1)


def _schema(conv: T.StructField, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("_c", conv.dataType), *T.StructType.fromDDL(ddl).fields])


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(t) for t in row.get("_texts") or ()) + sum(len(t["text"]) for t in row.get("_kept") or ())
        if size > PIECE_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    most: int = PIECE_ROWS,
) -> DataFrame:
    """Conversations with the cheapest edits that bring their roles into the form `(s?(ua)+)?`, in pieces.

    A conversation's rows are taken by turn, nulls first, then by role and text; a null role or text counts as one space. Edits and
    costs: K keep 0, R rerole to user or assistant 1, D delete 2 (a must for rows without a visible character and for rows whose role
    and text were seen before), I insert an empty row 5; a row that stays and does not end in `.`, `!` or `?` adds 5. Of equally
    cheap edits the letters least by ASCII are taken.

    Most conversations are one piece, with `_whole` true. `_part`, `_seq` order the pieces of others; `_audit` the letters, `_kept`
    the rows that stay or are inserted, in order. The piece with `_report` true bears the conversation's counts `_gaps`, `_blank`, `_duplicate`,
    `_truncated`, `_illegal` and `_cost`, null elsewhere. The conversation itself is `_c`; a null one is a conversation too. Other
    columns are not looked at. An empty table gives no rows. `most` is how many different rows a piece holds.
    """
    found = faulty(rows, conv, turn, role, text)
    # The texts' beginnings part rows of equal conversation, turn and role; whole ones would travel in the sample.
    keys = [F.col("_c"), F.col("_t"), F.col("_r"), F.substring("_x", 1, 32)]
    ordered = found.repartitionByRange(*keys).sortWithinPartitions("_c", "_t", "_r", "_x")
    schema = _schema(found.schema["_c"], PIECES)
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_cut(batches, most), arrow)

    pieces = stored(ordered.mapInArrow(cut, schema), "dialogue")
    names = ["_c", "_part", "_seq", "_audit", "_kept", "_gaps", *COUNTS, "_cost"]
    whole = pieces.filter("_whole").select(*names, F.lit(True).alias("_report"), "_whole")
    rest = _finished(pieces.filter("NOT _whole")).select(*names, "_report", F.lit(False).alias("_whole"))
    return whole.union(rest)


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict]:
    part, run, number = TaskContext.get().partitionId(), None, 0
    for batch in chunks(batches, "_x"):
        columns = [batch.column(c).to_pylist() for c in ("_c", "_t", "_r", "_x", "_m", "_blank", "_f")]
        for c, *row in zip(*columns, strict=True):
            if run is None or run.conv != c:
                if run is not None:
                    yield from run.finished(False)
                number += 1
                run = _Run(part, number, c, run is None, most)
            run.add(*row)
            if run.done:
                yield from run.ready()
    if run is not None:
        yield from run.finished(True)


def _finished(pieces: DataFrame) -> DataFrame:
    """Pieces of conversations that are not whole, with their letters."""
    conv = pieces.schema["_c"]
    totals = [*COUNTS, "_low", "_high", "_turns", "_first", "_end", "_matrix"]
    costs = stored(_costs(pieces.filter("_last").select("_c", "_part", "_run", *totals), conv), "dialogue-costs")

    # Costs-to-go behind each piece and the state in which it is entered, for each state at the partition's start.
    symbols = pieces.select("_part", "_run", "_seq", "_symbols", "_times")
    inner = symbols.join(costs.select("_part", "_run", "_after"), ["_part", "_run"]).groupBy("_part", "_run")
    entries = stored(inner.applyInArrow(_entries, ENTRIES), "dialogue-entries")

    ends = entries.filter("_exit IS NOT NULL").select("_part", "_run", "_exit")
    ends = ends.join(costs.select("_c", "_part", "_run"), ["_part", "_run"])
    starts = ends.groupBy("_c").applyInArrow(_starts, STARTS)

    told = ["_gaps", *COUNTS, "_cost"]
    first = F.lit(1).cast("long").alias("_seq")
    report = costs.select("_part", "_run", first, *told, F.col("_cost").isNotNull().alias("_report"))
    # The small tables meet first, so that the texts are joined once.
    known = entries.drop("_exit").join(starts, ["_part", "_run"]).join(report, ["_part", "_run", "_seq"], "left")
    open_ones = pieces.select("_c", "_part", "_run", "_seq", "_last", "_symbols", "_times", "_roles", "_texts")
    schema = _schema(conv, UNROLLED_PIECES)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (batch.slice(k, 1).to_pylist()[0] for batch in batches for k in range(batch.num_rows))
        yield from _batches(map(_unrolled, rows), arrow)

    return open_ones.join(known, ["_part", "_run", "_seq"]).mapInArrow(run, schema)


def _listed(symbols: bytes, counts: bytes) -> tuple[list[int], list[int]]:
    return np.frombuffer(symbols, np.uint8).tolist(), np.frombuffer(counts, np.int64).tolist()


def _unrolled(row: dict) -> dict:
    symbols, counts = _listed(row["_symbols"], row["_times"])
    state = row["_enter"][row["_state"]]
    last = row["_last"] and row["_final"]
    audit, kept, _ = repaired(runs_of(symbols, counts), counts, row["_roles"], row["_texts"], tuple(row["_after"]), state, last)
    names = ["_c", "_part", "_seq", "_gaps", *COUNTS, "_cost"]
    return {n: row[n] for n in names} | {"_report": bool(row["_report"]), "_audit": audit, "_kept": kept}


def _costs(heads: DataFrame, conv: T.StructField) -> DataFrame:
    """For each partition that holds rows of a conversation, the costs-to-go behind them; the first bears the conversation's counts."""
    schema = _schema(conv, COSTS)
    arrow = to_arrow_schema(schema)

    def run(group: pa.Table) -> pa.Table:
        parts = sorted(group.to_pylist(), key=lambda r: r["_part"])
        out, after = [], END
        for r in reversed(parts):
            out.append({"_c": r["_c"], "_part": r["_part"], "_run": r["_run"], "_after": list(after)})
            m = r["_matrix"]
            after = apply(tuple(tuple(m[STATES * i : STATES * i + STATES]) for i in range(STATES)), after)
        totals = {c: sum(r[c] for r in parts) for c in COUNTS}
        totals["_illegal"] += sum(a["_end"] + b["_first"] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
        timed = [r for r in parts if r["_low"] is not None]
        turns = sum(r["_turns"] for r in timed) - sum(a["_high"] == b["_low"] for a, b in zip(timed, timed[1:], strict=False))
        gaps = gaps_of(timed[0]["_low"], timed[-1]["_high"], turns) if timed else 0
        out[-1] |= totals | {"_gaps": gaps, "_cost": after[0]}
        return pa.Table.from_pylist(out, arrow)

    return heads.groupBy("_c").applyInArrow(run, schema)


def _entries(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["_seq"])
    after, held = tuple(rows[0]["_after"]), []
    for r in reversed(rows):
        runs = runs_of(*_listed(r["_symbols"], r["_times"]))
        held.append((r, runs, after))
        after = before_runs(runs, after)[-1]
    at, out = list(range(STATES)), []
    for r, runs, after in reversed(held):
        out.append({"_part": r["_part"], "_run": r["_run"], "_seq": r["_seq"], "_after": list(after), "_enter": at, "_exit": None})
        ends = {}
        for state in set(at):
            ends[state] = state
            for _, ends[state] in edits(runs, after, state):
                pass
        at = [ends[s] for s in at]
    out[-1]["_exit"] = at
    return pa.Table.from_pylist(out, ENTRIES_ARROW)


def _starts(group: pa.Table) -> pa.Table:
    parts = sorted(group.to_pylist(), key=lambda r: r["_part"])
    state, out = 0, []
    for k, r in enumerate(parts):
        out.append({"_part": r["_part"], "_run": r["_run"], "_state": state, "_final": k == len(parts) - 1})
        state = r["_exit"][state]
    return pa.Table.from_pylist(out, STARTS_ARROW)


def reports(pieces: DataFrame) -> DataFrame:
    """One row per conversation of `repair`: `_c`, its counts, `_cost`, `_audit`, and `_sha256` of the repaired `role:text` lines.

    A digest goes through all bytes of its conversation in order. One that is in several pieces is read by one task, a piece at a
    time, so that only its letters are held; others are digested where they are.
    """
    line = F.array_join(F.transform("_kept", lambda k: F.concat(k["role"], F.lit(":"), k["text"])), "\n")
    counts = ["_gaps", *COUNTS, "_cost"]
    alone = pieces.filter("_whole").select("_c", *counts, "_audit", F.sha2(line, 256).alias("_sha256"))
    ordered = pieces.filter("NOT _whole").repartition("_c").sortWithinPartitions("_c", "_part", "_seq")
    schema = alone.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_digested(batches, counts), arrow)

    return alone.union(ordered.select("_c", *counts, "_report", "_audit", "_kept").mapInArrow(run, schema))


def _digested(batches: Iterator[pa.RecordBatch], counts: list[str]) -> Iterator[dict]:
    row, letters, digest, lines = None, [], None, 0
    for batch in batches:
        for k in range(batch.num_rows):
            piece = batch.slice(k, 1).to_pylist()[0]
            if row is None or row["_c"] != piece["_c"]:
                if row is not None:
                    yield row | {"_audit": "".join(letters), "_sha256": digest.hexdigest()}
                row, letters, digest, lines = {"_c": piece["_c"]}, [], hashlib.sha256(), 0
            if piece["_report"]:
                row |= {c: piece[c] for c in counts}
            letters.append(piece["_audit"])
            for kept in piece["_kept"]:
                digest.update((("\n" if lines else "") + kept["role"] + ":" + kept["text"]).encode())
                lines += 1
    if row is not None:
        yield row | {"_audit": "".join(letters), "_sha256": digest.hexdigest()}
