"""Byte-level BPE encoding and decoding with given ranks.

A text is cut by a pattern into pre-tokens, and in each the adjacent pair of lowest rank is merged, leftmost first,
until no adjacent pair has a rank. All different pre-tokens of a piece of the table are merged at once: their symbols
form one linked list, and a queue holds a bucket of list positions for each merge rank. A hierarchical bitmap over the
ranks tells the lowest one that has a bucket by find-first-set. A bucket's positions whose pair has changed since they
were queued are stale and skipped; the others are merged together, left before right where they overlap. So a pre-token of
any length costs a few array steps for each rank that occurs, and never a scan for each merge.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablekeeper.llm.words import chunks, give_back

#: Text whose different pre-tokens are merged together, and text cut or decoded at once, in bytes.
PIECE_BYTES = 12 << 20
SLICE_BYTES = 1_000_000

NO_RANK = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """Token bytes by rank, and the rank of each pair of tokens whose bytes together are a token."""

    def __init__(self, tokens: dict[bytes, int]):
        self.size = max(tokens.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in tokens.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.of_byte = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        keys, ranks = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        self._fill(np.array(keys, np.uint64), np.array(ranks, np.int32))

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing; all keys that still want a slot try their next one together."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, ~np.uint64(0)), np.full(1 << bits, NO_RANK, np.int32)
        slots, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] == ~np.uint64(0)]
            self.keys[slots[free]] = keys[free]  # of several at one slot the last stays
            won = free[self.keys[slots[free]] == keys[free]]
            self.values[slots[won]] = ranks[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> self.shift).astype(np.int64)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NO_RANK; ids below 0 pair with nothing."""
        out = np.full(len(left), NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[todo].astype(np.uint64) << np.uint64(32) | right[todo].astype(np.uint64)
        slots = self._slots(keys)
        while len(todo):
            seen = self.keys[slots]
            hit = seen == keys
            out[todo[hit]] = self.values[slots[hit]]
            on = ~hit & (seen != ~np.uint64(0))
            todo, keys, slots = todo[on], keys[on], (slots[on] + 1) & self.mask
        return out


@lru_cache(maxsize=4)
def _parsed(digest: str, content: bytes) -> Ranks:
    return Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a})


def read_ranks(content: bytes) -> Ranks:
    """Ranks from the lines of a rank file: a token in base64 and its rank. Kept for the process."""
    return _parsed(hashlib.sha256(content).hexdigest(), content)


class RankQueue:
    """Buckets of list positions by rank under three levels of 64-bit bitmaps."""

    def __init__(self, size: int):
        self.levels = [[0] * (size // 64 + 1)]
        while len(self.levels[-1]) > 1:
            self.levels.append([0] * ((len(self.levels[-1]) - 1) // 64 + 1))
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held.append(positions)
            return
        self.buckets[rank] = [positions]
        for level in self.levels:
            rank, bit = rank >> 6, rank & 63
            before = level[rank]
            level[rank] = before | 1 << bit
            if before:
                return

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if len(ranks) == 1:
            self.push(int(ranks[0]), positions)
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            self.push(rank, positions[a:b])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank that has a bucket, and the bucket."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        held, word = self.buckets.pop(rank), rank
        for level in self.levels:
            word, bit = word >> 6, word & 63
            level[word] &= ~(1 << bit)
            if level[word]:
                break
        return rank, held[0] if len(held) == 1 else np.concatenate(held)


class _LowerRank(Exception):
    """A merge made a pair of a lower rank than its own."""


def merge(ranks: Ranks, data: np.ndarray, bounds: np.ndarray, together: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of pre-tokens given as bytes, and where each pre-token's ids begin, with the end.

    `together` merges a whole bucket at once. That equals one merge at a time as long as no merge makes a pair of lower
    rank, which no rank file from training does; where it happens the pre-tokens are merged again one by one.
    """
    n = len(data)
    symbols = np.concatenate([ranks.of_byte[data], np.array([-1], np.int32)])
    follows, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    filled = np.diff(bounds) > 0
    follows[bounds[1:][filled] - 1] = n
    before[bounds[:-1][filled]] = n
    pair = np.full(n + 1, NO_RANK, np.int32)
    queue = RankQueue(ranks.size)
    for at in range(0, n, 1 << 18):  # in blocks, to hold little beside the list
        here = slice(at, min(n, at + (1 << 18)))
        pair[here] = ranks.of_pairs(symbols[here], symbols[follows[here]])
        known = (at + np.flatnonzero(pair[here] != NO_RANK)).astype(np.int32)
        if len(known):
            queue.push_all(pair[known], known)
    try:
        while (found := queue.pop()) is not None:
            rank, at = found
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                at = np.unique(at)
                if not together:
                    queue.push(rank, at[1:])
                    at = at[:1]
            right = follows[at]
            if len(at) > 1 and (linked := right[:-1] == at[1:]).any():
                # In a row of overlapping pairs every second one is taken, from the left.
                first = np.concatenate([[True], ~linked])
                nth = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[nth % 2 == 0]
                right = follows[at]
            after = follows[right]
            symbols[at], symbols[right] = rank, -1
            pair[right] = NO_RANK
            follows[at] = after
            before[after] = at
            left = before[at]
            touched = np.concatenate([left[left < n], at])
            if len(at) > 1:
                touched = np.unique(touched)
            new = ranks.of_pairs(symbols[touched], symbols[follows[touched]])
            pair[touched] = new
            if len(known := np.flatnonzero(new != NO_RANK)):
                if together and new[known].min() <= rank:
                    raise _LowerRank
                queue.push_all(new[known], touched[known])
    except _LowerRank:
        parts = [merge(ranks, data[a:b], np.array([0, b - a]), False)[0] for a, b in zip(bounds, bounds[1:], strict=False)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    alive = symbols[:n] >= 0
    return symbols[:n][alive], np.concatenate([[0], np.cumsum(alive)])[bounds]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[start : start + length], one after another."""
    ends = np.cumsum(lengths)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def decoded(ranks: Ranks, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of each row's ids."""
    lengths = ranks.lengths[ids]
    data = gather(ranks.bytes, ranks.starts[ids], lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])[bounds].astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _pieces(ranks: Ranks, pattern: str, column: str, batches: Iterator[pa.RecordBatch]):
    """Slices of the rows with their ids and bounds; the different pre-tokens of several slices are merged together."""
    find = regex.compile(pattern).findall

    def finish():
        lengths = np.fromiter((len(t.encode()) for t in codes), np.int64, len(codes))
        data = np.frombuffer("".join(codes).encode(), np.uint8)
        codes.clear()
        ids, starts = merge(ranks, data, np.concatenate([[0], np.cumsum(lengths)]))
        counts = np.diff(starts)
        for part, of_part, rows in held:
            lengths = counts[of_part]
            yield part, gather(ids, starts[of_part], lengths), np.concatenate([[0], np.cumsum(lengths)])[rows]

    codes: defaultdict[str, int] = defaultdict()
    codes.default_factory = codes.__len__
    held, size = [], 0
    for part in chunks(batches, column, SLICE_BYTES):
        found, rows = [], [0]
        for text in part.column(column).to_pylist():
            found += find(text) if text else ()
            rows.append(len(found))
        held.append((part, np.fromiter(map(codes.__getitem__, found), np.int32, len(found)), np.array(rows)))
        size += part.column(column).nbytes
        if size >= PIECE_BYTES:
            yield from finish()
            held, size = [], 0
    if held:
        yield from finish()
        held.clear()
    give_back()


def _with(docs: DataFrame, **added: T.DataType) -> T.StructType:
    kept = [f for f in docs.schema.fields if f.name not in added]
    return T.StructType(kept + [T.StructField(k, v) for k, v in added.items()])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", back: str | None = None):
    """The rows with `ids`, the token ids of their whole text; with `back`, also the bytes these ids decode to.

    `path` is a rank file on the driver, whose content (under 1 MB) goes along with the tasks. Null and empty texts have
    no ids. Columns that bear one of the new names are replaced. Special tokens are not known; their text is ordinary.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    added = {ids: T.ArrayType(T.IntegerType(), False)} | ({back: T.BinaryType()} if back else {})
    schema = _with(docs, **added)
    kept = [f.name for f in schema.fields if f.name not in added]

    def run(batches):
        ranks = read_ranks(content.value)
        for part, found, bounds in _pieces(ranks, pattern, text, batches):
            columns = [part.column(k) for k in kept]
            columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32())))
            if back:
                columns.append(decoded(ranks, found, bounds).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", back: str = "bytes") -> DataFrame:
    """The rows with `back`, the bytes that `ids` stand for; null ids and no ids give no bytes. An unknown id fails."""
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    schema = _with(docs, **{back: T.BinaryType()})
    kept = [f.name for f in schema.fields if f.name != back]

    def run(batches):
        ranks = read_ranks(content.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column(ids).to_pylist()
                found = np.array([i for row in lists for i in row or ()], np.int64)
                if len(found) and not 0 <= found.min() <= found.max() < ranks.size:
                    raise ValueError("an id is not in the rank file")
                bounds = np.concatenate([[0], np.cumsum([len(row or ()) for row in lists])]).astype(np.int64)
                columns = [*(part.column(k) for k in kept), decoded(ranks, found, bounds).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
