"""Which of many terms a text holds: an automaton over all of them, read once over the bytes of a batch of texts.

The states are the beginnings of the terms. From a state a byte leads to the longer beginning, or, over failure links, to the longest
beginning that the text read so far ends in, so the time is linear in the text, whatever the terms share. All arrays are flat. The
bytes of a batch are cut into lanes of equal length that step together; each lane starts with nothing read and is then corrected by
letting the one before it read on, until both agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Lanes that step together, and the least length of one.
LANES, LANE_BYTES = 4_096, 64
#: Bytes of text read together; one longer text is read alone.
BATCH_BYTES = 1 << 20
#: An automaton whose whole table, a number for each state and each byte that terms hold, is no larger reads by that table.
TABLE_BYTES = 32 << 20


class Automaton:
    """Of different terms that are not empty. A term is named by its number in the sequence."""

    def __init__(self, terms: Sequence[bytes]):
        lengths = np.array([len(t) for t in terms], np.int64)
        if len(set(terms)) < len(terms) or (len(lengths) and not lengths.min()):
            raise ValueError("terms must differ and hold a byte at least")
        data = np.frombuffer(b"".join(terms), np.uint8).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        size = int(lengths.sum()) + 1
        # A state above 0 is the place of its edge + 1 among the edges, sorted by (state, byte).
        self.edges = np.zeros(size - 1, np.int64)
        self.fail, self.term, self.link = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.count, self.near = 0, np.zeros((1, 256), np.int32)
        at, open_ = np.zeros(len(terms), np.int64), np.arange(len(terms))
        for depth in range(int(lengths.max(initial=0))):
            open_ = open_[lengths[open_] > depth]
            edges, which = np.unique(at[open_] << 8 | data[first[open_] + depth], return_inverse=True)
            new = np.arange(len(edges)) + self.count + 1
            fail = self.step(self.fail[edges >> 8], edges & 255) if depth else np.zeros(len(edges), np.int32)
            self.edges[self.count : self.count + len(edges)] = edges
            self.count += len(edges)
            self.fail[new] = fail
            at[open_] = new[which]
            done = open_[lengths[open_] == depth + 1]
            self.term[at[done]] = done
            self.link[new] = np.where(self.term[fail] >= 0, fail, self.link[fail])
            if depth == 0:
                self.near[0, edges] = new
            elif depth == 1:
                # The first beginnings lead on by a table: most bytes of most texts are read there.
                self.near = np.repeat(self.near[:1], int(edges[0] >> 8 == 0) + int(new[0]), axis=0)
                self.near[edges >> 8, edges & 255] = new
        self.kinds = np.zeros(256, np.int64)  # 0 for all bytes that no term holds
        held = np.unique(data)
        self.kinds[held] = np.arange(len(held)) + 1
        self.table = None
        self.edges, self.fail = self.edges[: self.count], self.fail[: self.count + 1]
        self.term, self.link = self.term[: self.count + 1], self.link[: self.count + 1]

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states after one more byte each."""
        out = np.zeros(len(state), np.int32)
        edges, near = self.edges[: self.count], len(self.near)
        todo, state, byte = np.arange(len(state)), state.astype(np.int64), byte.astype(np.int64)
        while True:
            table = state < near
            out[todo[table]] = self.near[state[table], byte[table]]
            deep = ~table
            if not deep.any():
                return out
            todo, state, byte = todo[deep], state[deep], byte[deep]
            edge = state << 8 | byte
            place = np.searchsorted(edges, edge)
            place[place == len(edges)] = 0
            leads = edges[place] == edge
            out[todo[leads]] = place[leads] + 1
            todo, byte, state = todo[~leads], byte[~leads], self.fail[state[~leads]].astype(np.int64)
            if not len(todo):
                return out

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None}

    def reader(self, data: np.ndarray):
        """The bytes as they are read, a function like `step` for those, and what a state counts as in it."""
        wide = int(self.kinds.max()) + 1
        if (self.count + 1) * wide * 4 > TABLE_BYTES:
            return data, self.step, 1
        if self.table is None:
            table = np.zeros((self.count + 1, wide), np.int32)
            state, kind = self.edges >> 8, self.kinds[self.edges & 255]
            low, high = 0, 1  # the states of one depth
            while low < high:
                table[low:high] = table[self.fail[low:high]] if low else 0
                first, last = np.searchsorted(state, [low, high])
                table[state[first:last], kind[first:last]] = np.arange(first, last) + 1
                low, high = high, last + 1
            self.table = (table * wide).ravel()
        return self.kinds.astype(np.int32)[data], lambda state, kind: self.table.take(state + kind), wide

    def states(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The state behind each byte; every text, from one of `bounds` to the next, starts anew."""
        data, step, scale = self.reader(data)
        size = max(LANE_BYTES, -(-len(data) // LANES))
        counts = -(-np.diff(bounds) // size)
        row = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = bounds[:-1][row] + nth * size
        length = np.minimum(bounds[1:][row] - start, size)
        order = np.argsort(-length, kind="stable")
        begin, length = start[order], length[order]
        out, state = np.zeros(len(data), np.int32), np.zeros(len(begin), np.int32)
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k, side="left"))  # lanes that have a byte left
            state = step(state[:n], data[begin[:n] + k])
            out[begin[:n] + k] = state
        follows = nth > 0
        at, end, state = start[follows], bounds[1:][row[follows]], out[start[follows] - 1]
        while len(at):
            state = step(state, data[at])
            differs = out[at] != state
            at, end, state = at[differs], end[differs], state[differs]
            out[at] = state
            at = at + 1
            inside = at < end
            at, end, state = at[inside], end[inside], state[inside]
        return out // scale if scale > 1 else out

    def held(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and term of every pair of a text and a term that it holds, in this order."""
        state = self.states(data, bounds)
        ends = np.flatnonzero((self.term[state] >= 0) | (self.link[state] > 0))
        width = self.count + 1
        seen = np.unique((np.searchsorted(bounds, ends, side="right") - 1) * width + state[ends])
        found = []
        while len(seen):
            row, at = seen // width, seen % width
            here = self.term[at] >= 0
            found.append(row[here] * width + self.term[at[here]])
            shorter = self.link[at]
            seen = np.unique(row[shorter > 0] * width + shorter[shorter > 0])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // width, pairs % width


def texts_as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins, with the end; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def held_terms(texts: pa.Array, automaton: Automaton) -> pa.Array:
    """For each text the numbers of the terms it holds, as a list."""
    lists, numbers, start = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)], 0
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
        row, term = automaton.held(*texts_as_bytes(texts.slice(start, stop - start)))
        lists.append(np.bincount(row, minlength=stop - start))
        numbers.append(term.astype(np.int32))
        start = stop
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(lists)), pa.int32()), pa.array(np.concatenate(numbers), pa.int32()))
