"""Words of whole texts as numpy arrays, and bounded pieces of Arrow batches.

A word is a longest run of characters outside space and U+0009 to U+000D. All of these are single
bytes in UTF-8, so words are found on bytes, without decoding.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once in a task; one longer text is handled alone.
CHUNK_BYTES = 1_000_000

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def give_back() -> None:
    """Return freed memory to the system: a Python worker serves many tasks and would keep what its largest one used."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` bytes of that column, one row at least."""
    give_back()
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row begins (one more entry than rows); null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if not len(texts):
        return data[:0], np.zeros(1, np.int64)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words(NamedTuple):
    data: np.ndarray  # the words' bytes, one after another
    offsets: np.ndarray  # where each word begins in data, and the end
    rows: np.ndarray  # the first word of each text, and the end

    def of_row(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def array(self) -> pa.Array:
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(self.offsets) - 1,
            [None, pa.py_buffer(self.offsets.astype(np.int64)), pa.py_buffer(self.data)],
        )

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """The words with one space after each, and where each begins there, with the end."""
        n = len(self.offsets) - 1
        out = np.full(len(self.data) + n, 0x20, np.uint8)
        out[np.arange(len(self.data)) + np.repeat(np.arange(n), np.diff(self.offsets))] = self.data
        return out, self.offsets + np.arange(n + 1)

    def only(self, keep: np.ndarray) -> Words:
        """The words where `keep` holds."""
        lengths = np.diff(self.offsets)
        before = np.concatenate([[0], np.cumsum(keep)])
        return Words(
            self.data[np.repeat(keep, lengths)],
            np.concatenate([[0], np.cumsum(lengths[keep])]),
            before[self.rows],
        )

    def joined(self) -> pa.Array:
        """Each text's words joined by one space."""
        out, starts = self.spaced()
        keep = np.ones(len(out), bool)
        filled = np.diff(self.rows) > 0
        keep[starts[self.rows[1:][filled]] - 1] = False  # the space after a text's last word
        lengths = np.diff(starts[self.rows]) - filled
        bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(out[keep]))
        )


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each word begins in the bytes of texts that begin at `bounds`."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    begins = bounds[:-1][np.diff(bounds) > 0]
    first[begins] = ~space[begins]
    return np.flatnonzero(first)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each text; with `lower`, A to Z become a to z."""
    data, bounds = raw(texts)
    space = _SPACE[data]
    starts = word_starts(data, bounds)
    # A word ends before the next space, or where the next text begins.
    rows = np.searchsorted(starts, bounds)
    kept = data[~space]
    if lower:
        kept = _LOWER[kept]
    solid = np.concatenate([[0], np.cumsum(~space)])
    return Words(kept, np.concatenate([solid[starts], [len(kept)]]).astype(np.int64), rows.astype(np.int64))
