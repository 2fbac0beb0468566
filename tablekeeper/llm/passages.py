"""Removal of word passages that occur more than once, with difference-cover anchors.

Every window of `window` words whose sequence starts anywhere else too is removed, the first occurrence included. Windows are
not compared one by one. Within each text the positions whose number modulo a period is in a difference cover are
anchors, hashed over `window - period + 1` words. For any two positions there is a shift below the period that takes both to
the cover, so two equal windows share an anchor at the same place inside them. Only windows around anchors that occur
twice are looked at further: from a shared anchor they extend over every start that keeps the anchor inside, and those starts
are matched by a 128-bit hash of the full window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.llm import repeats
from tablekeeper.llm.hashing import BASES, prefix, windows, word_hashes
from tablekeeper.llm.words import Words, chunks, raw, word_starts, words_of

WINDOW = 35
#: Perfect difference sets; every residue modulo the period is a difference of two members.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
}


def _cover(window: int) -> tuple[int, tuple[int, ...]]:
    period = max(p for p in COVERS if p <= max(1, window * 2 // 3))
    return period, COVERS[period]


def _sums(words: Words) -> list[np.ndarray]:
    return [prefix(word_hashes(words.data, words.offsets, base), base) for base in BASES]


def _anchors(words: Words, window: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hash, row and position of the anchors of the rows that hold a window."""
    period, cover = _cover(window)
    length = window - period + 1
    row = words.of_row()
    at = np.arange(len(row)) - words.rows[row]
    n = np.diff(words.rows)[row]
    chosen = np.isin(np.arange(period), cover)[at % period] & (at + length <= n) & (n >= window)
    here = np.flatnonzero(chosen)
    base = BASES[0]
    hashes = windows(prefix(word_hashes(words.data, words.offsets, base), base), here, here + length, base)
    return [hashes], row[here], at[here]


def spread(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of 0..n-1 lie in a span [start, end)."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges[:-1]) > 0


def _windows(words: Words, anchors: list[np.ndarray], window: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Two hashes, row and position of every window that holds one of its text's given anchors."""
    period, _ = _cover(window)
    counts = np.array([len(a) for a in anchors])
    at = np.concatenate([*anchors, np.zeros(0, np.int32)]).astype(np.int64)
    row = np.repeat(np.arange(len(anchors)), counts)
    first, n = words.rows[:-1][row], np.diff(words.rows)[row]
    low, high = np.maximum(at - period + 1, 0), np.minimum(at, n - window)
    starts = np.flatnonzero(spread(first + low, first + high + 1, int(words.rows[-1])))
    sums = _sums(words)
    hashes = [windows(s, starts, starts + window, b) for s, b in zip(sums, BASES, strict=True)]
    row = np.searchsorted(words.rows, starts, side="right") - 1
    return hashes, row, starts - words.rows[row]


def repeated_starts(docs: DataFrame, text: str, window: int = WINDOW, moved: DataFrame | None = None) -> DataFrame:
    """For each text (`_id`, `_th`) with such windows: `_at`, the starts of its windows that occur elsewhere too.

    `docs` comes from `repeats.keyed`; `moved` holds the same rows by that key.
    """
    buckets = repeats.buckets_for(docs, text)
    moved = docs.repartition("_id", "_th") if moved is None else moved
    narrow = docs.select("_id", "_th", repeats.plain(text).alias("_text"))

    def anchors(batches):
        for part in chunks(batches, "_text"):
            words = words_of(part.column("_text"))
            yield *_anchors(words, window), *_keys(part), part.column("_text").nbytes

    def sketch(batches):
        yield from repeats.sent(anchors(batches), buckets)

    shared = repeats.per_text(repeats.repeated(narrow.mapInArrow(sketch, repeats.ITEMS), buckets))
    held = moved.join(shared, ["_id", "_th"])  # all columns, so that both uses of `moved` share one shuffle

    def starts(batches):
        for part in chunks(batches, text):
            words = words_of(part.column(text))
            found = _windows(words, repeats.numbers(part.column("_at")), window)
            yield *found, *_keys(part), part.column(text).nbytes

    def extend(batches):
        yield from repeats.sent(starts(batches), buckets)

    return repeats.per_text(repeats.repeated(held.mapInArrow(extend, repeats.ITEMS), buckets))


def _keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("_id").to_numpy(), part.column("_th").to_numpy()


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def runs(covered: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each longest covered run inside a row."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], covered[:-1]]) if len(covered) else covered
    after = np.concatenate([covered[1:], [False]]) if len(covered) else covered
    starts = np.flatnonzero(covered & (~before | edge[:-1]))
    ends = np.flatnonzero(covered & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def uncovered(texts: pa.Array, covered: np.ndarray) -> pa.Array:
    """The texts as they stand without the covered words and the white space behind each."""
    data, bounds = raw(texts)
    starts = word_starts(data, bounds)
    ends = np.minimum(np.append(starts[1:], len(data)), bounds[np.searchsorted(bounds, starts, side="right")])
    gone = spread(starts[covered], ends[covered], len(data))
    lost = np.concatenate([[0], np.cumsum(gone)])[bounds]
    left = pa.py_buffer(np.ascontiguousarray(data[~gone]))
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer((bounds - lost).astype(np.int64)), left)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, as_it_stands: bool = False
) -> DataFrame:
    """The rows with `_n_words`, `_n_removed`, `_spans` (removed runs, in words) and `_kept`, the other words by one space.

    `as_it_stands`: `_kept` keeps the white space and lines between the words that stay. Null and empty texts have no words and keep the empty text. Texts shorter than a window are never touched. Repeated
    rows repeat each other's windows and lose them. Columns named like the four added ones are replaced.
    """
    rows = repeats.enclosed(docs, doc_id, text)
    keyed = repeats.keyed(rows, "_doc", "_text")
    moved = keyed.repartition("_id", "_th")
    starts = repeated_starts(keyed, "_text", window, moved)
    joined = moved.join(starts, ["_id", "_th"], "left")
    added = [
        T.StructField("_n_words", T.LongType()),
        T.StructField("_n_removed", T.LongType()),
        T.StructField("_spans", SPANS),
        T.StructField("_kept", T.StringType()),
    ]
    kept, schema = rows.columns, T.StructType(rows.schema.fields + added)

    def cut(batches):
        for part in chunks(batches, "_text"):
            words = words_of(part.column("_text"))
            at = repeats.numbers(part.column("_at"))
            begin = np.concatenate([a + f for a, f in zip(at, words.rows, strict=False)] + [np.zeros(0)]).astype(np.int64)
            covered = spread(begin, begin + window, int(words.rows[-1]))
            s, e, row = runs(covered, words.rows)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            spans = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(s - words.rows[row], pa.int32()), pa.array(e - words.rows[row], pa.int32())], ["start", "end"]
                ),
            )
            lost = np.concatenate([[0], np.cumsum(covered)])[words.rows]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in kept),
                    pa.array(np.diff(words.rows), pa.int64()),
                    pa.array(np.diff(lost), pa.int64()),
                    spans,
                    (uncovered(part.column("_text"), covered) if as_it_stands else words.only(~covered).joined()).cast(pa.string()),
                ],
                names=schema.names,
            )

    return repeats.opened(joined.mapInArrow(cut, schema), docs, doc_id, text, [f.name for f in added])
