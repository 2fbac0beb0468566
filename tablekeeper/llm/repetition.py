"""Repetition inside a text from its suffix array over words.

The suffix array of every text of a piece is built by prefix doubling, all texts together. Its longest-common-prefix
intervals give the maximal repeated word sequences; the union of their spans is the repeated part of the text, and the longest
of them the longest repeat. A text fails if the part is too large or the longest repeat too long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.llm.hashing import BASES, mixed, prefix, windows
from tablekeeper.llm.passages import SPANS, runs, spread
from tablekeeper.llm.words import chunks, raw, words_of

#: A repeat counts from so many words on; limits of the repeated share of all words and of the longest repeat in words.
LEAST_REPEAT = 10
MOST_COVERED = 0.3
LONGEST_REPEAT = 50
#: Base rules: fewest words, window of repeated words, and their most in percent.
FEWEST_WORDS = 50
WINDOW = 3
MOST_REPEATED = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def suffix_array(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array and longest common prefixes of each row, row after row, and the row of each place.

    `codes` are the words' numbers. lcp[k] is that of the suffixes at places k - 1 and k, 0 where a row begins.
    """
    n = len(codes)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    left = bounds[1:][row] - np.arange(n)  # words from here to the end of the row
    key = row.astype(np.int64) << 32 | codes.astype(np.int64)
    order = np.argsort(key, kind="stable")
    rank, todo = _ranks(key[order], order, np.zeros(n, np.int64), 0)
    step = 1
    while len(todo):
        after = np.where(left[todo] > step, rank[np.minimum(todo + step, n - 1)] + 1, 0)
        key = rank[todo] << 32 | after
        by = np.argsort(key, kind="stable")
        rank, todo = _ranks(key[by], todo[by], rank, None)
        step *= 2
    places = np.empty(n, np.int64)
    places[rank] = np.arange(n)
    del rank, key, order
    lcp = np.zeros(n, np.int64)
    pairs = np.flatnonzero(row[places[1:]] == row[places[:-1]]) + 1
    if len(pairs):
        lcp[pairs] = common_words(codes, places[pairs - 1], places[pairs], np.minimum(left[places[pairs - 1]], left[places[pairs]]))
    return places, lcp, row


def common_words(codes: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from a and from b on are the same, up to `most`, by binary search over two hashes of their beginnings.

    Only the two arrays of prefix sums are held, however long a text is.
    """
    values = mixed(codes.astype(np.uint64) + np.uint64(1))
    sums = [prefix(values, base) for base in BASES]
    low, high = np.zeros(len(a), np.int64), most + 1  # low words are the same, high are not
    while len(open_ := np.flatnonzero(high - low > 1)):
        middle = (low[open_] + high[open_]) // 2
        same = np.ones(len(open_), bool)
        for total, base in zip(sums, BASES, strict=True):
            one, two = (windows(total, at[open_], at[open_] + middle, base) for at in (a, b))
            same &= one == two
        low[open_] = np.where(same, middle, low[open_])
        high[open_] = np.where(same, high[open_], middle)
    return low


def _ranks(keys: np.ndarray, items: np.ndarray, rank: np.ndarray, base: int | None):
    """New ranks of items in the order of their keys, which split their old ranks; and the items still tied."""
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    within = starts[np.cumsum(first) - 1] if len(keys) else starts
    if base is None:  # groups keep their first rank; members move up by their place in it
        old = rank[items]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        heads = np.flatnonzero(group)
        new = old + within - heads[np.cumsum(group) - 1]
    else:
        new = within
    rank = rank.copy()
    rank[items] = new
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    return rank, items[np.repeat(sizes > 1, sizes)]


def maximal_repeats(places: np.ndarray, lcp: np.ndarray, codes: np.ndarray, bounds: np.ndarray, least: int):
    """(length, first place, last place) of the LCP intervals of at least `least` words that no word to the left extends."""
    before = np.where(np.isin(places, bounds), -1 - places, codes[places - 1])
    changes = np.cumsum(np.concatenate([[0], before[1:] != before[:-1]])) if len(places) else before
    long = lcp >= least
    edges = np.flatnonzero(np.diff(long.astype(np.int8), prepend=0, append=0))
    found = []

    def close(length, low, high):
        if changes[high] != changes[low]:
            found.append((length, low, high))

    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        stack = []
        for k, here in enumerate(lcp[a:b].tolist(), a):
            low = k - 1
            while stack and stack[-1][0] > here:
                length, low = stack.pop()
                close(length, low, k - 1)
            if not stack or stack[-1][0] < here:
                stack.append((here, low))
        while stack:
            length, low = stack.pop()
            close(length, low, b - 1)
    return found


def _lines(texts: pa.Array) -> np.ndarray:
    """For each text, how many of its lines that hold a word equal an earlier one."""
    split = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    flat, parent = split.flatten(), split.value_parent_indices().to_numpy()
    data, bounds = raw(flat)
    solid = np.concatenate([[0], np.cumsum(~np.isin(data, [0x20, *range(0x09, 0x0E)]))])[bounds]
    worded = np.diff(solid) > 0
    codes = flat.dictionary_encode().indices.to_numpy()[worded].astype(np.int64)
    parent = parent[worded].astype(np.int64)
    distinct = np.unique(parent << 32 | codes) >> 32
    return np.bincount(parent, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


COLUMNS = [
    T.StructField(name, kind)
    for name, kind in {
        "_n_words": T.LongType(),
        "_word_chars": T.LongType(),
        "_n_symbols": T.LongType(),
        "_n_dup_lines": T.LongType(),
        "_n_repeat_words": T.LongType(),
        "_n_covered": T.LongType(),
        "_n_repeats": T.LongType(),
        "_longest": T.LongType(),
        "_spans": SPANS,
    }.items()
]


def measured(texts: pa.Array, least: int = LEAST_REPEAT) -> list[pa.Array]:
    """The values of COLUMNS for each text."""
    data, bounds = raw(texts)
    words = words_of(texts)
    rows, n = words.rows, int(words.rows[-1])
    codes = words.array().dictionary_encode().indices.to_numpy().astype(np.int64)
    places, lcp, row = suffix_array(codes, rows)
    # The deepest interval around a suffix is as long as the larger of its two common prefixes.
    reach = np.maximum(lcp, np.concatenate([lcp[1:], [0]])) if n else lcp
    window = places[reach >= WINDOW]
    again = spread(window, window + WINDOW, n)
    long = reach >= least
    covered = spread(places[long], places[long] + reach[long], n)
    longest, count = np.zeros(len(rows) - 1, np.int64), np.zeros(len(rows) - 1, np.int64)
    if repeats := maximal_repeats(places, lcp, codes, rows, least):
        length, low, _ = np.array(repeats).T
        np.maximum.at(longest, row[places[low]], length)
        np.add.at(count, row[places[low]], 1)
    s, e, of = runs(covered, rows)
    cuts = np.searchsorted(of, np.arange(len(rows)))
    ends = [pa.array(x - rows[of], pa.int32()) for x in (s, e)]

    def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])

    return [
        *(
            pa.array(x, pa.int64())
            for x in (
                np.diff(rows),
                per_row((words.data & 0xC0) != 0x80, words.offsets[rows]),
                per_row(_SYMBOL[data], bounds),
                _lines(texts),
                per_row(again, rows),
                per_row(covered, rows),
                count,
                longest,
            )
        ),
        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(ends, ["start", "end"])),
    ]


def measure(docs: DataFrame, text: str = "text", least: int = LEAST_REPEAT) -> DataFrame:
    """The rows without their text and with COLUMNS: counts of words, the repeated part in words and its spans.

    Null and empty texts have zeros and no spans. Columns that bear one of the new names are replaced.
    """
    names = {f.name for f in COLUMNS}
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in names]

    def run(batches):
        for part in chunks(batches, text):
            columns = [part.column(f.name) for f in kept] + measured(part.column(text), least)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept + COLUMNS])

    return docs.mapInArrow(run, T.StructType(kept + COLUMNS))


def judged(measured_rows: DataFrame) -> DataFrame:
    """Adds `_base_failed` and `_kept`; a text without words fails the base rules."""
    base = (F.col("_n_words") < FEWEST_WORDS) | (100 * F.col("_n_repeat_words") > MOST_REPEATED * F.col("_n_words"))
    calm = (F.col("_n_covered") <= MOST_COVERED * F.col("_n_words")) & (F.col("_longest") <= LONGEST_REPEAT)
    return measured_rows.withColumns({"_base_failed": base, "_kept": ~base & calm})
