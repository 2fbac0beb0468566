"""SimHash near-duplicates by a self-join of the binary trie of all fingerprints.

The fingerprints' trie is cut at a depth that grows with their number. Each task gets two subtrees whose prefixes
differ in few enough bits, and walks node pairs of both together: a step takes each pair to its children, adds the
bits that differ, and drops a pair as soon as it exceeds the budget of bits. What a task finds leaves it as a
spanning forest of its links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.llm.components import components, forest
from tablekeeper.llm.storage import stored
from tablekeeper.llm.words import chunks, words_of

BITS = 64
SHINGLE = 3
MOST_BITS = 2
SEED = 42
#: Fingerprints of one subtree on average, and node pairs that are walked together.
SUBTREE = 50_000
PAIRS_AT_ONCE = 200_000
#: Nodes this small are compared fingerprint by fingerprint.
LEAF = 4


def fingerprint_array(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """A uint64 per text: a bit is set if it is set in over half of the hashes of the text's shingles."""
    words = words_of(texts, lower=True)
    spaced, starts = words.spaced()
    content = spaced.tobytes()
    n_words = np.diff(words.rows)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - shingle + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - words.rows[:-1], counts)
    last = np.minimum(first + shingle, np.repeat(words.rows[1:], counts))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(content[a:b], seed) for a, b in zip(starts[first].tolist(), (starts[last] - 1).tolist(), strict=True)],
        np.uint64,
    )
    out = np.zeros(len(n_words), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    for bit in range(BITS):
        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), bounds[filled])
        out[filled] |= (2 * ones > counts[filled].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, text: str = "text", name: str = "_fp", shingle: int = SHINGLE) -> DataFrame:
    """The rows without their text and with `name`, the fingerprint's 64 bits as a long. Null and empty texts have 0."""
    kept = [c for c in docs.columns if c not in (text, name)]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias(name)).schema

    def run(batches):
        for part in chunks(batches, text):
            fp = fingerprint_array(part.column(text), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), pa.array(fp)], names=[*kept, name])

    return docs.mapInArrow(run, schema)


def near_pairs(left: np.ndarray, right: np.ndarray | None, depth: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different fingerprints with at most `most` differing bits: one of each subtree, or both of `left`.

    Both are sorted and without repeats, and each shares its first `depth` bits.
    """
    own = right is None
    right = left if own else right
    bits = int((left[0] ^ right[0]) >> np.uint64(BITS - depth)).bit_count() if depth and len(left) and len(right) else 0
    if not len(left) or not len(right) or bits > most:
        return left[:0], left[:0]
    stack = [(depth, *(np.array([v]) for v in (0, len(left), 0, len(right), bits)))]
    found_a, found_b = [], []
    while stack:
        at, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > PAIRS_AT_ONCE:  # the frontier is walked in parts
            half = len(a0) // 2
            stack += [(at, *(x[s] for x in (a0, a1, b0, b1, diff))) for s in (slice(half), slice(half, None))]
            continue
        small = (a1 - a0) * (b1 - b0) <= LEAF * LEAF if at < BITS else np.ones(len(a0), bool)
        if small.any():
            na, nb = (a1 - a0)[small], (b1 - b0)[small]
            each = na * nb
            nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            wide = np.repeat(nb, each)
            i, j = np.repeat(a0[small], each) + nth // wide, np.repeat(b0[small], each) + nth % wide
            near = np.bitwise_count(left[i] ^ right[j]) <= most
            if own:
                near &= i < j
            found_a.append(left[i[near]])
            found_b.append(right[j[near]])
        big = ~small
        if not big.any():
            continue
        a0, a1, b0, b1, diff = (x[big] for x in (a0, a1, b0, b1, diff))
        am, bm = _middle(left, a0, a1, at), _middle(right, b0, b1, at)
        same = own & (a0 == b0)  # a node with itself: its two children meet once
        sides = [(a0, am, b0, bm, 0, None), (am, a1, bm, b1, 0, None), (a0, am, bm, b1, 1, None), (am, a1, b0, bm, 1, ~same)]
        nexts = []
        for x0, x1, y0, y1, more, where in sides:
            ok = (x1 > x0) & (y1 > y0) & (diff + more <= most)
            if where is not None:
                ok &= where
            nexts.append([v[ok] for v in (x0, x1, y0, y1, diff + more)])
        merged = [np.concatenate(v) for v in zip(*nexts, strict=True)]
        if len(merged[0]):
            stack.append((at + 1, *merged))
    return np.concatenate(found_a or [left[:0]]), np.concatenate(found_b or [left[:0]])


def _middle(sorted_: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """In each run that shares its first `bit` bits, where the next bit turns to 1."""
    mask = np.uint64(1) << np.uint64(BITS - 1 - bit)
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        one = (sorted_[np.minimum(middle, len(sorted_) - 1)] & mask) != 0
        high = np.where(open_ & one, middle, high)
        low = np.where(open_ & ~one, middle + 1, low)


def near_links(prints: DataFrame, most: int = MOST_BITS, name: str = "_fp") -> DataFrame:
    """Links `a`, `b` between different fingerprints that connect the same ones as all pairs of at most `most` bits.

    `prints` holds each fingerprint once.
    """
    n = prints.count()
    depth = min(16, max(2, math.ceil(math.log2(max(n, 1) / SUBTREE + 1))))
    near = [d for d in range(1 << depth) if d.bit_count() <= most]
    prefix = F.shiftrightunsigned(F.col(name), BITS - depth)
    # Subtrees x and x ^ d meet in the task of (the lower of both, d).
    spread = prints.select(F.col(name).alias("_fp"), F.explode(F.array(*[F.lit(d).cast("long") for d in near])).alias("_d"), prefix.alias("_p"))
    spread = spread.select("_fp", "_d", F.least(F.col("_p"), F.col("_p").bitwiseXOR(F.col("_d"))).alias("_low"))

    def run(key, group):
        low, d = (k.as_py() for k in key)
        values = np.sort(group.column("_fp").to_numpy().view(np.uint64))
        if d:
            mine = values >> np.uint64(BITS - depth) == np.uint64(low)
            a, b = near_pairs(values[mine], values[~mine], depth, most)
        else:
            a, b = near_pairs(values, None, depth, most)
        a, b = forest(a.view(np.int64), b.view(np.int64))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return spread.groupBy("_low", "_d").applyInArrow(run, "a long, b long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST_BITS, more=()) -> DataFrame:
    """`doc_id`, the columns `more`, `_fp`, `_root` and `_component` for every row.

    `_component` is the least doc_id reachable over links of at most `most` bits; `_root` names the component by a fingerprint.

    Rows without words have fingerprint 0 and are linked like others. Rows that repeat a doc_id are rows of their own.
    A null doc_id takes part, but names a component only if no other row is in it (then the component is null).
    """
    prints = stored(fingerprints(docs.select(doc_id, *more, text), text), "prints")
    each = prints.groupBy("_fp").agg(F.min(doc_id).alias("_least"))
    roots = components(near_links(each.select("_fp"), most), reduced=True)
    rooted = each.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left")
    rooted = rooted.withColumn("_root", F.coalesce("root", "_fp"))
    named = rooted.groupBy("_root").agg(F.min("_least").alias("_component"))
    of_print = rooted.select("_fp", "_root").join(named, "_root")
    return prints.join(of_print, "_fp")


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
