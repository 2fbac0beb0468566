"""Removal of byte strings that an earlier document holds, by a hash-compared suffix sort.

Each byte covered by a string of `length` bytes that also starts in a document with a smaller doc_id is removed. To bring equal
strings together without moving all suffixes, each string is named by its minimizer, the least hash among its grams of
`GRAM` bytes: equal strings have the same one at the same offset. Only strings whose minimizer occurs twice in the corpus
are moved, as short stretches of text that hold several of them. Where they meet, the suffixes at these strings are sorted by a
mergesort whose comparisons find the common extension of two suffixes by binary search over prefix polynomial hashes. The
sorted neighbours are then compared byte by byte; where a hash had collided, the group is sorted again by its bytes.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.llm import repeats
from tablekeeper.llm.bpe import gather
from tablekeeper.llm.hashing import BASES, mixed, powers, prefix, windows
from tablekeeper.llm.passages import SPANS, runs, spread
from tablekeeper.llm.words import chunks, raw

LENGTH = 50
GRAM = 20
#: A moved stretch holds strings whose minimizer stands at one of so many neighbouring offsets; all of them share
#: LENGTH - STEP + 1 bytes, by which they are dealt out. So a common minimizer with varied surroundings is dealt to many tasks.
STEP = 16
#: Bytes of stretches that are sorted or hashed together.
SORTED_BYTES = 1_000_000
#: Bytes of different stretches of one key beyond which its strings are dealt out one by one, by all their bytes.
HOT_BYTES = 16 << 20
#: Marks a text that is, as a whole, a copy of an earlier document's.
WHOLE = np.array([-1, 0], np.int32)


def minimizers(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All starts of strings of `length` bytes inside a row, where the minimizer of each stands, and the hash of every gram."""
    wide = length - GRAM + 1
    lengths = np.diff(bounds)
    fits = np.maximum(lengths - length + 1, 0)
    starts = np.arange(int(fits.sum())) + np.repeat(bounds[:-1] - (np.cumsum(fits) - fits), fits)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    base = BASES[0]
    sums = prefix(data + np.uint64(1), base)
    n = len(data) - GRAM + 1
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * powers(len(sums), base)[1][:n])
    # The high half of the hash above the position: the least is the leftmost of the least.
    least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    return starts, (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64), grams


def _anchors(data: np.ndarray, bounds: np.ndarray, length: int):
    starts, at, grams = minimizers(data, bounds, length)
    at = at[np.flatnonzero(np.diff(at, prepend=-1))]
    row = np.searchsorted(bounds, at, side="right") - 1
    return [grams[at]], row, at - bounds[row]


def suffix_order(text: np.ndarray, at: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A sort of suffixes by their first `length` bytes inside groups, and whether each equals the one before it.

    `at` holds the suffixes' places, group by group; `first` where each group begins, and the end.
    """
    n = len(at)
    begin, end = np.repeat(first[:-1], np.diff(first)), np.repeat(first[1:], np.diff(first))
    order, where = np.arange(n), at.copy()
    sums, power = prefix(text + np.uint64(1), BASES[1]), powers(len(text), BASES[1])[0]

    def less(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the suffix at a is before that at b, and whether they are equal."""
        pa_, pb, sa, sb = power[a], power[b], sums[a], sums[b]
        equal = (sums[a + length] - sa) * pb == (sums[b + length] - sb) * pa_
        before = np.zeros(len(a), bool)
        left = np.flatnonzero(~equal)
        a, b, pa_, pb, sa, sb = (x[left] for x in (a, b, pa_, pb, sa, sb))
        low, high = np.zeros(len(a), np.int64), np.full(len(a), length)
        while len(low) and (high - low).max() > 1:
            middle = (low + high) // 2
            same = (sums[a + middle] - sa) * pb == (sums[b + middle] - sb) * pa_
            low, high = np.where(same, middle, low), np.where(same, high, middle)
        before[left] = text[a + low] < text[b + low]
        return before, equal

    width = 1
    while len(open_ := np.flatnonzero(end - begin > width)):
        nth = open_ - begin[open_]
        pair = begin[open_] + nth // (2 * width) * (2 * width)
        right = nth // width % 2 == 1
        edge = np.minimum(pair + width, end[open_])
        low = np.where(right, pair, edge)
        high = np.where(right, edge, np.minimum(pair + 2 * width, end[open_]))
        rank, mine = low.copy(), where[open_]
        while len(todo := np.flatnonzero(rank < high)):
            middle = (rank[todo] + high[todo]) // 2
            before, equal = less(where[middle], mine[todo])
            on = before | (equal & right[todo])  # equal ones stay in order
            rank[todo] = np.where(on, middle + 1, rank[todo])
            high[todo] = np.where(on, high[todo], middle)
        to = pair + nth % width + rank - low
        moved, order_ = mine, order[open_]
        where[to], order[to] = moved, order_
        width *= 2

    same = np.zeros(n, bool)
    inner = np.flatnonzero(np.arange(n) > begin) if n else np.zeros(0, np.int64)
    wrong = [inner[:0]]
    for part in np.array_split(inner, len(inner) // 100_000 + 1):
        # Equal by bytes is equal by hash, so equal ones are neighbours unless a collision has put one elsewhere.
        a, b = where[part - 1], where[part]
        left = np.ones(len(part), bool)
        for k in range(0, length, 8):
            left &= _eight(text, a, min(k, max(0, length - 8))) == _eight(text, b, min(k, max(0, length - 8)))
        same[part] = left
        part, a, b = part[~left], a[~left], b[~left]
        cells = np.arange(length)
        for some in np.array_split(np.arange(len(part)), len(part) // 10_000 + 1):
            x, y = text[a[some][:, None] + cells], text[b[some][:, None] + cells]
            at_ = (x != y).argmax(1)
            here = np.arange(len(some))
            wrong.append(part[some][x[here, at_] > y[here, at_]])
    for g in np.unique(begin[np.concatenate(wrong)]).tolist():
        stop = int(end[g])
        strings = [text[p : p + length].tobytes() for p in at[g:stop]]
        own = sorted(range(stop - g), key=strings.__getitem__)
        order[g:stop] = g + np.array(own)
        same[g + 1 : stop] = [strings[x] == strings[y] for x, y in zip(own, own[1:], strict=False)]
    return order, same


def _eight(text: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
    """Eight bytes of text from each place, as one number; at the very end fewer, padded with zeros."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        place = at + (shift + k)
        inside = np.minimum(place, len(text) - 1)
        out |= np.where(place < len(text), text[inside], 0).astype(np.uint64) << np.uint64(8 * k)
    return out


def _stretches(data: np.ndarray, bounds: np.ndarray, anchors: list[np.ndarray] | None, length: int, hot: np.ndarray | None = None):
    """Stretches of strings around a text's given anchors: key, row, first start, offset of the anchor there, number of strings.

    Without anchors, around all. Each string at a key of `hot` is a stretch of its own, with a key by its bytes and the offset.
    """
    starts, at, _ = minimizers(data, bounds, length)
    if anchors is not None:
        wanted = np.zeros(len(data) + 1, bool)
        wanted[np.concatenate([a + b for a, b in zip(anchors, bounds, strict=False)] + [np.zeros(0)]).astype(np.int64)] = True
        chosen = wanted[at]
        starts, at = starts[chosen], at[chosen]
    offset = at - starts
    new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(offset // STEP, prepend=-1) != 0))
    counts = np.diff(new, append=len(starts))
    low = offset[new] // STEP * STEP
    high = np.minimum(low + STEP - 1, length - GRAM)
    sums = prefix(data + np.uint64(1), BASES[0])
    key = windows(sums, at[new] - low, at[new] - high + length, BASES[0]) + low.astype(np.uint64)
    if hot is not None and len(hot) and (is_hot := np.isin(key, hot)).any():
        each = np.where(is_hot, counts, 1)
        of = np.repeat(np.arange(len(new)), each)
        new = new[of] + np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
        single, key, counts = is_hot[of], key[of], np.where(is_hot, 1, counts)[of]
        first = starts[new[single]]
        own = windows(sums, first, first + length, BASES[0])
        key[single] = mixed(key[single] + mixed(own + offset[new[single]].astype(np.uint64)))
    row = np.searchsorted(bounds, starts[new], side="right") - 1
    return key, row, starts[new], offset[new], counts


def hot_keys(docs: DataFrame, text: str, length: int, rate: int, most: int) -> np.ndarray:
    """Keys whose different stretches make over `most` bytes, as estimated from one of `rate` texts.

    All tasks split the strings of the same keys, so results do not depend on the estimate.
    """

    def run(batches):
        for part in chunks(batches, text):
            data, bounds = raw(part.column(text))
            key, _, start, _, count = _stretches(data, bounds, None, length)
            sums = prefix(data + np.uint64(1), BASES[1])
            own = windows(sums, start, start + count + length - 1, BASES[1])
            columns = [pa.array(k.view(np.int64), pa.int64()) for k in (key, own)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "own"])

    sample = docs.filter(F.pmod(F.xxhash64("_id", "_th"), F.lit(rate)) == 0).select(text)
    each = sample.mapInArrow(run, "key long, own long").distinct().groupBy("key").count()
    # A stretch of a line that stands in other surroundings each time has about this many bytes; few in the sample tell nothing.
    found = each.filter(F.col("count") >= max(4, math.ceil(most / (length + STEP - 1) / rate))).select("key").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def _store(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(arrays, 5))


def _load(value: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(value))


def _equal_runs(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Whether each place in the order has the same keys as the one before."""
    same = np.ones(len(order), bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[order[1:]] == k[order[:-1]]
    return same


def _decided(key, ids, offset, count, content, begin, size) -> np.ndarray:
    """Which stretches are those of a smaller id again, as a whole, byte by byte."""
    own = np.zeros(len(key), np.uint64)
    block = begin // SORTED_BYTES  # a bounded part of the content at a time
    cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        low, high = begin[a], begin[b - 1] + size[b - 1]
        sums = prefix(content[low:high] + np.uint64(1), BASES[1])
        own[a:b] = windows(sums, begin[a:b] - low, begin[a:b] - low + size[a:b], BASES[1])
    name = mixed(key + mixed(own + (offset.astype(np.uint64) << np.uint64(8)) + count.astype(np.uint64)))
    order = np.lexsort((ids, name))
    same = _equal_runs([name, key, offset, count, own], order)
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    test = np.flatnonzero(same)
    for part in np.array_split(test, len(test) // 20_000 + 1):
        if len(part):
            cells = np.arange(int(size[order[part]].max()))
            a, b = (begin[order[x]][:, None] + cells for x in (part, head[part]))
            inside, last = cells < size[order[part]][:, None], len(content) - 1
            same[part] &= ((content[np.minimum(a, last)] == content[np.minimum(b, last)]) | ~inside).all(1)
    out = np.zeros(len(key), bool)
    out[order] = same & (ids[order] > ids[order[head]])
    return out


def _sent(parts: list[tuple], buckets: int, length: int) -> pa.RecordBatch:
    """Stretches by bucket. Of equal ones only those of the least id are sent; larger ids are already decided."""
    key, docs, ids, ths, local, offset, count, content = (np.concatenate(c) for c in zip(*parts, strict=True))
    size = count.astype(np.int64) + length - 1
    begin = np.cumsum(size) - size
    decided = _decided(key, docs, offset, count, content, begin, size)
    names, values = [], []
    send = np.flatnonzero(~decided)
    bucket = (key[send] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    send, bucket = send[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        s = send[a:b]
        names.append(int(bucket[a]))
        values.append(_store(*(c[s] for c in (key, docs, ids, ths, local, offset, count)), gather(content, begin[s], size[s])))
    done = np.flatnonzero(decided)
    if len(done):
        names.append(int(repeats.own_bucket(ids[done[:1]], buckets)[0]))
        values.append(_store(ids[done], ths[done], np.stack([local[done], count[done]], 1).astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.binary())], names=["bucket", "items"])


def _later(key, docs, ids, ths, local, offset, count, content, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and (start, number) of the runs of strings that a document of a smaller id holds too, among the stretches of a bucket."""
    size = count.astype(np.int64) + length - 1
    begin = np.cumsum(size) - size
    # Stretches of one key are looked at together, so a bucket can be taken in parts by key.
    part = mixed(key) % np.uint64(max(1, math.ceil(len(content) / SORTED_BYTES)))
    found = [(ids[:0], ths[:0], np.zeros((0, 2), np.int32))]
    for k in np.unique(part):
        s = np.flatnonzero(part == k)
        text = gather(content, begin[s], size[s])
        here = np.cumsum(size[s]) - size[s]
        decided = _decided(key[s], docs[s], offset[s], count[s], text, here, size[s])
        found.append((ids[s][decided], ths[s][decided], np.stack([local[s][decided], count[s][decided]], 1).astype(np.int32)))
        # Among different stretches only those that share their key with another can hold equal strings.
        s, here = s[~decided], here[~decided]
        _, which, times = np.unique(key[s], return_inverse=True, return_counts=True)
        s, here = s[times[which] > 1], here[times[which] > 1]
        flags, bounds = _later_flags(key[s], docs[s], offset[s], count[s], gather(text, here, size[s]), length)
        first, last, of = runs(flags, bounds)
        found.append((ids[s][of], ths[s][of], np.stack([local[s][of] + first - bounds[of], last - first], 1).astype(np.int32)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _later_flags(key, ids, offset, count, content, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a smaller id holds each string of the stretches too, and where each stretch's strings begin, with the end."""
    n = count.astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(n)])
    nth = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
    of = np.repeat(np.arange(len(n)), n)
    name = key[of] + mixed((offset.astype(np.int64)[of] - nth).astype(np.uint64))  # minimizer, surroundings and offset
    order = np.argsort(name, kind="stable")
    same = _equal_runs([name], order)
    grouped = same.copy()
    grouped[:-1] |= same[1:]
    order, same = order[grouped], same[grouped]  # strings that are alone are not sorted
    flags = np.zeros(bounds[-1], bool)
    if len(order):
        first = np.concatenate([np.flatnonzero(~same), [len(order)]]).astype(np.int64)
        place = np.arange(bounds[-1])[order] + of[order] * (length - 1)
        rank, equal = suffix_order(content, place, first, length)
        item = order[rank]
        least = np.minimum.reduceat(ids[of[item]], np.flatnonzero(~equal))
        flags[item] = ids[of[item]] > np.repeat(least, np.diff(np.flatnonzero(~equal), append=len(item)))
    return flags, bounds


def earlier_strings(docs: DataFrame, moved: DataFrame, text: str, length: int = LENGTH, most: int = HOT_BYTES) -> DataFrame:
    """For each text (`_id`, `_th`) with such strings: `_at`, (start, number) of runs of them, or WHOLE for an earlier text's copy.

    `_order` says which texts are earlier.
    """
    buckets = repeats.buckets_for(docs, text)
    # A key is hot from four stretches of the sample on, so the sample is never so thin that four stand for more than `most` bytes.
    rate = max(1, min(buckets, most // (4 * (length + STEP - 1))))
    hot = hot_keys(docs, text, length, rate, most)
    digest = docs.select("_id", "_th", "_order", F.sha2(F.coalesce(repeats.plain(text), F.lit("")), 256).alias("_digest"))
    first = digest.groupBy("_digest").agg(F.min("_order").alias("_first"), F.max("_order").alias("_last")).filter("_last > _first")
    copies = digest.join(first, "_digest").filter("_order > _first").select("_id", "_th").distinct()
    # As an outer join, because an anti join would be planned below the shuffle, which could then not be shared.
    marked = moved.join(copies.withColumn("_copy", F.lit(True)), ["_id", "_th"], "left")
    single = marked.filter("_copy IS NULL").drop("_copy")

    def anchors(batches):
        for part in chunks(batches, text):
            data, bounds = raw(part.column(text))
            yield *_anchors(data, bounds, length), *_keys(part), len(data)

    def sketch(batches):
        yield from repeats.sent(anchors(batches), buckets)

    shared = repeats.per_text(repeats.repeated(single.mapInArrow(sketch, repeats.ITEMS), buckets))
    held = moved.join(shared, ["_id", "_th"])

    def stretch(batches):
        held, total = [], 0
        for part in chunks(batches, text):
            data, bounds = raw(part.column(text))
            key, row, start, offset, count = _stretches(data, bounds, repeats.numbers(part.column("_at")), length, hot)
            docs_, ids, ths = (k[row] for k in (part.column("_order").to_numpy(), *_keys(part)))
            narrow = ((start - bounds[row]).astype(np.int32), offset.astype(np.uint8), count.astype(np.uint8))
            held.append((key, docs_, ids, ths, *narrow, gather(data, start, count + length - 1)))
            total += len(data)
            if total >= repeats.SENT_BYTES:
                yield _sent(held, buckets, length)
                held, total = [], 0
        if held:
            yield _sent(held, buckets, length)

    def sort(key, group):
        parts = [_load(v.as_py()) for c in group.column("items").chunks for v in c]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return repeats.by_row(*(columns if key[0].as_py() >= buckets else _later(*columns, length)))

    starts = held.mapInArrow(stretch, repeats.ITEMS).groupBy("bucket").applyInArrow(sort, repeats.PLACES)
    whole = copies.select("_id", "_th", F.lit(bytearray(WHOLE.tobytes())).alias("at"))
    return repeats.per_text(starts.union(whole))


def _keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("_id").to_numpy(), part.column("_th").to_numpy()


def remove_earlier(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, most: int = HOT_BYTES
) -> DataFrame:
    """The rows with `_n_bytes`, `_n_removed`, `_spans` (removed runs, in bytes) and `_kept`, the remaining bytes.

    Null and empty texts have no bytes. A text shorter than `length` loses nothing. Rows that share a doc_id take nothing from
    each other; a null doc_id counts as the largest long. A key of stretches of over `most` bytes is split by string. Columns named like the four added ones are replaced.
    """
    added = [
        T.StructField("_n_bytes", T.LongType()),
        T.StructField("_n_removed", T.LongType()),
        T.StructField("_spans", SPANS),
        T.StructField("_kept", T.BinaryType()),
    ]
    rows = repeats.enclosed(docs, doc_id, text)
    keyed = repeats.keyed(rows, "_doc", "_text").withColumn("_order", F.coalesce(F.col("_doc").cast("long"), F.lit(2**63 - 1)))
    moved = keyed.repartition("_id", "_th")
    joined = moved.join(earlier_strings(keyed, moved, "_text", length, most), ["_id", "_th"], "left")
    kept, schema = rows.columns, T.StructType(rows.schema.fields + added)

    def cut(batches):
        for part in chunks(batches, "_text"):
            data, bounds = raw(part.column("_text"))
            lists = part.column("_at").to_pylist()
            found = np.frombuffer(b"".join(b for row_ in lists for b in row_ or ()), np.int32).reshape(-1, 2).astype(np.int64)
            of = np.repeat(np.arange(len(lists)), [sum(map(len, row_ or ())) // 8 for row_ in lists])
            whole = np.zeros(len(lists), bool)
            whole[of[found[:, 0] == WHOLE[0]]] = True
            whole &= np.diff(bounds) >= length
            of, found = of[found[:, 1] > 0], found[found[:, 1] > 0]
            begin = bounds[of] + found[:, 0]
            covered = spread(begin, begin + found[:, 1] + length - 1, len(data)) | np.repeat(whole, np.diff(bounds))
            s, e, row = runs(covered, bounds)
            cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
            ends = [pa.array(x - bounds[row], pa.int32()) for x in (s, e)]
            spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(ends, ["start", "end"]))
            lost = np.concatenate([[0], np.cumsum(covered)])[bounds]
            left = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                part.num_rows,
                [None, pa.py_buffer((bounds - lost).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~covered]))],
            )
            counts = [pa.array(np.diff(x), pa.int64()) for x in (bounds, lost)]
            columns = [*(part.column(c) for c in kept), *counts, spans, left.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return repeats.opened(joined.mapInArrow(cut, schema), docs, doc_id, text, [f.name for f in added])
