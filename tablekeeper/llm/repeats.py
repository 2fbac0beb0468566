"""Which hashed places of a corpus share their hash with another place.

A place is (row, position). Tasks pack their places by bucket of the hash, without row overhead, and one group per bucket
finds the hashes that occur twice. Within a task a hash is sent once: the other places that bear it are known to repeat and
only pass through, so a hash that half of all texts contain costs its bucket one entry per task piece. The number of buckets
grows with the data, so that a bucket stays at a few MB.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.llm.words import give_back

#: Bytes of text for each bucket. A text has places in few buckets if there are few, so a bucket is as large as a task can hold.
BUCKET_BYTES = 32 << 20
#: Bytes of text whose places a task sends together.
SENT_BYTES = 8 << 20
ITEMS = "bucket long, items binary"
PLACES = "_id long, _th int, at binary"


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows with `_id` and `_th`, 96 bits of two unlike hashes of id and whole text, which name a row.

    Rows of equal id and text share a name, and with it their results. Ids may be null or repeat: in 10^11 rows that differ two
    share a name with a chance of one in ten million.
    """
    whole = [plain(doc_id), F.coalesce(plain(text), F.lit(""))]
    return docs.withColumns({"_id": F.xxhash64(*whole), "_th": F.hash(*whole)})


def enclosed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows as `_doc`, `_text` and `_rest`, a struct of all other columns, so that no name of theirs can clash."""
    rest = [plain(c) for c in docs.columns if c not in (doc_id, text)]
    parts = {"_doc": plain(doc_id), "_text": plain(text)} | ({"_rest": F.struct(*rest)} if rest else {})
    return docs.select(*[c.alias(k) for k, c in parts.items()])


def opened(rows: DataFrame, docs: DataFrame, doc_id: str, text: str, added: list[str]) -> DataFrame:
    """The columns of `docs` again, in their order, and the added ones, which replace any of the same name."""
    own = {doc_id: F.col("_doc"), text: F.col("_text")}
    kept = [own.get(c, F.col(f"_rest.`{c}`")).alias(c) for c in docs.columns if c not in added]
    return rows.select(*kept, *added)


def buckets_for(docs: DataFrame, text: str, each: int = BUCKET_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length(plain(text)))).first()[0] or 0
    return max(16, math.ceil(size / each))


def pack(hashes: list[np.ndarray], row: np.ndarray, at: np.ndarray, more: np.ndarray, ids: np.ndarray, ths: np.ndarray) -> bytes:
    """Places in the order of their rows as one value: hashes as they are (a single one in six bytes), the rest small."""
    used, counts = np.unique(row, return_counts=True)
    parts = [ids[used].astype(np.int64), ths[used].astype(np.int32), counts.astype(np.int32), at.astype(np.int32), more.astype(np.uint8)]
    head = np.array([len(row), len(used), len(hashes)], np.int64).tobytes()
    small = zstandard.ZstdCompressor(level=1).compress(head + b"".join(p.tobytes() for p in parts))
    # One hash only names candidates, for which six bytes do; several decide.
    held = hashes if len(hashes) > 1 else [h.view(np.uint8).reshape(-1, 8)[:, 2:] for h in hashes]
    return np.int64(len(small)).tobytes() + small + b"".join(h.tobytes() for h in held)


def unpack(value: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the places; ids, text hashes and numbers of places of the rows; positions and marks of the places."""
    size = int(np.frombuffer(value, np.int64, 1)[0])
    small = zstandard.ZstdDecompressor().decompress(value[8 : 8 + size])
    n, used, k = np.frombuffer(small, np.int64, 3)
    at, out = 24, []
    for dtype, count in ((np.int64, used), (np.int32, used), (np.int32, used), (np.int32, n), (np.uint8, n)):
        out.append(np.frombuffer(small, dtype, count, at))
        at += out[-1].nbytes
    if k == 1:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, 2:] = np.frombuffer(value, np.uint8, 6 * n, 8 + size).reshape(-1, 6)
        hashes = [wide.view(np.uint64)[:, 0]]
    else:
        hashes = [np.frombuffer(value, np.uint64, n, 8 + size + 8 * n * i) for i in range(k)]
    return hashes, *out


def packed(hashes: list[np.ndarray], row: np.ndarray, at: np.ndarray, ids: np.ndarray, ths: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A piece's places as rows of ITEMS; buckets from `buckets` on hold places already known to repeat.

    Those are dealt out by their text, so that a hash of which there are many is not one group.
    """
    order = np.lexsort(hashes[::-1])
    same = np.ones(max(0, len(order) - 1), bool)
    for h in hashes:
        same &= h[order[1:]] == h[order[:-1]]
    again, twice = np.zeros(len(row), np.uint8), np.zeros(len(row), np.uint8)
    again[order[1:]] = same  # not the first of its hash
    twice[order[:-1]] = same
    known = np.flatnonzero(again)
    row = row.copy()
    row[known] = first_alike(ids, ths)[row[known]]
    bucket = (hashes[0] % np.uint64(buckets)).astype(np.int64)
    bucket[known] = own_bucket(ids, buckets)[row[known]]
    _, once = np.unique(row[known].astype(np.int64) << 32 | at[known], return_index=True)
    use = np.concatenate([np.flatnonzero(again == 0), known[once]])
    use = use[np.argsort(row[use], kind="stable")]
    order = use[np.argsort(bucket[use], kind="stable")]  # rows stay in order
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    names, values = [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        o = order[a:b]
        name = int(bucket[o[0]])
        names.append(name)
        values.append(pack([h[o] for h in hashes] if name < buckets else [], row[o], at[o], twice[o], ids, ths))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.binary())], names=["bucket", "items"])


def own_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each text's places that are known to repeat; another one for a copy that is sent with other texts."""
    return buckets + ((ids + ids[:1]).view(np.uint64) % np.uint64(buckets)).astype(np.int64)


def first_alike(ids: np.ndarray, ths: np.ndarray) -> np.ndarray:
    """For each row of a piece the first of the same name."""
    order = np.lexsort((ths, ids))
    same = np.zeros(len(ids), bool)
    same[1:] = (ids[order[1:]] == ids[order[:-1]]) & (ths[order[1:]] == ths[order[:-1]])
    out = np.empty(len(ids), np.int64)
    out[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))] if len(ids) else order
    return out


def sent(found: Iterable[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Places of pieces of text, given as (hashes, row, position, ids, text hashes, bytes), sent together for many pieces."""
    held, size = [], 0
    for piece in found:
        held.append(piece)
        size += piece[5]
        if size >= SENT_BYTES:
            yield _together(held, buckets)
            held, size = [], 0
    if held:
        yield _together(held, buckets)


def _together(held: list[tuple], buckets: int) -> pa.RecordBatch:
    hashes = [np.concatenate(h) for h in zip(*(piece[0] for piece in held), strict=True)]
    first = np.cumsum([0, *(len(piece[3]) for piece in held)])
    row = np.concatenate([piece[1] + n for piece, n in zip(held, first, strict=False)])
    at, ids, ths = (np.concatenate([piece[k] for piece in held]) for k in (2, 3, 4))
    return packed(hashes, row, at, ids, ths, buckets)


def by_row(ids: np.ndarray, ths: np.ndarray, at: np.ndarray) -> pa.Table:
    """Places as rows of PLACES, each once; a place is a number, or a pair of them."""
    columns = [ths, ids] if at.ndim == 1 else [at[:, 1], ths, ids]
    order = np.lexsort((at if at.ndim == 1 else at[:, 0], *columns))
    ids, ths, at = ids[order], ths[order], at[order].astype(np.int32)
    if len(ids):
        differs = at[1:] != at[:-1]
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (ths[1:] != ths[:-1]) | (differs if at.ndim == 1 else differs.any(1))])
        ids, ths, at = ids[new], ths[new], at[new]
    cuts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (ths[1:] != ths[:-1])])) if len(ids) else []
    ends = [*cuts[1:], len(ids)]
    return pa.table(
        [
            pa.array(ids[cuts] if len(ids) else [], pa.int64()),
            pa.array(ths[cuts] if len(ids) else [], pa.int32()),
            pa.array([at[a:b].tobytes() for a, b in zip(cuts, ends, strict=False)], pa.binary()),
        ],
        names=["_id", "_th", "at"],
    )


def repeated(items: DataFrame, buckets: int) -> DataFrame:
    """Rows of PLACES: the places whose hash occurs at another place too, in several rows per text."""

    def run(key, group):
        give_back()
        # A place is held as the number of its row; the names of the rows are held once.
        hashes, *rest = zip(*(unpack(v.as_py()) for c in group.column("items").chunks for v in c), strict=True)
        ids, ths, counts, at, twice = (np.concatenate(x) for x in rest)
        rest.clear()
        row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        if key[0].as_py() >= buckets:
            return by_row(ids[row], ths[row], at)
        hashes = [np.concatenate(h) for h in zip(*hashes, strict=True)]
        order = np.lexsort(hashes[::-1])
        same = np.ones(len(order) - 1, bool)
        for h in hashes:
            same &= h[order[1:]] == h[order[:-1]]
        found = twice[order] > 0
        found[1:] |= same
        found[:-1] |= same
        chosen = order[found]
        del hashes, order
        return by_row(ids[row[chosen]], ths[row[chosen]], at[chosen])

    return items.groupBy("bucket").applyInArrow(run, PLACES)


def per_text(places: DataFrame) -> DataFrame:
    """One row per text, its places in the array `_at` of packed int32."""
    return places.groupBy("_id", "_th").agg(F.collect_list("at").alias("_at"))


def numbers(lists: pa.Array) -> list[np.ndarray]:
    """The sorted int32 places of each row of `_at`; none for null."""
    return [
        np.sort(np.concatenate([np.frombuffer(b, np.int32) for b in row])) if row else np.zeros(0, np.int32)
        for row in lists.to_pylist()
    ]


def plain(name: str) -> Column:
    return F.col(f"`{name}`")
