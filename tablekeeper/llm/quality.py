"""Quality scores from random-indexing word vectors and a small network with calibrated probabilities.

Each token has a sparse random index vector, a function of its hash. A token's word vector is the sum of the index vectors of its
neighbours over the whole corpus; tokens share `TOKENS` hash slots, so that the table of vectors has a fixed size. A text is
the mean and the deviation of its tokens' vectors, and nothing else. A network of two layers,
trained on the driver on a bounded sample of labelled rows, turns that into a probability, which a temperature fitted on
rows kept out of the training makes calibrated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.llm.hashing import mixed, prefix, windows
from tablekeeper.llm.storage import stored
from tablekeeper.llm.words import chunks, raw

#: Hash slots of tokens, length of a vector, entries of an index vector that are not 0, neighbours on each side.
TOKENS, DIMENSIONS, NONZERO, REACH = 1 << 14, 64, 4, 2
FEATURES = 2 * DIMENSIONS
#: Labelled rows the network is trained on at most: those with the least hashes of their ids.
MOST_TRAINED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
POSITIVE = 0.7
#: Token slots that travel together while word vectors are summed, and tasks whose sums are added up first.
SLOTS, TASKS_TOGETHER = 64, 1_024

_BASE = 0x9E3779B97F4A7C15
#: Character classes by byte: white space, line end, letter (and all beyond ASCII), digit, and each symbol its own.
_CLASS = np.arange(256) + 8
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
_CLASS[0x0A] = 1
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 2
_CLASS[0x30:0x3A] = 3
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_FOLD[0x30:0x3A] = 0x30


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the tokens of all texts, and each text's first token, with the end.

    Tokens are runs of letters (case folded), of digits (alike), of one symbol and of line ends.
    """
    data, bounds = raw(texts)
    kinds = _CLASS[data]
    new = np.ones(len(data), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    solid = kinds[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    hashes = windows(prefix(_FOLD[data] + np.uint64(1), _BASE), starts, ends, _BASE)
    return (hashes % np.uint64(TOKENS)).astype(np.int64), np.searchsorted(starts, bounds)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each slot the places and signs of the entries of its index vector that are not 0."""
    grid = np.arange(TOKENS * NONZERO, dtype=np.uint64).reshape(TOKENS, NONZERO)
    drawn = mixed(grid + np.uint64(_BASE))
    places = (drawn % np.uint64(DIMENSIONS // NONZERO)).astype(np.int64) + np.arange(NONZERO) * (DIMENSIONS // NONZERO)
    return places, np.where(drawn >> np.uint64(63), 1.0, -1.0)


def _add_contexts(total: np.ndarray, counts: np.ndarray, slots: np.ndarray, bounds: np.ndarray) -> None:
    places, signs = index_vectors()
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    counts += np.bincount(slots, minlength=TOKENS)
    for shift in range(1, REACH + 1):
        near = row[shift:] == row[:-shift]
        a, b = slots[:-shift][near], slots[shift:][near]
        for word, other in ((a, b), (b, a)):
            for k in range(NONZERO):
                flat = word * DIMENSIONS + places[other, k]
                total += np.bincount(flat, signs[other, k], TOKENS * DIMENSIONS)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The vectors of all slots, TOKENS rows of DIMENSIONS, from all texts; a common slot weighs less.

    Tasks sum their own texts; groups of SLOTS slots are then summed, first over TASKS_TOGETHER tasks each and then over all, so that
    no group holds more than some 30 MB, with up to a million tasks. The result has a fixed size (4 MB).
    """

    def partial(batches):
        total, counts = np.zeros(TOKENS * DIMENSIONS), np.zeros(TOKENS)
        for part in chunks(batches, text, 2_000_000):
            _add_contexts(total, counts, *tokens(part.column(text)))
        table = np.concatenate([counts[:, None], total.reshape(TOKENS, DIMENSIONS)], 1).reshape(TOKENS // SLOTS, -1)
        keys = np.flatnonzero(np.abs(table).sum(1))
        values = [table[k].tobytes() for k in keys]
        part = np.full(len(keys), TaskContext.get().partitionId() // TASKS_TOGETHER)
        columns = [pa.array(keys, pa.int64()), pa.array(part, pa.int64()), pa.array(values, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["slots", "part", "sums"])

    def summed(key, group):
        total = sum(np.frombuffer(v.as_py()) for c in group.column("sums").chunks for v in c)
        columns = [pa.array([key[0].as_py()]), pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())]
        return pa.table(columns, names=["slots", "part", "sums"])

    kind = "slots long, part long, sums binary"
    first = docs.select(F.col(text).alias(text)).mapInArrow(partial, kind).groupBy("slots", "part").applyInArrow(summed, kind)
    sums = first.groupBy("slots").applyInArrow(summed, kind)
    table = np.zeros((TOKENS // SLOTS, SLOTS * (DIMENSIONS + 1)))
    for row in sums.collect():
        table[row["slots"]] = np.frombuffer(row["sums"])
    table = table.reshape(TOKENS, DIMENSIONS + 1)
    counts, vectors = table[:, 0], table[:, 1:]
    share = counts / max(1.0, counts.sum())
    vectors = vectors / np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-12)
    vectors -= (share[:, None] * vectors).sum(0)
    return (vectors * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """FEATURES numbers for each text; an empty text has zeros."""
    slots, bounds = tokens(texts)
    n = np.diff(bounds)
    out = np.zeros((len(n), FEATURES), np.float32)
    filled = np.flatnonzero(n)
    if not len(filled):
        return out
    rows = np.repeat(np.arange(len(n)), n)
    pairs, times = np.unique(rows * TOKENS + slots, return_counts=True)
    of, slot = pairs // TOKENS, pairs % TOKENS
    first = np.searchsorted(of, filled)
    mean, square = (np.zeros((len(filled), DIMENSIONS)) for _ in range(2))
    step = 4096
    for at in range(0, len(filled), step):  # a bounded number of vectors at a time
        a = first[at]
        b = first[at + step] if at + step < len(first) else len(of)
        held = vectors[slot[a:b]].astype(np.float64)
        cuts, weight = first[at : at + step] - a, times[a:b, None]
        mean[at : at + step] = np.add.reduceat(held * weight, cuts)
        square[at : at + step] = np.add.reduceat(held**2 * weight, cuts)
    count = n[filled][:, None]
    mean /= count
    out[filled, :DIMENSIONS] = mean
    out[filled, DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(square / count - mean**2, 0))
    return out


def features(docs: DataFrame, vectors: np.ndarray, text: str = "text", name: str = "_features") -> DataFrame:
    """The rows without their text and with `name`, FEATURES float32 as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    kept = [c for c in docs.columns if c not in (text, name)]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(b"").alias(name)).schema

    def run(batches):
        for part in chunks(batches, text):
            values = [row.tobytes() for row in pooled(part.column(text), shared.value)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(values, pa.binary())], names=[*kept, name])

    return docs.mapInArrow(run, schema)


class Network:
    """Standardised inputs, one hidden layer, one output; log odds divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        order = rng.permutation(len(x))
        apart = max(1, len(x) // 5)
        x = self._standard(x)
        held, used = order[:apart], order[apart:] if len(x) > apart else order
        shapes = ((x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, 1), (1,))
        self.weights = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s) for s in shapes]
        self.temperature = 1.0
        first, second = ([np.zeros(s) for s in shapes] for _ in range(2))
        best, step = (np.inf, self.weights), 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(used), max(1, len(used) // BATCH)):
                step += 1
                grown = self._gradient(x[part], y[part])
                for k, g in enumerate(grown):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - RATE * move
            loss = _loss(self._odds(x[held])[0], y[held])
            if loss < best[0]:
                best = (loss, [w.copy() for w in self.weights])
        self.weights = best[1]
        odds = self._odds(x[held])[0]
        self.temperature = min(np.geomspace(0.25, 8, 61).tolist(), key=lambda t: _loss(odds / t, y[held]))

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _odds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b, v, c = self.weights
        hidden = np.maximum(x @ w + b, 0)
        return (hidden @ v + c)[:, 0], hidden

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w, _, v, _ = self.weights
        odds, hidden = self._odds(x)
        out = (_probability(odds) - y)[:, None] / len(x)
        back = (out @ v.T) * (hidden > 0)
        return [x.T @ back + DECAY * w, back.sum(0), hidden.T @ out + DECAY * v, out.sum(0)]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _probability(self._odds(self._standard(x.astype(np.float64)))[0] / self.temperature)


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _loss(odds: np.ndarray, y: np.ndarray) -> float:
    return float((np.logaddexp(0, odds) - y * odds).mean())


def held_out(doc_id: Column) -> Column:
    """Rows never trained on: crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(described: DataFrame, labels: DataFrame, doc_id: str, label: str, name: str = "_features") -> Network | None:
    """A network from at most MOST_TRAINED labelled rows that are not held out; none without any.

    Of a doc_id with several labels each counts; rows with a null label are ignored.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")).dropna()
    known = known.filter(~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id").limit(MOST_TRAINED)
    rows = described.select(F.col(doc_id).alias("_id"), F.col(name).alias("_x")).join(known, "_id")
    rows = rows.orderBy(F.xxhash64("_id"), "_id").limit(MOST_TRAINED).select("_x", "_y").collect()
    if not rows:
        return None
    x = np.stack([np.frombuffer(r["_x"], np.float32) for r in rows]).astype(np.float64)
    return Network(x, np.array([r["_y"] > 0 for r in rows], float))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` for every row; null text is scored like empty text.

    Only the text is read to score a row. Without any labelled row every score is 0.5.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    described = stored(features(known, word_vectors(known)), "quality")
    network = train(described, labels, "doc_id", label)

    def run(batches):
        for batch in batches:
            found = batch.column("_features").to_pylist()
            x = np.frombuffer(b"".join(found), np.float32).reshape(len(found), FEATURES)
            score = network.score(x) if network else np.full(len(found), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    kind = described.select("doc_id", F.lit(0.0).alias("score")).schema
    out = described.mapInArrow(run, kind)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= POSITIVE).cast("int").alias("predicted"))
