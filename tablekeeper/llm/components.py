"""Connected components of a graph of long ids, distributed.

Tasks first reduce their own links to a spanning forest, so what is shuffled is bounded by the nodes a task has seen.
Then rounds of large-star and small-star (every node links its larger, then its smaller neighbours to the least
neighbour) run until nothing changes; each round is written to the shared folder. No round sends a node's neighbours
to one task: the least neighbour is an aggregate, and the join with it can be split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeeper.llm.storage import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its component) that connect the same nodes as the links a - b; every node but the least."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = least(len(nodes), ends[: len(a)], ends[len(a) :])
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of 0..n-1 the least number in its component under the links a - b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _local(links: DataFrame) -> DataFrame:
    def run(batches):
        held_a, held_b, size = [], [], 0
        for batch in batches:
            a, b = (np.asarray(batch.column(k)) for k in ("a", "b"))
            held_a.append(a)
            held_b.append(b)
            size += len(a)
            if size > 1 << 20:
                a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
                held_a, held_b, size = [a], [b], len(a) // 2
        if held_a:
            a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(links: DataFrame, reduced: bool = False) -> DataFrame:
    """`node`, `root` for every node that has a link, root being the least node it is connected with.

    `links` has long columns `a` and `b`; links with a null, and of a node to itself, are ignored. `reduced` links are already
    forests from Python tasks, (node, smaller node), which then need no second Python worker beside the first.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    edges = (edges if reduced else _local(edges)).distinct()  # a: node, b: a smaller one
    edges = stored(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _local(large.filter("a <> b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        after = stored(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _state(after)
        edges = after
        if now == state:
            break
        state = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().join(
            edges.select(F.col("a").alias("node")), "node", "left_anti"
        )
    )
