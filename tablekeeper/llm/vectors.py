"""Near-duplicates among vectors of one label by int8 tile products with error bounds.

Equal vectors are one class. Each label's classes are dealt to blocks, and every pair of blocks meets in one task, which goes
through it in tiles. A vector u of norm 1 is stored as s * q + e, q in int8. For two of them
    |u.v - s_u s_v q_u.q_v| <= |e_u| + (1 + |e_u|) |e_v|,
so a tile's product of small whole numbers bounds all its cosines, and only pairs that may reach the threshold are computed again
in double precision. A task gives back sums of links and a spanning forest, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeeper.llm.components import components, forest
from tablekeeper.llm.storage import stored

THRESHOLD = 0.93
#: Vectors of a block (what a task holds twice), and of a tile's side.
BLOCK = 8192
TILE = 1024
#: More than the rounding of the sums here can reach.
SLACK = 1e-9
#: Below this many components a product of int8 values is exact in float32.
EXACT_IN_FLOAT = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale and error norm of each row of norm 1."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1))
    return codes.astype(np.int8), scale, error


def linked(left: tuple, right: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two tiles with cosine >= threshold; a tile is (vectors, norms, codes, scales, errors)."""
    x, nx, qx, sx, ex = left
    y, ny, qy, sy, ey = right
    kind = np.float32 if x.shape[1] < EXACT_IN_FLOAT else np.float64
    near = (qx.astype(kind) @ qy.astype(kind).T) * sx[:, None] * sy[None, :]
    near += ex[:, None] + (1 + ex[:, None]) * ey[None, :]
    i, j = np.nonzero(near >= threshold - SLACK)
    keep = [
        np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
        for a, b in zip(np.array_split(i, len(i) // 50_000 + 1), np.array_split(j, len(i) // 50_000 + 1), strict=True)
    ]
    keep = np.concatenate(keep)
    return i[keep], j[keep]


def _block(group: pa.Table) -> tuple:
    """Class numbers, counts and the tile columns of a block's vectors."""
    values = group.column("vec").combine_chunks().cast(pa.large_list(pa.float64()))
    x = values.flatten().to_numpy().reshape(group.num_rows, -1)
    x = x / np.abs(x).max(1)[:, None]  # no square of it can overflow or vanish
    norm = np.sqrt((x * x).sum(1))
    return group.column("class").to_numpy(), group.column("copies").to_numpy(), (x, norm, *quantised(x / norm[:, None]))


def _links(a: tuple, b: tuple | None, threshold: float) -> pa.Table:
    """`node`, `links` and `root` of each class of the block (or both blocks) that has a link inside (between) them."""
    same = b is None
    b = a if same else b
    total = [np.zeros(len(a[0]), np.int64), np.zeros(len(b[0]), np.int64)]
    nodes, roots = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for u in range(0, len(a[0]), TILE):
        for v in range(u if same else 0, len(b[0]), TILE):
            left, right = tuple(c[u : u + TILE] for c in a[2]), tuple(c[v : v + TILE] for c in b[2])
            i, j = linked(left, right, threshold)
            if same and u == v:
                i, j = i[i < j], j[i < j]
            i, j = i + u, j + v
            np.add.at(total[0], i, b[1][j])
            np.add.at(total[1], j, a[1][i])
            nodes, roots = forest(np.concatenate([nodes, a[0][i]]), np.concatenate([roots, b[0][j]]))
    if same:
        ids, counts = a[0], total[0] + total[1]
    else:
        ids, counts = np.concatenate([a[0], b[0]]), np.concatenate(total)
    found = counts > 0
    root = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
    ids, counts = ids[found], counts[found]
    return pa.table(
        [pa.array(ids), pa.array(counts), pa.array([root.get(n, n) for n in ids.tolist()], pa.int64())],
        names=["node", "links", "root"],
    )


def near_vectors(
    table: DataFrame, vec_id: str = "vec_id", vec: str = "vec", label: str = "label", threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """For each row `vec_id`, `n_links`, `component_id` and `kept`, by cosine >= threshold between rows of equal label.

    Rows whose label or vector is null, or whose vector is zero, empty or holds a null or a value that is not finite, link
    with nothing; so do vectors of different lengths with each other. Links to equal vectors count row by row. A null id
    never names a component that has another id; a row without links is its own component.
    """
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("_ok", usable)
    good = rows.filter("_ok")
    grouped = good.groupBy("label", "vec").agg(F.min("vec_id").alias("_least"), F.count("*").alias("copies"))
    classes = stored(grouped.withColumn("class", F.monotonically_increasing_id()), "vectors")
    sizes = classes.groupBy("label", F.size("vec").alias("_dim")).agg(F.ceil(F.count("*") / block).alias("_blocks"))
    dealt = classes.withColumn("_dim", F.size("vec")).join(sizes, ["label", "_dim"])
    mine = F.pmod(F.xxhash64("class"), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    met = dealt.withColumn("_mine", mine).withColumn("_other", other)
    met = met.withColumns({"_a": F.least("_mine", "_other"), "_b": F.greatest("_mine", "_other")})

    def run(key, group):
        a, b = key[2].as_py(), key[3].as_py()
        if a == b:
            return _links(_block(group), None, threshold)
        side = group.column("_mine").to_numpy() == a
        parts = [group.filter(pa.array(s)) for s in (side, ~side)]
        if not all(p.num_rows for p in parts):
            return pa.table([pa.array([], pa.int64())] * 3, names=["node", "links", "root"])
        return _links(*map(_block, parts), threshold)

    wanted = met.select("label", "_dim", "_a", "_b", "_mine", "class", "copies", "vec")
    found = stored(wanted.groupBy("label", "_dim", "_a", "_b").applyInArrow(run, "node long, links long, root long"), "links")
    links = found.groupBy(F.col("node").alias("class")).agg(F.sum("links").alias("_links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    known = classes.join(links, "class", "left").join(roots, "class", "left").withColumn("_root", F.coalesce("root", "class"))
    named = known.groupBy("_root").agg(F.min("_least").alias("_component"))
    known = known.join(named, "_root").select(
        "label", "vec", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "_component"
    )
    result = good.join(known, ["label", "vec"]).select("vec_id", "n_links", F.col("_component").alias("component_id"))
    rest = rows.filter("NOT _ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
