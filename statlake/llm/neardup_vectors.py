"""Near-duplicate vectors by a forest of random-projection trees.

A node of a tree projects its vectors on a random direction and splits them where least is left to compare; vectors
within the spill margin of the split go to both sides, so close vectors are seldom parted, and less often
in all trees at once.  Cuts come from at most ``SAMPLE`` vectors of a node, but every vector is routed.
A round goes ``LEVELS`` levels down in all large nodes of all trees, until nodes hold at most ``LEAF``
vectors or stop shrinking (a cluster closer than the margin).  Vectors are compared inside leaves, in
double precision and in tiles of bounded size, and what is linked is united over the whole cluster.

Equal vectors are first made one with a number of copies.  A pair of vectors may meet in several leaves;
it is counted in the first leaf that both share, so a task gives one row for each vector that it holds and never
the pairs themselves.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
different lengths; their component is their own id.  A null id is a row without a component that links with nothing.
Rows that repeat an id are vectors of their own with that id.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.lineage import cut_lineage
from .common import mixed
from .components import components

COSINE = 0.95
TREES = 5
LEAF = 1024
LEVELS = 4
SAMPLE = 1024
# Spill margin, in standard deviations of what the projections of two vectors at the least cosine differ by.
SPILL = 0.5
TILE = 2048
_SEED = 20240607


def _child(node: int, leaf: int) -> int:
    return int(mixed(np.array([(node & (1 << 64) - 1) ^ (leaf + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1], np.uint64)).view(np.int64)[0])


def _directions(node: int, dim: int) -> np.ndarray:
    """One unit vector for each inner node of a round's subtree, in heap order."""
    made = np.random.default_rng([_SEED, node & (1 << 64) - 1]).standard_normal(((1 << LEVELS) - 1, dim))
    return made / np.linalg.norm(made, axis=1, keepdims=True)


def _units(lists: pa.Array) -> np.ndarray:
    """Unit vectors of a column of lists of one length."""
    values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(lists), -1)
    values = values / np.abs(values).max(1, keepdims=True)  # so that neither huge nor tiny components overflow
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _cut(here: np.ndarray, margin: float) -> float:
    """Where to split projections so that least is left to compare, spilled vectors counted twice; NaN where no
    split saves a tenth, as inside a cluster closer than the margin."""
    if len(here) < 2:
        return float("nan")
    cuts = np.quantile(here, np.linspace(0.1, 0.9, 17))
    ordered = np.sort(here)
    left = np.searchsorted(ordered, cuts + margin, "right") / len(here)
    right = 1 - np.searchsorted(ordered, cuts - margin, "right") / len(here)
    work = left ** 2 + right ** 2
    best = int(np.argmin(work))
    return float(cuts[best]) if work[best] < 0.9 else float("nan")


def fit(node: int, units: np.ndarray, margin: float, levels: int = LEVELS) -> np.ndarray:
    """Cuts of a node's subtree, from a sample of its unit vectors; none below ``levels`` levels."""
    projected = units @ _directions(node, units.shape[1]).T
    cuts, places = np.zeros(projected.shape[1]), np.zeros(len(units), np.int64)
    for inner in range(len(cuts)):
        mine = places == inner
        cuts[inner] = _cut(projected[mine, inner], margin) if inner + 1 < 1 << levels else float("nan")
        places[mine] = 2 * inner + 1 + (projected[mine, inner] > cuts[inner])
    return cuts


def route(node: int, units: np.ndarray, cuts: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the subtree leaves they go to; a row near a cut goes both ways, and all go left where there is none."""
    projected = units @ _directions(node, units.shape[1]).T - cuts
    rows, places = np.arange(len(units)), np.zeros(len(units), np.int64)
    for _ in range(LEVELS):
        off = projected[rows, places]
        left, right = ~(off > margin), off > -margin
        rows, places = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * places[left] + 1, 2 * places[right] + 2])
    return rows, places - ((1 << LEVELS) - 1)


def _margin(dim: int, cosine: float) -> float:
    return SPILL * np.sqrt(2 - 2 * cosine) / np.sqrt(dim)


def _fits(table: pa.Table, cosine: float, leaf: int) -> pa.Table:
    node, size = table.column("node")[0].as_py(), table.column("size")[0].as_py()
    units = _units(table.column("v").combine_chunks())
    levels = min(LEVELS, max(1, int(np.ceil(np.log2(size / leaf)))))
    cuts = fit(node, units, _margin(units.shape[1], cosine), levels)
    return pa.table({"node": pa.array([node], pa.int64()), "cuts": pa.array([cuts.astype("<f8").tobytes()])})


def _drawn(rows: DataFrame, sample: int) -> DataFrame:
    """About twice ``sample`` rows of each node, those with the lowest hashes."""
    # Spark ranks before the shuffle only up to a limit below the sample's size, so whole nodes must not get there.
    return rows.where(F.xxhash64("id", "node").cast("double") <= F.lit(-2.0 ** 63) + F.lit(2.0 ** 65 * sample) / F.col("size"))


def _sampled(rows: DataFrame, sample: int) -> DataFrame:
    among = Window.partitionBy("node").orderBy(F.xxhash64("id", "node"), "id")
    return _drawn(rows, sample).withColumn("place", F.row_number().over(among)).where(F.col("place") <= sample)


def forest(vectors: DataFrame, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, cosine: float = COSINE) -> DataFrame:
    """``id, node, size, v``: the leaves of all trees, a row for each vector and leaf.  Reads ``id, v``."""
    roots = F.array(*[F.xxhash64(F.lit(tree), F.size("v")) for tree in range(trees)])
    rows = vectors.select("id", "v", F.explode(roots).alias("node"), F.lit(1 << 62).alias("was"))
    done = []

    def down(batches):
        for batch in batches:
            nodes = batch.column(2).to_numpy()
            for node in np.unique(nodes):
                mine = batch.take(pa.array(np.flatnonzero(nodes == node)))
                units = _units(mine.column(1))
                cuts = np.frombuffer(mine.column(4)[0].as_py(), "<f8")
                at, places = route(int(node), units, cuts, _margin(units.shape[1], cosine))
                children = np.array([_child(int(node), place) for place in range(1 << LEVELS)], np.int64)
                out = mine.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([out.column(0), out.column(1), pa.array(children[places]), out.column(3)],
                                                 names=["id", "v", "node", "was"])

    while True:
        rows = cut_lineage(rows, "nodes")
        sizes = cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.max("was").alias("was")), "sizes")
        large = sizes.where((F.col("size") > leaf) & (F.col("size") < 0.8 * F.col("was"))).select("node", "size")
        settled = sizes.where((F.col("size") <= leaf) | (F.col("size") >= 0.8 * F.col("was"))).select("node", "size")
        done.append(rows.drop("was").join(settled, "node").select("id", "node", "size", "v"))
        if large.isEmpty():
            leaves = done[0]
            for more in done[1:]:
                leaves = leaves.unionByName(more)
            return leaves
        chosen = _sampled(rows.join(large, "node"), sample).select("node", "size", "v")
        cuts = cut_lineage(chosen.groupBy("node").applyInArrow(lambda table: _fits(table, cosine, leaf), "node long, cuts binary"),
                           "cuts")
        kind = rows.schema["v"].dataType.simpleString()
        rows = (rows.drop("was").join(large, "node").join(cuts, "node")
                .select("id", "v", "node", F.col("size").alias("was"), "cuts")
                .mapInArrow(down, f"id long, v {kind}, node long, was long"))


def first_shared(pairs_a: np.ndarray, pairs_b: np.ndarray, leaves: np.ndarray, node: int) -> np.ndarray:
    """Whether ``node`` is the smallest leaf that both vectors of each pair are in; ``leaves`` is padded on the right."""
    out = np.zeros(len(pairs_a), bool)
    valid = leaves != _NO_LEAF
    for at in range(0, len(pairs_a), 1 << 16):
        a, b = pairs_a[at:at + (1 << 16)], pairs_b[at:at + (1 << 16)]
        earlier = np.zeros(len(a), bool)
        for slot in range(leaves.shape[1]):
            mine = leaves[a, slot]
            use = valid[a, slot] & (mine < node)
            if use.any():
                earlier |= use & (leaves[b] == mine[:, None]).any(1)
        out[at:at + (1 << 16)] = ~earlier
    return out


_NO_LEAF = np.iinfo(np.int64).max


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row each row is linked with, over pairs a < b."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, b, label[a])
        np.minimum.at(least, a, label[b])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def linked_in_tile(table: pa.Table, cosine: float) -> pa.Table:
    """One row per vector with a link: how many other vectors it is linked with here first, and the
    smallest id it hangs together with."""
    table = table.sort_by("id").combine_chunks()
    node, first, second = (table.column(c)[0].as_py() for c in ("node", "first", "second"))
    units, tiles, n = _units(table.column("v").chunk(0)), table.column("tile").to_numpy(), len(table)
    ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
    lists = table.column("leaves").chunk(0)
    lengths = np.diff(lists.offsets.to_numpy())
    leaves = np.full((n, lengths.max()), _NO_LEAF, np.int64)
    leaves[np.arange(leaves.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
    a, b = [], []
    for at in range(0, n, 512):
        close = units[at:at + 512] @ units.T >= cosine
        i, j = np.nonzero(close)
        i += at
        keep = i < j
        if first != second:
            keep &= tiles[i] != tiles[j]
        a.append(i[keep])
        b.append(j[keep])
    a, b = np.concatenate(a), np.concatenate(b)
    new = first_shared(a, b, leaves, node)
    links = np.zeros(n, np.int64)
    np.add.at(links, a[new], copies[b[new]])
    np.add.at(links, b[new], copies[a[new]])
    roots, some = _roots(n, a, b), np.union1d(a, b)
    return pa.table({"id": ids[some], "links": links[some], "root": ids[roots[some]]})


def near_duplicates(df: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, tile: int = TILE,
                    id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row for each row of ``df``."""
    linkable = F.coalesce(
        F.col(id_).isNotNull() & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0)
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    digest = F.sha2(F.concat_ws(",", F.transform(vector, lambda x: x.cast("string"))), 256)
    rows = df.select(F.col(id_).cast("long").alias("row_id"), F.when(linkable, digest).alias("digest"),
                     F.when(linkable, F.col(vector)).alias("v"))
    # An id may repeat with other vectors: a class is told by its smallest id and, within that, by a number.
    classes = cut_lineage(rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("row_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v")), "classes")
    if classes.isEmpty():
        classes_linked = classes.select("digest", F.lit(0).cast("long").alias("n_links"), F.col("least").alias("component_id"))
    else:
        classes_linked = _linked(classes, cosine, trees, leaf, tile)
    alone = rows.where(F.col("digest").isNull()).select("row_id", F.lit(0).cast("long").alias("n_links"),
                                                        F.col("row_id").alias("component_id"))
    found = (rows.where(F.col("digest").isNotNull()).select("row_id", "digest").join(classes_linked, "digest")
             .select("row_id", "n_links", "component_id").unionByName(alone))
    return found.select(F.col("row_id").alias(id_), "n_links", "component_id",
                        F.coalesce(F.col("row_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _linked(classes, cosine, trees, leaf, tile):
    # Digests give classes long ids that do not depend on the run.
    classes = classes.withColumn("id", F.xxhash64("digest"))
    leaves = forest(classes.select("id", "v"), trees, leaf, cosine=cosine)
    member = leaves.groupBy("id").agg(F.sort_array(F.collect_set("node")).alias("leaves"))
    tiles = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("id", "node", F.lit("tile")), F.col("tiles")).cast("int")
    spread = (leaves.join(member, "id").join(classes.select("id", "copies"), "id")
              .withColumn("tiles", tiles).withColumn("tile", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .withColumn("first", F.least("tile", "other")).withColumn("second", F.greatest("tile", "other")))
    linked = cut_lineage(
        spread.select("id", "node", "v", "copies", "leaves", "tile", "first", "second")
        .groupBy("node", "first", "second")
        .applyInArrow(lambda table: linked_in_tile(table, cosine), "id long, links long, root long"), "links")
    joined = components(linked.select(F.col("id").alias("u"), F.col("root").alias("v")))
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    named = (classes.select("id", "digest", "least", "copies").join(counts, "id", "left")
             .join(joined.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "component").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
