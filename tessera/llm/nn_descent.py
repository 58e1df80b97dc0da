"""Embedding near-dedup by NN-descent.

1. Equal vectors become one node (copies counted). Vectors that are null, zero or hold
   null or non-finite components link with nothing and never enter the graph.
2. A first neighbour graph: nodes share a leaf of a random-projection tree if they lie on
   the same side of its hyperplanes; each node takes its best neighbours from its leaf in
   each of a few trees. A leaf of more than ``leaf`` nodes is dealt over several groups.
3. NN-descent: around every node (pivot) its neighbours, and the nearest of those that have
   it as neighbour, meet and compare themselves; a node keeps the ``k`` best it has met.
   Pairs met before are left out, so pivots without new members need no work. Rounds end
   when few lists change. The lists only steer the search: links lost by a bounded list are
   restored in step 5.
4. Links are kept list entries at the threshold or above (cosine in double precision).
   Components follow.
5. A list is saturated when its last entry is still a link: more may lie behind it. All
   nodes of a component with a saturated list get the longest list there can be, every
   node of the component; it is compared in blocks, and only counts leave a block. A link
   that neither list holds lies between two saturated nodes, so components with saturated
   lists are also compared with each other, in blocks, where they share a leaf of a tree and
   their balls (a center, and the largest angle to it) are near enough for a link; what links
   becomes one component. One link in a shared leaf is enough for all links of two components
   to be counted, and a leaf shared by more of them is compared in blocks, none left out.
6. Audit: all links of one node in ``audit_every`` (of more nodes where that would be under
   ``audit``) are found by brute force, in blocks over all nodes, and set against the links
   counted for the result. Two shares must reach ``recall``: that of links, and the mean over
   nodes with links of each one's share, which a large group cannot outweigh. Below it, lists
   are doubled, trees are added and the descent goes on; after ``retries`` the query fails
   and says the figures.

There are as many trees as it takes for a pair at the threshold to share a leaf of one with
probability ``recall``, so more the deeper they are.

Vectors of different lengths are never compared. Defined results: a vector that links with
nothing is alone in its component; a null id never names a component unless all its ids are
null; repeated rows are copies of each other; no rows give no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import complete_groups, connected_components, materialize, prepare_workers


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    k: int = 10
    trees: int = 6
    leaf: int = 256
    rounds: int = 8
    few: float = 0.002  # share of list entries that may still change at the end
    block: int = 2048
    audit: int = 200
    audit_every: int = 20
    recall: float = 0.98
    retries: int = 3
    seed: int = 5


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors in double precision of a column of equally long packed doubles."""
    x = np.stack([np.frombuffer(v.as_buffer()) for v in column])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.ones(t.num_rows, bool)
    change[1:] = False
    for k in keys:
        x = t.column(k).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def best_per_node(u: np.ndarray, v: np.ndarray, sim: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best distinct neighbours of each node."""
    order = np.lexsort((v, -sim, u))
    a, b = u[order], v[order]
    same = np.zeros(len(order), bool)
    same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])  # a pair met twice has the same cosine
    order = order[~same]
    a = u[order]
    first = np.concatenate(([True], a[1:] != a[:-1])) if len(a) else np.zeros(0, bool)
    rank = np.arange(len(a)) - np.maximum.accumulate(np.where(first, np.arange(len(a)), 0))
    return order[rank < k]


def links_batch(u: np.ndarray, v: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], ["u", "v", "sim"])


LINKS = "u long, v long, sim double"


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """Written tables: all rows (row_id, vec_id, vec: packed doubles or null) and nodes (id, dim, vec, copies)."""
    prepare_workers(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = []
            for x in b.column(2):
                v = np.array(x.values.to_numpy(zero_copy_only=False), float) if x.is_valid and not x.values.null_count else np.zeros(0)
                ok = len(v) > 0 and np.isfinite(v).all() and np.isfinite(norm := np.linalg.norm(v)) and norm > 0
                packed.append((v + 0.0).tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["row_id", "vec_id", "vec"])

    rows = vectors.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = materialize(rows.mapInArrow(run, "row_id long, vec_id long, vec binary"), "vectors")
    nodes = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.min("row_id").alias("id"), F.count("*").alias("copies"))
    return rows, materialize(nodes.select("id", F.octet_length("vec").alias("dim"), "vec", "copies"), "nodes")


def depth_of(n: int, s: Settings) -> int:
    return max(1, int(np.ceil(np.log2(max(2, n / s.leaf)))))


def trees_for(n: int, s: Settings) -> int:
    """Trees after which a pair at the threshold has shared a leaf with probability ``recall``; at least ``trees``."""
    together = (1 - np.arccos(s.threshold) / np.pi) ** depth_of(n, s)
    return max(s.trees, int(np.ceil(np.log(1 - s.recall) / np.log(1 - together))))


def leaf_codes(nodes: DataFrame, n: int, trees: range, s: Settings) -> DataFrame:
    """Written table (id, tree, dim, leaf): the leaf of each node in each of the trees."""
    depth = depth_of(n, s)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = matrix(b.column(2).take(pa.array(at)))
                for tree in trees:
                    planes = np.random.default_rng([s.seed, tree, int(d)]).standard_normal((x.shape[1], depth))
                    leaf = ((x @ planes > 0) << np.arange(depth)).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.full(len(at), tree)), pa.array(np.full(len(at), int(d))), pa.array(leaf)],
                                                     ["id", "tree", "dim", "leaf"])

    return materialize(nodes.select("id", F.col("dim").cast("long").alias("dim"), "vec").mapInArrow(code, "id long, tree long, dim long, leaf long"), "leaves")


LEAF = ["tree", "dim", "leaf"]


def leaf_neighbours(nodes: DataFrame, coded: DataFrame, k: int, s: Settings) -> DataFrame:
    """(u, v, sim): the best neighbours of each node in its leaf of each tree of ``coded``."""
    large = materialize(coded.groupBy(*LEAF).agg(F.count("*").alias("n")).where(F.col("n") > s.leaf), "large-leaves")
    parts = F.coalesce(F.ceil(F.col("n") / s.leaf), F.lit(1)).cast("long")
    key = [*LEAF, "part"]
    placed = (coded.join(large, LEAF, "left").withColumn("part", F.pmod(F.xxhash64("id", "tree"), parts)).drop("n", "dim")
              .join(nodes.select("id", "vec", F.col("dim").cast("long").alias("dim")), "id").select(*key, "id", "vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, key, 8192):
            ids, starts = t.column("id").to_numpy(), group_starts(t, key)
            us, vs, sims = [], [], []
            for a, b in zip(starts, starts[1:], strict=False):
                if b - a < 2:
                    continue
                x = matrix(t.column("vec").slice(a, b - a))
                sim = x @ x.T
                np.fill_diagonal(sim, -2)
                kk = min(k, b - a - 1)
                best = np.argpartition(-sim, kk - 1, axis=1)[:, :kk]
                us.append(np.repeat(ids[a:b], kk))
                vs.append(ids[a:b][best].ravel())
                sims.append(np.take_along_axis(sim, best, axis=1).ravel())
            if us:
                yield links_batch(np.concatenate(us), np.concatenate(vs), np.concatenate(sims))

    return placed.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, LINKS)


def keep_best(known: DataFrame | None, met: DataFrame, n: int, k: int) -> DataFrame:
    """The k best neighbours per node: (u, v, sim, new: met just now, low: the worst kept, -2 of a list that isn't full)."""
    both = met.withColumn("new", F.lit(1))
    if known is not None:
        both = both.unionByName(known.select("u", "v", "sim", F.lit(0).alias("new")))
    pairs = both.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))).where(F.col("rank") <= k)
    of_u = Window.partitionBy("u")
    ranked = ranked.withColumn("low", F.when(F.count("*").over(of_u) == k, F.min("sim").over(of_u)).otherwise(F.lit(-2.0)))
    return materialize(ranked.select("u", "v", "sim", "new", "low"), "graph", n * k)


def met_around_pivots(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(u, v, sim) of pairs that meet at a pivot, one of them new there, better than u's worst neighbour."""
    back = (graph.withColumn("rank", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("sim"), "u"))).where(F.col("rank") <= k)
            .select(F.col("v").alias("pivot"), F.col("u").alias("id"), "new"))
    members = graph.select(F.col("u").alias("pivot"), F.col("v").alias("id"), "new").unionByName(back).groupBy("pivot", "id").agg(F.max("new").alias("new"))
    lively = members.withColumn("any", F.max("new").over(Window.partitionBy("pivot"))).where("any = 1").drop("any")
    low = graph.groupBy("u").agg(F.min("low").alias("low"))
    with_low = nodes.join(low, nodes.id == low.u).select("id", "vec", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, ["pivot"], 16384):
            ids, new, low = t.column("id").to_numpy(), t.column("new").to_numpy() == 1, t.column("low").to_numpy()
            starts, x = group_starts(t, ["pivot"]), None
            us, vs, sims = [], [], []
            for a, b in zip(starts, starts[1:], strict=False):
                x = matrix(t.column("vec").slice(a, b - a))
                sim = x @ x.T
                better = (sim > low[a:b, None]) & (new[a:b, None] | new[None, a:b])
                np.fill_diagonal(better, False)
                i, j = np.nonzero(better)
                us.append(ids[a:b][i])
                vs.append(ids[a:b][j])
                sims.append(sim[i, j])
            u, v, sim = np.concatenate(us), np.concatenate(vs), np.concatenate(sims)
            best = best_per_node(u, v, sim, k)
            yield links_batch(u[best], v[best], sim[best])

    return (lively.join(with_low, "id").select("pivot", "id", F.col("new").cast("long").alias("new"), "low", "vec")
            .repartition("pivot").sortWithinPartitions("pivot").mapInArrow(run, LINKS))


def descend(nodes: DataFrame, n: int, graph: DataFrame | None, k: int, coded: DataFrame, s: Settings) -> DataFrame:
    """The neighbour graph after the leaves ``coded`` and rounds of NN-descent."""
    graph = keep_best(graph, leaf_neighbours(nodes, coded, k, s), n, k)
    for _ in range(s.rounds):
        graph = keep_best(graph, met_around_pivots(graph, nodes, k), n, k)
        if graph.where("new = 1").count() <= s.few * n * k:
            break
    return graph


def components_of(graph: DataFrame, nodes: DataFrame, n: int, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Written tables: links (u, v) between different nodes, one row a pair; nodes with their root."""
    links = materialize(graph.where(F.col("sim") >= s.threshold).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links", n)
    roots = connected_components(links)
    rooted = nodes.select("id").join(roots, nodes.id == roots.node, "left").select("id", F.coalesce("root", "id").alias("root"))
    return links, materialize(rooted, "rooted", n)


def audited_recall(nodes: DataFrame, linked: DataFrame, n: int, s: Settings) -> tuple[float, float]:
    """Of the true links of the audited nodes: the share counted in ``linked``, and the mean of each node's share."""
    every = max(1, min(s.audit_every, n // s.audit))
    chosen = F.pmod(F.xxhash64("id"), F.lit(every)) == 0
    block = lambda rows: F.pmod(F.xxhash64("id", F.lit(1)), F.lit(-(-rows // s.block) or 1))
    over = lambda rows: F.explode(F.sequence(F.lit(0).cast("long"), F.lit((-(-rows // s.block) or 1) - 1).cast("long")))
    audited = -(-n // every)
    columns = ["i", "j", "dim", "id", "vec", "copies", "target"]
    of_all = nodes.withColumn("dim", F.col("dim").cast("long"))
    cells = (of_all.where(chosen).withColumn("i", block(audited)).withColumn("j", over(n)).withColumn("target", F.lit(0).cast("long")).select(*columns)
             .unionByName(of_all.withColumn("j", block(n)).withColumn("i", over(audited)).withColumn("target", F.lit(1).cast("long")).select(*columns)))
    key = ["dim", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, key, 1024):
            starts = group_starts(t, key)
            for a, b in zip(starts, starts[1:], strict=False):
                cell = t.slice(a, b - a)
                target = cell.column("target").to_numpy() == 1
                if target.all() or not target.any():
                    continue
                x, ids, copies = matrix(cell.column("vec")), cell.column("id").to_numpy(), cell.column("copies").to_numpy()
                near = (x[~target] @ x[target].T >= s.threshold) & (ids[~target][:, None] != ids[target][None, :])
                yield pa.RecordBatch.from_arrays([pa.array(ids[~target]), pa.array((near * copies[target]).sum(axis=1))], ["id", "near"])

    true = (cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "id long, near long")
            .groupBy("id").agg(F.sum("near").alias("near")).where("near > 0"))
    counted = F.least("linked", "near")  # a cosine just at the threshold may come out either way
    row = true.join(linked, "id").agg(F.sum("near"), F.sum(counted), F.avg(counted / F.col("near"))).first()
    return (row[1] / row[0], row[2]) if row[0] else (1.0, 1.0)


def near_components(nodes: DataFrame, leaves: DataFrame, member: DataFrame, s: Settings) -> DataFrame:
    """Written table (a, b, size_a, size_b): pairs of components that may have links between them, the larger one first.

    ``member``: root, size and id of the nodes of all components in question. Components that
    share a leaf are set against each other; by the triangle inequality of angles no other pair
    that shares one has a link.
    """
    reach = float(np.arccos(s.threshold)) + 1e-6
    center = nodes.select(F.col("id").alias("root"), F.col("dim").cast("long").alias("dim"), F.col("vec").alias("center"))  # a root is one of its nodes

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy()
            for d in np.unique(dims):
                at = pa.array(np.flatnonzero(dims == d))
                cos = np.einsum("ij,ij->i", matrix(b.column(2).take(at)), matrix(b.column(3).take(at)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(np.arccos(np.clip(cos, -1, 1)))], ["root", "angle"])

    measured = (member.join(nodes.select("id", "vec"), "id").join(center, "root").select("root", "dim", "vec", "center")
                .mapInArrow(angles, "root long, angle double").groupBy("root").agg(F.max("angle").alias("radius")))
    balls = materialize(member.select("root", "size").distinct().join(measured, "root").join(center, "root").select("root", "dim", "size", "radius", "center"), "balls")
    present = materialize(leaves.join(member.select("id", "root"), "id").select(*LEAF, "root").distinct(), "present")
    shared = present.groupBy(*LEAF).agg(F.count("*").alias("n")).where("n > 1")
    dealt = (present.join(shared, LEAF).withColumn("blocks", F.ceil(F.col("n") / s.block).cast("long")).withColumn("mine", F.pmod(F.xxhash64("root"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).join(balls.drop("dim"), "root"))
    columns = ["root", "size", "radius", "center"]
    cells = (dealt.select(*LEAF, F.col("mine").alias("i"), F.col("other").alias("j"), *columns, F.lit(0).cast("long").alias("target"))
             .unionByName(dealt.select(*LEAF, F.col("other").alias("i"), F.col("mine").alias("j"), *columns, F.lit(1).cast("long").alias("target"))))
    key = [*LEAF, "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, key, 1024):
            starts = group_starts(t, key)
            for a, b in zip(starts, starts[1:], strict=False):
                cell = t.slice(a, b - a)
                target = cell.column("target").to_numpy() == 1
                if target.all() or not target.any():
                    continue
                x, root, size, radius = matrix(cell.column("center")), cell.column("root").to_numpy(), cell.column("size").to_numpy(), cell.column("radius").to_numpy()
                first = ~target
                apart = np.arccos(np.clip(x[first] @ x[target].T, -1, 1)) - radius[first][:, None] - radius[target][None, :]
                larger = (size[first][:, None] > size[target][None, :]) | (size[first][:, None] == size[target][None, :]) & (root[first][:, None] < root[target][None, :])
                u, v = np.nonzero((apart <= reach) & larger)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (root[first][u], root[target][v], size[first][u], size[target][v])], ["a", "b", "size_a", "size_b"])

    near = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long, size_a long, size_b long")
    return materialize(near.distinct(), "near-components")


def links_between_components(nodes: DataFrame, leaves: DataFrame, rooted: DataFrame, roots: DataFrame, s: Settings) -> DataFrame | None:
    """Written table (u, v, linked): of each node u (v null) the copies linked to it in other components of ``roots`` (root, size);
    and pairs (u, v) of components that have a link (linked null). None if no components are near each other."""
    member = rooted.join(roots, "root").select("root", "size", "id")
    pairs = near_components(nodes, leaves, member, s)
    if pairs.isEmpty():
        return None
    # What is near a component is dealt over blocks together, however small its components are.
    around = pairs.groupBy("a", "size_a").agg(F.sum("size_b").alias("size_b"))
    around = materialize(around.select("a", F.ceil(F.col("size_a") / s.block).cast("long").alias("rows"), F.ceil(F.col("size_b") / s.block).cast("long").alias("columns")), "around")
    vectors = member.select("root", "id").join(nodes.select("id", "vec", "copies"), "id")
    mine = vectors.join(around, vectors.root == around.a).withColumn("i", F.pmod(F.xxhash64("id"), F.col("rows")))
    theirs = (vectors.join(pairs.select("a", F.col("b").alias("root")), "root").join(around, "a").withColumn("j", F.pmod(F.xxhash64("id"), F.col("columns"))))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["a", "i", "j", "root", "id", "vec", "copies", "target"]
    cells = (mine.withColumn("j", every("columns")).withColumn("target", F.lit(0).cast("long")).select(*columns)
             .unionByName(theirs.withColumn("i", every("rows")).withColumn("target", F.lit(1).cast("long")).select(*columns)))
    key = ["a", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u: np.ndarray, v: np.ndarray | None, linked: np.ndarray | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) if x is not None else pa.nulls(len(u), pa.int64()) for x in (u, v, linked)], ["u", "v", "linked"])

        for t in complete_groups(batches, key, 1024):
            starts = group_starts(t, key)
            for a, b in zip(starts, starts[1:], strict=False):
                cell = t.slice(a, b - a)
                target = cell.column("target").to_numpy() == 1
                if target.all() or not target.any():
                    continue
                x, ids, copies, root = matrix(cell.column("vec")), *(cell.column(c).to_numpy() for c in ("id", "copies", "root"))
                near = x[~target] @ x[target].T >= s.threshold
                for linked, at in ((near @ copies[target], ~target), (copies[~target] @ near, target)):
                    yield out(ids[at][linked > 0], None, linked[linked > 0])
                other = np.unique(root[target][near.any(axis=0)])
                yield out(np.full(len(other), cell.column("a")[0].as_py()), other, None)

    return materialize(cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "u long, v long, linked long"), "between-components")


def links_in_components(nodes: DataFrame, rooted: DataFrame, roots: DataFrame, s: Settings) -> DataFrame:
    """(id, linked): copies linked to each node of the components ``roots`` (root, size), compared in blocks.

    A component of less than some blocks is cut into up to eight smaller ones, so that several tasks share its cells.
    """
    blocks = F.greatest(F.ceil(F.col("size") / s.block), F.least(F.lit(8), F.ceil(F.col("size") * 16 / s.block))).cast("long")
    member = (rooted.join(roots, "root").join(nodes, "id").withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    cells = (member.select("root", F.col("mine").alias("i"), F.col("other").alias("j"), "id", "vec", "copies", F.lit(0).cast("long").alias("target"))
             .unionByName(member.select("root", F.col("other").alias("i"), F.col("mine").alias("j"), "id", "vec", "copies", F.lit(1).cast("long").alias("target"))))
    key = ["root", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, key, 1024):
            starts = group_starts(t, key)
            for a, b in zip(starts, starts[1:], strict=False):
                cell = t.slice(a, b - a)
                target = cell.column("target").to_numpy() == 1
                x, ids, copies = matrix(cell.column("vec")), cell.column("id").to_numpy(), cell.column("copies").to_numpy()
                near = (x[~target] @ x[target].T >= s.threshold) & (ids[~target][:, None] != ids[target][None, :])
                yield pa.RecordBatch.from_arrays([pa.array(ids[~target]), pa.array((near * copies[target]).sum(axis=1))], ["id", "linked"])

    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "id long, linked long").groupBy("id").agg(F.sum("linked").alias("linked"))


def counted_links(graph: DataFrame, nodes: DataFrame, leaves: DataFrame, n: int, s: Settings) -> DataFrame:
    """Written table (id, root, linked): the component of each node, and the copies of other nodes that are linked to it."""
    links, rooted = components_of(graph, nodes, n, s)
    saturated = graph.where(F.col("low") >= s.threshold).select(F.col("u").alias("id")).distinct().join(rooted, "id").select("root").distinct()
    saturated = materialize(rooted.join(saturated, "root").groupBy("root").agg(F.count("*").alias("size")), "saturated", n)
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    from_lists = both.join(nodes.select(F.col("id").alias("v"), "copies"), "v").groupBy(F.col("u").alias("id")).agg(F.sum("copies").alias("listed"))
    in_blocks = links_in_components(nodes, rooted, saturated, s)
    between = links_between_components(nodes, leaves, rooted, saturated, s)
    if between is not None:
        in_blocks = in_blocks.unionByName(between.where("v IS NULL").select(F.col("u").alias("id"), "linked")).groupBy("id").agg(F.sum("linked").alias("linked"))
        joined = connected_components(between.where("v IS NOT NULL").select("u", "v").distinct()).select(F.col("node").alias("root"), F.col("root").alias("joined"))
        rooted = rooted.join(joined, "root", "left").select("id", F.coalesce("joined", "root").alias("root"))
    return materialize(rooted.join(from_lists, "id", "left").join(in_blocks, "id", "left")
                       .select("id", "root", F.coalesce("linked", "listed", F.lit(0)).alias("linked")), "linked", n)


def near_duplicates(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    s = settings
    rows, nodes = nodes_of(vectors, id_col, vector_col)
    n = nodes.count()
    k, trees, graph, leaves = s.k, range(trees_for(n, s)), None, None
    for turn in range(s.retries + 1):
        coded = leaf_codes(nodes, n, trees, s)
        leaves = coded if leaves is None else leaves.unionByName(coded)
        graph = descend(nodes, n, graph, k, coded, s)
        linked = counted_links(graph, nodes, leaves, n, s)
        of_links, of_nodes = audited_recall(nodes, linked, n, s)
        if min(of_links, of_nodes) >= s.recall:
            break
        if turn == s.retries:
            raise RuntimeError(f"recall of {of_links:.4f} of links and {of_nodes:.4f} by node after lists of {k}; {s.recall} is asked for")
        k, trees = 2 * k, range(trees.stop, 2 * trees.stop - trees.start)
    first = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.min("row_id").alias("id"), F.min("vec_id").alias("first_id"))
    counted = materialize(nodes.select("id", "copies").join(linked, "id").join(first.select("id", "first_id"), "id")
                          .select("id", "root", "first_id", (F.col("linked") + F.col("copies") - 1).alias("n_links")), "counted", n)
    named = materialize(counted.groupBy("root").agg(F.min("first_id").alias("component_id")), "named", n)
    by_node = counted.join(named, "root").join(nodes.select("id", "vec"), "id").select("vec", "n_links", "component_id")
    # A vector that some rows share is looked up by its bytes; both sides come from files.
    return (rows.join(materialize(by_node, "by-node", n), "vec", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
