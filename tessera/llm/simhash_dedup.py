"""SimHash near-dedup with sharded BK-trees.

1. Fingerprints. ASCII letters are lower-cased, words are runs of characters other
   than space and 0x09-0x0D, and every run of ``shingle`` words (repeats included,
   joined by one space) is hashed with XXH64, seed 42. A bit of the fingerprint is 1
   if more than half of the hashes have it. A text of fewer words is one shingle; one
   without words has fingerprint zero. The table (row, fingerprint) is written.
2. Equal fingerprints are one fingerprint from here on, so copies cost nothing.
3. Shards. Cut into ``distance + 1`` bands, two fingerprints at ``distance`` bits or
   fewer agree in a whole band. A shard is the set of fingerprints with one value in
   one band; each shard becomes a BK-tree (children keyed by the Hamming distance to
   their parent) in the task that it is dealt to. Fingerprints are never gathered in
   the driver or sent to every executor. A shard of more than ``split`` fingerprints is
   cut into blocks of about ``split``; every two blocks meet in a cell, where one is the
   tree and the other queries it, so no task holds more than two blocks, however hot the
   shard. Cells are as many as the square of the blocks: every two fingerprints of a
   shard have to meet.
4. Every fingerprint queries its trees, following only edges within the radius
   (``|edge - distance to the node| <= distance``). All trees of a task are built and
   searched level by level in numpy. A task emits one link per fingerprint, to the
   smallest member of its part of the component, not all pairs.
5. Components of these links; a document's class is the smallest ``doc_id`` in it.

Defined results: a null text counts as empty; rows with equal fingerprints (also all
those without words) are linked; a null ``doc_id`` never names a class unless all of
its ids are null; no rows give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import complete_groups, connected_components, materialize, numbered, prepare_workers

SEED = 42
#: Hashes whose bits are counted at a time; bounds memory for very long texts.
HASHES_AT_ONCE = 1 << 18


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[i:i + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of 255 ones fit a byte
        total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[whole:].sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint of one UTF-8 text as an unsigned 64-bit integer."""
    words = text.lower().split()  # of bytes: both follow ASCII only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    parts = zip(*(words[i:] for i in range(shingle)), strict=False)
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(b" ".join(p), SEED) for p in parts), np.uint64, n)
    ones = 2 * bit_counts(hashes) > n
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 row_col: str | None = None) -> DataFrame:
    """Written table (row_id, doc_id, fp): fp is the fingerprint as a signed long."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                               for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["row_id", "doc_id", "fp"])

    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row_id"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, "row_id long, doc_id long, fp long"), "fingerprints")


def bands_of(distance: int, bits: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of ``distance + 1`` bands that cover all bits."""
    edges = [round(i * bits / (distance + 1)) for i in range(distance + 2)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class BKForest:
    """BK-trees over 64-bit codes, one per tree id, built and searched together.

    A node is the row number of its code; rows that are no nodes only query the tree of
    their id. ``edge_key`` (parent * 65 + distance to the parent) of all nodes but the
    roots is sorted, so the children of a node within a range of distances are one slice.
    Equal codes of a tree hang below each other at distance 0. ``root_of`` is -1 where a
    tree has no nodes.
    """

    def __init__(self, codes: np.ndarray, trees: np.ndarray, is_node: np.ndarray | None = None):
        self.codes = codes
        inside = np.arange(len(codes)) if is_node is None else np.flatnonzero(is_node)
        names, first = np.unique(trees[inside], return_index=True)
        self.root_of = np.full(len(codes), -1)
        if len(names):
            tree = np.minimum(np.searchsorted(names, trees), len(names) - 1)
            self.root_of = np.where(names[tree] == trees, inside[first][tree], -1)
        at = self.root_of.copy()
        waiting = inside[at[inside] != inside]
        keys, nodes = [], []
        while len(waiting):  # everybody descends one level; the first at a free edge takes it
            key = at[waiting] * 65 + distances(codes[waiting], codes[at[waiting]])
            edge, taker, which = np.unique(key, return_index=True, return_inverse=True)
            child = waiting[taker]
            keys.append(edge)
            nodes.append(child)
            at[waiting] = child[which]
            waiting = waiting[at[waiting] != waiting]
        order = np.argsort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        self.edge_key = np.concatenate(keys)[order] if keys else np.zeros(0, np.int64)
        self.child = np.concatenate(nodes)[order] if nodes else np.zeros(0, np.int64)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius, level by level; queries are row numbers."""
        q = queries[self.root_of[queries] >= 0]
        node = self.root_of[q]
        while len(q):
            d = distances(self.codes[q], self.codes[node])
            near = d <= radius
            yield q[near], node[near]
            lo = np.searchsorted(self.edge_key, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.edge_key, node * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            start = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            node = self.child[start + np.arange(int(n.sum()))]
            q = np.repeat(q, n)


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the classes of a[i] and b[i], in place; a label is the smallest row number of its class."""
    while len(a):
        la, lb = label[a], label[b]
        hi, lo = np.maximum(la, lb), np.minimum(la, lb)
        differ = hi != lo
        if not differ.any():
            return
        a, b, hi, lo = a[differ], b[differ], hi[differ], lo[differ]
        np.minimum.at(label, hi, lo)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def shard_links(codes: np.ndarray, trees: np.ndarray, is_query: np.ndarray, radius: int, block: int = 4096,
                is_node: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(code, smallest member of its class) for all whose class has others, by BK-tree searches."""
    forest = BKForest(codes, trees, is_node)
    label = np.arange(len(codes))
    queries = np.flatnonzero(is_query)
    for i in range(0, len(queries), block):
        for q, node in forest.search(queries[i:i + block], radius):
            merge_labels(label, q, node)
    linked = np.flatnonzero(label != np.arange(len(codes)))
    return codes[linked], codes[label[linked]]


def link_fingerprints(fps: DataFrame, distance: int = 3, split: int = 8192) -> DataFrame:
    """Links (u, v) whose components are those of all pairs at ``distance`` bits or fewer.

    ``fps``: one column ``fp``, distinct signed longs.
    """
    prepare_workers(fps.sparkSession)
    cells = deal_cells(fps, distance, split)
    order = ["band", "value", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in complete_groups(batches, order):
            key = np.stack([t.column(c).to_numpy() for c in order], axis=1)
            tree = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]).any(axis=1))))
            query, node = (t.column(c).to_numpy() for c in ("query", "node"))
            u, v = shard_links(t.column("fp").to_numpy().view(np.uint64), tree, query, distance, is_node=node)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return cells.repartition(*order).sortWithinPartitions(*order, "fp").mapInArrow(run, "u long, v long")


def deal_cells(fps: DataFrame, distance: int, split: int) -> DataFrame:
    """Fingerprints dealt to cells (band, value, low, high): in each, those of block ``low`` of the shard
    query the tree of block ``high``; a fingerprint of block b is in the cells that b has with each block."""
    keys = [F.struct(F.lit(i).cast("long").alias("band"),
                     F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
            for i, (shift, width) in enumerate(bands_of(distance))]
    n = fps.count()
    keyed = materialize(fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.band", "key.value"), "bands", 4 * n)
    shards = materialize(keyed.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1"), "shards", 2 * n)
    blocks = F.ceil(F.col("n") / F.lit(split)).cast("long")
    met = keyed.join(shards, ["band", "value"]).withColumn("mine", F.pmod(F.xxhash64("fp"), blocks))
    return (met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .select("band", "value", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "fp",
                    (F.col("mine") <= F.col("other")).alias("query"), (F.col("mine") >= F.col("other")).alias("node")))


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, row_col: str | None = None) -> DataFrame:
    """Per row: row_id, doc_id, fp, component_id and ``first_row`` (the row that stands for its class)."""
    rows = fingerprints(docs, id_col, text_col, shingle, row_col)
    n = rows.count()
    fps = materialize(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("first")), "fps", n)
    roots = connected_components(link_fingerprints(fps.select("fp"), distance))
    classed = (fps.join(roots, fps.fp == roots.node, "left")
               .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    classed = materialize(classed, "classes", n)
    first = classed.groupBy("root").agg(F.min("first").alias("first"))
    by_fp = materialize(classed.select("fp", "root").join(materialize(first, "firsts", n), "root"), "class-of", n)
    return (rows.join(by_fp, "fp")
            .select("row_id", "doc_id", "fp", F.col("first.doc_id").alias("component_id"),
                    F.col("first.row_id").alias("first_row")))


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       distance: int = 3) -> DataFrame:
    """``docs`` with one row (smallest id) of each class; all columns stay."""
    rows, row = numbered(docs)
    kept = simhash_classes(rows, id_col, text_col, shingle, distance, row).where("row_id = first_row")
    return rows.join(kept.select(F.col("row_id").alias(row)), row, "left_semi").drop(row)
