"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Components become ``floor(scale * x)``. A block of candidates keeps one sorted list per
dimension; a query reads it from the large end where its component is positive and from
the small end where it is negative, so contributions come in falling order. All lists are
read on together, some steps of a block's depth at a time. What was read counts as it is;
for what was not, the last value read gives a candidate's upper bound and the far end of
the list its lower bound. The (k + 1)-th best lower bound, or a better score already known
from other blocks, is the query's threshold: it stops when no more than a few candidates
reach it by their upper bounds, and theirs are resolved to final scores. Whoever is below
the threshold cannot qualify, so the result is exact at every depth.

Queries meet all candidates in passes: a pass broadcasts queries of about ``at_once``
components in all, every task runs its blocks of candidates against them with the
thresholds it has, and keeps k + 1 hits a query; a window picks the best of all tasks.
Candidates are neither shuffled nor copied. First thresholds come from a bounded number
of candidates (``seeds``). A pass then takes the candidates in portions, by a hash, each
``growth`` times what went before it, and what it found gives the thresholds of the next:
a portion has about ``growth`` times k + 1 candidates that reach a query's threshold, so
the hits that are shuffled grow with the logarithm of the table, not with its tasks.
Thresholds only save work. The work is the number of queries times the number of
vectors, as the exact search of a query set that grows with its table is.

Hits have one place more than asked for, because a query's own row is among the candidates:
the row of its id and vector with the best place is left out at the end. Equal rows are
interchangeable there.

Defined results: vectors that are null or hold null or non-finite components are neither
query nor candidate. Only vectors with as many components have an inner product with a
query (empty ones among each other: 0). Rows without an id are candidates, last among
ties, and no queries. Every copy of a repeated row is a query and a candidate of its own.
Fewer candidates than k give fewer rows; an empty table gives none. Columns beside the two
named are not read. Arithmetic is exact: float32 or float64 where no sum can leave their
whole numbers, else 64-bit integers; scores that may not fit those are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, numbered, prepare_workers

#: Parts of a block's depth after which bounds are compared.
DEPTHS = (0.25, 0.375, 0.5, 0.625, 0.75, 1.0)
BLOCK = 4096
QUERIES = 256


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the vectors that take part."""
    x = F.col(vector_col)
    # NaN is greater than infinity to Spark
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(finite, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), x.alias("v"))


def by_length(batch: pa.RecordBatch | pa.Table, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows' places and integer vectors (whole numbers as float64), one matrix for each number of components."""
    column = batch.column("v")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, flat[starts[at][:, None] + np.arange(n)]


def number_type(queries: np.ndarray, vectors: np.ndarray) -> type:
    """The cheapest type in which every bound and score of these is exact."""
    most = float(np.abs(queries).max(axis=0, initial=0) @ np.abs(vectors).max(axis=0, initial=0))
    for limit, kind in ((2.0 ** 24, np.float32), (2.0 ** 53, np.float64), (2.0 ** 62, np.int64)):
        if most < limit:
            return kind
    raise ValueError(f"inner products of up to {most:.3g} do not fit a long")


class SortedLists:
    """The sorted lists of a block of vectors, and what a reader knows of them at a depth."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.known: dict[float, tuple[np.ndarray, np.ndarray]] = {}

    def bounds(self, depth: float) -> tuple[np.ndarray, np.ndarray]:
        """Components as known after reading: for upper bounds and for lower ones.

        The first half of the columns is read from the large end (positive weights),
        the second from the small end (negative weights).
        """
        if depth not in self.known:
            n, dims = self.vectors.shape
            read = max(1, int(n * depth))
            upper, lower = np.empty((n, 2 * dims), self.vectors.dtype), np.empty((n, 2 * dims), self.vectors.dtype)
            ends = ((slice(0, dims), slice(n - read, n), n - read, 0), (slice(dims, 2 * dims), slice(0, read), read - 1, n - 1))
            for half, part, last, far in ends:
                upper[:, half], lower[:, half] = self.sorted[last], self.sorted[far]
                for known in (upper, lower):
                    np.put_along_axis(known[:, half], self.order[part], self.sorted[part], axis=0)
            self.known[depth] = upper, lower
        return self.known[depth]


def qualifying(queries: np.ndarray, floors: np.ndarray, lists: SortedLists, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, candidate, score)``: at least each query's k best of the block that reach its floor."""
    n = len(lists.vectors)
    few = max(2 * k, n // 64)
    weights = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
    active, found = np.arange(len(queries)), []
    for depth in DEPTHS:
        upper, lower = (weights[active] @ known.T for known in lists.bounds(depth))
        threshold = floors[active]
        if n >= k:
            threshold = np.maximum(threshold, np.partition(lower, n - k, axis=1)[:, n - k])
        reach = upper >= threshold[:, None]
        stops = (np.count_nonzero(reach, axis=1) <= few) | (depth == DEPTHS[-1])
        q, c = np.nonzero(reach & stops[:, None])
        if depth == DEPTHS[-1]:
            score = lower[q, c]
        else:
            score = np.einsum("ij,ij->i", queries[active[q]], lists.vectors[c])
        found.append((active[q], c, score))
        active = active[~stops]
        if not len(active):
            break
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Best:
    """The best hits of each query so far: score falling, then id, rows without an id last."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floors, self.k = floors, k
        self.hits = tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64, bool))  # query, score, no id, id, own

    def add(self, *hits: np.ndarray) -> None:
        reach = hits[1] >= self.floors[hits[0]]
        query, score, none, ids, own = both = [np.concatenate([x, y[reach]]) for x, y in zip(self.hits, hits, strict=True)]
        order = np.lexsort((~own, ids, none, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.hits = tuple(x[order[place < self.k]] for x in both)
        last = place == self.k - 1
        self.floors[query[last]] = np.maximum(self.floors[query[last]], score[order[last]])


def search_block(groups: dict[int, tuple[np.ndarray, np.ndarray]], query_ids: np.ndarray, batch: pa.RecordBatch, scale: int, best: Best) -> None:
    """Run the queries against a block of candidates."""
    column = batch.column("id")
    none = np.asarray(column.is_null())
    ids = column.fill_null(0).to_numpy()
    for at, vectors in by_length(batch, scale):
        places, queries = groups.get(vectors.shape[1], (np.empty(0, np.int64), None))
        if not len(places):
            continue
        kind = number_type(queries, vectors)
        lists = SortedLists(vectors.astype(kind))
        for start in range(0, len(places), QUERIES):
            some = places[start:start + QUERIES]
            weights = queries[start:start + QUERIES].astype(kind)
            floors = best.floors[some]
            # a floor below every sum stands for none; it must fit the type as well
            q, c, score = qualifying(weights, floors if kind is np.int64 else floors.astype(np.float64), lists, best.k)
            c_ids, c_none = ids[at[c]], none[at[c]]
            own = ~c_none & (c_ids == query_ids[some[q]])
            own[own] = (weights[q[own]] == lists.vectors[c[own]]).all(axis=1)
            best.add(some[q], score.astype(np.int64), c_none, c_ids, own)


#: Stands for no score known yet.
NO_FLOOR = -(1 << 62)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def with_floors(seeds: pa.Table, scale: int, k: int):
    """Adds to each query row its k-th best score among the seeds, null where there are fewer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            best = Best(np.full(batch.num_rows, NO_FLOOR), k)
            groups = {v.shape[1]: (at, v) for at, v in by_length(batch, scale)}
            for block in blocks(seeds.to_batches()):
                search_block(groups, batch.column("id").to_numpy(), block, scale, best)
            floors = pa.array(best.floors, pa.int64(), mask=best.floors == NO_FLOOR)
            yield pa.RecordBatch.from_arrays([*batch.columns, floors], [*batch.schema.names, "floor"])

    return run


def search(queries, scale: int, k: int, row: str):
    """Yields the k best of the partition's candidates for each broadcast query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: pa.Table = queries.value
        query_ids = table.column("id").to_numpy()
        groups = {v.shape[1]: (at, v) for at, v in by_length(table, scale)}
        best = Best(table.column("floor").fill_null(NO_FLOOR).to_numpy().copy(), k)
        for block in blocks(batches):
            search_block(groups, query_ids, block, scale, best)
        query, score, none, ids, own = best.hits
        rows = table.column(row).to_numpy()
        for i in range(0, len(query), 1 << 16):
            s = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[query[s]]), pa.array(query_ids[query[s]]), pa.array(ids[s], pa.int64(), mask=none[s]), pa.array(score[s]), pa.array(own[s])],
                [row, "query_id", "vec_id", "score", "own"])

    return run


def portions(rows: int, seeds: int, growth: int) -> list[tuple[int, int]]:
    """Ranges of a hash modulo the last one's end: each portion has ``growth`` times the candidates
    of those before it, and the first about that many times ``seeds`` at most."""
    ends = [1]
    while rows > seeds * growth * ends[-1]:
        ends.append(growth * ends[-1])
    return list(zip([0, *ends], ends))


def best_of_all(hits: DataFrame, row: str, k: int) -> DataFrame:
    """The k best hits of each query, with their ``place``."""
    place = F.row_number().over(Window.partitionBy(row).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), F.desc("own")))
    return hits.withColumn("place", place).where(F.col("place") <= k)


def raised(queries: DataFrame, best: DataFrame, row: str, k: int) -> DataFrame:
    """Queries with the threshold that their k-th best hit gives, where they have so many."""
    last = best.where(F.col("place") == k).select(row, F.col("score").alias("last"))
    return queries.join(last, row, "left").select("id", "v", F.greatest("floor", "last").alias("floor"), row)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
          scale: int = 256, at_once: int = 1 << 22, seeds: int = BLOCK, growth: int = 16) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    prepare_workers(spark)
    table = usable(vectors, id_col, vector_col)
    some = table.limit(seeds).toArrow()
    vector_type = vectors.schema[vector_col].dataType.simpleString()
    queries, row = numbered(table.where(F.col("id") % every == 0)
                            .mapInArrow(with_floors(some, scale, k + 1), f"id long, v {vector_type}, floor long"))
    components, = queries.agg(F.sum(F.size("v"))).first()
    passes = max(1, -(-(components or 0) // at_once))
    parts = portions(table.count(), seeds, growth)
    portion = F.pmod(F.xxhash64("id", "v"), F.lit(parts[-1][1]))
    found = None
    for i in range(passes):
        mine, best = queries.where(F.pmod(F.xxhash64(row), F.lit(passes)) == i), None
        for start, end in parts:
            now = mine if best is None else raised(mine, best, row, k + 1)
            shared = spark.sparkContext.broadcast(now.toArrow())
            candidates = table.where((portion >= start) & (portion < end))
            hits = candidates.mapInArrow(search(shared, scale, k + 1, row), f"{row} long, query_id long, vec_id long, score long, own boolean")
            best = materialize(best_of_all(hits if best is None else hits.unionByName(best.drop("place")), row, k + 1), "hits")
            shared.unpersist()
        found = best if found is None else found.unionByName(best)
    own = F.coalesce(F.min(F.when(F.col("own"), F.col("place"))).over(Window.partitionBy(row)), F.lit(k + 1))
    return (found.withColumn("left_out", own).where(F.col("place") != F.col("left_out"))
            .select("query_id", (F.col("place") - (F.col("place") > F.col("left_out")).cast("int")).alias("rank"), "vec_id", "score"))
