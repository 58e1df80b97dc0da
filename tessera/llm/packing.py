"""Packing into fixed-length sequences by cutting-stock column generation.

1. Tokenise: every whole text to ids, then the end id. Each full run of ``capacity``
   ids is a sequence of its own (its CRC is taken at once); the rest, the document's
   remainder, is stored. Texts are tokenised once, word by word through a cache: no
   token of the tokenizers taken here spans white space.
2. Cutting stock. Remainders fall into length classes of ``unit`` ids (rounded up).
   The class counts, at most ``capacity / unit`` numbers, are all that the driver sees.
   The linear program over packing patterns is solved by column generation: a revised
   simplex whose entering column is priced by a knapsack dynamic program.
3. Rounded-down pattern counts are dealt to documents by their rank in their class
   (ranks from prefix sums over hash buckets, so a class may hold most documents).
4. What patterns leave: documents beyond the rounded counts are laid end to end and
   cut to fill the gaps of all sequences exactly, then whole sequences, and at last
   sequences whose sizes are powers of two. So nothing is padded.

Defined results: a null text is empty and gives its end id alone; a repeated row, or
one with a null id, is a document of its own; no rows give no pieces; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import buckets_for, materialize, prefix_sums, prepare_workers

#: Words and pre-tokens whose ids a worker keeps; only memory depends on it.
CACHED_WORDS, CACHED_PRE_TOKENS = 400_000, 400_000
#: Python splits at 0x1C-0x1F as well, the tokenizer's white space is Unicode's alone.
SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


@lru_cache(maxsize=1)  # a worker's tasks share the caches
def word_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids of the tokenizer at ``path`` (one whose tokens never span white space).

    Words and pre-tokens seen before are looked up. New words of characters below U+0250,
    on whose classes and lower case all Unicode versions agree, are lower-cased and split
    here and each new pre-token goes to the tokenizer's model alone; all others go through
    the whole tokenizer. Lower-case ASCII letters are kept once, as a word: most words are
    also pre-tokens, and held as both they would take twice the memory.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    if tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
        raise ValueError("ids are stored in 16 bits")
    model, find = tokenizer.model, PRE_TOKENS.findall

    def ids_of(piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(BYTE_SYMBOLS)
        return array("H", [t.id for t in model.tokenize(symbols)]).tobytes()

    class PreTokens(dict):
        def __missing__(self, piece: str) -> bytes:
            if len(self) >= CACHED_PRE_TOKENS:
                self.clear()
            self[piece] = out = ids_of(piece)
            return out

    pre_tokens = PreTokens()

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            if len(self) >= CACHED_WORDS:
                self.clear()
            if word.isascii() or max(word) < "\u0250":
                lower = word.lower()
                stem = lower.rstrip(PUNCTUATION)
                if stem.isalpha():  # most words: letters, then punctuation if any
                    out = (pre_tokens[stem] if not stem.isascii() else ids_of(stem) if stem == word else self[stem])
                    if len(stem) < len(lower):
                        out += pre_tokens[lower[len(stem):]]
                else:
                    out = b"".join(map(pre_tokens.__getitem__, find(lower)))
            else:
                out = array("H", tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
            self[word] = out
            return out

    words = Words()

    def encode(text: str) -> np.ndarray:
        parts = [w for w in WHITE_SPACE.split(text) if w] if SEPARATORS.search(text) else text.split()
        return np.frombuffer(b"".join(map(words.__getitem__, parts)), np.uint16)

    return encode

# Fixed values of byte-level tokenizers: the pre-tokens of lower-case text, and the symbol of each byte.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SYMBOLS = {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(SHOWN)))}


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Written table (row_id, doc_id, n, crcs of the full runs, rest: ids of the remainder in 16 bits)."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        end = np.array([end_id], "<u2")
        for b in batches:
            ns, crcs, rests = [], [], []
            for t in b.column(2):
                ids = np.concatenate((encode(t.as_py() or ""), end))
                full = len(ids) // capacity * capacity
                ns.append(len(ids))
                crcs.append([crc_of(ids[i:i + capacity]) for i in range(0, full, capacity)])
                rests.append(ids[full:].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ns, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                                              pa.array(rests, pa.binary())], ["row_id", "doc_id", "n", "crcs", "rest"])

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, "row_id long, doc_id long, n long, crcs array<long>, rest binary"), "tokens")


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits (unbounded knapsack, by capacity)."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = sizes <= c
        with_item = np.where(fits, best[np.where(fits, c - sizes, 0)] + values, -1.0)
        k = int(np.argmax(with_item))
        if with_item[k] > best[c - 1] + 1e-12:
            best[c], took[c] = with_item[k], k
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= int(sizes[took[c]])
    return float(best[capacity]), pattern


def cutting_stock(counts: dict[int, int], capacity: int, rounds: int = 5000) -> list[tuple[dict[int, int], float]]:
    """Patterns (size: times) and how often to use each in the linear program's optimum.

    ``counts``: how many items of each size (1 to ``capacity``) there are. Ends at the
    optimum, or when Farley's bound shows less than half a sequence left to gain, which
    rounding loses anyway. Demands are shifted a little, against cycling.
    """
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    demand = np.array([counts[s] for s in sizes], float)
    shifted = demand + 1e-4 * np.random.default_rng(0).random(len(sizes))
    columns = [np.where(np.arange(len(sizes)) == i, capacity // s, 0) for i, s in enumerate(sizes)]
    basis = np.array(columns, float).T
    inverse = np.diag(1 / np.diag(basis))
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        value, entering = best_pattern(prices, sizes, capacity)
        use, change = (inverse * shifted).sum(axis=1), (inverse * entering).sum(axis=1)
        if value <= 1 + 1e-9 or use.sum() * (1 - 1 / value) < 0.5:
            break
        ratio = np.where(change > 1e-9, np.maximum(use, 0) / np.where(change > 1e-9, change, 1), np.inf)
        leaves = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaves]):
            break
        basis[:, leaves] = entering
        pivot = inverse[leaves] / change[leaves]
        inverse -= change[:, None] * pivot
        inverse[leaves] = pivot
    use = (inverse * demand).sum(axis=1)
    return [({int(sizes[i]): int(a) for i, a in enumerate(column) if a}, max(0.0, float(x))) for column, x in zip(basis.T, use, strict=True)]


def plan_sequences(counts: dict[int, int], capacity: int, most: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Per class, arrays (first rank, first sequence, items a sequence) of the rounded-down
    patterns, with a last entry where its dealt ranks end; and the number of sequences,
    ``most`` at most. Fullest patterns come first."""
    plan = [(p, int(x + 1e-6)) for p, x in cutting_stock(counts, capacity)]
    plan.sort(key=lambda px: (-sum(s * a for s, a in px[0].items()), sorted(px[0].items())))
    ranges: dict[int, list[tuple[int, int, int]]] = {s: [] for s in counts}
    dealt = dict.fromkeys(counts, 0)
    n = 0
    for pattern, times in plan:
        times = min([times, most - n, *((counts[s] - dealt[s]) // a for s, a in pattern.items())])
        if times <= 0:
            continue
        for s, a in pattern.items():
            ranges[s].append((dealt[s], n, a))
            dealt[s] += times * a
        n += times
    return {s: tuple(np.array([*r, (dealt[s], -1, 1)], np.int64).T) for s, r in ranges.items()}, n


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, capacity: int = 4096, unit: int = 32,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, row_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    tokens = tokenised(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), end_id, capacity, id_col, text_col)
    meta = tokens.select("row_id", "n", (F.col("n") % capacity).alias("rest_n"))
    rests = meta.where("rest_n > 0").withColumn("class", F.ceil(F.col("rest_n") / unit).cast("int"))

    found = rests.groupBy("class").agg(F.count("*").alias("docs"), F.sum("rest_n").alias("ids")).collect()  # a row a class
    total = sum(r["ids"] for r in found)
    whole = total // capacity  # sequences that the remainders fill
    ranges, closed_n = plan_sequences({r["class"]: r["docs"] for r in found}, capacity // unit, whole)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, rank = b.column(2).to_numpy(), b.column(3).to_numpy()
            seq = np.full(b.num_rows, -1, np.int64)
            for c in np.unique(cls):
                at = np.flatnonzero(cls == c)
                first, sequence, each = ranges[int(c)]
                k = np.searchsorted(first, rank[at], "right") - 1
                seq[at] = np.where(sequence[k] >= 0, sequence[k] + (rank[at] - first[k]) // each[k], -1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(seq)], ["row_id", "rest_n", "seq"])

    n_docs = sum(r["docs"] for r in found)
    ranked = prefix_sums(rests, "row_id", F.lit(1), "rank", "class", buckets_for(n_docs)).select("row_id", "rest_n", "class", "rank")
    assigned = materialize(ranked.mapInArrow(assign, "row_id long, rest_n long, seq long"), "assigned", n_docs)

    # Documents of a pattern lie in their sequence one after the other.
    closed = assigned.where("seq >= 0")
    before = Window.partitionBy("seq").orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1)
    in_patterns = closed.select("row_id", F.lit(0).cast("long").alias("rest_start"), F.col("rest_n").alias("length"), "seq",
                                F.coalesce(F.sum("rest_n").over(before), F.lit(0)).alias("offset"))

    # All other documents, end to end, against all gaps, end to end.
    small = powers_of_two(total - whole * capacity)
    gaps = (closed.groupBy("seq").agg(F.sum("rest_n").alias("offset")).select("seq", "offset", (F.lit(capacity) - F.col("offset")).alias("size"))
            .unionByName(spark.range(closed_n, whole).select(F.col("id").alias("seq"), F.lit(0).cast("long").alias("offset"), F.lit(capacity).cast("long").alias("size")))
            .where("size > 0"))
    if small:
        gaps = gaps.unionByName(spark.createDataFrame([(whole + i, 0, s) for i, s in enumerate(small)], "seq long, offset long, size long"))
    gaps = materialize(gaps, "gaps", whole)

    def binned(df: DataFrame, lo: str, size: str) -> DataFrame:
        return df.withColumn("bin", F.explode(F.sequence(F.expr(f"{lo} div {capacity}"), F.expr(f"({lo} + {size} - 1) div {capacity}"))))

    left = binned(prefix_sums(assigned.where("seq < 0"), "row_id", "rest_n", "doc_at", buckets=buckets_for(n_docs)), "doc_at", "rest_n").drop("seq")
    right = binned(prefix_sums(gaps, "seq", "size", "gap_at", buckets=buckets_for(whole)), "gap_at", "size")
    lo, hi = F.greatest("doc_at", "gap_at"), F.least(F.col("doc_at") + F.col("rest_n"), F.col("gap_at") + F.col("size"))
    filling = (left.join(right, "bin").withColumn("lo", lo).withColumn("hi", hi)
               .where((F.col("lo") < F.col("hi")) & (F.expr(f"lo div {capacity}") == F.col("bin")))
               .select("row_id", (F.col("lo") - F.col("doc_at")).alias("rest_start"), (F.col("hi") - F.col("lo")).alias("length"), "seq",
                       (F.col("offset") + F.col("lo") - F.col("gap_at")).alias("offset")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crcs = [crc_of(np.frombuffer(rest.as_buffer(), "<u2")[s:s + n])
                    for rest, s, n in zip(b.column("rest"), b.column("rest_start").to_pylist(), b.column("length").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:7], pa.array(crcs, pa.int64())], [*b.schema.names[:7], "ids_crc32"])

    pieces = (tokens.select("row_id", "doc_id", "n", "rest").join(in_patterns.unionByName(filling), "row_id")
              .select("row_id", "doc_id", "n", "rest_start", "length", "seq", "offset", "rest")
              .mapInArrow(cut, "row_id long, doc_id long, n long, rest_start long, length long, seq long, offset long, ids_crc32 long")
              .select("doc_id", "row_id", (F.col("n") - F.col("n") % capacity + F.col("rest_start")).alias("start"), "length", "ids_crc32",
                      F.col("n").alias("doc_tokens"), F.col("seq").alias("sequence_id"), "offset"))

    long_docs = tokens.where(F.col("n") >= capacity).select("row_id", "doc_id", "n", "crcs")
    full = (prefix_sums(long_docs, "row_id", F.size("crcs"), "sequences_before", buckets=buckets_for(long_docs.count()))
            .select("row_id", "doc_id", "n", "sequences_before", F.posexplode("crcs").alias("i", "crc"))
            .select("doc_id", "row_id", (F.col("i").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
                    F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
                    (F.lit(whole + len(small)) + F.col("sequences_before") + F.col("i")).cast("long").alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset")))
    return pieces.unionByName(full)
