"""Alignment of two tokenizers' tokens over a corpus, with counts of the pairs they link.

A text's tokens by A and by B cover the same bytes. Offsets where both end a token cut them
into groups; the last A token and the last B token of a group are linked (every token has at
least one byte, so one token of each ends there).

1. Texts are encoded once and their token ids written in the shared folder, with what needs
   no counts.
2. The distinct linked pairs, a hash aggregate, are dealt to shards of about ``SHARD`` pairs;
   each shard gets a minimal perfect hash (``minimal_hash``), which orders its pairs.
3. Every task aligns its documents again and counts pairs in one dense vector, indexed by the
   hash, after the pair stored in the slot is compared. Vectors go shard by shard into rounds
   in which ``FAN_IN`` of them are summed, until one is left.
4. A second reading aligns the documents once more and looks up counts.

Steps 3 and 4 broadcast at most ``pairs_at_once`` pairs (hash, pairs and counts: about 17
bytes a pair); of more, they go over shards in several passes and add up. The highest count of
each B id is a vector as long as B's vocabulary.

Defined results: null texts are empty ones; an empty text, and one whose A or B tokens do not
spell out a space and the text byte for byte (it holds U+2581, say), has no tokens: zeros and
an empty ``groups_sha256``. Repeated rows count as often as they occur. Rows without a doc_id
are treated as all others. Texts of any length are handled whole. An empty table gives no rows.
Columns beside the two named are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.common import fresh_dir, levels, materialize, prepare_workers
from tessera.llm.minimal_hash import Slots, build, shard_of

SHARD = 1 << 16
FAN_IN = 8
#: Texts and tokens are handled about so many bytes at a time.
BYTES = 1 << 19
#: Ids as written: little-endian, 32 bits.
A_ID = B_ID = np.dtype("<u4")
#: Fixed value: the pattern of words of a byte-level pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_SPACE = re.compile(r"\s{10000}")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 ones for themselves, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoders:
    """Both tokenizers and the bytes of their tokens.

    Where A's merges are ranked as their ids, tiktoken reads A's vocabulary: it gives the same
    ids about four times as fast, but cannot take very long runs of white space.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.a_bytes = [bytes(letters[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        file = json.loads(self.a.to_str())
        vocabulary, before = file["model"]["vocab"], file["pre_tokenizer"] or {}
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in file["model"]["merges"]]
        plain = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not file["normalizer"]
        self.ranked = None
        if plain and merged == sorted(set(merged)):
            ranks = {self.a_bytes[i]: i for i in vocabulary.values() if i not in self.a.get_added_tokens_decoder()}
            self.ranked = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, text: str) -> list[int]:
        if self.ranked is None or LONG_SPACE.search(text):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of each text with a space before it; none for texts without tokens."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            spelled = b" " + text.encode()
            a = self.a_ids(" " + text) if text and b"".join([self.b_bytes[i] for i in b]) == spelled else []
            yield (a, b) if a and b"".join([self.a_bytes[i] for i in a]) == spelled else ([], [])


@lru_cache(maxsize=2)
def encoders(a_path: str, b_path: str) -> Encoders:
    return Encoders(a_path, b_path)


def portions(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``BYTES`` in these columns, one row at least."""
    for batch in batches:
        part = np.cumsum(sum(pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in columns)) // BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)


def ends_together(a: np.ndarray, b: np.ndarray, a_length: np.ndarray, b_length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A tokens and of the B tokens that end where one of the other does. Both cover the same bytes."""
    a_end, b_end = np.cumsum(a_length[a]), np.cumsum(b_length[b])
    if not len(a):
        return a_end, b_end
    by_a, by_b = np.zeros((2, a_end[-1] + 1), bool)
    by_a[a_end], by_b[b_end] = True, True
    return np.flatnonzero(by_b[a_end]), np.flatnonzero(by_a[b_end])


@lru_cache(maxsize=2)
def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of all numbers below n, right-aligned with room for a letter behind, and their lengths with it."""
    width = len(str(n))
    digits = np.zeros((n, width + 1), np.uint8)
    for i in range(width):
        digits[:, i] = 48 + np.arange(n) // 10 ** (width - 1 - i) % 10
    return digits, 2 + np.searchsorted(10 ** np.arange(1, width), np.arange(n), side="right")


def decimal(ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ASCII of all ids, each with the letter after it, and each one's end."""
    digits, lengths = decimals(1 << int(ids.max(initial=0)).bit_length())
    written, length = digits[ids], lengths[ids]
    width = written.shape[1]
    written[:, -1] = after
    return written[np.arange(width) >= width - length[:, None]], np.cumsum(length)


def group_texts(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;`` for all groups, as ASCII, and the end of each group in it."""
    a_after, b_after = np.full(len(a), ord(","), np.uint8), np.full(len(b), ord(","), np.uint8)
    a_after[a_last], b_after[b_last] = ord("|"), ord(";")
    # the A tokens of a group come before its B tokens
    a_group, b_group = np.searchsorted(a_last, np.arange(len(a))), np.searchsorted(b_last, np.arange(len(b)))
    a_place = np.arange(len(a)) + np.concatenate([[0], b_last + 1])[a_group]
    b_place = np.arange(len(b)) + (a_last + 1)[b_group]
    ids, after = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    ids[a_place], ids[b_place], after[a_place], after[b_place] = a, b, a_after, b_after
    text, ends = decimal(ids, after)
    return text, ends[b_place[b_last]]


TOKENS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, a binary, b binary"


def encode_rows(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(a_path, b_path)
        for batch in portions(batches, "text"):
            a, b = zip(*both.tokens(batch.column("text").to_pylist()), strict=True)
            n_a, n_b = (np.array([len(x) for x in ids]) for ids in (a, b))
            a_ids, b_ids = np.fromiter(chain.from_iterable(a), A_ID, n_a.sum()), np.fromiter(chain.from_iterable(b), B_ID, n_b.sum())
            a_last, b_last = ends_together(a_ids, b_ids, both.a_length, both.b_length)
            groups = np.diff(np.searchsorted(a_last, np.concatenate([[0], np.cumsum(n_a)])))
            text, ends = group_texts(a_ids, b_ids, a_last, b_last)
            text = text.tobytes()
            ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(groups)])]
            digest = [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            none = np.zeros(len(a), np.int64)
            written = [pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(n)]).astype(np.int32) * ids.itemsize), pa.py_buffer(ids)])
                       for n, ids in ((n_a, a_ids), (n_b, b_ids))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (n_a, n_b, groups, groups, none, none)), pa.array(digest, pa.string()), *written],
                [f.split()[0] for f in TOKENS.split(", ")])

    return run


def linked_pairs(batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The linked pairs of these documents in their order, A's id in the high half of a 64-bit key."""
    a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t) for c, t in (("a", A_ID), ("b", B_ID)))
    a_last, b_last = ends_together(a, b, *lengths)
    return a[a_last].astype(np.int64) << 32 | b[b_last].astype(np.int64)


def distinct_rows(lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.empty(0, np.int64)
        for batch in portions(batches, "a", "b"):
            seen = pd.unique(np.concatenate([seen, pd.unique(linked_pairs(batch, lengths.value))]))
            if len(seen) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])
                seen = seen[:0]
        yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])

    return run


def hash_shard(table: pa.Table) -> pa.Table:
    bitmaps, pairs = build(table.column("pair").to_numpy())
    return pa.table({"shard": table.column("shard").slice(0, 1), "n": pa.array([len(pairs)]), "levels": pa.array([bitmaps], pa.list_(pa.binary())),
                     "pairs": pa.array([pairs], pa.list_(pa.int64()))})


class Counts:
    """Some shards' hash and pairs, to be broadcast; with their counts, where known."""

    def __init__(self, shards: int, hashed: pa.Table, counts: pa.Table | None = None, best: np.ndarray | None = None):
        hashed = hashed.sort_by("shard")
        built = dict(zip(hashed.column("shard").to_pylist(), hashed.column("levels").to_pylist(), strict=True))
        self.slots = Slots(shards, built)
        self.pairs = hashed.column("pairs").combine_chunks().flatten().to_numpy()
        self.first = dict(zip(built, np.cumsum([0, *hashed.column("n").to_pylist()]).tolist(), strict=False))
        if counts is not None:
            self.counts = counts.sort_by("shard").column("counts").combine_chunks().flatten().to_numpy()
            self.best = self.counts == best[self.pairs & 0xFFFFFFFF]

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the pairs that are in these shards, and which these are; every slot's own pair is compared."""
        slots = self.slots(pairs)
        here = np.flatnonzero(slots >= 0)
        slots = slots[here]
        if not (self.pairs[slots] == pairs[here]).all():
            raise RuntimeError("a linked pair is not in the hash: the written tokens have changed")
        return slots, here


def count_rows(table, lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Counts = table.value
        counts = np.zeros(len(t.pairs), np.int64)
        for batch in portions(batches, "a", "b"):
            places, pairs = pd.factorize(linked_pairs(batch, lengths.value))
            slots, here = t.of(pairs)
            counts[slots] += np.bincount(places, minlength=len(pairs))[here]
        ends = [*t.first.values(), len(counts)][1:]
        for (shard, start), end in zip(t.first.items(), ends, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([counts[start:end]])], ["shard", "part", "counts"])

    return run


def summed(table: pa.Table) -> pa.Table:
    column = table.column("counts").combine_chunks()
    total = column.flatten().to_numpy().reshape(len(column), -1).sum(axis=0)
    return pa.table({"shard": table.column("shard").slice(0, 1), "part": table.column("part").slice(0, 1), "counts": pa.array([total])})


def tree_sum(vectors: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One vector a shard, summed in rounds of ``fan_in``."""
    vectors = materialize(vectors, "counts")
    parts, = vectors.agg(F.max("part") + 1).first()
    for _ in range(levels(parts, fan_in)):
        vectors = (vectors.withColumn("part", F.expr(f"part div {fan_in}")).groupBy("shard", "part")
                   .applyInArrow(summed, "shard long, part long, counts array<long>"))
    return materialize(vectors.select("shard", "counts"), "counts")


def look_up_rows(table, lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Counts = table.value
        for batch in portions(batches, "a", "b"):
            places, pairs = pd.factorize(linked_pairs(batch, lengths.value))
            slots, here = t.of(pairs)
            best, counts = np.zeros((2, len(pairs)), np.int64)
            best[here], counts[here] = t.best[slots], t.counts[slots]
            ends = np.concatenate([[0], np.cumsum(batch.column("n_links").to_numpy())])
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for name, values in (("n_best", best), ("count_sum", counts)):
                columns[name] = pa.array(columns[name].to_numpy() + np.diff(np.concatenate([[0], np.cumsum(values[places])])[ends]))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", pairs_at_once: int = 1 << 22, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    prepare_workers(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    path = fresh_dir(spark, "tokens")
    texts.mapInArrow(encode_rows(a_path, b_path), TOKENS).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)

    both = encoders(a_path, b_path)
    lengths = spark.sparkContext.broadcast((both.a_length, both.b_length))
    pairs = materialize(tokens.select("a", "b").mapInArrow(distinct_rows(lengths), "pair long").distinct(), "pairs")
    shards = max(1, -(-pairs.count() // shard))
    number = F.pandas_udf(lambda x: pd.Series(shard_of(x.to_numpy(), shards)), "long")
    hashed = materialize(pairs.withColumn("shard", number("pair")).groupBy("shard")
                         .applyInArrow(hash_shard, "shard long, n long, levels array<binary>, pairs array<long>"), "shards")

    passes, room = [[]], pairs_at_once
    for r in hashed.select("shard", "n").orderBy("shard").collect():
        if r["n"] > room and passes[-1]:
            passes, room = [*passes, []], pairs_at_once
        passes[-1].append(r["shard"])
        room -= r["n"]
    passes = [p for p in passes if p]

    def rows(table: DataFrame, of: list[int]) -> pa.Table:
        return table.where(F.col("shard").between(of[0], of[-1])).toArrow()

    counted = []
    for of in passes:
        table = spark.sparkContext.broadcast(Counts(shards, rows(hashed, of)))
        counted.append(tree_sum(tokens.select("a", "b").mapInArrow(count_rows(table, lengths), "shard long, part long, counts array<long>")))
        table.unpersist()

    best = np.zeros(len(both.b_length), np.int64)
    for counts in counted:
        by_b = (hashed.join(counts, "shard").select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
                .groupBy(F.col("x.pairs").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("x.counts").alias("most")))
        for r in by_b.collect():  # at most B's vocabulary
            best[r["b"]] = max(best[r["b"]], r["most"])

    for of, counts in zip(passes, counted, strict=True):
        table = spark.sparkContext.broadcast(Counts(shards, rows(hashed, of), rows(counts, of), best))
        tokens = tokens.mapInArrow(look_up_rows(table, lengths), TOKENS)
        if of is not passes[-1]:
            tokens = materialize(tokens, "tokens")
    return tokens.drop("a", "b")
