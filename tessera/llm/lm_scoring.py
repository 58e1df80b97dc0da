"""Language-model scores by a gated recurrent network with a class-factored softmax.

Tokens are the words of the lower-cased (A-Z) text, split at spaces and 0x09-0x0D, and
one end per text. A null id is held out; other texts outside the held-out fold are for training.

1. Counts. Each task counts the words of its training texts; the sums are a written table
   of every distinct word. Totals and the counts of all words come from it exactly.
2. Symbols. The most frequent words have a symbol each, the end has one, and every other
   word has that of one of ``Shape.members`` buckets by its looks (letters beyond ASCII,
   last character, length). A bucket's words share its probability in proportion to
   ``count + 0.5`` (0.5 for unseen words), so the model gives every text a probability.
   Texts are read once more, and each becomes a row of symbols.
   The most frequent words, at most ``head`` (a fixed number, so a bounded broadcast), are
   looked up in the task; all other words of a text are joined with the counts by a shuffle.
3. Training, in ``rounds``: each task starts from the same weights and learns by truncated
   backpropagation from windows of its own training texts, each text whole and with the state
   carried through it; then the weights of all tasks are averaged, block by block, weighted by
   the symbols they learned from. A text belongs to one round, which its row decides, so all
   rounds together are one pass over every symbol of every training text.
4. Scores: each text's symbols run through the network from the first to the last, the
   state carried across windows.

Defined results: a null or empty text is its end alone; with no training text the counts
are zero and the weights the initial ones; repeated rows are scored each; no rows give no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_fold, materialize, prepare_workers
from tessera.llm.gru import Shape, flat, initial, log_likelihoods, train, unflat

FOLDS, HELD_OUT_FOLD = 5, 1
#: Texts whose words a task holds at once; only memory depends on it.
TEXTS_AT_ONCE = 2048
#: Symbols that run through the network together; only memory depends on it.
SYMBOLS_AT_ONCE = 4_000_000
BLOCK = 1024


@dataclass(frozen=True)
class Settings:
    shape: Shape = field(default_factory=Shape)
    head: int = 200_000
    rounds: int = 3
    seed: int = 3

    @property
    def end(self) -> int:
        return self.shape.members  # the first symbol after the buckets

    @property
    def words(self) -> int:
        return self.shape.symbols - self.shape.members - 1


def buckets_of(words: pa.Array, buckets: int) -> np.ndarray:
    """Bucket of each word (not empty) by its looks."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset + 1:words.offset + 1 + len(words)]
    last = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends - 1]
    beyond_ascii = ~pc.string_is_ascii(words.view(pa.string())).to_numpy(zero_copy_only=False)
    by_last = np.where(last == ord("."), 1, np.where(last == ord(","), 2, np.where(last < ord("0"), 3, 0)))
    return (16 * beyond_ascii + 4 * by_last + np.minimum(3, pc.binary_length(words).to_numpy() // 4)).astype(np.int64) % buckets


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of the lower-cased texts (binary, taken byte by byte; only ASCII letters and white space count) one after
    the other, and where each text's words begin, with the end of all."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, length = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # empty: before and after the white space at a text's ends
    return words.filter(pa.array(full)), np.append(0, np.cumsum(full))[np.append(0, np.cumsum(length))]


def word_counts(texts: DataFrame) -> DataFrame:
    """Written table (word, c) of ``texts`` (text: binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counted = words_of(b.column(0))[0].value_counts()
            words, n = counted.field(0).view(pa.binary()), counted.field(1)
            for i in range(0, len(words), 20_000):
                yield pa.RecordBatch.from_arrays([words.slice(i, 20_000), n.slice(i, 20_000)], ["word", "c"])

    return materialize(texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


class Vocabulary:
    """Head words with their counts, and what the buckets hold; sent to the tasks."""

    def __init__(self, counts: DataFrame, n_texts: int, s: Settings):
        buckets = s.shape.members
        # The lowest step of the counts' logarithm above which there are at most ``head`` words.
        step = F.floor(F.log2("c") * 8)
        left, cut = s.head, 0
        for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):  # some hundred rows
            left -= r["n"]
            if left < 0:
                cut = r["step"] + 1
                break
        rows = sorted(counts.where(step >= cut).collect(), key=lambda r: (-r["c"], bytes(r["word"])))
        self.head = [bytes(r["word"]) for r in rows]
        self.head_counts = np.array([r["c"] for r in rows], np.int64)
        own = pa.array(self.head[:s.words], pa.binary())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, distinct = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
            for b in batches:
                others = pc.is_in(b.column(0), value_set=own).to_numpy(zero_copy_only=False) == 0
                at, c = buckets_of(b.column(0), buckets)[others], b.column(1).to_numpy()[others]
                total += np.bincount(at, c, buckets).astype(np.int64)
                distinct += np.bincount(at, minlength=buckets)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total), pa.array(distinct)], ["bucket", "total", "distinct"])

        sums = counts.mapInArrow(run, "bucket long, total long, distinct long").groupBy("bucket").agg(F.sum("total"), F.sum("distinct")).collect()
        of = {r[0]: (r[1], r[2]) for r in sums}
        n, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        self.tokens, self.distinct = n + n_texts, distinct + (n_texts > 0)
        total = np.array([of.get(b, (0, 0)) for b in range(buckets)], float).reshape(buckets, 2)
        # Subtracted for each word of a bucket; nothing for other symbols.
        self.bucket_log = np.zeros(s.shape.symbols)
        self.bucket_log[:buckets] = np.log10(total[:, 0] + 0.5 * (total[:, 1] + 1))
        self.symbol_counts = np.zeros(s.shape.symbols)
        self.symbol_counts[:buckets] = total[:, 0]
        self.symbol_counts[s.end] = n_texts
        self.symbol_counts[s.end + 1:][:len(self.head[:s.words])] = self.head_counts[:s.words]


def symbol_rows(docs: DataFrame, vocabulary: Vocabulary, s: Settings) -> DataFrame:
    """Written table: row_id, doc_id, trains, n_tokens, symbols (packed), head_log (sum of log10(c + 0.5) over
    head words), bucketed_log (the same over head words in buckets, less the logarithm of the bucket for every word in
    one), n_head, tail (words beyond the head)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((vocabulary.head, vocabulary.head_counts, vocabulary.bucket_log))
    columns = ["row_id", "doc_id", "trains", "n_tokens", "symbols", "head_log", "bucketed_log", "n_head", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_counts, bucket_log = sent.value
        n_head, buckets = len(head), s.shape.members

        head_words = pa.array(head, pa.binary()).view(pa.string())
        # Numbers of words: of head words their place, of others that of their bucket after these.
        symbol = np.concatenate((s.end + 1 + np.arange(n_head), np.arange(buckets)))
        symbol[s.words:n_head] = buckets_of(head_words[s.words:], buckets)
        symbol = symbol.astype(np.uint16)
        log = np.concatenate((np.log10(head_counts + 0.5), np.zeros(buckets)))
        in_bucket = np.where(symbol < buckets, log, 0) - bucket_log[symbol]
        for whole in batches:
            for i in range(0, whole.num_rows, TEXTS_AT_ONCE):
                b = whole.slice(i, TEXTS_AT_ONCE)
                words, starts = words_of(b.column(3))
                found = pc.index_in(words, value_set=head_words)
                beyond = found.is_null()
                is_tail, tail = beyond.to_numpy(zero_copy_only=False), words.filter(beyond)
                at = pc.fill_null(found, 0).to_numpy().astype(np.int64)
                at[is_tail] = n_head + buckets_of(tail, buckets)
                tails, n_words = np.append(0, np.cumsum(is_tail))[starts], np.diff(starts)
                with_ends = np.insert(symbol[at], starts[1:], np.uint16(s.end))
                offsets = (2 * (starts + np.arange(len(starts)))).astype(np.int32)
                logs, in_buckets, spans = log[at], in_bucket[at], list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    *b.columns[:3], pa.array(n_words + 1), pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(with_ends)]),
                    *(pa.array([float(v[a:z].sum()) for a, z in spans], pa.float64()) for v in (logs, in_buckets)),
                    pa.array(n_words - np.diff(tails)), pa.ListArray.from_arrays(pa.array(tails, pa.int32()), tail.view(pa.binary()))], columns)

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "trains", "text")
    return materialize(rows.mapInArrow(run, "row_id long, doc_id long, trains boolean, n_tokens long, symbols binary, head_log double, bucketed_log double, n_head long, tail array<binary>"), "symbols")


def in_portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(row ids, symbol sequences) of batches (row_id, symbols), some million symbols at a time."""
    ids, sequences, n = [], [], 0
    for b in batches:
        for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids.append(i)
            sequences.append(np.frombuffer(x.as_py(), np.uint16))
            n += len(sequences[-1])
            if n >= SYMBOLS_AT_ONCE:
                yield ids, sequences
                ids, sequences, n = [], [], 0
    if ids:
        yield ids, sequences


def learned(symbols: DataFrame, vocabulary: Vocabulary, s: Settings) -> dict[str, np.ndarray]:
    """Network weights after all rounds of training in tasks and averaging."""
    weights = initial(s.shape, vocabulary.symbol_counts, s.seed)
    texts = symbols.where("trains").select("row_id", "symbols")
    for turn in range(s.rounds):
        start = weights

        def run(batches: Iterator[pa.RecordBatch], start: dict = start) -> Iterator[pa.RecordBatch]:
            now, total = start, 0
            for _, sequences in in_portions(batches):
                now, n = train(now, sequences, s.end)
                total += n
            if total:
                v = flat(now)
                blocks = [v[a:a + BLOCK] for a in range(0, len(v), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array([total] * len(blocks), pa.int64()), pa.array(blocks, pa.list_(pa.float32()))], ["block", "n", "values"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for b in batches:
                for block, n, values in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    one = sums.setdefault(block, [0, np.zeros(len(values))])
                    one[0] += n
                    one[1] += n * values.values.to_numpy().astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v / n for n, v in sums.values()], pa.list_(pa.float64()))], ["block", "values"])

        trained = texts.where(F.pmod("row_id", F.lit(s.rounds)) == turn).mapInArrow(run, "block long, n long, values array<float>")
        blocks = {r["block"]: r["values"] for r in trained.repartition("block").mapInArrow(average, "block long, values array<double>").collect()}  # the weights, once
        if blocks:
            weights = unflat(np.concatenate([blocks[b] for b in sorted(blocks)]), weights)
    return weights


def network_scores(symbols: DataFrame, weights: dict[str, np.ndarray], s: Settings) -> DataFrame:
    """(row_id, network_log): log10 probability of each symbol sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sequences in in_portions(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(log_likelihoods(weights, sequences, s.end) / np.log(10))], ["row_id", "network_log"])

    return symbols.select("row_id", "symbols").mapInArrow(run, "row_id long, network_log double")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    s = settings
    prepare_workers(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(crc_fold(F.col(f"`{id_col}`"), FOLDS) != HELD_OUT_FOLD, F.lit(False)).alias("trains"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    training = rows.where("trains")
    counts = word_counts(training.select("text"))
    vocabulary = Vocabulary(counts, training.count(), s)
    symbols = symbol_rows(rows, vocabulary, s)
    weights = learned(symbols, vocabulary, s)
    scored = materialize(network_scores(symbols, weights, s), "network-scores")
    return with_tails(symbols, counts, scored, vocabulary, s)


def with_tails(symbols: DataFrame, counts: DataFrame, scored: DataFrame, vocabulary: Vocabulary, s: Settings) -> DataFrame:
    """The result rows, after the words beyond the head have met their counts (none of these words is frequent)."""
    c = F.coalesce("c", F.lit(0))
    sums = (symbols.select("row_id", F.explode("tail").alias("word")).join(counts, "word", "left")
            .groupBy("row_id").agg(F.sum(F.log10(c + 0.5)).alias("tail_log"), F.sum((c > 0).cast("long")).alias("tail_known")))
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    norm = float(np.log10(vocabulary.tokens + 0.5 * (vocabulary.distinct + 1)))
    ends = vocabulary.symbol_counts[s.end]
    return (symbols.drop("symbols", "tail").join(scored, "row_id").join(sums, "row_id", "left")
            .select("doc_id", (~F.col("trains")).alias("held_out"), "n_tokens",
                    (F.col("n_head") + F.coalesce("tail_known", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
                    F.lit(int(vocabulary.tokens)).cast("long").alias("train_tokens"),
                    (F.col("head_log") + tail_log + float(np.log10(ends + 0.5)) - F.col("n_tokens") * norm).alias("base_score"),
                    (F.col("network_log") + F.col("bucketed_log") + tail_log).alias("score")))
