"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors: one for each word and for each of the
word's character n-grams, found by hashing, and for two document tokens, counted per
word, that mark a word already seen in the text and a word equal to the one before. A
softmax over the average gives the probability of each label. Vectors and output
weights are learned together by stochastic gradient descent (one document a step,
Adagrad step sizes) in numpy.

Fitting uses at most ``max_labelled`` labelled documents, those of the smallest
XXH64 of their id, whole texts; that bound is the only sample taken. Their hashed
features (at most ``buckets`` ids each) are counted in tasks, the driver holds these
counts alone. Scoring reads every whole text in tasks. As the output is linear in the
average, a task keeps a score sum per word, in a cache of bounded size.

Defined results: a null text counts as empty; a text without words has the zero vector
and the score of the output bias; labels other than 0 and 1 are ignored, of several
labels of one id the largest counts; with no labels every score is 0.5, with one
label only the smoothed rate of that label. No rows give no rows. A null id is held
out. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import RecentlyUsed, crc_fold, prepare_workers

FOLDS, HELD_OUT_FOLD = 5, 0
#: Words whose sums a worker keeps (twice as many at most); only memory depends on it.
CACHED_WORDS = 250_000


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dimensions: int = 16
    shortest: int = 3
    longest: int = 4
    epochs: int = 4
    step: float = 0.1
    max_labelled: int = 4000
    seed: int = 7


def word_features(word: str, s: Settings) -> list[int]:
    """Hashed ids of a word and its character n-grams."""
    w = f"<{word}>"
    grams = [w, *(w[i:i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(w) - n + 1) if n < len(w))]
    return [zlib.crc32(g.encode()) % s.buckets for g in grams]


def document_tokens(words: list[str], s: Settings) -> list[tuple[int, int]]:
    """(id, count) of the tokens for repeated words."""
    seen = len(words) - len(set(words))
    same = sum(map(eq, words, words[1:]))
    return [(zlib.crc32(b"\x00seen") % s.buckets, 8 * seen), (zlib.crc32(b"\x00same") % s.buckets, 8 * same)]


def document_features(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids of a text and their shares."""
    words = text.split()
    counts: dict[int, int] = {}
    for w in words:
        for f in word_features(w, s):
            counts[f] = counts.get(f, 0) + 1
    for f, n in document_tokens(words, s):
        if n:
            counts[f] = counts.get(f, 0) + n
    ids = np.fromiter(sorted(counts), np.int32, len(counts))
    n = np.array([counts[i] for i in ids.tolist()], np.float64)
    return ids, (n / n.sum() if len(n) else n).astype(np.float32)


@dataclass
class Model:
    """Subword vectors (buckets x dimensions), output weights (2 x dimensions) and biases."""

    settings: Settings
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def probability(self, text: str) -> float:
        """Of label 1, through the document's vector (the tasks use the same sums, word by word)."""
        ids, share = document_features(text, self.settings)
        z = self.weights @ (share @ self.vectors[ids] if len(ids) else np.zeros(self.vectors.shape[1])) + self.bias
        return float(1 / (1 + np.exp(z[0] - z[1])))

    def scorer(self) -> Callable[[str], float]:
        """The same probability for many texts, with a cache of word sums."""
        s = self.settings
        margin = (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float64)
        bias = float(self.bias[1] - self.bias[0])

        def word_sum(word: str) -> bytes:
            ids = word_features(word, s)
            return np.array([margin[ids].sum(), len(ids)]).tobytes()

        sums = RecentlyUsed(word_sum, CACHED_WORDS)

        def score(text: str) -> float:
            words = text.split()
            total, n = np.frombuffer(b"".join(map(sums.__getitem__, words))).reshape(-1, 2).sum(axis=0)
            for f, count in document_tokens(words, s):
                total += margin[f] * count
                n += count
            return float(1 / (1 + np.exp(-np.clip(total / max(n, 1) + bias, -500, 500))))

        return score


_SCORERS: dict[int, Callable[[str], float]] = {}


def shared_scorer(model: Model) -> Callable[[str], float]:
    """The model's scorer, kept for the next tasks of this worker."""
    key = zlib.crc32(model.vectors, zlib.crc32(model.weights, zlib.crc32(model.bias)))
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = model.scorer()
    return _SCORERS[key]


def fit_numpy(examples: list[tuple[np.ndarray, np.ndarray, int]], s: Settings) -> Model:
    """Stochastic gradient descent over (ids, shares, label)."""
    rng = np.random.default_rng(s.seed)
    vectors = (rng.random((s.buckets, s.dimensions), np.float32) - 0.5) / s.dimensions
    weights = np.zeros((2, s.dimensions), np.float32)
    n1 = sum(y for *_, y in examples)
    n0 = len(examples) - n1
    bias = np.log(np.array([n0 + 0.5, n1 + 0.5]) / (len(examples) + 1)).astype(np.float32)
    if n0 and n1:
        vector_sq = np.full(s.buckets, 1e-6, np.float32)
        weight_sq, bias_sq = np.full((2, s.dimensions), 1e-4, np.float32), np.full(2, 1e-2, np.float32)
        weights += (rng.random((2, s.dimensions), np.float32) - 0.5) / s.dimensions
        for _ in range(s.epochs):
            for k in rng.permutation(len(examples)):
                ids, share, y = examples[k]
                rows = vectors[ids]
                mean = np.einsum("i,ij->j", share, rows) if len(ids) else np.zeros(s.dimensions, np.float32)
                z = weights @ mean + bias
                p = np.exp(z - z.max())
                g = p / p.sum()
                g[y] -= 1
                down = weights.T @ g
                step = np.outer(g, mean)
                weight_sq += step * step
                bias_sq += g * g
                weights -= s.step * step / np.sqrt(weight_sq)
                bias -= 0.1 * s.step * g / np.sqrt(bias_sq)
                if len(ids):
                    size = share * np.float32(np.sqrt(down @ down / len(down)))
                    vector_sq[ids] += size * size
                    vectors[ids] = rows - s.step * (share / np.sqrt(vector_sq[ids]))[:, None] * down
    return Model(s, vectors, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", settings: Settings = Settings(), held_out: int | None = HELD_OUT_FOLD) -> Model:
    """Learn from labelled rows outside the fold ``held_out``."""
    spark, s = docs.sparkSession, settings
    prepare_workers(spark)
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("label IN (0, 1) AND id IS NOT NULL")
    if held_out is not None:
        known = known.where(crc_fold(F.col("id"), FOLDS) != held_out)
    sample = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(s.max_labelled)
    texts = (docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
             .join(F.broadcast(sample), "id").select("id", "label", "text"))  # at most max_labelled rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, share = document_features(b.column(2)[i].as_py(), s)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([ids.tobytes()]), pa.array([share.tobytes()])],
                                                 ["id", "label", "ids", "share"])

    counted = texts.mapInArrow(run, "id long, label int, ids binary, share binary")
    rows = counted.orderBy(F.xxhash64("id"), "id", "ids").limit(s.max_labelled).collect()
    return fit_numpy([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["share"], np.float32), r["label"]) for r in rows], s)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (probability of label 1)."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared_scorer(model)
        for b in batches:
            scores = [of(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they are."""
    prepare_workers(docs.sparkSession)
    at = [c.lower() for c in docs.columns].index(text_col.lower())  # as Spark finds columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared_scorer(model)
        for b in batches:
            yield b.filter(pa.array([of(t.as_py() or "") >= threshold for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
