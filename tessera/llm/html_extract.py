"""Main-text extraction from HTML with gradient-boosted trees over DOM nodes.

Each page is parsed into nodes (``html_nodes``); boosted regression trees (logistic loss,
second-order gains, binned features, numpy) give each node's log-odds of belonging to the
main text, from subtree density, attribute tokens, depth, tag, and sibling statistics.
Decoding is hierarchical: among all labellings in which nothing is kept below a dropped
node, the one of the largest total log-odds is taken (a sum from the leaves up, then a
choice from the root down), so ancestors and descendants never contradict each other.
The kept runs of text make the result, in page order, joined by one space.

The trees are learned from generated pages (``html_templates``) once per driver process;
a task gets them with its function. Pages never leave their task.

Defined results: a null or empty html gives an empty text; markup without text likewise;
broken markup never fails; repeated rows are pages of their own; no rows give no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers
from tessera.llm.html_nodes import Nodes, by_levels, features, parse
from tessera.llm.html_templates import MARK, pages

#: Nodes whose features are computed together; bounds memory.
NODES_AT_ONCE = 20_000


@dataclass(frozen=True)
class Settings:
    pages: int = 900
    trees: int = 60
    levels: int = 5
    step: float = 0.2
    bins: int = 32
    l2: float = 1.0
    seed: int = 11


@dataclass
class Trees:
    """Complete binary trees in arrays (tree, node): feature and threshold of inner nodes, values of leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value)))):
                at = 2 * at + 1 + (x[row, feature[at]] > threshold[at])
            out += value[at - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, s: Settings) -> Trees:
    """Gradient boosting with logistic loss; level-wise trees on binned features."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, s.bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)  # bin b: x <= edges[b]
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(rate / (1 - rate)))
    score, inner = np.full(n, base), (1 << s.levels) - 1
    feature, threshold, value = [], [], []
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        f, t, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(s.levels):
            first = (1 << level) - 1
            cells = ((at - first) * s.bins)[:, None] + binned
            shape, size = (1 << level, s.bins), (1 << level) * s.bins
            best = np.full(1 << level, 1e-6)
            for j in range(m):
                if not len(edges[j]):
                    continue
                gl = np.bincount(cells[:, j], g, size).reshape(shape).cumsum(axis=1)
                hl = np.bincount(cells[:, j], h, size).reshape(shape).cumsum(axis=1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gain = (gl ** 2 / (hl + s.l2) + (ga - gl) ** 2 / (ha - hl + s.l2) - ga ** 2 / (ha + s.l2))[:, :len(edges[j])]
                k = gain.argmax(axis=1)
                found = gain[np.arange(len(k)), k]
                better = found > best
                best[better] = found[better]
                f[first:][:len(k)][better] = j
                t[first:][:len(k)][better] = edges[j][k[better]]
            at = 2 * at + 1 + (x[np.arange(n), f[at]] > t[at])
        leaf = at - inner
        v = -s.step * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + s.l2)
        score += v[leaf]
        feature.append(f)
        threshold.append(t)
        value.append(v)
    return Trees(np.array(feature), np.array(threshold, np.float32), np.array(value), base)


def columns(found: list[Nodes]) -> tuple[np.ndarray, ...]:
    """The nodes of several pages as arrays (parent, kind, depth, tokens, text, link, inline)."""
    starts = np.cumsum([0, *(len(x.parent) for x in found)])
    parent = np.concatenate([np.array(x.parent) + np.where(np.array(x.parent) < 0, 0, s) for x, s in zip(found, starts, strict=False)])
    joined = [np.concatenate([np.array(getattr(x, name), np.int64) for x in found]) for name in ("kind", "depth", "tokens", "link", "inline")]
    text = [t for x in found for t in x.text]
    return parent, joined[0], joined[1], joined[2], text, joined[3], joined[4]


def decode(parent: np.ndarray, depth: np.ndarray, log_odds: np.ndarray) -> np.ndarray:
    """Kept nodes: the labelling of the largest sum in which no node is kept below a dropped one. Roots stay."""
    total, levels = log_odds.astype(float).copy(), by_levels(depth)
    for level in reversed(levels[1:]):
        np.add.at(total, parent[level], np.maximum(total[level], 0))
    kept = np.ones(len(parent), bool)
    for level in levels[1:]:
        kept[level] = kept[parent[level]] & (total[level] > 0)
    return kept


def truth_of(found: list[Nodes], parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Main runs and every node above one."""
    y = np.concatenate([np.array(x.truth, bool) for x in found])
    for level in reversed(by_levels(depth)[1:]):
        np.logical_or.at(y, parent[level], y[level])
    return y


@lru_cache(maxsize=2)
def trained(s: Settings = Settings()) -> Trees:
    found = [parse(p, MARK) for p in pages(s.pages, s.seed)]
    cols = columns(found)
    return fit_trees(features(*cols), truth_of(found, cols[0], cols[2]).astype(float), s)


def main_texts(htmls: list[str], trees: Trees) -> Iterator[str]:
    """The main text of each page."""
    waiting: list[Nodes] = []
    n = 0

    def done() -> Iterator[str]:
        parent, kind, depth, tokens, text, link, inline = columns(waiting)
        kept = decode(parent, depth, trees.log_odds(features(parent, kind, depth, tokens, text, link, inline)))
        at = 0
        for x in waiting:
            yield " ".join(t for t, k in zip(x.text, kept[at:at + len(x.text)].tolist(), strict=True) if k and t)
            at += len(x.text)

    for h in htmls:
        waiting.append(parse(h))
        n += len(waiting[-1].parent)
        if n >= NODES_AT_ONCE:
            yield from done()
            waiting, n = [], 0
    if waiting:
        yield from done()


def extract(pages_df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", trees: Trees | None = None) -> DataFrame:
    """Per row: page_id, url, text."""
    prepare_workers(pages_df.sparkSession)
    model = trees or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                texts = list(main_texts([h.as_py() or "" for h in b.column(2)], model))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages_df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                           F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
