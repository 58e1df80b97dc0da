from __future__ import annotations

import html
import math
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import gru, html_extract, lm_scoring
from tessera.llm import quality_classifier as quality
from tessera.llm.html_nodes import parse
from tessera.llm.html_templates import MARK, pages
from tessera.llm.queries import op4_quality_classifier

LABELS = "doc_id long, quality int, toxic int, text string"


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in op4_quality_classifier(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for i, r in rows.items())
    held = [(rows[i]["score"], y) for i, y in labels.items() if rows[i]["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_quality_of_odd_rows(spark, docs, odd_texts):
    labels = spark.createDataFrame([(4, 1, 0, "x"), (5, 0, 0, "x"), (6, None, 0, "x"), (7, 3, 0, "x"), (None, 1, 0, "x"), (8, 0, 0, "x"), (8, 1, 0, "x")], LABELS)
    model = quality.fit(docs(odd_texts), labels)
    rows = quality.score(docs(odd_texts), model).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r["score"] <= 1 for r in rows)
    for i, t in odd_texts[:8]:
        assert any(r["doc_id"] == i and r["score"] == pytest.approx(model.probability(t or ""), abs=1e-5) for r in rows)
    assert quality.score(docs([]), model).count() == 0
    kept = quality.keep_good(docs(odd_texts), model, threshold=0.0)
    assert kept.columns == docs([]).columns and kept.count() == len(odd_texts)


def test_quality_without_labels(spark, docs, odd_texts):
    none = quality.fit(docs(odd_texts), spark.createDataFrame([], LABELS))
    assert {r["score"] for r in quality.score(docs(odd_texts), none).collect()} == {0.5}
    ones = quality.fit(docs(odd_texts), spark.createDataFrame([(4, 1, 0, "x"), (6, 1, 0, "x")], LABELS))
    assert all(r["score"] > 0.5 for r in quality.score(docs(odd_texts), ones).collect())


def truth(page):
    nodes = parse(page, MARK)
    return " ".join(t for t, y in zip(nodes.text, nodes.truth, strict=True) if y)


def test_extraction_of_unseen_templates():
    unseen = pages(150, 1234)
    found = list(html_extract.main_texts([p.replace(MARK, "") for p in unseen], html_extract.trained()))
    assert np.mean([a == truth(p) for a, p in zip(found, unseen, strict=True)]) > 0.8


def test_extraction_of_pages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in html_extract.extract(table).collect()}
    for r in table.collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        assert texts[r["page_id"]] == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())


def test_extraction_of_odd_pages(spark):
    odd = [None, "", "no markup at all", "<", "<p", "<!--", "<script>x", "<article><p>a &amp; b&nbsp;c<p>d", "</p></div>", "<table><td>x<td>y", "&#x110000; &bogus; <3", "<p>" * 3000 + "x",
           "<div>" * 3000 + "deep", '<a href="x>y">z</a>', "<article>" + "w " * 200_000 + "</article>", "<nav><a>m</a></nav>"]
    rows = spark.createDataFrame([(i % 9, "u", h, "t") for i, h in enumerate(odd)], "page_id long, url string, html string, text string")
    found = html_extract.extract(rows).collect()
    assert len(found) == len(odd) and all(r["text"] is not None and r["text"] == " ".join(r["text"].split()) for r in found)
    by_text = {r["text"] for r in found}
    assert "a & b c d" in by_text and "w " * 199_999 + "w" in by_text
    assert html_extract.extract(rows.limit(0)).count() == 0


@pytest.mark.parametrize("attribute", ["data-x='<p>Ad</p>'", 'title="' + "<b>x</b> > " * 20 + '"', "data-x = '{\"a\": \"<p>b</p>\"}'", "a=\"it's > 1\" b='\">' c=d\"e", 'x=a\'b y="" z', 'alt="never closed'])
def test_greater_than_signs_in_attributes(attribute):
    assert [t for t in parse(f"<div {attribute}>One <i {attribute}>two</i></div><p>three").text if t] == ["One two", "three"] or attribute.startswith("alt")
    assert [t for t in parse(f"<div {attribute}>One").text if t] == ["One"]


def test_decoding_has_no_kept_node_below_a_dropped_one():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = 60
        parent = np.array([-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        kept = html_extract.decode(parent, depth, rng.standard_normal(n))
        assert all(kept[parent[i]] for i in range(1, n) if kept[i])


def test_decoding_is_optimal():
    parent, depth = np.array([-1, 0, 1, 1, 0]), np.array([0, 1, 2, 2, 1])
    assert html_extract.decode(parent, depth, np.array([0, -1.0, 3, -2, -1])).tolist() == [True, True, True, False, False]
    assert html_extract.decode(parent, depth, np.array([0, -4.0, 3, -2, 1])).tolist() == [True, False, False, False, True]


def small_network():
    shape = gru.Shape(symbols=12, members=4, embedding=3, hidden=5)
    return shape, gru.initial(shape, np.arange(12.0), 1)


def test_probabilities_sum_to_one():
    _, w = small_network()
    total = sum(math.exp(gru.log_likelihoods(w, [np.array([a, b], np.uint16)], 4)[0]) for a in range(12) for b in range(12))
    assert total == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows_and_lanes():
    _, w = small_network()
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 12, n).astype(np.uint16) for n in (0, 1, 7, 30, 100, 3)]
    whole = gru.log_likelihoods(w, sequences, 4, lanes=8, steps=1000)
    assert gru.log_likelihoods(w, sequences, 4, lanes=2, steps=7) == pytest.approx(whole, rel=1e-4, abs=1e-6)


def test_log_softmax_of_far_apart_numbers():
    for spread in (1.0, 50.0, 3000.0):
        x = (np.random.default_rng(3).standard_normal((40, 7)) * spread).astype(np.float32)
        exact = x.astype(np.float64) - x.max(axis=1, keepdims=True)
        exact -= np.log(np.exp(exact).sum(axis=1, keepdims=True))
        assert gru.log_softmax(x.copy()) == pytest.approx(exact, rel=1e-4, abs=1e-4)
    assert gru.log_softmax(np.empty((0, 7), np.float32)).shape == (0, 7)


def test_gradients_against_differences():
    _, w = small_network()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rng = np.random.default_rng(1)
    h, y = rng.standard_normal((6, 5)), rng.integers(0, 12, 6)
    g = {k: np.zeros_like(v) for k, v in w.items()}
    _, dh = gru.output(w, h, y, g)
    loss = lambda: -gru.output(w, h, y)[0].mean()
    for k in ("class", "member", "class_bias", "member_bias"):
        at = tuple(rng.integers(0, n) for n in w[k].shape)
        w[k][at] += 1e-5
        up = loss()
        w[k][at] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[k][at], abs=1e-5)
        w[k][at] += 1e-5
    assert dh.shape == h.shape


def test_gradients_through_time_against_differences():
    """Of every weight, over a window of lanes of different lengths that starts from a state."""
    _, w = small_network()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rng = np.random.default_rng(2)
    n, hidden = np.array([7, 4, 1]), w["state"].shape[0]
    x, y = rng.integers(0, 12, (2, 7, 3))
    h = rng.standard_normal((3, hidden))
    g, last = gru.window_gradients(w, x, y, n, h)
    valid = np.arange(7)[:, None] < n

    def loss():
        states, _ = gru.run_states(w, w["embedding"] @ w["input"] + w["input_bias"], x, h, False)
        return -gru.output(w, states[valid], y[valid])[0].mean()

    assert set(g) == set(w) and last.shape == h.shape
    for k in w:
        for _ in range(6):
            at = tuple(rng.integers(0, m) for m in w[k].shape)
            w[k][at] += 1e-5
            up = loss()
            w[k][at] -= 2e-5
            assert (up - loss()) / 2e-5 == pytest.approx(g[k][at], abs=1e-6), k
            w[k][at] += 1e-5


def test_windows_use_the_same_arrays_again():
    """Results are those of fresh arrays, and a later window, also a smaller one, gets no large ones."""
    shape = gru.Shape()
    w = gru.initial(shape, np.ones(shape.symbols), 1)
    rng = np.random.default_rng(5)
    sequences = [rng.integers(0, shape.symbols, n).astype(np.uint16) for n in (300, 40, *[200] * 60)]
    scratch, peaks = gru.Scratch(), []
    for lane, _, _, x, y, n in gru.windows(sequences, 64, 100, shape.members):
        h = rng.standard_normal((len(lane), shape.hidden)).astype(np.float32)
        tracemalloc.start()
        g, last = gru.window_gradients(w, x, y, n, h, scratch)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        fresh, fresh_last = gru.window_gradients(w, x, y, n, h)
        assert all(np.array_equal(g[k], fresh[k]) for k in w) and np.array_equal(last, fresh_last)
    assert len(peaks) == 3 and max(peaks[1:]) < peaks[0] / 4


def test_windows_hold_each_symbol_once():
    rng = np.random.default_rng(6)
    sequences = [rng.integers(0, 12, n).astype(np.uint16) for n in (5, 0, 17, 1, 8, 8)]
    inputs, targets = [[] for _ in sequences], [[] for _ in sequences]
    for lane, seq, at, x, y, n in gru.windows(sequences, 2, 4, 4):
        for k, i in enumerate(seq):
            assert at[k] == len(targets[i]) and (x[n[k]:, k] == 4).all() and (y[n[k]:, k] == 4).all()
            inputs[i] += x[:n[k], k].tolist()
            targets[i] += y[:n[k], k].tolist()
    assert targets == [s.tolist() for s in sequences]
    assert inputs == [[4, *s.tolist()][:len(s)] for s in sequences]
    assert list(gru.windows([], 2, 4, 4)) == []


def test_training_lowers_the_loss():
    shape, w = small_network()
    sequences = [np.tile(np.array([1, 5, 9], np.uint16), 30) for _ in range(20)]
    trained, n = gru.train(w, sequences, 4, lanes=4, steps=8, rate=0.02)
    assert n == sum(map(len, sequences))
    assert gru.log_likelihoods(trained, sequences, 4).sum() > 0.5 * gru.log_likelihoods(w, sequences, 4).sum()


def test_words_of_any_bytes():
    rng = np.random.default_rng(7)
    pieces = [bytes([i]) for i in range(256)] + [b" ", b"\n", b"\x0b", b"Zz", b".", b",", "é".encode()] * 12
    texts = [None, b"", b" ", b" A  b\tC ", b"\xff\xfe.", b"\x00 \x1c\x1f \x85\xa0", *(b"".join(pieces[i] for i in rng.integers(0, len(pieces), n)) for n in range(90))]
    for some in (texts, texts[:1], []):
        words, starts = lm_scoring.words_of(pa.array(some, pa.binary()))
        words = words.view(pa.binary()).to_pylist()
        assert [words[a:b] for a, b in zip(starts, starts[1:], strict=False)] == [(t or b"").lower().split() for t in some]
    sliced = pa.array([b"x", *(w for t in texts for w in (t or b"").split())], pa.binary())[1:]
    looks = [16 * (not t.isascii()) + 4 * {b".": 1, b",": 2}.get(t[-1:], 3 * (t[-1:] < b"0")) + min(3, len(t) // 4) for t in sliced.to_pylist()]
    assert lm_scoring.buckets_of(sliced, 32).tolist() == looks and lm_scoring.buckets_of(sliced, 5).tolist() == [x % 5 for x in looks]


@pytest.mark.parametrize("head", [200_000, 3])
def test_lm_scores_of_odd_rows(docs, odd_texts, head):
    rows = lm_scoring.score_texts(docs(odd_texts), settings=lm_scoring.Settings(head=head)).collect()
    assert len(rows) == len(odd_texts)
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in odd_texts]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for i, ws in tokens)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert len({(r["n_tokens"], r["score"]) for r in rows if r["doc_id"] == 5}) == 1


def test_network_learns_from_every_training_text(spark):
    """Each text repeats a symbol of its own, whose embedding moves if the text is learned from."""
    s = lm_scoring.Settings()
    rows = [(i, True, np.full(20 + 3 * i, s.end + 1 + i, np.uint16).tobytes()) for i in range(60)]
    counts = np.ones(s.shape.symbols)
    weights = lm_scoring.learned(spark.createDataFrame(rows, "row_id long, trains boolean, symbols binary"), SimpleNamespace(symbol_counts=counts), s)
    moved = np.abs(weights["embedding"] - gru.initial(s.shape, counts, s.seed)["embedding"]).max(axis=1) > 1e-4
    assert moved[s.end + 1:s.end + 61].all()
    assert not moved[s.end + 61:].any()


def test_lm_scores_without_training_texts(docs):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = lm_scoring.score_texts(docs([(i, "a b") for i in held])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows) and len(rows) == len(held)
    assert lm_scoring.score_texts(docs([])).count() == 0
