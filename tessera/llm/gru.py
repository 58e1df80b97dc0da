"""A gated recurrent network over symbol sequences, in numpy.

Symbols are numbered so that ``members`` of them in a row form a class; the output is a
softmax over classes times a softmax over the members of the class. Sequences run side by
side in lanes: a window takes the next symbols of each lane's sequence, the state is
carried from window to window, and a lane whose sequence has ended starts the next one
with a zero state. The first input of a sequence is its end symbol.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

Weights = dict[str, np.ndarray]
#: Rows of logits, and weights, that are handled at once, so that they stay in the processor's cache; no result depends on it.
AT_ONCE, WEIGHTS_AT_ONCE = 2048, 8192


@dataclass(frozen=True)
class Shape:
    symbols: int = 1024
    members: int = 32
    embedding: int = 16
    hidden: int = 24

    @property
    def classes(self) -> int:
        return self.symbols // self.members


def initial(shape: Shape, counts: np.ndarray, seed: int) -> Weights:
    """Small random weights; output biases give the symbols' smoothed frequencies."""
    rng, s = np.random.default_rng(seed), shape
    share = (counts + 0.5) / (counts + 0.5).sum()
    by_class = share.reshape(s.classes, s.members)

    def small(*size: int) -> np.ndarray:
        return (rng.standard_normal(size) / np.sqrt(size[0])).astype(np.float32)

    return {"embedding": small(s.symbols, s.embedding) * np.float32(np.sqrt(s.symbols) * 0.3), "input": small(s.embedding, 3 * s.hidden), "input_bias": np.zeros(3 * s.hidden, np.float32),
            "state": small(s.hidden, 3 * s.hidden), "class": small(s.hidden, s.classes) * np.float32(0.1), "class_bias": np.log(by_class.sum(axis=1)).astype(np.float32),
            "member": np.stack([small(s.hidden, s.members) * np.float32(0.1) for _ in range(s.classes)]),
            "member_bias": np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32)}


def flat(w: Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def views(v: np.ndarray, like: Weights) -> Weights:
    """The weights that lie in ``v`` as ``flat`` puts them there."""
    parts, at = {}, 0
    for k in sorted(like):
        parts[k] = v[at:at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return {k: parts[k] for k in like}


def unflat(v: np.ndarray, like: Weights) -> Weights:
    parts = views(v, like)
    return {k: parts[k].astype(np.float32) for k in sorted(like)}


class Scratch(dict):
    """Arrays by name that one window after the other writes into: to get fresh pages for each takes longer than the
    arithmetic. What is in one holds until the next call with the same scratch."""

    def array(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size = math.prod(shape)
        if name not in self or self[name].size < size or self[name].dtype != dtype:
            self[name] = np.empty(size, dtype)
        return self[name][:size].reshape(shape)


def ordered(numbers: np.ndarray, below: int) -> np.ndarray:
    """Stable order of numbers from 0 up to ``below``, in the smallest type that holds them: short ones are sorted by their digits."""
    return np.argsort(numbers.astype(np.min_scalar_type(max(below - 1, 0))), kind="stable")


def windows(sequences: list[np.ndarray], lanes: int, steps: int, end: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(lane numbers, sequence numbers, starts, inputs, targets, lengths): inputs and targets are (step, lane).

    Sequences begin longest first, so that lanes run out together; lanes without a
    sequence are left out.
    """
    size = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    # All sequences in a row with the end before each: inputs start there, targets one further.
    row = np.concatenate([x for s in sequences for x in (np.array([end], s.dtype), s)] or [np.empty(0, np.int64)])
    first = np.cumsum(size + 1) - size - 1
    taken = min(lanes, len(order))
    lane, seq, at = np.arange(taken), order[:taken], np.zeros(taken, np.int64)
    while len(lane):
        n = np.minimum(steps, size[seq] - at)
        t = np.arange(int(n.max()))[:, None]
        where = first[seq] + at + t
        x, y = row.take(where, mode="clip").astype(np.int64), row.take(where + 1, mode="clip").astype(np.int64)
        if n.min() < len(t):
            x[t >= n] = y[t >= n] = end
        yield lane, seq, at, x, y, n
        at = at + n
        for k in np.flatnonzero(at >= size[seq]):
            if taken < len(order):
                seq[k], at[k] = order[taken], 0
                taken += 1
        on = at < size[seq]
        lane, seq, at = lane[on], seq[on].copy(), at[on]


def run_states(w: Weights, table: np.ndarray, x: np.ndarray, h: np.ndarray, keep: bool, scratch: Scratch | None = None) -> tuple[np.ndarray, tuple | None]:
    """States after each step (step, lane, hidden); with ``keep`` what backpropagation needs: states before each
    step, update and reset gates, candidates, and what the reset gates act on."""
    scratch = Scratch() if scratch is None else scratch
    (lanes, hidden), steps, kept = h.shape, len(x), len(x) if keep else 1
    all_states = scratch.array("states", (steps + 1, lanes, hidden), h.dtype)
    gates = scratch.array("gates", (kept, 2, lanes, hidden), h.dtype)
    candidates, recurrent = (scratch.array(k, (kept, lanes, hidden), h.dtype) for k in ("candidates", "recurrent"))
    inputs, given = (scratch.array(k, (lanes, 3 * hidden), h.dtype) for k in ("inputs", "given"))
    gates_in, gates_given = (a.reshape(lanes, 3, hidden)[:, :2].swapaxes(0, 1) for a in (inputs, given))
    candidate_in, candidate_given = inputs[:, 2 * hidden:], given[:, 2 * hidden:]
    all_states[0] = h
    half, one = h.dtype.type(0.5), h.dtype.type(1)
    for t in range(steps):
        at = t if keep else 0
        gate, candidate, acted_on, before, h = gates[at], candidates[at], recurrent[at], all_states[t], all_states[t + 1]
        table.take(x[t], 0, inputs, "clip")
        np.matmul(before, w["state"], out=given)
        np.add(gates_in, gates_given, out=gate)
        gate *= half
        np.tanh(gate, out=gate)
        gate += one
        gate *= half
        acted_on[:] = candidate_given
        np.multiply(gate[1], acted_on, out=candidate)
        candidate += candidate_in
        np.tanh(candidate, out=candidate)
        np.subtract(before, candidate, out=h)
        h *= gate[0]
        h += candidate
    if not keep:
        return all_states[1:], None
    return all_states[1:], (all_states[:-1], gates[:, 0], gates[:, 1], candidates, recurrent)


def log_softmax(logits: np.ndarray, scratch: Scratch | None = None) -> np.ndarray:
    """In place. One number is subtracted from all rows where none of them could vanish by it, else each row's largest."""
    if not logits.size:
        return logits
    scratch = Scratch() if scratch is None else scratch
    top, ones = logits.max(), np.ones((logits.shape[1], 1), logits.dtype)
    near = top - logits.min() < 80
    for a in range(0, len(logits), AT_ONCE):
        some = logits[a:a + AT_ONCE]
        some -= top if near else some.max(axis=1, keepdims=True)
        powers = np.exp(some, out=scratch.array("powers", some.shape, some.dtype))
        some -= np.log(powers @ ones)  # a sum along short rows
    return logits


def output(w: Weights, h: np.ndarray, y: np.ndarray, gradients: Weights | None = None, scratch: Scratch | None = None) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Log-probability of each target (natural log); or, with ``gradients``, adds to these of the mean loss and returns that of h."""
    scratch = Scratch() if scratch is None else scratch
    classes, _, members = w["member"].shape
    order = ordered(y // members, classes)
    y = y[order]
    cls, member = y // members, y % members
    h = np.take(h, order, axis=0, out=scratch.array("ordered", h.shape, h.dtype), mode="clip")
    rows = np.arange(len(y))
    by_class = np.matmul(h, w["class"], out=scratch.array("by_class", (len(y), classes), h.dtype))
    by_class += w["class_bias"]
    log_softmax(by_class, scratch)
    starts = np.searchsorted(cls, np.arange(classes + 1)).tolist()
    parts = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(starts, starts[1:], strict=False)) if b > a]
    by_member = np.take(w["member_bias"], cls, axis=0, out=scratch.array("by_member", (len(y), members), h.dtype), mode="clip")
    for c, part in parts:
        by_member[part] += h[part] @ w["member"][c]
    log_softmax(by_member, scratch)
    if gradients is None:
        found = np.empty(len(y))
        found[order] = by_class[rows, cls].astype(np.float64) + by_member[rows, member]
        return found, None
    for logs, picked in ((by_class, cls), (by_member, member)):
        np.exp(logs, out=logs)
        logs[rows, picked] -= 1
        logs /= len(y)
    gradients["class"] += h.T @ by_class
    gradients["class_bias"] += np.ones(len(y), by_class.dtype) @ by_class
    dh = np.matmul(by_class, w["class"].T, out=scratch.array("d_ordered", h.shape, h.dtype))
    for c, part in parts:
        gradients["member"][c] += h[part].T @ by_member[part]
        dh[part] += by_member[part] @ w["member"][c].T
    filled = [c for c, _ in parts]
    gradients["member_bias"][filled] += np.add.reduceat(by_member, [part.start for _, part in parts], axis=0)
    back = scratch.array("d_output", h.shape, h.dtype)
    back[order] = dh
    return None, back


def log_likelihoods(w: Weights, sequences: list[np.ndarray], end: int, lanes: int = 768, steps: int = 64) -> np.ndarray:
    """Natural log-probability of each whole sequence."""
    total = np.zeros(len(sequences))
    table = w["embedding"] @ w["input"] + w["input_bias"]
    state, scratch = np.zeros((lanes, w["state"].shape[0]), np.float32), Scratch()
    for lane, seq, at, x, y, n in windows(sequences, lanes, steps, end):
        state[lane[at == 0]] = 0
        states, _ = run_states(w, table, x, state[lane], False, scratch)
        state[lane] = states[-1]  # of lanes whose sequence goes on; these fill the window
        valid = np.flatnonzero(np.arange(len(x))[:, None] < n)
        flat_states, flat_y = states.reshape(-1, states.shape[2]), y.ravel()
        if len(valid) < len(flat_y):
            flat_states = flat_states.take(valid, 0, scratch.array("valid", (len(valid), states.shape[2]), states.dtype), "clip")
            flat_y = flat_y[valid]
        found, _ = output(w, flat_states, flat_y, None, scratch)
        total += np.bincount(seq[valid % len(seq)], found, len(total))
    return total


def window_gradients(w: Weights, x: np.ndarray, y: np.ndarray, n: np.ndarray, h: np.ndarray, scratch: Scratch | None = None) -> tuple[Weights, np.ndarray]:
    """Gradients of the mean loss of a window (inputs and targets (step, lane), lengths) that starts from
    states ``h``, by backpropagation through its steps; and the states after it."""
    scratch = Scratch() if scratch is None else scratch
    hidden = h.shape[1]
    table = np.matmul(w["embedding"], w["input"], out=scratch.array("table", (len(w["embedding"]), 3 * hidden), h.dtype))
    table += w["input_bias"]
    states, (before, z, r, candidate, recurrent) = run_states(w, table, x, h, True, scratch)
    g_flat = scratch.array("gradients", (sum(a.size for a in w.values()),), h.dtype)
    g_flat.fill(0)
    g = views(g_flat, w)
    if n.min() == len(x):
        _, d_states = output(w, states.reshape(-1, hidden), y.ravel(), g, scratch)
        d_states = d_states.reshape(states.shape)
    else:
        valid = np.arange(len(x))[:, None] < n
        d_states = scratch.array("d_states", states.shape, states.dtype)
        d_states.fill(0)
        _, d_states[valid] = output(w, states[valid], y[valid], g, scratch)
    # Gradients of the three inputs of the gates and the candidate, and of what the state gives them: a step's gradient
    # of its state times factors, which are made for some steps at once.
    shape = (*x.shape, 3, hidden)
    d_input, d_state = (scratch.array(k, shape, h.dtype) for k in ("d_input", "d_state"))
    at_once = max(1, 384 // len(h))  # steps, so that what they need stays in the processor's cache
    back, dh = np.ascontiguousarray(w["state"].T), np.zeros_like(h)
    for start in reversed(range(0, len(x), at_once)):
        some = slice(start, min(len(x), start + at_once))
        to_z, to_r, to_candidate, to_recurrent, rest = scratch.array("factors", (5, some.stop - start, *h.shape), h.dtype)
        np.subtract(1, z[some], out=rest)
        np.multiply(candidate[some], candidate[some], out=to_candidate)
        np.subtract(1, to_candidate, out=to_candidate)
        to_candidate *= rest
        np.subtract(before[some], candidate[some], out=to_z)
        to_z *= z[some]
        to_z *= rest
        np.multiply(to_candidate, recurrent[some], out=to_r)
        to_r *= r[some]
        to_r *= np.subtract(1, r[some], out=rest)
        np.multiply(to_candidate, r[some], out=to_recurrent)
        for t in reversed(range(start, some.stop)):
            dh += d_states[t]
            k = t - start
            np.multiply(to_z[k], dh, out=d_input[t, :, 0])
            np.multiply(to_r[k], dh, out=d_input[t, :, 1])
            np.multiply(to_candidate[k], dh, out=d_input[t, :, 2])
            d_state[t, :, :2] = d_input[t, :, :2]
            np.multiply(to_recurrent[k], dh, out=d_state[t, :, 2])
            dh *= z[t]
            dh += d_state[t].reshape(-1, 3 * hidden) @ back
    flat_x, d_input, d_state = x.ravel(), d_input.reshape(-1, 3 * hidden), d_state.reshape(-1, 3 * hidden)
    g["state"] += before.reshape(-1, hidden).T @ d_state
    embedded = (len(flat_x), w["embedding"].shape[1])
    g["input"] += np.take(w["embedding"], flat_x, axis=0, out=scratch.array("embedded", embedded, h.dtype), mode="clip").T @ d_input
    g["input_bias"] += d_input.sum(axis=0)
    order = ordered(flat_x, len(w["embedding"]))
    sorted_x = flat_x[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_x[1:] != sorted_x[:-1])))
    d_embedded = np.matmul(d_input, w["input"].T, out=scratch.array("d_embedded", embedded, h.dtype))
    g["embedding"][sorted_x[first]] = np.add.reduceat(np.take(d_embedded, order, axis=0, out=scratch.array("embedded", embedded, h.dtype), mode="clip"), first)
    return g, states[-1]


def adam(w: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, step: int, rate: float, norm: float) -> None:
    """One Adam step, in place, some thousand weights at a time so that they stay in the processor's cache."""
    first, second = np.float32(rate / (1 - 0.9 ** step)), np.float32(1 - 0.99 ** step)
    for a in range(0, len(w), WEIGHTS_AT_ONCE):
        part = slice(a, a + WEIGHTS_AT_ONCE)
        now = g[part]
        if norm > 1:
            now /= np.float32(norm)
        change = now - m[part]
        change *= np.float32(0.1)
        m[part] += change
        np.multiply(now, now, out=change)
        change -= v[part]
        change *= np.float32(0.01)
        v[part] += change
        np.divide(v[part], second, out=change)
        np.sqrt(change, out=change)
        change += np.float32(1e-6)
        np.divide(first * m[part], change, out=change)
        w[part] -= change


def train(w: Weights, sequences: list[np.ndarray], end: int, lanes: int = 384, steps: int = 16, rate: float = 0.03) -> tuple[Weights, int]:
    """Truncated backpropagation through time: one Adam step a window. New weights, and symbols learned from.

    ``rate`` is that of windows of ``lanes`` x ``steps`` symbols. It falls with the square root where all windows
    are smaller, to a third at least, and in proportion in the last windows, which hold few sequences and tell little.
    """
    w_flat = flat(w)
    w, m, v, step, learned = views(w_flat, w), np.zeros_like(w_flat), np.zeros_like(w_flat), 0, 0
    state, scratch = np.zeros((lanes, w["state"].shape[0]), np.float32), Scratch()
    full = 0
    for lane, _, at, x, y, n in windows(sequences, lanes, steps, end):
        full = max(full, n.sum())
        size = rate * max(1 / 3, np.sqrt(full / (lanes * steps))) * n.sum() / full
        state[lane[at == 0]] = 0
        g, state[lane] = window_gradients(w, x, y, n, state[lane], scratch)
        step += 1
        learned += int(n.sum())
        norm = np.sqrt(sum(float(np.square(a, out=scratch.array("squares", a.shape, a.dtype)).sum()) for a in g.values()))
        adam(w_flat, scratch["gradients"], m, v, step, size, norm)
    return w, learned
