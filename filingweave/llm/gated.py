"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Words are numbered by frequency. The first ``CLASSES * MEMBERS`` are predicted one by one, as class times
member of the class; all others are the tail, one more class, whose members keep their corpus shares.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np

CLASSES, MEMBERS = 64, 64
HEAD = CLASSES * MEMBERS
#: Number of a word of the tail, as input and as target.
TAIL = HEAD
UNITS = 16
#: Numbers of words and classes: numpy sorts short ones by their digits.
_SHORT = np.min_scalar_type(HEAD)

Weights = dict[str, np.ndarray]


def fresh(counts: np.ndarray, tail: float, seed: int = 1) -> Weights:
    """Small random weights; the biases start at the corpus shares (``counts`` of the head, in order)."""
    rng = np.random.default_rng(seed)

    def small(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.1, shape).astype(np.float32)

    share = np.full(HEAD, 1e-9)
    share[: len(counts)] = counts
    by_class = share.reshape(CLASSES, MEMBERS)
    totals = np.append(by_class.sum(axis=1), max(tail, 1e-9))
    return {
        "input": small(HEAD + 1, 3 * UNITS),
        "state": small(UNITS, 3 * UNITS),
        "gate": np.zeros(3 * UNITS, np.float32),
        "class": small(UNITS, CLASSES + 1),
        "class_bias": np.log(totals / totals.sum()).astype(np.float32),
        "member": small(CLASSES, UNITS, MEMBERS),
        "member_bias": np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32),
    }


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def shaped(values: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


class Steps:
    """The recurrent layer over a window: steps by streams. Keeps what going back needs."""

    def __init__(self, w: Weights):
        self.w = w

    def run(self, words: np.ndarray, fresh_start: np.ndarray, state: np.ndarray) -> np.ndarray:
        """States after each step; ``fresh_start`` marks inputs in front of which the state is emptied."""
        w, n = self.w, UNITS
        steps, streams = words.shape
        inputs = w["input"][words] + w["gate"]
        self.before = np.empty((steps, streams, n), np.float32)
        self.gates = np.empty((steps, streams, 2 * n), np.float32)
        self.new = np.empty((steps, streams, n), np.float32)
        self.inner = np.empty((steps, streams, n), np.float32)
        out = np.empty((steps, streams, n), np.float32)
        keep = (~fresh_start).astype(np.float32)[:, :, None]
        recurrent = w["state"]
        for t in range(steps):
            h = np.multiply(state, keep[t], out=self.before[t])
            a = h @ recurrent
            x = inputs[t]
            g = self.gates[t]
            np.add(x[:, : 2 * n], a[:, : 2 * n], out=g)
            g *= 0.5
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            self.inner[t] = a[:, 2 * n :]
            new = self.new[t]
            np.multiply(g[:, n:], self.inner[t], out=new)
            new += x[:, 2 * n :]
            np.tanh(new, out=new)
            state = out[t]
            np.subtract(h, new, out=state)
            state *= g[:, :n]
            state += new
        self.keep = keep
        return out

    def back(self, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gates' inputs (steps by streams by 3 units) and of the recurrent weights."""
        n = UNITS
        steps, streams, _ = grad.shape
        z, r = self.gates[:, :, :n], self.gates[:, :, n:]
        slope_z = (self.before - self.new) * z * (1 - z)
        slope_n = (1 - z) * (1 - self.new * self.new)
        slope_r = self.inner * r * (1 - r)
        d_in = np.empty((steps, streams, 3 * n), np.float32)
        d_rec = np.empty((steps, streams, 3 * n), np.float32)
        back = np.ascontiguousarray(self.w["state"].T)
        carried = np.zeros((streams, n), np.float32)
        for t in range(steps - 1, -1, -1):
            dh = grad[t] + carried
            di, dr = d_in[t], d_rec[t]
            np.multiply(dh, slope_z[t], out=di[:, :n])
            dn = np.multiply(dh, slope_n[t], out=di[:, 2 * n :])
            np.multiply(dn, slope_r[t], out=di[:, n : 2 * n])
            dr[:, : 2 * n] = di[:, : 2 * n]
            np.multiply(dn, r[t], out=dr[:, 2 * n :])
            dh *= z[t]
            dh += dr @ back
            carried = dh * self.keep[t]
        rows = steps * streams
        return d_in, self.before.reshape(rows, n).T @ d_rec.reshape(rows, 3 * n)


def _by_class(targets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each class of the head, tail left out."""
    classes = (targets // MEMBERS).astype(_SHORT)
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if ends[c] < ends[c + 1]:
            yield c, order[ends[c] : ends[c + 1]]


def log_likelihood(w: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each target (of the tail as a whole)."""
    logits = states @ w["class"]
    logits += w["class_bias"]
    rows = np.arange(len(targets))
    own = logits[rows, targets // MEMBERS]
    np.exp(logits, out=logits)
    out = own - np.log(logits.sum(axis=1))
    for c, at in _by_class(targets):
        inner = states[at] @ w["member"][c]
        inner += w["member_bias"][c]
        own = inner[np.arange(len(at)), targets[at] % MEMBERS]
        np.exp(inner, out=inner)
        out[at] += own - np.log(inner.sum(axis=1))
    return out


def output_gradients(w: Weights, states: np.ndarray, targets: np.ndarray, grads: Weights) -> np.ndarray:
    """Gradient of the mean loss with respect to the states; the output weights' go into ``grads``."""
    n = len(targets)
    logits = states @ w["class"]
    logits += w["class_bias"]
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    logits[np.arange(n), targets // MEMBERS] -= 1
    logits *= 1 / n
    grads["class"] = states.T @ logits
    grads["class_bias"] = logits.sum(axis=0)
    back = logits @ w["class"].T
    grads["member"] = np.zeros_like(w["member"])
    grads["member_bias"] = np.zeros_like(w["member_bias"])
    for c, at in _by_class(targets):
        own = states[at]
        inner = own @ w["member"][c]
        inner += w["member_bias"][c]
        np.exp(inner, out=inner)
        inner /= inner.sum(axis=1, keepdims=True)
        inner[np.arange(len(at)), targets[at] % MEMBERS] -= 1
        inner *= 1 / n
        grads["member"][c] = own.T @ inner
        grads["member_bias"][c] = inner.sum(axis=0)
        back[at] += inner @ w["member"][c].T
    return back


def summed_by_word(words: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words.astype(_SHORT), kind="stable")
    ordered = words[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[starts], np.add.reduceat(grad[order], starts, axis=0)


class Learner:
    """Adam over windows of streams; the input table is updated where words occur."""

    def __init__(self, weights: Weights, rate: float):
        self.w, self.rate = weights, rate
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}
        self.updates = 0

    def window(self, words: np.ndarray, targets: np.ndarray, fresh_start: np.ndarray, state: np.ndarray) -> np.ndarray:
        """One update; returns the state to carry on with. Targets below 0 do not count."""
        steps = Steps(self.w)
        states = steps.run(words, fresh_start, state)
        rows = states.reshape(-1, UNITS)
        wanted = targets.ravel()
        grads: Weights = {}
        if (wanted < 0).any():
            real = np.flatnonzero(wanted >= 0)
            back = np.zeros_like(rows)
            back[real] = output_gradients(self.w, rows[real], wanted[real], grads)
        else:
            back = output_gradients(self.w, rows, wanted, grads)
        d_in, grads["state"] = steps.back(back.reshape(states.shape))
        d_in = d_in.reshape(-1, 3 * UNITS)
        grads["gate"] = d_in.sum(axis=0)
        found, summed = summed_by_word(words.ravel(), d_in)
        self.updates += 1
        self._step("input", summed, found)
        for name, grad in grads.items():
            self._step(name, grad, slice(None))
        return states[-1].copy()

    def _step(self, name: str, grad: np.ndarray, at) -> None:
        mean = self.mean[name][at] * 0.9 + 0.1 * grad
        square = self.square[name][at] * 0.99 + 0.01 * grad * grad
        self.mean[name][at], self.square[name][at] = mean, square
        even = np.sqrt(1 - 0.99 ** min(self.updates, 2000)) / (1 - 0.9 ** min(self.updates, 2000))
        self.w[name][at] -= self.rate * even * mean / (np.sqrt(square) + 1e-7)


def learn(learner: Learner, texts: Sequence[np.ndarray], end: int, window: int = 32, streams: int = 512) -> int:
    """One pass over the texts (numbers, each closed by ``end``), laid side by side in equal streams.

    State is carried from window to window and emptied at each text's start; gradients stop at the window.
    """
    if not texts:
        return 0
    line = np.concatenate(texts)
    streams = max(1, min(streams, len(line) // (64 * window)))  # little text: fewer streams, not fewer updates
    length = -(-len(line) // streams)
    targets = np.full(length * streams, -1, np.int64)
    targets[: len(line)] = line
    words = np.full(length * streams, end, np.int64)
    words[1 : len(line)] = line[:-1]
    targets, words = (np.ascontiguousarray(x.reshape(streams, length).T) for x in (targets, words))
    state = np.zeros((streams, UNITS), np.float32)
    for at in range(0, length, window):
        part = slice(at, at + window)
        state = learner.window(words[part], targets[part], words[part] == end, state)
    return len(line)


def scores(w: Weights, texts: Sequence[np.ndarray], end: int, window: int = 32, streams: int = 512) -> np.ndarray:
    """Log-likelihood of each whole text. Long texts pass through window after window, their state carried."""
    out = np.zeros(len(texts))
    if not texts:
        return out
    streams = min(streams, len(texts))
    lines: list[list[int]] = [[] for _ in range(streams)]
    heap = [(0, s) for s in range(streams)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        length, s = heapq.heappop(heap)
        lines[s].append(i)
        heapq.heappush(heap, (length + len(texts[i]), s))
    lengths = sorted(((length, s) for length, s in heap), reverse=True)
    longest = lengths[0][0]
    targets = np.full((streams, longest), -1, np.int32)
    owner = np.zeros((streams, longest), np.int32)
    for row, (_, s) in enumerate(lengths):
        at = 0
        for i in lines[s]:
            targets[row, at : at + len(texts[i])] = texts[i]
            owner[row, at : at + len(texts[i])] = i
            at += len(texts[i])
    words = np.full_like(targets, end)
    words[:, 1:] = targets[:, :-1]
    words[words < 0] = end
    sizes = np.array([length for length, _ in lengths])
    state = np.zeros((streams, UNITS), np.float32)
    for at in range(0, longest, window):
        open_ = int(np.searchsorted(-sizes, -at))  # streams that reach beyond this place come first
        part = (slice(0, open_), slice(at, at + window))
        now = np.ascontiguousarray(words[part].T)
        states = Steps(w).run(now, now == end, state[:open_])
        state = states[-1]
        wanted = targets[part].T.ravel()
        real = np.flatnonzero(wanted >= 0)
        ll = log_likelihood(w, states.reshape(-1, UNITS)[real], wanted[real])
        out += np.bincount(owner[part].T.ravel()[real], weights=ll, minlength=len(texts))
    return out
