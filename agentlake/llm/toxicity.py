"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every word enters as a learned word vector next to the mean of its hashed character trigram
vectors, so unknown words still have a character input. Two gated recurrent layers read a
window from both ends, attention pools their states and a logistic output scores it. A text's
score is the highest of its windows at every word; training follows suit and learns from the
window of each labelled text that scores highest. Everything is numpy: training runs on a
bounded sample in the driver, scoring in Arrow batches on the executors.
"""

from __future__ import annotations

import math
import string
import threading
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm.native import own_columns

#: Words in a window; one begins at every word that has so many from it on. Windows scored at once.
LENGTH, SLIDE = 32, 4096
#: Windows side by side in a step's slice; how far log odds of ``slide`` may be from ``score``, by far.
LANES, CLOSE = 16, 1e-3
#: Bound of the training sample (rows of each class), of the learned vocabulary, sizes of the network.
SAMPLE, VOCABULARY, WORD_DIM, CHAR_DIM, BUCKETS, HIDDEN = (900, 2200), 12_000, 8, 8, 512, 8
EPOCHS, BATCH, SEED = 8, 96, 7
#: Words that are numbered and scored together, their plain forms have terms meanwhile; texts split together.
MEMO, SPLIT = 200_000, 256


def words_of(text: str | None) -> list[str]:
    return (text or "").split()


def plain(word: str) -> str:
    return word.strip(string.punctuation).lower()


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of ``<<word>`` for all words, and the number of each."""
    raw = [f"<<{w}>".encode("utf-8", "surrogatepass") for w in words]
    return _grams(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw], dtype=np.int64))


def _grams(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the bytes of words with their marks, the words' ends given."""
    b = np.concatenate([raw, np.zeros(2, np.uint8)]).astype(np.uint32)
    hashed = ((b[:-2] * 7919 + b[1:-1] * 104_729 + b[2:] * 1_299_709) % 65_521 % BUCKETS).astype(np.int64)
    keep = np.ones(len(hashed), dtype=bool)
    for back in (1, 2):  # the last two places of each word begin no trigram of their own
        keep[ends - back] = False
    return hashed[keep], np.diff(ends, prepend=0) - 2


def window_index(n: int) -> np.ndarray:
    """Positions (one row a window, -1 behind the end) of all windows over n words."""
    at = np.arange(max(1, n - LENGTH + 1))[:, None] + np.arange(LENGTH)
    return np.where(at < n, at, -1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(-x, 80)))


def _inverse(y: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(y)), in place."""
    np.exp(y, out=y)
    y += 1
    return np.reciprocal(y, out=y)


_rooms = threading.local()


def _room(name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
    """An array in memory that the thread's next call by this name uses again, aligned to cache
    lines: to get fresh pages from the system for every slice costs more than the work on them."""
    kept, size = _rooms.__dict__.setdefault("kept", {}), math.prod(shape) * dtype.itemsize
    if name not in kept or len(kept[name]) < size:
        raw = np.empty(size + 64, np.uint8)
        kept[name] = raw[-raw.ctypes.data % 64 :]
    return kept[name][:size].view(dtype).reshape(shape)


class Network:
    """Parameters, forward pass, gradients."""

    def __init__(self, vocabulary: dict[str, int], odds: np.ndarray, seed: int = SEED, dtype=np.float32):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(dtype)
        self.vocabulary = vocabulary  # word to row; row 0 stands for unknown words
        p = {"word": small(len(vocabulary) + 1, WORD_DIM) * 0.2, "char": small(BUCKETS, CHAR_DIM)}
        p["word"][1:, 0] = odds
        p["word"][0] = 0
        for d in "fb":
            p[f"W{d}"], p[f"U{d}"], p[f"b{d}"] = small(WORD_DIM + CHAR_DIM, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN), np.zeros(3 * HIDDEN, dtype)
        p["A"], p["a"], p["u"] = small(2 * HIDDEN, HIDDEN), np.zeros(HIDDEN, dtype), small(HIDDEN)
        p["w"], p["c"] = small(2 * HIDDEN), np.full(1, -1, dtype)
        self.p = p

    def features(self, words: list[str]) -> tuple[np.ndarray, list[int], tuple[np.ndarray, np.ndarray]]:
        """Input vectors of distinct words, with the rows they are made of."""
        rows, grams = [self.vocabulary.get(w, 0) for w in words], trigrams(words)
        return self.inputs(rows, *grams), rows, grams

    def inputs(self, rows: list[int] | np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Input vectors of words by their rows in the vocabulary and their trigrams."""
        chars = np.zeros((len(rows), CHAR_DIM), self.p["char"].dtype)
        if len(rows):
            chars = np.add.reduceat(self.p["char"][grams], np.cumsum(sizes) - sizes) / sizes[:, None]
        return np.concatenate([self.p["word"][rows], chars], axis=1).astype(self.p["char"].dtype)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Both directions' input terms of word vectors; a row of zeros at the end for padding."""
        out = np.concatenate([x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]], axis=1)
        return np.concatenate([out, np.zeros((1, out.shape[1]), out.dtype)])

    def _run(self, g: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction: g (steps, windows, 3 H) are its input terms."""
        steps, n, h = g.shape[0], g.shape[1], HIDDEN
        state, out, u = np.zeros((n, h), g.dtype), np.empty((steps, n, h), g.dtype), self.p[f"U{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            hu = state @ u
            zr = _sigmoid(g[t, :, : 2 * h] + hu[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[t, :, 2 * h :] + r * hu[:, 2 * h :])
            m = mask[t][:, None]
            nxt = state + m * (1 - z) * (new - state)
            if keep is not None:
                keep.append((t, state, hu[:, 2 * h :], z, r, new, m))
            state = out[t] = nxt
        return out

    def forward(self, terms: np.ndarray, at: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Probabilities of windows; ``at`` has rows of ``terms``, -1 for padding."""
        at = at.T
        mask = (at >= 0).astype(terms.dtype)
        g = terms[at]
        kf, kb = ([], []) if keep is not None else (None, None)
        s = np.concatenate([self._run(g[:, :, : 3 * HIDDEN], mask, "f", kf), self._run(g[:, :, 3 * HIDDEN :], mask, "b", kb)], axis=2)
        e = np.tanh(s @ self.p["A"] + self.p["a"])
        score = np.where(mask > 0, e @ self.p["u"], -1e9)
        weight = np.exp(score - score.max(axis=0)) * mask
        weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
        pool = (s * weight[:, :, None]).sum(axis=0)
        out = _sigmoid(pool @ self.p["w"] + self.p["c"])
        if keep is not None:
            keep.update(mask=mask, s=s, e=e, weight=weight, pool=pool, out=out, kf=kf, kb=kb, at=at)
        return out

    def slide(self, terms: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Log odds of the windows at every place of ``words`` (rows of ``terms``, ``LENGTH`` at
        least), within ``CLOSE`` of ``score``. Features are rows; column 16 k + l of them is place
        l n / 16 + k, so a step reads a slice that is as aligned as the arrays it is added to."""
        p, h, n = self.p, HIDDEN, len(words) - LENGTH + 1
        runs = -(-n // LANES)
        size, at = runs * LANES, np.arange(runs + LENGTH - 1)[:, None] + np.arange(LANES) * runs
        rows = words[np.minimum(at, len(words) - 1).ravel()]
        flat, x = _room("flat", (len(rows), terms.shape[1]), terms.dtype), _room("x", (2, 3 * h, len(rows)), terms.dtype)
        np.copyto(x.reshape(6 * h, -1), np.take(terms, rows, axis=0, out=flat, mode="clip").T)
        # Gates are (1 + tanh(y)) / 2 of half their input y; one less the update gate that of -y.
        x[:, :h] *= -0.5
        x[:, h : 2 * h] *= 0.5
        half = np.repeat(np.array([-0.5, 0.5, 0.5], x.dtype), h)[:, None]
        states, hu, e = (_room(k, shape, x.dtype) for k, shape in (("states", (LENGTH, 2 * h, size)), ("hu", (3 * h, size)), ("e", (h + 1, size))))
        gates, new = hu[: 2 * h], hu[2 * h :]
        score, value = (_room(k, (LENGTH, size), x.dtype) for k in ("score", "value"))
        a, bias = np.concatenate([p["A"].T, p["w"][None]]), p["a"][:, None]
        for k, d in enumerate("fb"):
            u, state = np.ascontiguousarray(p[f"U{d}"].T) * half, None
            for t in range(LENGTH) if d == "f" else range(LENGTH - 1, -1, -1):
                step, nxt = x[k, :, LANES * t : LANES * t + size], states[t, k * h : (k + 1) * h]
                if state is None:  # zeros: no reset gate
                    np.tanh(step[:h], out=gates[:h])
                    gates[:h] += 1
                    np.tanh(step[2 * h :], out=new)
                    new *= gates[:h]
                    state = np.multiply(new, 0.5, out=nxt)
                else:
                    np.matmul(u, state, out=hu)
                    gates += step[: 2 * h]
                    np.tanh(gates, out=gates)
                    gates += 1
                    new *= gates[h:]
                    new += step[2 * h :]
                    np.tanh(new, out=new)
                    new -= state
                    new *= gates[:h]
                    new *= 0.5
                    state = np.add(state, new, out=nxt)
                if d == "b":
                    np.matmul(a, states[t], out=e)
                    value[t] = e[h]
                    e[:h] += bias
                    np.matmul(p["u"], np.tanh(e[:h], out=e[:h]), out=score[t])
        score -= score.max(axis=0)
        np.exp(score, out=score)
        value *= score
        return (value.sum(axis=0) / score.sum(axis=0) + p["c"]).reshape(runs, LANES).T.ravel()[:n]

    def score(self, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log odds of whole windows, rows of ``at`` hold rows of ``terms``, of the probabilities ``forward`` has."""
        p, h, n = self.p, HIDDEN, len(at)
        # 1 - z, r and (1 - new) / 2 are all 1 / (1 + exp(y)) of y = the update gate's input, minus
        # the reset gate's, twice the candidate's.
        scale = np.repeat(np.array([1, -1, 2], terms.dtype), h)[:, None]
        g = np.ascontiguousarray(terms[at.T].transpose(0, 2, 1))
        states, score, value = np.empty((LENGTH, h, n), g.dtype), np.empty((LENGTH, n), g.dtype), np.empty((LENGTH, n), g.dtype)
        a, bias, u_e = np.ascontiguousarray(2 * p["A"].T), 2 * p["a"][:, None], p["u"]
        with np.errstate(over="ignore"):  # exp(y) may become infinite, its inverse is 0 then
            for d, x in (("f", g[:, : 3 * h]), ("b", g[:, 3 * h :])):
                u, state = np.ascontiguousarray(p[f"U{d}"].T) * scale, np.zeros((h, n), g.dtype)
                x *= scale
                for t in range(LENGTH) if d == "f" else range(LENGTH - 1, -1, -1):
                    hu = u @ state
                    gates = _inverse(hu[: 2 * h] + x[t, : 2 * h])
                    new = _inverse(gates[h:] * hu[2 * h :] + x[t, 2 * h :])
                    new *= -2
                    new += 1
                    new -= state
                    new *= gates[:h]
                    state += new
                    if d == "f":
                        states[t] = state
                    else:
                        e = a[:, :h] @ states[t]
                        e += a[:, h:] @ state
                        e += bias
                        score[t] = u_e.sum() - 2 * (u_e @ _inverse(e))
                        value[t] = p["w"][:h] @ states[t] + p["w"][h:] @ state
        weight = np.exp(score - score.max(axis=0))
        return (weight * value).sum(axis=0) / weight.sum(axis=0) + p["c"]

    def gradients(self, x: np.ndarray, rows: list[int], grams: tuple[np.ndarray, np.ndarray], at: np.ndarray, y: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted mean cross entropy."""
        p, k, h = self.p, {}, HIDDEN
        self.forward(self.project(x), at, k)
        g = {n: np.zeros_like(v) for n, v in p.items()}
        d_out = (k["out"] - y) * weights / max(weights.sum(), 1e-9)
        g["w"], g["c"] = k["pool"].T @ d_out, d_out.sum(keepdims=True)
        d_pool = d_out[:, None] * p["w"]
        d_weight = (k["s"] * d_pool).sum(axis=2)
        d_score = k["weight"] * (d_weight - (k["weight"] * d_weight).sum(axis=0))
        d_e = d_score[:, :, None] * p["u"] * (1 - k["e"] ** 2)
        g["u"] = (k["e"] * d_score[:, :, None]).sum(axis=(0, 1))
        g["A"], g["a"] = np.einsum("tni,tnj->ij", k["s"], d_e), d_e.sum(axis=(0, 1))
        d_s = k["weight"][:, :, None] * d_pool + d_e @ p["A"].T
        d_x = np.zeros((len(x) + 1, x.shape[1]), x.dtype)
        for d, kept, part in (("f", k["kf"], d_s[:, :, :h]), ("b", k["kb"], d_s[:, :, h:])):
            d_state = np.zeros((at.shape[0], h), x.dtype)
            u, w = p[f"U{d}"], p[f"W{d}"]
            for t, state, hun, z, r, new, m in reversed(kept):
                d_next = d_state + part[t]
                d_new = d_next * m * (1 - z) * (1 - new**2)
                d_z = -d_next * m * (new - state) * z * (1 - z)
                d_r = d_new * hun * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_g = np.concatenate([d_z, d_r, d_new], axis=1)
                g[f"U{d}"] += state.T @ d_hu
                g[f"b{d}"] += d_g.sum(axis=0)
                g[f"W{d}"] += np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])[k["at"][t]].T @ (d_g * m)
                np.add.at(d_x, k["at"][t], (d_g * m) @ w.T)
                d_state = d_next * (1 - m * (1 - z)) + d_hu @ u.T
        d_x = d_x[:-1]
        np.add.at(g["word"], rows, d_x[:, :WORD_DIM])
        g["word"][0] = 0
        np.add.at(g["char"], grams[0], np.repeat(d_x[:, WORD_DIM:] / grams[1][:, None], grams[1], axis=0))
        return g


def _numbered(texts: list[list[str]]) -> tuple[list[str], list[np.ndarray]]:
    known: dict[str, int] = {}
    at = [np.array([known.setdefault(w, len(known)) for w in t], dtype=np.int64) for t in texts]
    return list(known), at


def _window(a: np.ndarray, begin: int) -> np.ndarray:
    """The window of word numbers ``a`` that begins there, -1 behind the end."""
    a = a[begin : begin + LENGTH]
    return np.concatenate([a, np.full(LENGTH - len(a), -1)])


def _highest(net: Network, terms: np.ndarray, at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Highest score of each text and where the first window that has it begins."""
    out, begin = np.empty(len(at), terms.dtype), np.zeros(len(at), np.int64)
    short, long = [i for i, a in enumerate(at) if len(a) <= LENGTH], [i for i, a in enumerate(at) if len(a) > LENGTH]
    for k in range(0, len(short), 4096):
        some = short[k : k + 4096]
        out[some] = net.forward(terms, np.stack([_window(at[i], 0) for i in some]))
    if long:
        line, first, near = np.concatenate([at[i] for i in long]), 0, []  # windows across two texts are passed over below
        p = np.concatenate([net.slide(terms, line[k : k + SLIDE + LENGTH - 1]) for k in range(0, len(line) - LENGTH + 1, SLIDE)])
        for i in long:
            own = p[first : first + len(at[i]) - LENGTH + 1]
            near.append(first + np.flatnonzero(_sigmoid(own + CLOSE) >= _sigmoid(own.max() - CLOSE)))  # also what rounds to the same
            first += len(at[i])
        places = np.concatenate(near)
        p = _sigmoid(np.concatenate([net.score(terms, line[places[k : k + 1024, None] + np.arange(LENGTH)]) for k in range(0, len(places), 1024)]))
        first = used = 0
        for i, some in zip(long, near, strict=True):
            own = p[used : used + len(some)]
            best = own.argmax()
            out[i], begin[i] = own[best], some[best] - first
            first, used = first + len(at[i]), used + len(some)
    return out, begin


def _suspicious(odds: np.ndarray) -> int:
    """Where the window begins that has the largest sum of three words' odds."""
    if len(odds) <= LENGTH:
        return 0
    return int(np.partition(np.lib.stride_tricks.sliding_window_view(odds, LENGTH), LENGTH - 3, axis=1)[:, -3:].sum(axis=1).argmax())


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> Network | float:
    """A network for labelled texts; with one class only, the constant score of that class."""
    y = np.array(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.0
    split = [[plain(w) for w in words_of(t)] for t in texts]
    found, n_toxic = Counter(), Counter()
    for t, label in zip(split, labels, strict=True):
        found.update(set(t))
        if label:
            n_toxic.update(set(t))
    vocabulary = {w: i + 1 for i, (w, _) in enumerate(sorted(((w, c) for w, c in found.items() if c >= 3), key=lambda x: (-x[1], x[0]))[:VOCABULARY])}
    prior = y.mean()
    rate = np.array([(n_toxic[w] + 4 * prior) / (found[w] + 4) for w in vocabulary], dtype=np.float32)
    net = Network(vocabulary, np.log(rate / (1 - rate)) - np.log(prior / (1 - prior)))
    words, at = _numbered(split)
    weights = np.where(y > 0, 0.5 / prior, 0.5 / (1 - prior)).astype(np.float32)
    moment, square, step = {n: np.zeros_like(v) for n, v in net.p.items()}, {n: np.zeros_like(v) for n, v in net.p.items()}, 0
    rng = np.random.default_rng(SEED)
    odds = net.p["word"][[vocabulary.get(w, 0) for w in words], 0]
    begins = np.array([_suspicious(odds[a]) for a in at])  # to begin with: the most suspicious words
    _, rows_of_all, grams_of_all = net.features(words)
    for epoch in range(epochs):
        if epoch:
            begins = _highest(net, net.project(net.inputs(rows_of_all, *grams_of_all)), at)[1]
        shuffled = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            pick = shuffled[i : i + BATCH]
            some = np.stack([_window(at[j], begins[j]) for j in pick])
            used = np.unique(some[some >= 0])
            local = np.where(some >= 0, np.searchsorted(used, some), -1)
            if not len(used):
                continue
            x, rows, grams = net.features([words[j] for j in used])
            step += 1
            for n, g in net.gradients(x, rows, grams, local, y[pick], weights[pick]).items():
                moment[n] = 0.9 * moment[n] + 0.1 * g
                square[n] = 0.99 * square[n] + 0.01 * g * g
                net.p[n] -= (0.02 * (moment[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.99**step)) + 1e-7)).astype(net.p[n].dtype)
    return net


class Scorer:
    """Scores of whole texts, ``MEMO`` words or a longer text at a time."""

    def __init__(self, model: Network | float):
        self.model = model
        if not isinstance(model, float):
            self.words = pa.array(model.vocabulary, pa.large_string())
            self.rows = np.array([*model.vocabulary.values(), 0])
            self.terms = model.project(model.features([])[0])
            self.empty = float(model.forward(self.terms, np.full((1, LENGTH), -1))[0])

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``terms`` for the words of each text; the terms are those of these texts alone."""
        return self._numbers(pa.array([w for t in texts for w in t], pa.large_string()), np.array([len(t) for t in texts]))

    def _numbers(self, words: pa.Array, sizes: np.ndarray) -> list[np.ndarray]:
        coded = pc.ascii_trim(words, characters=string.punctuation).dictionary_encode()
        forms = coded.dictionary
        odd = pc.invert(pc.string_is_ascii(forms))  # ``plain`` has more rules for other letters
        forms = pc.replace_with_mask(pc.ascii_lower(forms), odd, pa.array([w.lower() for w in forms.filter(odd).to_numpy(zero_copy_only=False)], forms.type)).dictionary_encode()
        begin, end, between = (pa.scalar(m, words.type) for m in ("<<", ">", ""))
        marked = pc.binary_join_element_wise(begin, forms.dictionary, end, between)
        ends = np.frombuffer(marked.buffers()[1], np.int64)[1 : len(marked) + 1]
        raw = np.frombuffer(marked.buffers()[2], np.uint8)[: ends[-1]] if len(ends) else np.zeros(0, np.uint8)
        known = pc.index_in(forms.dictionary, value_set=self.words).fill_null(len(self.words)).to_numpy()
        self.terms = self.model.project(self.model.inputs(self.rows[known], *_grams(raw, ends)))
        return np.split(forms.indices.to_numpy()[coded.indices.to_numpy()].astype(np.int64), np.cumsum(sizes)[:-1])

    def scores(self, texts: list[str | None], at_once: int = MEMO) -> np.ndarray:
        if isinstance(self.model, float):
            return np.full(len(texts), self.model)
        out, group, size = np.full(len(texts), self.empty), [], 0
        for first in range(0, len(texts), SPLIT):
            words, counts = _split(texts[first : first + SPLIT])
            ends, k, done = np.cumsum(counts), 0, 0
            while k < len(counts):  # up to the text that makes the group larger than at_once
                last = min(int(np.searchsorted(ends, done + at_once - size, side="right")) + 1, len(counts))
                n = int(ends[last - 1]) - done
                group.append((np.arange(first + k, first + last), words.slice(done, n), counts[k:last]))
                size, done, k = size + n, done + n, last
                if size > at_once:
                    self._score(group, out)
                    group, size = [], 0
        self._score(group, out)
        return out

    def _score(self, group: list, out: np.ndarray) -> None:
        if group:
            index, words, counts = zip(*group, strict=True)
            counts = np.concatenate(counts)
            some = np.flatnonzero(counts)
            if len(some):
                at = self._numbers(pa.concat_arrays(words), counts[some])  # replaces the terms
                out[np.concatenate(index)[some]] = _highest(self.model, self.terms, at)[0]


def _split(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, at the same characters as ``words_of`` has them, and how many each has."""
    split = pc.utf8_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    words = split.flatten()
    full = pc.not_equal(pc.binary_length(words), 0)  # blanks at the ends give empty words
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[split.offsets.to_numpy()])


def training_rows(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> list[tuple[str, int]]:
    """At most ``sample`` (toxic, clean) labelled texts outside the held-out fifth, by the hash
    of their id; null ids and labels are left out, of several labels of an id the highest counts."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    )
    by = (F.xxhash64("doc_id"), F.col("doc_id"))
    ids = known.filter("toxic = 1").orderBy(*by).limit(sample[0]).unionByName(known.filter("toxic = 0").orderBy(*by).limit(sample[1]))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    return [(r.text or "", r.toxic) for r in sorted(found.collect(), key=lambda r: r.doc_id)]


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _score(model: Network | float, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            s = scorer.scores([t or "" for t in b.column(0).field(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s.astype(float), pa.float64())], ["row", "score"])

    return run


def scored(docs: DataFrame, model: Network | float) -> DataFrame:
    """``row``, the columns of ``docs``, and ``score``."""
    rows = docs.select(own_columns(docs))
    kind = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_score(model, docs.columns.index("text")), kind)


def fit(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The model for these labels; 0 where no labelled text exists."""
    rows = training_rows(docs, labels)
    return train([t for t, _ in rows], [label for _, label in rows])


def toxicity(docs: DataFrame, labels: DataFrame, model: Network | float | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every text, one row for each input row.

    Null and empty texts get the network's score of no words; null and repeated ids keep a row
    each (a null id is not held out); labels without both classes give a constant score, an
    empty table no rows. Further columns are ignored. The training sample is bounded by
    ``SAMPLE``; scoring reads every window of every text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return scored(rows, fit(docs, labels) if model is None else model).select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    return scored(docs, fit(docs, labels)).filter("score < 0.5").select("row.*")
