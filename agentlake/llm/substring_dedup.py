"""Removal of word passages that an earlier document has, by fixed-block anchors.

Every document is a reference: its non-overlapping blocks of half a window's words are indexed.
Every rolling window of that size probes the index; a full window always holds one whole block
of any text it repeats. Hits that concern more than one document are extended: the full
windows around them are compared across all documents, each with the smallest doc_id that has
it, and the union of those with a smaller one makes the maximal repeats that are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agentlake.llm import packed
from agentlake.llm.packed import Search, Unit, counted, mix, prefix_sums, run_search, stretch_keys
from agentlake.llm.suffix_dedup import _Make

WINDOW = 50
PROBE_BITS = np.uint64(24)  # probes are filtered by 40 of their 64 bits; a chance hit costs work alone
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, *range(9, 14)]] = True


class Passages(Search):
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"

    def __init__(self, window: int):
        self.window, self.block = window, (window + 1) // 2
        self.letters = np.random.default_rng(30).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.letters ^= np.random.default_rng(31).integers(0, 2**63, 256, dtype=np.uint64)

    def words(self, unit: Unit) -> tuple:
        """Begin and end of each word in the unit's bytes, its document, place there, running sums."""
        ink = ~BLANK[unit.bytes]
        before = np.concatenate([[False], ink[:-1]]) if len(ink) else ink
        before[unit.begin[unit.begin < len(ink)]] = False
        after = np.concatenate([ink[1:], [False]]) if len(ink) else ink
        after[unit.end[unit.end > 0] - 1] = False
        begin, end = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
        doc = np.searchsorted(unit.end, begin, side="right")
        first = np.searchsorted(doc, np.arange(len(unit.end)))
        names = [np.zeros(0, np.uint64)]
        for i in range(0, len(begin), 1 << 18):  # sums over some words' bytes at a time
            b, e = begin[i : i + (1 << 18)], end[i : i + (1 << 18)]
            sums = prefix_sums(self.letters[unit.bytes[b[0] : e[-1]]])
            names.append(mix(stretch_keys(sums, b - b[0], e - b[0]) + (e - b).astype(np.uint64)))
        return begin, end, doc, np.arange(len(begin)) - first[doc], prefix_sums(np.concatenate(names))

    def stretches(self, unit: Unit, w: tuple, size: int) -> np.ndarray:
        """Numbers of the words at which ``size`` words of one document with an id begin."""
        doc = w[2]
        i = np.arange(max(0, len(doc) - size + 1))
        return i[(doc[i] == doc[i + size - 1]) & unit.known[doc[i]]]

    def probes(self, unit: Unit, w: tuple) -> tuple[np.ndarray, np.ndarray]:
        i = self.stretches(unit, w, self.block)
        return i, stretch_keys(w[4], i, i + self.block) >> PROBE_BITS << PROBE_BITS

    def full(self, unit: Unit, w: tuple, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and keys of the full windows that hold a shared probe."""
        i, names = self.probes(unit, w)
        hit = i[shared[np.searchsorted(np.unique(names), names)]] if len(i) else i
        j = self.stretches(unit, w, self.window)
        j = j[np.searchsorted(hit, j + self.window - self.block, side="right") > np.searchsorted(hit, j)]
        return j, stretch_keys(w[4], j, j + self.window)

    def keys(self, unit: Unit, answers: list) -> tuple[np.ndarray, list[np.ndarray]]:
        w = self.words(unit)
        ids = np.where(unit.known, unit.doc_id, 0).astype(np.int64)
        i, names = self.full(unit, w, answers[0]) if answers else self.probes(unit, w)
        keys, order, first = counted(names)
        if not len(keys):
            return keys, [keys] if answers else [keys, keys]
        own = ids[w[2][i[order]]]
        least = np.minimum.reduceat(own, first)
        if answers:
            return keys, [(least.astype(np.int64).view(np.uint64)) ^ np.uint64(1 << 63)]
        indexed = np.maximum.reduceat((w[3][i[order]] % self.block == 0).astype(np.uint64), first)
        return keys, [indexed, (np.maximum.reduceat(own, first) != least).astype(np.uint64)]

    def judge(self, phase: int, key: np.ndarray, owner: np.ndarray, extras: list[np.ndarray]) -> np.ndarray:
        if phase == 0:
            n = np.bincount(key, 1 + extras[1])
            return ((np.bincount(key, extras[0]) > 0) & (n >= 2))[key]
        least = np.full(key.max() + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(least, key, extras[0])
        return least[key] < extras[0]

    def rows(self, unit: Unit, answers: list) -> pa.Table:
        w = self.words(unit)
        ids = np.where(unit.known, unit.doc_id, 0).astype(np.int64)
        i, names = self.full(unit, w, answers[0])
        gone = np.zeros(len(w[0]), dtype=bool)
        if len(i):
            keys, order, first = counted(names)
            at = np.searchsorted(keys, names)
            least = np.minimum.reduceat(ids[w[2][i[order]]], first)
            i = i[answers[1][at] | (least[at] < ids[w[2][i]])]
            edges = np.zeros(len(gone) + 1, dtype=np.int32)
            np.add.at(edges, i, 1)
            np.add.at(edges, i + self.window, -1)
            gone = np.cumsum(edges)[:-1] > 0
        out = []
        bounds = np.searchsorted(w[2], np.arange(len(unit.end) + 1))
        for k, (doc, known, raw) in enumerate(zip(unit.doc_id, unit.known, unit.raw, strict=True)):
            g = gone[bounds[k] : bounds[k + 1]]
            words = raw.split()
            kept = [x for x, lost in zip(words, g.tolist(), strict=True) if not lost] if g.any() else words
            out.append((int(doc) if known else None, len(words), int(g.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, window: int = WINDOW, unit_bytes: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    Words are runs of other than ASCII white space. A null id is neither smaller nor larger than
    any: such rows keep all their words and are no reference. Rows of one id do not remove each
    other's words; a null text has no words; further columns are ignored; an empty table gives
    no rows."""
    return run_search(docs, _Make(Passages, window), (2, 1), unit_bytes or packed.UNIT)
