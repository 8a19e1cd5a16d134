"""Removal of long repeats by blockwise suffix sorting with a difference cover.

Only repeats of ``length`` bytes matter, so suffixes are told apart by their first ``length``
bytes and no further. A difference cover D modulo v has, for any two residues, a shift below v
that puts both in D: two equal stretches of ``length`` bytes always hold, at one and the same
shift, two cover samples whose next ``length - v + 1`` bytes agree.

1. The samples are named by those bytes and sorted in buckets of the name space; a sample whose
   name is alone ends there. Samples are |D| / v of all positions, some six in a hundred.
2. A suffix may repeat only if one of the samples in its first v positions has a shared name.
   Those suffixes are sorted one bucket at a time, by the 64-bit name of their ``length``
   bytes, and equal neighbours are repeats. No bucket needs any text, so memory is bounded.

Names stand for the ranks of a full suffix order: deduplication asks for equality alone.
"""

from __future__ import annotations

import hashlib
from functools import cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agentlake.llm import packed
from agentlake.llm.packed import Search, Unit, prefix_sums, run_search, stretch_keys

LENGTH, PRIME = 400, 17
SAMPLE_BITS = np.uint64(24)  # samples are filtered by 40 of their 64 bits; a chance hit costs work alone
SLICE = 1 << 20


@cache
def difference_cover(q: int) -> tuple[int, tuple[int, ...]]:
    """(v, D) for a prime q: v = q*q + q + 1 and the q + 1 exponents below v at which a generator
    of the field of q cubed elements has no square term; every difference occurs."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, seen, n = (1, 0, 0), [], 0  # powers of t with t^3 = a t^2 + b t + c
                while True:
                    if n < v and x[2] == 0:
                        seen.append(n)
                    x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
                    n += 1
                    if x == (1, 0, 0) or n >= q**3:
                        break
                if n == q**3 - 1:
                    return v, tuple(seen)
    raise ValueError("q must be prime")


def is_first(ordered: np.ndarray) -> np.ndarray:
    """Whether each of the sorted values is the first of its kind."""
    out = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=out[1:])
    return out


def spread(answers: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each name the answer to it; ``answers`` are those to the sorted distinct names."""
    order = np.argsort(names)
    out = np.empty(len(names), dtype=bool)
    out[order] = np.repeat(answers, np.diff(np.append(np.flatnonzero(is_first(names[order])), len(names))))
    return out


class Repeats(Search):
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def __init__(self, length: int, prime: int):
        self.length = length
        self.v, cover = difference_cover(prime)
        self.depth = length - self.v + 1
        if self.depth < 1:
            raise ValueError("the cover's period must not exceed the length")
        self.cover = np.zeros(self.v, dtype=bool)
        self.cover[list(cover)] = True
        self.letters = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.letters ^= np.random.default_rng(21).integers(0, 2**63, 256, dtype=np.uint64)

    def names(self, unit: Unit, at: int, i: np.ndarray, size: int) -> np.ndarray:
        """Names of the stretches of ``size`` bytes at positions of the slice that begins at ``at``."""
        sums = prefix_sums(self.letters[unit.bytes[at : at + SLICE + self.length]])
        return stretch_keys(sums, i - at, i - at + size)

    def places(self, unit: Unit, at: int) -> np.ndarray:
        """Positions of a slice at which ``length`` bytes of one text begin."""
        i = np.arange(at, min(at + SLICE, len(unit.bytes)))
        some = slice(np.searchsorted(unit.end, at, side="right"), np.searchsorted(unit.begin, i[-1], side="right"))
        inside = np.minimum(unit.end[some], i[-1] + 1) - np.maximum(unit.begin[some], at)
        return i[i <= np.repeat(unit.end[some] - self.length, inside)]

    def samples(self, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
        """Positions and names of the cover samples."""
        periods = -(-(unit.end - unit.begin) // self.v)
        first = np.cumsum(periods) - periods
        start = np.repeat(unit.begin - first * self.v, periods) + np.arange(periods.sum()) * self.v
        i = start[:, None] + np.flatnonzero(self.cover)
        i = i[i <= np.repeat(unit.end - self.depth, periods)[:, None]]
        edges = np.searchsorted(i, np.arange(0, len(unit.bytes) + SLICE, SLICE))
        names = [self.names(unit, k * SLICE, i[a:b], self.depth) for k, (a, b) in enumerate(pairwise(edges.tolist())) if a < b]
        return i, np.concatenate([np.zeros(0, np.uint64), *names]) >> SAMPLE_BITS << SAMPLE_BITS

    def suffixes(self, unit: Unit, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and names of the suffixes that a shared sample lets repeat."""
        where, names = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        i, n = self.samples(unit)
        hit = i[spread(shared, n)]
        for at in range(0, len(unit.bytes), SLICE):
            near = hit[slice(*np.searchsorted(hit, (at, at + SLICE + self.v)))] - at
            if len(near):
                before = np.zeros(SLICE + self.v + 1, dtype=np.int32)  # hits in front of each place of the slice
                before[near + 1] = 1
                np.cumsum(before, out=before)
                j = self.places(unit, at)
                j = j[before[j - at + self.v] > before[j - at]]
                where.append(j)
                names.append(self.names(unit, at, j, self.length))
        return np.concatenate(where), np.concatenate(names)

    def keys(self, unit: Unit, answers: list) -> tuple[np.ndarray, list[np.ndarray]]:
        names = self.suffixes(unit, answers[0])[1] if answers else self.samples(unit)[1]
        names = np.sort(names)
        first = np.flatnonzero(is_first(names))
        return names[first], [(np.diff(np.append(first, len(names))) > 1).astype(np.uint64)]

    def judge(self, phase: int, key: np.ndarray, owner: np.ndarray, extras: list[np.ndarray]) -> np.ndarray:
        return (np.bincount(key, 1 + extras[0]) >= 2)[key]

    def rows(self, unit: Unit, answers: list) -> pa.Table:
        i, names = self.suffixes(unit, answers[0])
        i = i[spread(answers[1], names)]
        edges = np.zeros(len(unit.bytes) + 1, dtype=np.int32)
        edges[i] = 1  # no position comes twice
        edges[i + self.length] -= 1
        gone = np.cumsum(edges)[:-1] > 0
        out = []
        for doc, known, raw, a, b in zip(unit.doc_id, unit.known, unit.raw, unit.begin, unit.end, strict=True):
            g = gone[a:b]
            n = int(g.sum())
            kept = unit.bytes[a:b][~g].tobytes() if n else raw
            out.append((int(doc) if known else None, int(b - a), n, int((g[1:] & ~g[:-1]).sum() + g[:1].sum()) if n else 0, hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


class _Make:
    """Builds the search inside a task."""

    def __init__(self, cls, *args):
        self.make, self.schema = partial(cls, *args), cls.schema

    def __call__(self) -> Search:
        return self.make()


def suffix_dedup(docs: DataFrame, length: int = LENGTH, prime: int = PRIME, unit_bytes: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Repeated rows repeat each other's bytes; null ids keep a row each; a null text counts as
    empty, shorter texts than ``length`` keep all; further columns are ignored; an empty table
    gives no rows. ``prime`` chooses the cover: its period must not exceed ``length``."""
    return run_search(docs, _Make(Repeats, length, prime), (1, 1), unit_bytes or packed.UNIT)
