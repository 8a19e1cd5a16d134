"""Searches for equal stretches across all documents, with packed keys instead of a row for each.

Documents are hashed into units of a few megabytes. In each phase every unit sends the distinct
keys of its stretches, sorted, to buckets of the key space; a bucket sorts what it gets, judges
each key over all units and answers with one bit for each key sent. Keys travel as the bytes of
their differences, so a stretch costs two to seven bytes. A unit rebuilds its keys from its texts
when the answers arrive; earlier answers travel along through the buckets. The texts are
shuffled once and reused by all phases. A key is sent once by a unit, however often it occurs
there, so a passage that many documents share meets its bucket once for each unit.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a unit; a longer document is a unit's size of its own.
UNIT = 4_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    got = _powers.get(str(base))
    if got is None or len(got) < n:
        got = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        got[0] = 1
        got = _powers[str(base)] = np.cumprod(got, dtype=np.uint64)
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of 64-bit values, each times a power of the multiplier."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power(MULTIPLIER, len(values)), out=out[1:])
    return out


def stretch_keys(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit key of each stretch [begin, end); equal stretches have equal keys."""
    return mix((sums[end] - sums[begin]) * _power(_INVERSE, len(sums))[begin])


def pack(values: np.ndarray) -> bytes:
    """Unsigned values as byte planes, no wider than the largest needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def unpack(raw: bytes, n: int) -> tuple[np.ndarray, int]:
    width = raw[0]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, width * n, 1).reshape(width, n).T
    return out.reshape(-1).view("<u8"), 1 + width * n


def pack_keys(keys: np.ndarray, extras: list[np.ndarray]) -> bytes:
    """Sorted keys by their differences, then the values that go with them."""
    return pack(np.diff(keys, prepend=np.uint64(0))) + b"".join(pack(e) for e in extras)


def unpack_keys(raw: bytes, n: int, extras: int) -> tuple[np.ndarray, list[np.ndarray]]:
    steps, at = unpack(raw, n)
    out = []
    for _ in range(extras):
        e, used = unpack(raw[at:], n)
        out.append(e)
        at += used
    return np.cumsum(steps, dtype=np.uint64), out


class Unit:
    """The texts of a unit as one run of bytes; text k is [begin[k], end[k])."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)  # not by way of floats: large ids stay exact
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        self.raw = raw
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)


class Search:
    """What a search must say: its phases' keys, how a bucket judges them, and the rows it gives."""

    phases = 2
    schema = ""

    def keys(self, unit: Unit, answers: list) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sorted distinct keys of the next phase and the values that go with each. ``answers``
        has one boolean array for each phase before, aligned with the keys of that phase."""
        raise NotImplementedError

    def judge(self, phase: int, key: np.ndarray, owner: np.ndarray, extras: list[np.ndarray]) -> np.ndarray:
        """A boolean for each entry of a bucket; ``key`` numbers its distinct keys."""
        raise NotImplementedError

    def rows(self, unit: Unit, answers: list) -> pa.Table:
        raise NotImplementedError


REQUEST = "bucket int, unit int, phase int, n int, payload binary"


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32()] * 4 + [pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["bucket", "unit", "phase", "n", "payload"])


def _send(search: Search, unit: Unit, number: int, answers: list, carried: list, buckets: int) -> pa.Table:
    keys, extras = search.keys(unit, answers)
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    cuts = [0, *np.searchsorted(keys, edges, side="left").tolist(), len(keys)]
    phase = len(answers)
    rows = [(b, number, phase, cuts[b + 1] - cuts[b], pack_keys(keys[cuts[b] : cuts[b + 1]], [e[cuts[b] : cuts[b + 1]] for e in extras])) for b in range(buckets) if cuts[b + 1] > cuts[b]]
    return _table(rows + [(number % buckets, number, p, len(a), np.packbits(a).tobytes()) for p, a in enumerate(carried)])


def _answers(replies: pa.Table, phases: int) -> list[np.ndarray]:
    """Per phase the bits of all its keys, in the order of the buckets and so of the keys."""
    rows = sorted(zip(*(replies.column(c).to_pylist() for c in ("phase", "bucket", "n", "payload")), strict=True))
    bits = [[np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(bool) for f, _, n, p in rows if f == phase] for phase in range(phases)]
    return [np.concatenate(b) if b else np.zeros(0, bool) for b in bits]


def _judge(search: Search, phase: int, extras: int):
    def run(key, table):
        rows = list(zip(*(table.column(c).to_pylist() for c in ("bucket", "unit", "phase", "n", "payload")), strict=True))
        mine = [r for r in rows if r[2] == phase]
        out = [r for r in rows if r[2] < phase]
        if mine:
            parts = [unpack_keys(r[4], r[3], extras) for r in mine]
            sizes = [r[3] for r in mine]
            number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)[1].reshape(-1)
            good = search.judge(phase, number, np.repeat(np.arange(len(mine)), sizes), [np.concatenate([p[1][e] for p in parts]) for e in range(extras)])
            ends = np.cumsum(sizes)
            out += [(r[0], r[1], phase, r[3], np.packbits(good[e - r[3] : e]).tobytes()) for r, e in zip(mine, ends, strict=True)]
        return _table(out)

    return run


def run_search(docs: DataFrame, search: Callable[[], Search], extras: tuple[int, ...], unit_bytes: int = UNIT) -> DataFrame:
    """The rows of ``search`` over all documents (doc_id, text); ``extras`` has for each phase the
    number of values that go with a key."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number, for the number of units
    units, buckets = int(total // unit_bytes) + 1, max(4, int(total // unit_bytes) // 4)
    texts = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(units)).cast("int").alias("unit"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    phases = len(extras)

    def first(key, table):
        return _send(search(), Unit(table), key[0].as_py(), [], [], buckets)

    def following(phase: int):
        def run(key, table, replies):
            got = _answers(replies, phase)
            return _send(search(), Unit(table), key[0].as_py(), got, got, buckets)

        return run

    def last(key, table, replies):
        return search().rows(Unit(table), _answers(replies, phases))

    sent = texts.groupBy("unit").applyInArrow(first, REQUEST)
    for phase in range(phases):
        replies = sent.groupBy("bucket").applyInArrow(_judge(search(), phase, extras[phase]), REQUEST)
        if phase + 1 < phases:
            sent = texts.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(following(phase + 1), REQUEST)
    return texts.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(last, search.schema)


def counted(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the order that sorts the entries, and where each key begins in it."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[first], order, first
