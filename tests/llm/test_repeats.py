"""Suffix and substring deduplication against direct comparison of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from agentlake.llm import suffix_dedup as sd
from agentlake.llm.packed import Unit, pack_keys, unpack_keys
from agentlake.llm.substring_dedup import substring_dedup
from agentlake.llm.suffix_dedup import difference_cover, suffix_dedup

rng = random.Random(8)


def corpus():
    passage = [" ".join(rng.choice(["the", "of", "Été", "x", "日本"]) + str(rng.randrange(99)) for _ in range(rng.randint(40, 160))) for _ in range(6)]
    docs = [(0, None), (1, ""), (2, " \n\t "), (3, "a" * 900), (4, "a" * 500 + "b" + "a" * 450), (5, "ab " * 400), (None, passage[0] * 2), (None, passage[1])]
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passage)
            a = rng.randrange(len(p))
            parts += [p[a : a + rng.randint(100, 1500)], "".join(rng.choice("xyz \n") for _ in range(rng.randint(0, 300)))]
        docs.append((100 - i, rng.choice([" ", "\x1c", " "]).join(parts)))
    return docs + [docs[9], (9, docs[12][1]), (2**62 + 1, docs[12][1])]


DOCS = corpus()


def frame(spark, docs):
    return spark.createDataFrame([(*d, "q") for d in docs], "doc_id long, text string, unit string")


def brute_suffix(docs, n):
    raw = [(t or "").encode() for _, t in docs]
    count = Counter(r[i : i + n] for r in raw for i in range(len(r) - n + 1))
    out = []
    for (d, _), r in zip(docs, raw, strict=True):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - n + 1):
            if count[r[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((-1 if d is None else d, len(r), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def brute_words(docs, n):
    split = [[w for w in re.split("[\x20\x09-\x0d]+", t or "") if w] for _, t in docs]
    least = {}
    for (d, _), w in zip(docs, split, strict=True):
        for i in range(len(w) - n + 1):
            if d is not None:
                k = tuple(w[i : i + n])
                least[k] = min(d, least.get(k, d))
    out = []
    for (d, _), w in zip(docs, split, strict=True):
        gone = set()
        for i in range(len(w) - n + 1):
            if d is not None and least[tuple(w[i : i + n])] < d:
                gone.update(range(i, i + n))
        out.append((-1 if d is None else d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("q", [2, 3, 5, 17])
def test_difference_cover(q):
    v, d = difference_cover(q)
    assert len(d) == q + 1 and {(a - b) % v for a in d for b in d} == set(range(v))


def test_packing():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64 - 1, 5000, dtype=np.uint64))
    extra = keys[::-1].copy()
    got, (e,) = unpack_keys(pack_keys(keys, [extra]), len(keys), 1)
    assert (got == keys).all() and (e == extra).all()
    assert len(unpack_keys(pack_keys(keys[:0], [keys[:0]]), 0, 1)[0]) == 0


def test_only_slices_near_shared_samples_are_hashed(monkeypatch):
    monkeypatch.setattr(sd, "SLICE", 256)
    texts = ["", "ab" * 700, None, "c" * 59, "", "d" * 60, "e" * 2000, ""]
    unit, search = Unit(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})), sd.Repeats(60, 5)
    i, names = search.samples(unit)
    want = [b + x for b, e in zip(unit.begin, unit.end, strict=True) for x in range(e - b - search.depth + 1) if search.cover[x % search.v]]
    assert i.tolist() == want and len(names) == len(want)
    got = search.suffixes(unit, np.ones(len(np.unique(names)), bool))[0]
    assert got.tolist() == [b + x for b, e in zip(unit.begin, unit.end, strict=True) for x in range(e - b - 59)]
    hashed, known = [], set(names[i < 1400].tolist())
    monkeypatch.setattr(sd, "prefix_sums", lambda v, f=sd.prefix_sums: hashed.append(len(v)) or f(v))
    search.samples(unit)
    alone = len(hashed)
    assert search.suffixes(unit, np.zeros(len(np.unique(names)), bool))[0].tolist() == []
    assert len(hashed) == 2 * alone  # the samples again, no suffix
    some = search.suffixes(unit, np.array([n in known for n in np.unique(names).tolist()]))[0]
    assert some.tolist() == list(range(1341))


@pytest.mark.parametrize(("n", "q", "size"), [(400, 17, 3000), (400, 17, 10**6), (60, 5, 2000)])
def test_suffix_dedup(spark, n, q, size):
    got = suffix_dedup(frame(spark, DOCS), n, q, size).na.fill(-1).collect()
    assert sorted(tuple(r) for r in got) == brute_suffix(DOCS, n)


@pytest.mark.parametrize(("n", "size"), [(50, 3000), (50, 10**6), (9, 2000)])
def test_substring_dedup(spark, n, size):
    got = substring_dedup(frame(spark, DOCS), n, size).na.fill(-1).collect()
    assert sorted(tuple(r) for r in got) == brute_words(DOCS, n)


def test_empty(spark):
    assert suffix_dedup(frame(spark, DOCS).limit(0)).count() == 0
    assert substring_dedup(frame(spark, DOCS).limit(0)).count() == 0
