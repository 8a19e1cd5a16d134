"""SimHash groups against all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from agentlake.llm.graph import components
from agentlake.llm.simhash import fingerprint, links, near_duplicates

rng = random.Random(3)


def brute_print(text, n=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots_of(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("text", ["", None, "One", "A b", "a B c", "ÉCOLE École x y z", "a\x1cb c\x85d e f", "w " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text) == brute_print(text)


def test_links_equal_all_pairs(spark):
    base = [0, 2**64 - 1] + [rng.getrandbits(64) for _ in range(60)]
    bits = set(base)
    for b in base:
        for _ in range(6):
            for _ in range(rng.randint(0, 3)):
                b ^= 1 << rng.randrange(64)
            bits.add(b)
    nodes = sorted(signed(b) for b in bits)
    want = roots_of(nodes, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 2)
    df = spark.createDataFrame([(b,) for b in nodes], "bits long")
    got = {r.node: r.root for r in components(links(df)).collect()}
    assert {n: got.get(n, n) for n in nodes} == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}


def test_near_duplicates(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (None, "   "), (3, "solo"), (None, "only null ids here"), (9, "w " * 70_000)]
    for g in range(8):
        text = rng.choices(words, k=600)
        for c in range(5):
            t = list(text)
            for _ in range(c // 2):
                t[rng.randrange(600)] = "changed"
            rows.append((10 * g + 20 + c, " ".join(t).upper() if c == 4 else " ".join(t)))
    rows.append(rows[-1])
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    prints = [brute_print(t) for _, t in rows]
    root = roots_of(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = sorted((-1 if i is None else i, f"{p:016x}", least.get(root[p], -1)) for (i, _), p in zip(rows, prints, strict=True))
    got = near_duplicates(docs).na.fill(-1).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert near_duplicates(docs.limit(0)).count() == 0
    assert near_duplicates(docs, distance=0).select(F.countDistinct("root")).first()[0] == len(set(prints))
