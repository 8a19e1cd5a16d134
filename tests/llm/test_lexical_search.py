"""Ranked search against scoring every document, and the tree against a full product."""

import math
import random
import re
from collections import Counter

import numpy as np

from agentlake.llm.lexical_search import BallTree, ranked

rng = random.Random(31)


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute(docs, items, top=10):
    tf = [Counter(words(t)) for _, t in docs]
    n, total = sum(1 for c in tf if c), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, _), c in zip(docs, tf, strict=True):
            m = 25 + 75 * sum(c.values()) * n // total if c else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def test_against_brute_force(spark):
    vocab = ["the", "The", "É", "é", "x1", "日本"] + [f"w{i}" for i in range(60)]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    docs = [(k, text(rng.randint(1, 60))) for k in range(150)] + [(500, None), (501, ""), (502, "..."), (None, text(30)), (503, "the w1 " * 20_000)]
    docs += [docs[3], docs[3], (7, text(20)), (600, docs[5][1])]  # repeated rows, a repeated id, a tie
    items = [(k, text(rng.randint(1, 15))) for k in range(20)] + [(90, None), (91, ""), (92, "unseen"), (None, text(5)), (3, "w1 w1 w1 the")]
    d = spark.createDataFrame([(*x, "a", 1) for x in docs], "doc_id long, text string, item_id string, score int")
    q = spark.createDataFrame([(*x, 1, "b") for x in items], "item_id long, text string, rank int, term string")
    for blocks in ((4096, 256), (16, 4)):
        got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in ranked(d, q, doc_block=blocks[0], item_block=blocks[1]).collect()]
        assert sorted(got, key=str) == brute(docs, items)
    assert ranked(d.limit(0), q).count() == 0
    assert ranked(d, q.limit(0)).count() == 0


def test_tree_prunes_and_stays_exact():
    g = np.random.default_rng(5)
    centers = [np.sort(g.choice(400, 20, replace=False)) for _ in range(25)]
    docs = [{int(t): int(g.integers(400_000, 500_000)) for t in g.choice(centers[k % 25], 15, replace=False)} for k in range(1000)]
    begin = np.cumsum([0] + [len(x) for x in docs])
    tree = BallTree(begin, np.array([t for x in docs for t in x]), np.array([v for x in docs for v in x.values()]), 400)
    rank, scored = np.arange(1000), 0
    for c in centers[:10]:
        query = np.zeros(400, np.int64)
        query[c[:8]] = g.integers(1, 9000, 8)
        every = sorted(((-sum(int(query[t]) * v for t, v in x.items()), k) for k, x in enumerate(docs)))[:10]
        got, leaves = tree.search(query, rank, 10)
        assert [(-s, d) for s, d in got] == [x for x in every if x[0] < 0]
        scored += leaves
    assert scored < 10 * len(tree.spans) / 4  # half of the nodes are leaves: under half of them
