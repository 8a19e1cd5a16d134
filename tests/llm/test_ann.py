"""Nearest neighbours: recall and exact scores against brute force, odd vectors, ties."""

import numpy as np
from pyspark.sql import functions as F

from agentlake.llm.ann import balanced_parts, neighbour_graph, search

SF = "/root/testdata/sf0.1"


def test_parts_are_balanced():
    x = np.random.default_rng(3).standard_normal((1000, 8))
    sizes = np.bincount(balanced_parts(neighbour_graph(x), 7), minlength=7)
    assert sizes.max() - sizes.min() <= 3


def test_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = search(df, F.col("vec_id") % 20 == 0).toPandas()
    t = df.toPandas()
    x, ids = np.stack(t.embedding).astype(float), t.vec_id.to_numpy()
    at, hits, n = {i: k for k, i in enumerate(ids)}, 0, 0
    for q, g in got.sort_values("rank").groupby("query_id"):
        s = x @ x[at[q]]
        s[at[q]] = -np.inf
        best = set(ids[np.argsort(-s)[:20]])
        hits, n = hits + len(best & set(g.vec_id)), n + 20
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g.vec_id)
        assert abs(np.array([x[at[i]] @ x[at[q]] for i in g.vec_id]) - g.score.to_numpy()).max() < 1e-12
        assert (np.diff(g.score) <= 0).all()
    assert n == 20 * (ids % 20 == 0).sum() and hits / n >= 0.9


def test_odd_vectors_and_ties(spark):
    v = [1.0, 2.0, 0.5]
    rows = [(0, v), (1, v), (2, v), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, float("nan"), 0.0]), (6, [None, 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0]), (8, [1.0]), (None, v), (9, [-1.0, 0.0, 0.0]), (9, [-1.0, 0.0, 0.0]), (20, v), (40, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 20), (0, 4, 9), (20, 1, 0), (20, 2, 1), (20, 3, 2), (20, 4, 9)]
    assert search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
