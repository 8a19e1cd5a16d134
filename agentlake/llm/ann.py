"""Approximate nearest neighbours with learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts (recursive bisection at the
median of a smooth vector over the graph), a small network learns to tell in which parts a
vector's neighbours lie, and every row is indexed under its most probable part. A query visits
its most probable parts and ranks all their vectors exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.session import materialize

#: Rows of the sample the parts are learned from (a bound), rows a part should have, sample rows a
#: part needs, neighbours in the graph, width and training rounds of the network.
SAMPLE, PART, SUPPORT, NEIGHBOURS, WIDTH, ROUNDS, SEED = 4096, 512, 32, 10, 64, 15, 9
#: A query visits its most probable parts until they hold this much probability together.
MASS, TOP = 0.97, 20
#: Rows of one part that one task ranks; larger parts are dealt to several.
CHUNK = 4096


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k rows of largest inner product with each row."""
    out = np.empty((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i : i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = SEED) -> np.ndarray:
    """A part for each node; sizes differ by rounding only, few edges are cut."""
    rng = np.random.default_rng(seed)
    part = np.zeros(len(graph), dtype=np.int64)
    todo = [(np.arange(len(graph)), 0, parts)]
    while todo:
        nodes, first, n = todo.pop()
        if n == 1:
            part[nodes] = first
            continue
        place = np.full(len(graph), -1)
        place[nodes] = np.arange(len(nodes))
        near = place[graph[nodes]]
        inside = near >= 0
        v = rng.standard_normal(len(nodes))
        a, b = np.nonzero(inside)
        c = near[a, b]
        degree = np.bincount(a, minlength=len(nodes)) + np.bincount(c, minlength=len(nodes)) + 1e-9
        for _ in range(60):  # smooth the vector over the edges; what stays after removing its mean splits the graph
            v = (np.bincount(a, v[c], len(nodes)) + np.bincount(c, v[a], len(nodes))) / degree * 0.5 + v * 0.5
            v -= (v * degree).sum() / degree.sum()
            v /= np.abs(v).max() + 1e-12
        left = n // 2
        cut = len(nodes) * left // n
        order = np.lexsort((nodes, v))
        todo += [(nodes[order[:cut]], first, left), (nodes[order[cut:]], first + left, n - left)]
    return part


@dataclass
class Router:
    """Part probabilities from a vector: one hidden layer, trained on where neighbours lie."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        s = np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def learn(x: np.ndarray, parts: int, seed: int = SEED) -> Router:
    """A router for ``parts`` parts from sample rows ``x``."""
    rng = np.random.default_rng(seed)
    d, scale = x.shape[1], 1 / (np.sqrt((x * x).mean()) + 1e-12)
    if parts == 1 or len(x) <= NEIGHBOURS + 1:
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), scale)
    graph = neighbour_graph(x)
    part = balanced_parts(graph, parts, seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
    target[np.arange(len(x)), part] += 2
    target /= target.sum(axis=1, keepdims=True)
    p = {"w1": rng.standard_normal((d, WIDTH)) / np.sqrt(d), "b1": np.zeros(WIDTH), "w2": rng.standard_normal((WIDTH, parts)) / np.sqrt(WIDTH), "b2": np.zeros(parts)}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            rows = order[i : i + 256]
            a = x[rows] * scale
            h = np.maximum(a @ p["w1"] + p["b1"], 0)
            s = h @ p["w2"] + p["b2"]
            e = np.exp(s - s.max(axis=1, keepdims=True))
            ds = (e / e.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            dh = (ds @ p["w2"].T) * (h > 0)
            step += 1
            for k, g in {"w1": a.T @ dh, "b1": dh.sum(axis=0), "w2": h.T @ ds, "b2": ds.sum(axis=0)}.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(p["w1"], p["b1"], p["w2"], p["b2"], scale)


def visited(probability: np.ndarray, mass: float) -> list[np.ndarray]:
    """For each row its most probable parts that hold ``mass`` together."""
    order = np.argsort(-probability, axis=1, kind="stable")
    n = 1 + (np.take_along_axis(probability, order, axis=1).cumsum(axis=1) < mass).sum(axis=1)
    return [o[: min(k, len(o))] for o, k in zip(order, n, strict=True)]


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, no null or non-finite component, not all
    zero, and the most frequent length (of equal ones the smallest)."""
    v = F.col(vector).cast("array<double>")
    ok = F.col("vec_id").isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    first = sizes.first()
    return rows.filter(F.size("v") == (first.d if first else 0))


def _route(router: Router, mass: float, x: np.ndarray, ids: np.ndarray, top: int):
    """Adds part and visits, and for queries the ``top``-th best score among the sample rows of
    the visited parts: no row below it can be among the ``top`` found."""
    parts = router.probabilities(x).argmax(axis=1)

    def bound(q: np.ndarray, own: int, visits: np.ndarray) -> float:
        s = (x @ q)[np.isin(parts, visits) & (ids != own)]
        return float(-np.partition(-s, top - 1)[top - 1]) if len(s) >= top else float("-inf")

    def run(batches):
        for b in batches:
            if len(b):
                v = np.stack(b["v"].to_numpy())
                p = router.probabilities(v)
                seen = visited(p, mass)
                least = [bound(q, i, n) if a else None for q, i, n, a in zip(v, b["vec_id"], seen, b["asks"], strict=True)]
                yield b.assign(part=p.argmax(axis=1), visits=seen, bound=pd.Series(least, index=b.index, dtype="float64"))

    return run


def _rank(top: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            v, ids = np.stack(rows["row_v"].to_numpy()), rows["row_id"].to_numpy()
            for i in range(0, len(queries), 256):
                some = queries.iloc[i : i + 256]
                q, qid = np.stack(some["v"].to_numpy()), some["vec_id"].to_numpy()
                s = q @ v.T
                s[qid[:, None] == ids[None, :]] = -np.inf
                k = min(top, len(ids))
                least = np.maximum(-np.partition(-s, k - 1, axis=1)[:, k - 1], some["bound"].to_numpy())
                for j in range(len(some)):
                    # near the last place all are kept; scores are then summed alike for equal vectors
                    floor = least[j] - 1e-9 * (1 + abs(least[j])) if least[j] > -np.inf else -np.inf
                    pick = np.flatnonzero((s[j] >= floor) & (s[j] > -np.inf))
                    score = (v[pick] * q[j]).sum(axis=1)
                    best = np.lexsort((ids[pick], -score))[:top]
                    out.append(pd.DataFrame({"query_id": qid[j], "vec_id": ids[pick[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    return run


def search(vectors: DataFrame, is_query: Column, top: int = TOP, mass: float = MASS, sample: int = SAMPLE, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` of largest inner product found for each query row.

    The sample (by hash of the id) is bounded; every usable row is indexed and every query row
    that is usable is answered with all rows of the parts it visits. Rows that share the query's
    id count as its own; repeated rows of an id count once. Null, zero, non-finite or odd-sized
    vectors and null ids take no part; an empty table gives no rows; further columns are ignored."""
    rows = usable(vectors, vector)
    rows = materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    n = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    picked = sorted(picked, key=lambda r: r.vec_id)
    x = np.array([r.v for r in picked]).reshape(len(picked), len(picked[0].v) if picked else 1)
    parts = max(1, min(-(-n // PART), len(x) // SUPPORT))
    router = learn(x, parts) if n else Router(np.zeros((1, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1.0)
    rows = rows.withColumn("asks", F.coalesce(is_query, F.lit(False)))
    kind = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("visits", T.ArrayType(T.IntegerType())), T.StructField("bound", T.DoubleType())])
    ids = np.array([r.vec_id for r in picked], dtype=np.int64)
    routed = materialize(rows.mapInPandas(_route(router, mass, x, ids, top), kind), "routed")
    sizes = routed.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))  # one row a part
    index = routed.join(sizes, "part").select("part", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk"), F.col("vec_id").alias("row_id"), F.col("v").alias("row_v"))
    queries = routed.filter("asks").select("vec_id", "v", "bound", F.explode("visits").alias("part")).join(sizes, "part")
    queries = queries.select("part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "vec_id", "v", "bound")
    found = queries.groupBy("part", "chunk").cogroup(index.groupBy("part", "chunk")).applyInPandas(_rank(top), "query_id long, vec_id long, score double")
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
