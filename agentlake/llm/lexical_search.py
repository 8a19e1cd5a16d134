"""Ranked lexical search as exact inner-product search in sparse ball trees.

A document is the sparse vector of its saturated term frequencies, a query that of its terms'
weights, both 64-bit integers, and the score is their inner product. Documents are dealt into
blocks of bounded size and queries too; a document's entries travel only to the query blocks that
hold the term. Each pair of blocks builds a ball tree over its vectors: a node has the centroid of
its documents, the radius around it, and the reach of each term above the centroid. With rounding
upwards, ``<q, centroid> + min(|q| * radius, <q, reach>)`` bounds every score below a node, so the
search goes best-first and leaves subtrees that cannot enter the top any more. Leaves score
exactly, in integers.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agentlake.session import materialize

TOP, LEAF = 10, 16
DOC_BLOCK, ITEM_BLOCK = 2048, 256
CHUNK = 1 << 20
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SLACK = 1e-9  # far above the rounding of sums of doubles of one sign


def terms(text: str | None) -> list[str]:
    """Maximal runs of digits, letters and all beyond ASCII; only A-Z lower-cased."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return TERM.findall(low)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(ends // CHUNK)) + 1).tolist(), b.num_rows]  # some texts' counts at a time
        for at, end in zip(cuts, cuts[1:], strict=False):
            part = b.slice(at, end - at)
            counts = [Counter(terms(t)) for t in part.column(2).to_pylist()]
            sizes = pa.array([0, *np.cumsum([len(c) for c in counts])], pa.int32())
            names = pa.ListArray.from_arrays(sizes, pa.array([t for c in counts for t in c], pa.string()))
            tf = pa.ListArray.from_arrays(sizes, pa.array([n for c in counts for n in c.values()], pa.int64()))
            total = pa.array([sum(c.values()) for c in counts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), total, names, tf], ["row", "id", "n", "term", "tf"])


def _vectors(table: DataFrame, key: str, name: str) -> DataFrame:
    """(row, id, n, term, tf) of each row; written once, so that the row numbers stay."""
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), "text")
    return materialize(rows.mapInArrow(_counted, "row long, id long, n long, term array<string>, tf array<long>"), name)


class BallTree:
    """Documents as runs of (term, value) entries; ``begin`` cuts them, ``order`` breaks ties."""

    def __init__(self, begin: np.ndarray, term: np.ndarray, value: np.ndarray, n_terms: int, leaf: int = LEAF):
        self.leaf, self.n_terms = leaf, n_terms
        self.docs, ranges = np.arange(len(begin) - 1), [(0, len(begin) - 1, -1)]
        self.begin, self.term, self.value = begin, term, value.astype(np.float64)
        self.norm = np.add.reduceat(self.value**2, begin[:-1]) if len(begin) > 1 else np.zeros(0)
        spans, self.children = [], []
        while ranges:  # breadth first: children get their numbers as they are cut
            lo, hi, parent = ranges.pop(0)
            if parent >= 0:
                self.children[parent].append(len(spans))
            spans.append((lo, hi))
            self.children.append([])
            if hi - lo > leaf:
                mid = (lo + hi) // 2
                self.docs[lo:hi] = self._halved(self.docs[lo:hi])
                ranges += [(lo, mid, len(spans) - 1), (mid, hi, len(spans) - 1)]
        at = self._entries(self.docs)
        sizes = np.diff(begin)[self.docs]
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.term, self.exact = term[at], value[at]
        self.value, self.norm = self.value[at], self.norm[self.docs]
        self.spans = spans
        self.nodes = [self._node(lo, hi) for lo, hi in spans]

    def _entries(self, docs: np.ndarray) -> np.ndarray:
        sizes = np.diff(self.begin)[docs]
        return np.repeat(self.begin[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())

    def _halved(self, docs: np.ndarray) -> np.ndarray:
        """Documents ordered from one of two far apart ones to the other."""
        at, sizes = self._entries(docs), np.diff(self.begin)[docs]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        term, value, norm = self.term[at], self.value[at], self.norm[docs]

        def apart(v: np.ndarray) -> np.ndarray:
            return norm - 2 * np.add.reduceat(v[term] * value, first) + v @ v

        def dense(i: int) -> np.ndarray:
            v = np.zeros(self.n_terms)
            v[term[first[i] : first[i] + sizes[i]]] = value[first[i] : first[i] + sizes[i]]
            return v

        a = apart(np.bincount(term, value, self.n_terms) / len(docs)).argmax()
        from_a = apart(dense(a))
        from_b = apart(dense(from_a.argmax()))
        return docs[np.argsort(from_a - from_b, kind="stable")]

    def _node(self, lo: int, hi: int) -> tuple:
        """(terms, centroid, reach, radius) of the documents [lo, hi)."""
        a, b = self.begin[lo], self.begin[hi]
        names, inverse = np.unique(self.term[a:b], return_inverse=True)
        centroid = np.bincount(inverse, self.value[a:b]) / (hi - lo)
        high = np.zeros(len(names))
        np.maximum.at(high, inverse, self.value[a:b])
        length = centroid @ centroid
        dots = np.add.reduceat(centroid[inverse] * self.value[a:b], self.begin[lo:hi] - a)
        squares = np.maximum(self.norm[lo:hi] - 2 * dots + length, 0) + SLACK * (self.norm[lo:hi] + length)
        return names, centroid, high - centroid, float(np.sqrt(squares.max()))

    def bound(self, node: int, query: np.ndarray) -> float:
        """No document below the node scores more; 0 only if none has a term of the query."""
        names, centroid, reach, radius = self.nodes[node]
        q = query[names]
        near = q @ centroid
        if near == 0:
            return 0.0
        return (near + min(float(np.sqrt(q @ q)) * radius, float(q @ reach))) * (1 + SLACK) + 1

    def search(self, query: np.ndarray, rank: np.ndarray, top: int) -> tuple[list[tuple[int, int]], int]:
        """The ``top`` best (score, document) with a score above 0, of equal scores the smaller
        ``rank``; and how many leaves were scored."""
        if not self.spans or not len(self.docs):
            return [], 0
        weights = query.astype(np.float64)
        best: list[tuple[int, int, int]] = []  # (score, -rank, document), the worst first
        heap, leaves = [(-self.bound(0, weights), 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            if bound == 0 or len(best) == top and -bound < best[0][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (-self.bound(child, weights), child))
                continue
            lo, hi = self.spans[node]
            a, b = self.begin[lo], self.begin[hi]
            scores = np.add.reduceat(query[self.term[a:b]] * self.exact[a:b], self.begin[lo:hi] - a)
            leaves += 1
            for i in np.flatnonzero(scores >= (best[0][0] if len(best) == top else 1)):
                entry = (int(scores[i]), -int(rank[self.docs[lo + i]]), int(self.docs[lo + i]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, d) for s, _, d in sorted(best, reverse=True)], leaves


FOUND = "item_row long, item_id long, row long, doc_id long, score long"


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _search(top: int):
    def run(key, docs: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows and items.num_rows:
            docs = docs.sort_by("row")
            row, first = np.unique(_numbers(docs, "row"), return_index=True)
            ids = docs.column("id").take(pa.array(first)).to_pylist()
            rank = np.empty(len(ids), np.int64)
            rank[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, i))] = np.arange(len(ids))
            known, term = np.unique(_numbers(docs, "tid"), return_inverse=True)
            tree = BallTree(np.append(first, docs.num_rows), term, _numbers(docs, "x"), len(known))
            items = items.sort_by("item_row")
            tid, weight = _numbers(items, "tid"), _numbers(items, "q")
            at = np.searchsorted(known, tid)
            there = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == tid)
            item_row, begin = np.unique(_numbers(items, "item_row"), return_index=True)
            names = items.column("item_id").take(pa.array(begin)).to_pylist()
            for r, name, a, b in zip(item_row.tolist(), names, begin, np.append(begin[1:], len(tid)), strict=True):
                query = np.zeros(len(known), np.int64)
                mine = there[a:b]
                query[at[a:b][mine]] = weight[a:b][mine]
                out += [(r, name, int(row[d]), ids[d], s) for s, d in tree.search(query, rank, top)[0]]
        return pa.table([pa.array([o[i] for o in out], pa.int64()) for i in range(5)], names=["item_row", "item_id", "row", "doc_id", "score"])

    return run


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, doc_block: int = DOC_BLOCK, item_block: int = ITEM_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``top`` documents with a score above 0.

    Every row is a document, every item row an item, repeated or without an id; documents without
    an id stand behind those of equal score. Null and empty texts have no terms: such documents
    are never found and such items find none. Further columns are ignored; empty tables give no rows."""
    d, q = _vectors(docs, "doc_id", "vectors"), _vectors(items, "item_id", "queries")
    size = d.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()  # two numbers of the formula
    n, total = size[0] or 0, max(1, size[1] or 0)
    blocks, item_blocks = n // doc_block + 1, q.count() // item_block + 1
    wanted = q.select("row", "id", F.pmod(F.xxhash64("row"), F.lit(item_blocks)).alias("item_block"), F.explode(F.arrays_zip("term", "tf")).alias("e")).select("row", "id", "item_block", F.col("e.term").alias("term"), F.col("e.tf").alias("times"))
    vocabulary = wanted.select("term").distinct()
    listed = d.select("row", "id", "n", F.explode(F.arrays_zip("term", "tf")).alias("e")).select("row", "id", "n", F.col("e.term").alias("term"), F.col("e.tf").alias("tf"))
    df = listed.select("term").join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    weighted = materialize(df.select("term", F.monotonically_increasing_id().alias("tid"), F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long").alias("w")), "weights")
    queries = materialize(wanted.join(weighted, "term").select("item_block", F.col("row").alias("item_row"), F.col("id").alias("item_id"), "tid", "term", (F.col("times") * F.col("w")).alias("q")), "asked")
    m = F.expr(f"25 + (75 * n * {n}L) div {total}L")
    places = queries.select("term", "tid", "item_block").distinct()
    entries = listed.join(places, "term").withColumn("m", m).select("item_block", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("doc_block"), "row", "id", "tid", F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").alias("x")).toDF("item_block", "doc_block", "row", "id", "tid", "x")
    asked = queries.select("item_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("doc_block"), "item_row", "item_id", "tid", "q").toDF("item_block", "doc_block", "item_row", "item_id", "tid", "q")
    found = entries.groupBy(entries.doc_block, entries.item_block).cogroup(asked.groupBy(asked.doc_block, asked.item_block)).applyInArrow(_search(top), FOUND)
    best = W.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
