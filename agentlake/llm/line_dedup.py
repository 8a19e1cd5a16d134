"""Removal of lines that many documents share, by range-partitioned line hashes.

Every line of ``LEAST`` code points becomes one narrow row for its document (hash of its key,
document, line numbers). The rows are range-partitioned by hash and document, so that a line in a
third of all documents spreads over many tasks, and each task streams them in the order of hash,
descending document and position. The first occurrence is the largest document's and stays; once
``DOCUMENTS`` documents are seen, the others are dropped as they pass. Only the first and the last
hash of a task may go on in its neighbours: a task puts their rows aside with what it counted, and
the counts of those hashes, two a task, settle them. What comes back to a document is a compressed
bitmap of the lines it keeps, never a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.session import materialize

LEAST, DOCUMENTS = 40, 5
WHITE = " \t\n\x0b\x0c\r"
LINES = "hash binary, doc_id long, text_hash long, places binary"
#: A decided row has no ``hash``; one put aside has it, and the counts of a hash have no ``places``.
PASSED = "hash binary, doc_id long, text_hash long, places binary, documents long, largest long, nameless long"
_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _lines(least: int):
    """(hash, document, places) of each long line of a document, its line numbers together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc_id, text_hash, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found: dict[bytes, list[int]] = {}
                for at, line in enumerate((text or "").split("\n")):
                    key = line.strip(WHITE)
                    if len(key) >= least:
                        found.setdefault(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()), []).append(at)
                out += ((h, doc_id, text_hash, np.array(p, "<u4").tobytes()) for h, p in found.items())
            yield _batch(out, ["hash", "doc_id", "text_hash", "places"])

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in zip(range(len(names)), _TYPES, strict=False)], names)


class _Run:
    """The rows of one hash in a task's stream."""

    def __init__(self, key: bytes, edge: bool):
        self.key, self.edge, self.documents, self.nameless, self.held = key, edge, 0, 0, []
        self.largest, self.now = None, ()

    def add(self, doc_id, text_hash, places, documents: int) -> Iterator[tuple]:
        if (doc_id,) != self.now:
            if not self.now:
                self.largest = doc_id
            self.documents += doc_id is not None
            self.nameless += doc_id is None
            self.now = (doc_id,)
        row = (None, doc_id, text_hash, places, None, None, None)
        if self.edge:
            yield (self.key, *row[1:])
        elif doc_id != self.largest:
            if self.documents + self.nameless >= documents:
                yield from self.held
                self.held = []
                yield row
            else:
                self.held.append(row)  # rows of fewer than ``documents`` documents

    def end(self, last: bool) -> Iterator[tuple]:
        if self.edge or last:
            yield from ((self.key, *r[1:]) for r in self.held)
            yield (self.key, None, None, None, self.documents, self.largest, self.nameless)


def _stream(documents: int):
    """Drops of a task's whole hashes; the first hash's rows are put aside, the last one's as long
    as the task cannot decide them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names = None, [x.split()[0] for x in PASSED.split(", ")]
        for b in batches:
            out: list[tuple] = []
            for h, doc_id, text_hash, places in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.key != h:
                    if now is not None:
                        out += now.end(False)
                    now = _Run(h, now is None)
                out += now.add(doc_id, text_hash, places, documents)
            yield _batch(out, names)
        yield _batch(list(now.end(True)) if now is not None else [], names)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs, hashes, lists = (c.to_pylist() for c in b.columns)
        maps = []
        for parts in lists:
            gone = np.frombuffer(b"".join(parts), "<u4")
            keep = np.ones(int(gone.max()) // 8 * 8 + 8, dtype=bool)  # lines behind the last byte stay
            keep[gone] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(hashes, pa.int64()), pa.array(maps, pa.binary())], ["doc_id", "text_hash", "keep"])


def keep_bitmaps(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, keep) of each document that loses lines; ``keep`` is a compressed bitmap
    of whole bytes, with a bit for each line up to the last one dropped, and ``text_hash`` tells rows of one id apart."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    lines = materialize(texts.mapInArrow(_lines(least), LINES), "lines")
    order = ["hash", F.col("doc_id").desc_nulls_last()]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order, "text_hash")
    passed = materialize(dealt.mapInArrow(_stream(documents), PASSED), "passed")
    edges = passed.filter("documents is not null").groupBy("hash").agg(F.sum("documents").alias("n"), F.max("nameless").alias("also"), F.max("largest").alias("top"))
    # two rows a task at most, whatever the input
    edges = edges.filter(F.col("n") + F.col("also") >= documents)
    aside = passed.filter("places is not null and hash is not null").join(F.broadcast(edges), "hash").filter("not doc_id <=> top")
    gone = passed.filter("places is not null and hash is null").select("doc_id", "text_hash", "places").union(aside.select("doc_id", "text_hash", "places"))
    lists = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("places").alias("places"))
    return lists.mapInArrow(_bitmaps, "doc_id long, text_hash long, keep binary")


def kept_text(text: str | None, keep: bytes | None) -> tuple[str, int, int]:
    """The text without the lines whose bit is clear, its lines before, and the lines dropped."""
    lines = (text or "").split("\n")
    if keep is None:
        return text or "", len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8)).tolist()
    left = [x for x, k in zip(lines, bits, strict=False) if k] + lines[len(bits) :]
    return "\n".join(left), len(lines), len(lines) - len(left)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc_id, text, keep in zip(*(c.to_pylist() for c in b.columns), strict=True):
            left, n, gone = kept_text(text, keep)
            out.append((doc_id, n, gone, sha256(left.encode("utf-8", "surrogatepass")).hexdigest()))
        kinds = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])


def line_dedup(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row.

    Rows of one doc_id are one document and each keep their lines where it is the largest one.
    Rows without an id are together one document, smaller than any. A null text is one empty
    line; empty and short lines never go; further columns are ignored; an empty table gives no rows."""
    keep = keep_bitmaps(docs, least, documents).withColumnRenamed("doc_id", "id").withColumnRenamed("text_hash", "h")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(keep, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("h")), "left")
    return rows.select("doc_id", "text", "keep").mapInArrow(_applied, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
