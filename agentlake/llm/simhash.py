"""Near duplicates by SimHash: fingerprints that differ in few bits, grouped.

A fingerprint is embedded as the vector of its segments' bit counts. Two fingerprints at d
differing bits are at most d apart there in Manhattan distance, so a grid range-join on that
space finds all links: each fingerprint visits the grid cells within half of the distance, and
linked ones meet in a cell. Cells with one visitor are done. In the others links are verified
exactly by meeting points: fingerprints at two or fewer bits from each other share a bit
pattern at one or none from both, and the cell they met in says in which segment it differs.
All visitors of one meeting point are linked to the least of them, so neither copies nor large
groups are expanded into pairs, and no link between different fingerprints is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.graph import components
from agentlake.llm.native import own_columns
from agentlake.session import materialize

WORDS, DISTANCE, SEED = 3, 2, 42
SEGMENT = 4  # bits of a segment; its bit count takes one hexadecimal digit of the cell


def fingerprint(text: str | None, n_words: int = WORDS, seed: int = SEED) -> int:
    """SimHash over XXH64 of the word shingles; no words give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(sizes + 1) - sizes - 1
    last = max(0, len(words) - n_words)
    ends = (begins + sizes)[n_words - 1 :] if len(words) >= n_words else np.array([len(line)])
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    spans = list(zip(begins[: last + 1].tolist(), ends.tolist(), strict=True))
    for i in range(0, len(spans), 65536):
        h = np.array([digest(line[a:b], seed) for a, b in spans[i : i + 65536]], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * c > len(spans) else "0" for c in ones), 2)


def _fingerprints(n_words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array([fingerprint(t, n_words, seed) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f, pa.int64()), *b.columns[2:]], ["doc_id", "bits", *b.schema.names[2:]])

    return run


def fingerprints(docs: DataFrame, n_words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, bits) of every row, and its ``text_hash`` if ``docs`` has one."""
    more = ["text_hash"] if "text_hash" in docs.columns else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more).mapInArrow(_fingerprints(n_words, seed), "doc_id long, bits long" + "".join(f", {c} long" for c in more))


def _visits(prints: DataFrame) -> DataFrame:
    """(bits, cell, segment, up): the grid cells within one step of each fingerprint's own."""
    counts = [F.bit_count(F.shiftrightunsigned("bits", SEGMENT * s).bitwiseAND(F.lit(2**SEGMENT - 1))).cast("long") for s in range(64 // SEGMENT)]
    cell = counts[0]
    for s, c in enumerate(counts[1:], 1):
        cell = cell.bitwiseOR(F.shiftleft(c, SEGMENT * s))
    own = prints.select("bits", cell.alias("own"), F.array(*counts).alias("counts"))
    step = lambda s, up: F.when((F.col("counts")[s] < SEGMENT) if up else (F.col("counts")[s] > 0), F.struct((F.col("own") + F.lit((1 if up else -1) * 2 ** (SEGMENT * s)).cast("long")).alias("cell"), F.lit(s).alias("segment"), F.lit(up).alias("up")))
    steps = [F.struct(F.col("own").alias("cell"), F.lit(-1).alias("segment"), F.lit(True).alias("up"))]
    steps += [step(s, up) for s in range(64 // SEGMENT) for up in (True, False)]
    return own.select("bits", F.explode(F.array(*steps)).alias("v")).filter("v is not null").select("bits", "v.*")


def _meeting_points(visits: DataFrame) -> DataFrame:
    """(bits, point): the bit patterns within one bit of ``bits`` that lie in the visited cell."""
    def flipped(i: int):
        bit = F.expr(f"shiftleft(1L, segment * {SEGMENT} + {i})")
        return F.when((F.col("bits").bitwiseAND(bit) == 0) == F.col("up"), F.col("bits").bitwiseXOR(bit))

    points = F.when(F.col("segment") < 0, F.array("bits")).otherwise(F.array(*(flipped(i) for i in range(SEGMENT))))
    return visits.select("bits", F.explode(points).alias("point")).filter("point is not null")


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all at two or fewer bits."""
    visits = _visits(prints)
    shared = visits.groupBy("cell").agg(F.min("bits").alias("lo"), F.max("bits").alias("hi")).filter("lo <> hi").select("cell")
    points = _meeting_points(visits.join(shared, "cell", "left_semi"))
    least = points.groupBy("point").agg(F.min("bits").alias("b"), F.max("bits").alias("hi")).filter("b <> hi").select("point", "b")
    return points.join(least, "point").select(F.col("bits").alias("a"), "b").filter("a <> b").distinct()


def classes(hashed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(bits, component_id, root_bits) of the fingerprints in ``hashed`` (doc_id, bits)."""
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")
    prints = hashed.groupBy("bits").agg(F.min("doc_id").alias("least"))
    if distance == 2:
        edges = links(prints.select("bits"))
    elif distance == 1:
        flips = F.array(*(F.col("bits").bitwiseXOR(F.lit(-(2**63) if i == 63 else 2**i).cast("long")) for i in range(64)))
        edges = prints.select(F.col("bits").alias("a"), F.explode(flips).alias("bits")).join(prints.select("bits"), "bits").select("a", F.col("bits").alias("b"))
    else:
        edges = prints.select(F.col("bits").alias("a"), F.col("bits").alias("b")).limit(0)
    roots = components(edges)
    rooted = prints.join(roots, prints.bits == roots.node, "left").select("bits", "least", F.coalesce("root", "bits").alias("root_bits"))
    ids = rooted.groupBy("root_bits").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root_bits").select("bits", "component_id", "root_bits")


def near_duplicates(docs: DataFrame, n_words: int = WORDS, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint, component_id, root of every row; links are transitive.

    ``distance`` is 0, 1 or 2 bits (1 and 0 link at most what 2 links). A null text has no words;
    texts without words share fingerprint zero and are linked like any others. Repeated rows
    stay; a null doc_id is never a component_id, a component of null ids alone has none, and
    ``root`` (the component's least fingerprint) still tells it apart. Further columns are
    ignored; an empty table gives no rows."""
    hashed = materialize(fingerprints(docs.select("doc_id", "text"), n_words, seed), "fingerprints")
    digits = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return hashed.join(classes(hashed, distance), "bits").select("doc_id", digits("bits").alias("fingerprint"), "component_id", digits("root_bits").alias("root"))


def representatives(docs: DataFrame, n_words: int = WORDS, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """One row of each group of near duplicates, with its own columns: the least doc_id (a null is
    larger than any), of several texts of that id one by its hash, of repeated rows one."""
    text_hash = F.xxhash64("text").alias("text_hash")
    hashed = materialize(fingerprints(docs.select("doc_id", "text", text_hash), n_words, seed), "fingerprints")
    rooted = hashed.join(classes(hashed, distance).select("bits", "root_bits"), "bits")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = rooted.groupBy("root_bits").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    rows = docs.select(own_columns(docs), F.col("doc_id").cast("long").alias("doc_id"), text_hash)
    found = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")), "left_semi")
    return found.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
