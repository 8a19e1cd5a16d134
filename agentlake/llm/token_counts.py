"""Token counts by overlap resynchronisation.

A huge text is cut into chunks that overlap; each chunk is a Spark row of its own, encoded
anywhere in the cluster. A chunk reports the first stable cut (see ``tokens``) inside each of
its two overlaps and the tokens before it. Whether a place is a stable cut depends on its two
neighbouring characters alone, so both chunks find the same one; the splice checks that they
did: tokens before the cut count for the left chunk, tokens after it for the right one. An overlap
without a stable cut is widened until it has one or reaches the end of the text, so text that
never breaks stays in one chunk and is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agentlake.llm.tokens import PieceMemo, load_tokenizer, pieces, stable_cut

TOKENIZER = "byte_bpe_50k.json"
CHUNK, OVERLAP, MEMO = 32768, 256, 400_000


def chunk_bounds(text: str, chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """(begin, end, overlap at the end) of the chunks of ``text``: the next one begins
    ``overlap`` characters before this one ends, or as many more as a stable cut takes."""
    out, begin = [], 0
    while True:
        end = begin + chunk
        if end >= len(text):
            out.append((begin, len(text), 0))
            return out
        width = overlap
        while stable_cut(text, end - overlap + 1, end - overlap + width - 1) == -1 and end - overlap + width < len(text):
            width *= 2
        end = end - overlap + width
        if end >= len(text):
            out.append((begin, len(text), 0))
            return out
        out.append((begin, end, width))
        begin = end - width


def _memo(tokenizer: str) -> PieceMemo:
    tk = load_tokenizer(tokenizer)
    return PieceMemo(lambda xs: [len(e.ids) for e in tk.encode_batch_fast(xs, add_special_tokens=False)], MEMO)


def _count_short(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(tokenizer)
        for b in batches:
            n = [sum(memo.values(t)) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


CHUNKS = "row_id long, doc_id long, n_bytes long, k long, begin long, head long, tail long, chunk string"
COUNTED = "row_id long, doc_id long, n_bytes long, k long, n long, head_x long, head_n long, tail_x long, tail_n long"


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row_id", "doc_id", "n_bytes", "k", "begin", "head", "tail", "chunk"]
        for b in batches:
            for row, doc, size, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                bounds = chunk_bounds(text, chunk, overlap)
                for at in range(0, len(bounds), 64):
                    some = bounds[at : at + 64]
                    cols = [[row] * len(some), [doc] * len(some), [size] * len(some), range(at, at + len(some)), [x[0] for x in some]]
                    cols += [[bounds[i - 1][2] if i else 0 for i in range(at, at + len(some))], [x[2] for x in some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols] + [pa.array([text[x[0] : x[1]] for x in some], pa.string())], names)

    return run


def count_chunk(memo: PieceMemo, text: str, begin: int, head: int, tail: int) -> tuple:
    """Tokens of a chunk; place of the first stable cut in its first ``head`` characters and the
    tokens before it; the same for its last ``tail`` characters (null where there is no overlap)."""
    parts = list(pieces(text))
    values = memo.of_pieces(parts)
    cuts, at, n = [], 0, 0
    for p, v in zip(parts, values, strict=True):
        cuts.append((begin + at, n))
        at, n = at + len(p), n + v
    none = (None, None)
    first = lambda lo, hi: next(((x, m) for x, m in cuts[1:] if lo < x < hi), none)
    end = begin + len(text)
    return n, *(first(begin, begin + head) if head else none), *(first(end - tail, end) if tail else none)


def _count_chunks(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(tokenizer)
        for b in batches:
            got = [count_chunk(memo, t, *x) for t, *x in zip(*(b.column(i).to_pylist() for i in (7, 4, 5, 6)), strict=True)]
            cols = [b.column(i) for i in range(4)] + [pa.array([g[i] for g in got], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in COUNTED.split(", ")])

    return run


def splice(counted: DataFrame) -> DataFrame:
    """Token counts of whole texts from the counts of their chunks."""
    w = W.partitionBy("row_id").orderBy("k")
    return (
        counted.withColumn("next_x", F.lead("head_x").over(w))
        .withColumn("last", F.lead("k").over(w).isNull())
        .withColumn("agreed", F.col("last") | F.coalesce(F.col("tail_x") == F.col("next_x"), F.lit(False)))
        .withColumn("own", F.when(F.col("agreed"), F.when(F.col("last"), F.col("n")).otherwise(F.col("tail_n")) - F.coalesce(F.col("head_n"), F.lit(0))).otherwise(F.raise_error(F.lit("chunks share no stable cut")).cast("long")))
        .groupBy("row_id")
        .agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum("own").alias("n_tokens"))
        .drop("row_id")
    )


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text, one row for each input row.

    ``tokenizer`` is a file of ``public_tokenizers`` or a path that all executors have. A null
    text counts as empty (0 bytes, 0 tokens); null and repeated ids keep a row each; further
    columns are ignored; an empty table gives no rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    short = rows.filter(F.length("text") <= chunk).mapInArrow(_count_short(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    long = (
        rows.filter(F.length("text") > chunk)
        .select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_bytes", "text")
        .mapInArrow(_cut(chunk, overlap), CHUNKS)
        .repartition("row_id", "k")
        .mapInArrow(_count_chunks(tokenizer), COUNTED)
    )
    return short.unionByName(splice(long)).withColumn("over_limit", F.col("n_tokens") > limit)
