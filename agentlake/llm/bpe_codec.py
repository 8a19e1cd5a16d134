"""BPE encoding and decoding with tree concatenation of long unsplit text.

Texts are cut at stable blanks (``tokens``); a piece that stays long has no such place. It is
halved, the halves are encoded as one batch, level by level up the tree, and each join is
mended: a window around it is encoded anew and grows until, on either side, its tokens begin
and end at cuts that the half had made too and agree with the half's tokens from there on.
A half's cut counts only where the split pattern is proven to have no view beyond it: an ASCII
character begins a new pre-token there, ``MARGIN`` or more characters from an artificial end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.llm.tokens import PieceMemo, is_visible, load_tokenizer

TOKENIZER = "word_bpe_49k.json"
LEAF, WINDOW, MARGIN, MEMO = 8192, 256, 64, 250_000
JOINT = 128  # pieces encoded as one text


class Encoded:
    """Ids of a stretch of text, and where each of its pre-tokens begins: offset to number of ids before."""

    def __init__(self, ids: np.ndarray, cuts: dict[int, int], begin: int, end: int):
        self.ids, self.cuts, self.begin, self.end = ids, cuts, begin, end


def _encode(tk, text: str, spans: list[tuple[int, int]]) -> list[Encoded]:
    out = []
    for (begin, end), e in zip(spans, tk.encode_batch([text[a:b] for a, b in spans], add_special_tokens=False), strict=True):
        words, cuts, last = e.word_ids, {}, object()
        for i, (w, (a, _)) in enumerate(zip(words, e.offsets, strict=True)):
            if w is None or w != last:
                x = begin + a
                if text[x].isascii() and (x == 0 or text[x - 1].isascii()) and x not in cuts:
                    cuts[x] = i
            last = w
        out.append(Encoded(np.array(e.ids, dtype="<u4"), cuts, begin, end))
    return out


def _join(tk, text: str, left: Encoded, right: Encoded, window: int) -> Encoded:
    """One stretch from two neighbours; exact, because both sides of the window agree."""
    at, size = left.end, window
    while True:
        a, b = max(left.begin, at - size), min(right.end, at + size)
        if a == left.begin and b == right.end:
            return _encode(tk, text, [(a, b)])[0]
        mid = _encode(tk, text, [(a, b)])[0]
        far_left = a + MARGIN if a > left.begin else left.begin
        far_right = b - MARGIN if b < right.end else right.end
        xs = [x for x in mid.cuts if far_left <= x <= at - MARGIN and x in left.cuts] if a > left.begin else [left.begin]
        ys = [y for y in mid.cuts if at + MARGIN <= y <= far_right and y in right.cuts] if b < right.end else [right.end]
        for x in xs[:1]:
            for y in ys[-1:]:
                i = left.cuts[x] if a > left.begin else 0
                m0 = mid.cuts[x] if a > left.begin else 0
                j = right.cuts[y] if b < right.end else len(right.ids)
                m1 = mid.cuts[y] if b < right.end else len(mid.ids)
                ids = np.concatenate([left.ids[:i], mid.ids[m0:m1], right.ids[j:]])
                cuts = {c: n for c, n in left.cuts.items() if c < x} | {c: n - m0 + i for c, n in mid.cuts.items() if x <= c < y}
                cuts |= {c: n - j + i + m1 - m0 for c, n in right.cuts.items() if c >= y}
                return Encoded(ids, cuts, left.begin, right.end)
        size *= 2


def encode_long(tk, text: str, leaf: int = LEAF, window: int = WINDOW) -> np.ndarray:
    """The library's ids of ``text``, from encodings of its halves."""
    parts = 1
    while len(text) / parts > leaf:
        parts *= 2
    edges = [len(text) * i // parts for i in range(parts + 1)]
    level = _encode(tk, text, list(zip(edges[:-1], edges[1:], strict=True)))
    while len(level) > 1:
        level = [_join(tk, text, level[i], level[i + 1], window) for i in range(0, len(level), 2)]
    return level[0].ids


def _together(tk, xs: list[str]) -> list[tuple[bytes, str]]:
    """Ids and decoded text of pieces, encoded as one text: each begins with its blank and both
    ends of every join are visible, so the joins are stable cuts. Offsets tell whose a token is."""
    (e,) = tk.encode_batch(["".join(xs)], add_special_tokens=False)
    begins = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
    cuts = [0, *np.searchsorted(begins, np.cumsum([len(x) for x in xs])).tolist()]
    ids, tokens = np.array(e.ids, dtype="<u4").tobytes(), e.tokens
    return [(ids[4 * i : 4 * j], " ".join(tokens[i:j])) for i, j in pairwise(cuts)]


def _codec(tokenizer: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = load_tokenizer(tokenizer)

        def encode(xs: list[str]) -> list[tuple[bytes, str]]:
            joint = [x for x in xs if len(x) <= leaf and x[:1] == " " and is_visible(x[1:2]) and is_visible(x[-1])]
            made = {x: v for k in range(0, len(joint), JOINT) for x, v in zip(joint[k : k + JOINT], _together(tk, joint[k : k + JOINT]), strict=True)}
            for x in xs:
                if x not in made:
                    ids = encode_long(tk, x, leaf) if len(x) > leaf else np.array(tk.encode(x, add_special_tokens=False).ids, dtype="<u4")
                    made[x] = ids.tobytes(), tk.decode(ids.tolist(), skip_special_tokens=False)
            return [made[x] for x in xs]

        memo = PieceMemo(encode, MEMO)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1).to_pylist():
                got = memo.values(text or "")
                ids = b"".join([g[0] for g in got])
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                # the vocabulary has no decoder of its own: tokens are joined by one blank
                text_sha.append(hashlib.sha256(" ".join([g[1] for g in got if g[0]]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_decode(docs: DataFrame, tokenizer: str = TOKENIZER, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, one row for each input row.

    Ids as the library gives them without added special tokens, hashed as little-endian 32-bit
    words; the decoded text keeps special tokens. A null text counts as empty; null and
    repeated ids keep a row each; further columns are ignored; an empty table gives no rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_codec(tokenizer, leaf), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
