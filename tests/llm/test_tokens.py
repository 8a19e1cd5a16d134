"""Token counts and the codec against the library itself."""

import hashlib
import random

import numpy as np
import pytest

from agentlake.llm.bpe_codec import _together, encode_decode, encode_long
from agentlake.llm.token_counts import token_counts
from agentlake.llm.tokens import PieceMemo, is_visible, load_tokenizer, pieces

rng = random.Random(5)
ALPHABET = ["a", "bc", "THE", " ", "  ", "\n", "\t", ".", "'s", "'re", "'", "é", "é", "́", " ", "\u0085", "\x1c", "日本", "Σ", "ς", "7", "½", "٣", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "‍", "ﬁ", "İ", "　", "$$$"]


def some_text(n: int) -> str:
    return "".join(rng.choice(ALPHABET) if rng.random() < 0.5 else rng.choice(["word", " next", " and", " the"]) for _ in range(n))


TEXTS = ["", None, " ", "   ", "\n\n", "a", " a", "a ", "x" * 3000] + [some_text(rng.randint(1, 80)) for _ in range(300)]
HUGE = [some_text(6000), "ab" * 40_000, ("abc7. " * 9000), "日本" * 9000, " " * 40_000, "x " * 20_000 + "y" * 30_000 + " z" * 9000, "".join(rng.choice("ab1.,'s") for _ in range(60_000))]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_the_whole(name):
    tk = load_tokenizer(name)
    memo = PieceMemo(lambda xs: [e.ids for e in tk.encode_batch(xs, add_special_tokens=False)], 200)
    for t in [t for t in TEXTS if t] + HUGE[:1]:
        assert "".join(pieces(t)) == t
        assert sum(memo.values(t), []) == tk.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_encoded_as_one_text():
    tk = load_tokenizer("word_bpe_49k.json")
    odd = [p for t in [t for t in TEXTS if t] for p in list(pieces(t))[1:] if is_visible(p[-1])]
    odd += [" it's", " don'T,", " İx", " ﬁn", " 日本", " a<|endoftext|>b", " a\n\tb", " e\u0301\u0323e", " 7½", " x\u200dy"]
    for k in (1, 7, len(odd)):
        for i in range(0, len(odd), k):
            for p, (ids, text) in zip(odd[i : i + k], _together(tk, odd[i : i + k]), strict=True):
                want = tk.encode(p, add_special_tokens=False).ids
                assert np.frombuffer(ids, "<u4").tolist() == want, repr(p)
                assert text == tk.decode(want, skip_special_tokens=False), repr(p)


def test_tree_concatenation_is_exact():
    tk = load_tokenizer("word_bpe_49k.json")
    for t in HUGE + [some_text(400).replace(" ", "") for _ in range(60)]:
        for leaf, window in ((64, 8), (500, 100), (4096, 128)):
            if len(t) > leaf and len(t) / leaf < 600:
                assert encode_long(tk, t, leaf, window).tolist() == tk.encode(t, add_special_tokens=False).ids


def table(spark, texts):
    rows = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)] + [(4, texts[4], "again", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, k int")


def test_token_counts(spark):
    tk = load_tokenizer("byte_bpe_50k.json")
    texts = TEXTS + HUGE
    want = sorted((-1 if i == 3 else i, len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids)) for i, t in [*enumerate(texts), (4, texts[4])])
    for chunk, overlap in ((300, 16), (32768, 256)):
        got = token_counts(table(spark, texts), chunk=chunk, overlap=overlap).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_encode_decode(spark):
    tk = load_tokenizer("word_bpe_49k.json")
    texts = TEXTS + HUGE

    def brute(i, t):
        ids = tk.encode(t or "", add_special_tokens=False).ids
        text = tk.decode(ids, skip_special_tokens=False)
        return (-1 if i == 3 else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())

    want = sorted(brute(i, t) for i, t in [*enumerate(texts), (4, texts[4])])
    got = encode_decode(table(spark, texts)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_empty_tables(spark):
    none = table(spark, TEXTS).limit(0)
    assert token_counts(none).count() == 0
    assert encode_decode(none).count() == 0
