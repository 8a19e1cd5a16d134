"""Each stage of the pipeline against a brute-force version over its own input."""

import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from agentlake.llm import toxicity as tox
from agentlake.llm.secret_scan import BASE, MORE
from agentlake.llm.tokens import load_tokenizer
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_simhash import brute_print, roots_of

SF = "/root/testdata/sf0.001"


def masked(text):
    spans = []
    for r in BASE + MORE:
        for m in re.finditer(r.pattern, text, re.ASCII):
            if len(m.group(r.group)) >= r.least:
                spans.append(m.span())
    out, at = "", 0
    for a, b in sorted(spans):
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    """(rows before, rows after) of each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    extra = spark.createDataFrame([(10**9 + 3, f"Some words before. {leak} And some after.", "en", "s", 1), (None, "token: abcdefgh12345 x", "en", None, 22), (None, "token: abcdefgh12345 x", "en", None, 22), (10**9, None, None, "s", None), (10**9 + 1, "", "en", "s", 0), (10**9 + 2, "w " * 60_000, "en", "s", 120_000)], docs.schema)
    docs, out = docs.unionByName(extra), {}
    for name, fn in corpus_pipeline.STAGES:
        before = docs.collect()
        after = spark.createDataFrame(fn(spark, docs, SF).collect(), fn(spark, docs, SF).schema)
        out[name] = (before, after.collect())
        docs = after
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.createDataFrame(before, spark.read.parquet(f"{SF}/documents.parquet").schema)
    model = tox.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = tox.Scorer(model).scores([r.text for r in before])
    assert sorted(after, key=key) == sorted((r for r, s in zip(before, scores, strict=True) if s < 0.5), key=key)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    prints = [brute_print(r.text) for r in before]
    root = roots_of(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 2)
    groups = {}
    for r, p in zip(before, prints, strict=True):
        groups.setdefault(root[p], []).append(r)
    want = [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")) for g in groups.values()]
    assert sorted(after, key=key) == sorted(want, key=key)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [r for r in before if not brute_hits([(r.doc_id, r.text)], items, 10)[0][2]]
    assert sorted(after, key=key) == sorted(want, key=key)
    assert len(after) < len(before)


def test_secrets(stages):
    before, after = stages["secrets"]
    want = [(r.doc_id, None if r.text is None else masked(r.text)) for r in before]
    assert sorted(((r.doc_id, r.text) for r in after), key=key) == sorted(want, key=key)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)


def test_encoding(stages):
    before, after = stages["encoding"]
    tk = load_tokenizer("word_bpe_49k.json")
    want = []
    for r in before:
        ids = tk.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((tuple(r) for r in after), key=key) == sorted(want, key=key)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


CLASHES = ("__h", "__found", "__text", "__id", "__score", "__rules", "row", "h", "score", "bits", "text_hash", "doc id.x", "first", "changed", "masked")


def test_clashing_columns_stay(spark):
    texts = ["", None, "some words of no interest", "token: abcdefgh12345 x"]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *(f"{c}{i}" for c in CLASHES)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    for name, fn in corpus_pipeline.STAGES[:-1]:
        got = fn(spark, docs, SF)
        assert got.columns == docs.columns, name
        rows = {r.doc_id: r for r in got.collect()}
        for i, r in rows.items():
            assert all(r[c] == f"{c}{i}" for c in CLASHES), name
        assert 3 in rows and (rows[3].text, rows[3].n_chars) == (("[secret] x", 10) if name == "secrets" else (texts[3], 22)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 4


def test_one_row_of_each_group(spark):
    rows = [(1, "some text of one group"), (2, "some text of one group"), (1, "another thing altogether, not alike"), (3, "another thing altogether, not alike"), (None, "a third one, nameless"), (None, "a third one, nameless")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", rows[2][1]), ("1", rows[0][1]), ("None", rows[4][1])]
