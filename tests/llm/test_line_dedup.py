"""Line deduplication against counting every line in memory."""

import hashlib
import random

import pytest

from agentlake.llm.line_dedup import _lines, _stream, keep_bitmaps, kept_text, line_dedup

rng = random.Random(13)
WHITE = " \t\n\x0b\x0c\r"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(docs):
    where = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            k = lower(line.strip(WHITE))
            if len(k) >= 40:
                where.setdefault(k, set()).add(doc)
    top = {k: max((d for d in v if d is not None), default=None) for k, v in where.items() if len(v) >= 5}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (k := lower(x.strip(WHITE))) not in top or top[k] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def docs():
    shared = [f"Shared line {i} " + "É" * rng.randint(20, 60) for i in range(30)] + ["x" * 39, "y" * 40, "日" * 40]
    hot = "This line stands in a third of all documents, or more"
    out = []
    for k in range(400):
        lines = [rng.choice(shared) if rng.random() < 0.3 else f"own {k} {i} " + "w" * rng.randint(0, 80) for i in range(rng.randint(1, 12))]
        lines += [hot.upper() if k % 2 else f"\t {hot}\r"] * (k % 3)
        rng.shuffle(lines)
        out.append((k, "\n".join(lines)))
    out += [(1000, None), (1001, ""), (1002, "\n\n"), (None, shared[0] + "\n" + hot), (None, shared[0]), (1003, hot + "\n" * 40_000 + shared[1])]
    return out + [out[5], out[5], (5, shared[2] + "\nother"), (2000, out[9][1])]


def test_against_brute_force(spark, docs):
    d = spark.createDataFrame([(*x, "a", b"b", 1) for x in docs], "doc_id long, text string, hash string, keep binary, places int")
    assert sorted((tuple(r) for r in line_dedup(d).collect()), key=str) == brute(docs)
    assert line_dedup(d.limit(0)).count() == 0
    bits = {(r.doc_id, r.text_hash): r.keep for r in keep_bitmaps(d).collect()}
    assert 0 < len(bits) < len(docs)
    assert kept_text("a\nb", None) == ("a\nb", 2, 0)


def test_cut_streams(docs):
    """Hashes that lie in several tasks: whatever the cuts, every row is dropped, kept or put aside."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in docs], pa.int64()), pa.array(range(len(docs)), pa.int64()), pa.array([x[1] for x in docs])], ["doc_id", "text_hash", "text"])
    rows = [r for b in _lines(40)(iter([batch])) for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["hash"], r["doc_id"] is None, -(r["doc_id"] or 0), r["text_hash"]))
    want = set()
    for h in {r["hash"] for r in rows}:
        mine = [r for r in rows if r["hash"] == h]
        if len({r["doc_id"] for r in mine}) >= 5:
            want |= {(r["text_hash"], r["places"]) for r in mine if r["doc_id"] != mine[0]["doc_id"]}
    for cuts in ([], [3], sorted(rng.sample(range(len(rows)), 40))):
        # equal documents of a hash are never cut apart
        at = sorted({next((j for j in range(i, 0, -1) if (rows[j]["hash"], rows[j]["doc_id"]) != (rows[j - 1]["hash"], rows[j - 1]["doc_id"])), 0) for i in cuts})
        gone, aside, sums = set(), [], {}
        for a, b in zip([0, *at], [*at, len(rows)], strict=True):
            part = pa.Table.from_pylist(rows[a:b], schema=pa.schema([("hash", pa.binary()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("places", pa.binary())]))
            for out in _stream(5)(iter(part.to_batches(max_chunksize=17))):
                for r in out.to_pylist():
                    if r["documents"] is not None:
                        sums.setdefault(r["hash"], []).append((r["documents"], r["nameless"], r["largest"]))
                    elif r["hash"] is None:
                        gone.add((r["text_hash"], r["places"]))
                    else:
                        aside.append(r)
        for r in aside:
            s = sums[r["hash"]]
            if sum(x[0] for x in s) + max(x[1] for x in s) >= 5 and r["doc_id"] != max((x[2] for x in s if x[2] is not None), default=None):
                gone.add((r["text_hash"], r["places"]))
        assert gone == want
