"""The transcript source against splitting whole files in memory."""

import random

import pytest

from agentlake.sources import transcripts as TR
from agentlake.sources.scan import FORMAT, Transcripts, list_files, ranges, read_range

rng = random.Random(1)


def lines_in(data):
    parts, at, out = data.split(b"\n"), 0, []
    for x in parts[:-1] if data.endswith(b"\n") or not data else parts:
        out.append((at, at + len(x) + 1, x))
        at += len(x) + 1
    return out


def test_every_cut_gives_the_same_lines(tmp_path):
    for _ in range(60):
        body = [bytes(rng.choice(b"ab\xc3\xa9\r") for _ in range(rng.choice([0, 0, 1, 5, 40]))) for _ in range(rng.randint(0, 12))]
        data = b"\n".join(body) + (b"\n" if rng.random() < 0.5 and body else b"")
        (tmp_path / "x.jsonl").write_bytes(data)
        for split in (1, 3, 7, 1000):
            for block in (1, 4, 1000):
                got = [(r["byte_start"], r["byte_end"], r["raw"]) for p in ranges(list_files(str(tmp_path)), split) for b in read_range(p, str(tmp_path), block) for r in b.to_pylist()]
                assert got == lines_in(data)


@pytest.mark.parametrize("split", [50, 1 << 26])
def test_batch_scan(spark, tmp_path, split):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "deep").mkdir()
    files = {f"p/s{k}.jsonl": b"".join(b"%d\xc3\xa9 %s\r\n" % (i, b"x" * rng.randint(0, 60)) for i in range(k * 5)) + b"open" * (k % 2) for k in range(6)}
    files |= {"p/deep/no.jsonl": b"deep\n", "p/.hidden.jsonl": b"h\n", "top.jsonl": b"t\n"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = TR.lines_of(spark, str(tmp_path), "claude", depth=1, split_bytes=split)
    got = sorted((r.path.rsplit("/", 1)[1], r.line_no, r.byte_start, r.byte_end, r.complete, r.raw) for r in rows.collect())
    want = []
    for name, data in files.items():
        if name.startswith("p/s"):
            want += [(name[2:], i + 1, a, b, b <= len(data), x.decode().removesuffix("\r")) for i, (a, b, x) in enumerate(lines_in(data))]
    assert got == sorted(want)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (split == 50)  # only files of several ranges need counts
    assert TR.lines_of(spark, str(tmp_path / "nothing"), "claude").count() == 0


def test_catalog_opens_no_file(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "s1.jsonl").write_text("abc\n")
    found = TR.catalog(spark, str(tmp_path))
    assert [(r.host, r.session_id, r["size"]) for r in found.collect()] == [("claude", "s1", 4)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_stream_goes_on_behind_the_last_line(spark, tmp_path):
    spark.dataSource.register(Transcripts)
    p = tmp_path / "in"
    p.mkdir()
    (p / "a.jsonl").write_text("1\n2\npart")
    seen = []
    q = (
        spark.readStream.format(FORMAT).option("path", str(p)).load()
        .selectExpr("regexp_extract(path, '[^/]*$', 0) AS name", "byte_start", "string(raw) AS raw")
        .writeStream.foreachBatch(lambda df, _: seen.append(sorted((r.name, r.byte_start, r.raw) for r in df.collect())))
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    try:
        q.processAllAvailable()
        (p / "a.jsonl").write_text("1\n2\npartial\n3\n")
        (p / "b.jsonl").write_text("b\n")
        q.processAllAvailable()
        (p / "b.jsonl").write_text("")
        q.processAllAvailable()
        (p / "b.jsonl").write_text("n\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert [x for s in seen for x in s] == [("a.jsonl", 0, "1"), ("a.jsonl", 2, "2"), ("a.jsonl", 4, "partial"), ("a.jsonl", 12, "3"), ("b.jsonl", 0, "b"), ("b.jsonl", 0, "n")]
