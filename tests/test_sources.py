"""File sources and sinks on small files."""

import json

from pyspark.sql import functions as F

from agentlake.operators import codex as CX
from agentlake.operators import records as R
from agentlake.sources import state as ST
from agentlake.sources import transcripts as TR


def test_raw_lines_have_byte_offsets(spark, tmp_path):
    p = tmp_path / "proj"
    p.mkdir()
    body = '{"type":"user","n":"é"}\n\n{bad\r\n{"type":"mode"}'
    (p / "s1.jsonl").write_bytes(body.encode())
    (p / "deep").mkdir()
    (p / "deep" / "sub.jsonl").write_text('{"type":"user"}\n')
    rows = TR.raw_lines(spark, f"{tmp_path}/*/*.jsonl", "claude").orderBy("line_no").collect()
    data = body.encode()
    assert [data[r.byte_start:r.byte_end] for r in rows] == [x + b"\n" for x in data.split(b"\n")[:-1]] + [data.split(b"\n")[-1]]
    assert [r.complete for r in rows] == [True, True, True, False]
    lines = TR.read_claude(spark, str(tmp_path))
    assert [r.session_id for r in lines.select("session_id").distinct().collect()] == ["s1"]
    _, counts = TR.parse_jsonl(TR.raw_lines(spark, f"{tmp_path}/*/*.jsonl", "claude"))
    assert [(r.records, r.malformed, r.blank, r.failed) for r in counts.collect()] == [(2, 1, 1, False)]


def test_rollout_file(spark, tmp_path):
    sid = "0199a213-81c0-7800-8aa1-bbab2a035a53"
    d = tmp_path / "2026" / "01"
    d.mkdir(parents=True)
    events = [
        {"timestamp": "t0", "type": "session_meta", "payload": {"id": sid, "cwd": "/w"}},
        {"type": "turn_context", "payload": {"model": "m"}},
        {"timestamp": "t1", "type": "response_item", "payload": {"type": "message", "role": "user", "content": [{"type": "input_text", "text": "do it"}]}},
        {"timestamp": "t2", "type": "response_item", "payload": {"type": "function_call", "name": "sh", "arguments": '{"a":1}', "call_id": "c1"}},
        {"timestamp": "t3", "type": "response_item", "payload": {"type": "function_call_output", "call_id": "c1", "output": {"ok": True}}},
        {"timestamp": "t4", "type": "event_msg", "payload": {"type": "token_count", "info": {"total_token_usage": {"input_tokens": 10, "cached_input_tokens": 4, "output_tokens": 3}}}},
    ]
    (d / f"rollout-2026-01-01T00-00-00-{sid}.jsonl").write_text("\n".join(map(json.dumps, events)) + "\n")
    ev = TR.read_codex(spark, str(tmp_path))
    records, meta = CX.codex_to_records(ev)
    rows = records.orderBy("seq").collect()
    assert [(r.type, r.ts) for r in rows] == [("user", "t1"), ("assistant", "t2"), ("user", "t3")]
    assert rows[1].usage.input_tokens == 6 and rows[1].usage.cache_read_input_tokens == 4 and rows[1].model == "m"
    assert rows[2].blocks[0].content == '{"ok":true}' and rows[2].blocks[0].tool_use_id == "c1"
    assert R.validate(records).count() == 0
    m = meta.first()
    assert (m.meta_id, m.title, m.cwd) == (sid, "do it", "/w")


def test_artifact_bodies(spark, tmp_path):
    (tmp_path / "a.md").write_bytes("fine é".encode())
    (tmp_path / "b.md").write_bytes(b"bad \xff")
    (tmp_path / "c.md").write_bytes(b" \n\t")
    good, bad = ST.read_artifacts(spark, str(tmp_path))
    assert [r.content for r in good.collect()] == ["fine é"]
    assert sorted(r.reason for r in bad.collect()) == ["empty", "not utf-8"]


def test_board_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("r", '{"agents":{"s1":{"status":"active","last_update":5}}}'), ("q", "{oops")], "repo string, value string")
    board = ST.parse_board(docs)
    ST.write_board(board, str(tmp_path / "b"))
    assert ST.read_board(spark, str(tmp_path / "b")).select("repo", "session_id").collect() == [("r", "s1")]


def test_redaction_keeps_the_last_of_colliding_keys(spark):
    k1, k2 = "mhk_" + "a" * 20, "mhk_" + "b" * 20
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    df = spark.createDataFrame([(json.dumps({k1: 1, k2: 2}),), (json.dumps({"x": k1}),)], "j string").select(F.parse_json("j").alias("v"))
    got = [(r.redaction_failed, r.t) for r in R.redact_records(df).select("redaction_failed", F.to_json("v").alias("t")).collect()]
    assert got == [(False, '{"mhk_<redacted>":2}'), (False, '{"x":"mhk_<redacted>"}')]


def test_a_backstop_of_a_batch_number_keeps_the_batch(spark, tmp_path):
    from agentlake.streaming import ingest as IN

    rows = spark.createDataFrame([("c1", "u1", 1), ("c1", "u2", 2), ("c2", None, 1)], "conversation_id string, uuid string, seq long")
    more = spark.createDataFrame([("c1", "u2", 2), ("c1", "u3", 3)], "conversation_id string, uuid string, seq long")
    target = str(tmp_path / "t")
    IN.merge_batch(rows, 0, target)
    IN.backstop(more, target, 0)
    IN.merge_batch(rows, 0, target)  # a replay
    assert [tuple(r) for r in IN.acks(spark, target).collect()] == [("c1", "u3", 3)]


def test_readers_are_dispatched_and_checked(spark, tmp_path):
    import pytest

    from agentlake.operators import imports as IM

    p = tmp_path / "proj"
    p.mkdir()
    rows = [
        {"type": "user", "uuid": "u1", "timestamp": "2024-01-01T00:00:00Z", "message": {"role": "user", "content": "hi"}},
        {"type": "user", "timestamp": "2024-01-01T00:00:01Z", "message": {"role": "user", "content": "no id"}},
    ]
    (p / "s1.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows) + "\t\n")
    records, problems = IM.read_records("claude", spark, str(tmp_path))
    assert records.count() == 2
    assert [(r.seq, r.problem) for r in problems.collect()] == [(2, "missing uuid")]
    with pytest.raises(ValueError, match="no reader"):
        IM.read_records("nobody", spark, str(tmp_path))
    IM.register_reader("bare", lambda s: s.range(1))
    with pytest.raises(ValueError, match="gives no"):
        IM.read_records("bare", spark)
    _, counts = TR.parse_jsonl(TR.raw_lines(spark, f"{tmp_path}/*/*.jsonl", "claude"))
    assert [(r.records, r.malformed, r.blank) for r in counts.collect()] == [(2, 0, 1)]


def test_imports_refuse_unknown_platforms(spark):
    import pytest

    records = spark.createDataFrame([("s1", 1, "{}"), ("s2", 1, "{}")], "session_id string, seq long, record string")
    sliced = spark.createDataFrame([("s1", 1, 1), ("s2", 1, 1)], "session_id string, seq long, slice long")
    sessions = lambda host: spark.createDataFrame([("s1", "claude", "t", "b", "o", "n"), ("s2", host, "t", "b", "o", "n")], "session_id string, host string, title string, brain_id string, org_id string, namespace string")
    assert sorted(r.source_platform for r in ST.build_imports(records, sliced, sessions("codex")).collect()) == ["claude", "codex"]
    for host in ("other", None):
        with pytest.raises(Exception, match="unknown source platform"):
            ST.build_imports(records, sliced, sessions(host)).collect()
