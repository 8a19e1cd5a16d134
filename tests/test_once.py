"""ST06 without a cap, as a stream over several triggers."""

import random

from agentlake.streaming import ingest as IN
from agentlake.streaming.state import WEEK_MS, _least, once_per_session

SCHEMA = "session_id string, item string, event_id long, note string"


def test_each_item_passes_once_with_its_least_row(spark, tmp_path):
    rnd = random.Random(6)
    names = [None, "a", "b", "c"]
    rows = [(rnd.choice(names), rnd.choice(names), rnd.choice([None, *range(40)]), str(i)) for i in range(240)]
    want = {}
    for trigger in (rows[:120], rows[120:] + [("new", "x", None, "n"), ("new", "x", 7, "s"), ("new", "x", 9, "g")]):
        spark.createDataFrame(trigger, SCHEMA).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        stream = once_per_session(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "item")
        got = IN.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", timed=True).collect()
        groups = {}
        for s, i, e, _ in trigger:
            groups.setdefault((s, i), []).append(e)
        want = {k: min((e for e in es if e is not None), default=None) for k, es in groups.items()} | want
        assert len(got) == len(want) and {(r.session_id, r.item): r.event_id for r in got} == want
        assert all((r.session_id, r.item, r.event_id, r.note) in rows or r.note == "s" for r in got)
    assert want["new", "x"] == 7


def test_an_item_passes_again_after_the_ttl(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([("s", "x", i, "n")], SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = once_per_session(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "item", ttl_ms=2)
        got = IN.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", timed=True).count()
        assert got == 1 if i == 0 else got <= i + 1
    assert got > 1


def test_no_call_to_python_for_each_item(spark, tmp_path):
    spark.createDataFrame([("s", "x", 1, "n")], SCHEMA).write.parquet(f"{tmp_path}/in")
    plan = once_per_session(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "item", ttl_ms=WEEK_MS)._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan and "TransformWithState" not in plan


def test_least_cuts_down_while_it_reads():
    import pyarrow as pa

    rows = [{"k": i % 7 or None, "event_id": (i * 37) % 500, "n": i} for i in range(500)]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 9]) for i in range(0, 500, 9)]
    got = [r for b in _least(["k"], "event_id", chunk=20)(iter(batches)) for r in b.to_pylist()]
    want = {}
    for r in rows:
        if r["k"] not in want or r["event_id"] < want[r["k"]]["event_id"]:
            want[r["k"]] = r
    assert sorted(got, key=str) == sorted(want.values(), key=str)
