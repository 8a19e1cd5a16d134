"""Tables as they lie on disk: as one file or as a folder, and far larger once expanded."""

import random
import re
import shutil
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from agentlake.functions.ids import safe_id
from agentlake.operators import directives as D
from agentlake.plans import load_all
from agentlake.plans.registry import as_entry
from agentlake.sources import scan as SC
from agentlake.sources import state as ST
from agentlake.streaming.state import SeenCapped
from tests.test_states import Value

load_all()


def test_tokens_are_never_broadcast(spark, tmp_path, capsys):
    spark.range(40).selectExpr("id", "cast(null as string) repo", "1 seen", "id pos", "array('app/retry.py') triggers").write.parquet(f"{tmp_path}/d")
    spark.range(9).selectExpr("id call_id", "'s' session_id", "'r' repo", "'/w/app/retry.py' hay").write.parquet(f"{tmp_path}/c")
    found = D.match_directives(spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/d"))
    found.explain()
    plan = capsys.readouterr().out
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {(r.id, r.token, r.match_len) for r in found.collect()} == {(i, "app/retry.py", 12) for i in range(40)}


@pytest.mark.parametrize("folder", [True, False])
def test_import_merge_streams_a_file_or_a_folder(spark, tmp_path, folder):
    rows = [(c, t, "user", "x") for c in (1, 2) for t in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(2).write.parquet(f"{tmp_path}/rows")
    if folder:
        (tmp_path / "rows").rename(tmp_path / "conversations.parquet")
    else:
        spark.read.parquet(f"{tmp_path}/rows").coalesce(1).write.parquet(f"{tmp_path}/one")
        shutil.copy(next((tmp_path / "one").glob("*.parquet")), tmp_path / "conversations.parquet")
    stored = as_entry("st02_import_merge")(spark, str(tmp_path)).collect()
    assert {(r.conversation_id, r.stored) for r in stored} == {("s1", 3), ("s2", 3)}


def test_links_read_many_documents_of_a_file(spark, tmp_path):
    docs = spark.range(200).selectExpr("""concat('{"repo":"', id, '",\n"links":[{"glob":"g', id, '","artifact_id":"a"}]}') value""")
    ST.write_documents(docs.coalesce(1), f"{tmp_path}/many")
    (tmp_path / "many" / "one.json").write_text('{"repo":"200",\n"links":[{"glob":"g200","artifact_id":"a"}]}')
    found = ST.read_links(spark, f"{tmp_path}/many").collect()
    assert {(r.repo, r.glob) for r in found} == {(str(i), f"g{i}") for i in range(201)}


def test_short_ranges_share_tasks_and_are_not_read_past(tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_bytes(b"".join(b"%06d\n" % i for i in range(60_000)))
    all_ranges = SC.ranges(SC.list_files(str(tmp_path), "*.txt"), 100)
    tasks = SC.grouped(all_ranges)
    assert len(all_ranges) == 4_200 and len(tasks) <= SC.TASKS + 1
    assert [r for t in tasks for r in t.ranges] == all_ranges
    taken, store = [], SC._store(str(tmp_path))

    class File:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.file.close()

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            taken.append(n)
            return self.file.read(n)

    files = SimpleNamespace(open_input_file=lambda path: File(store[0].open_input_file(path)))
    monkeypatch.setattr(SC, "_store", lambda root: (files, *store[1:]))
    lines = [x for t in tasks[:3] for r in t.ranges for b in SC.read_range(r, str(tmp_path)) for x in b.column("raw").to_pylist()]
    assert lines == [b"%06d" % i for i in range(len(lines))] and max(taken) <= SC.STEP


def test_a_capped_session_touches_its_state_once_a_trigger():
    calls = []

    class Items(dict):
        def iterator(self):
            calls.append("all")
            return iter([((k,), v) for k, v in self.items()])

        def containsKey(self, k):  # noqa: N802
            calls.append("has")
            return k[0] in self

        def updateValue(self, k, v):  # noqa: N802
            calls.append("put")
            self[k[0]] = v

        def removeKey(self, k):  # noqa: N802
            calls.append("del")
            self.pop(k[0], None)

    items, place = Items(), Value()
    machine = SeenCapped("item", 3, 1, "event_id")
    machine.init(SimpleNamespace(getMapState=lambda *a: items, getValueState=lambda *a: place))
    rnd, known = random.Random(3), []
    for trigger in range(6):
        pdf = pd.DataFrame({"event_id": range(50), "item": [rnd.choice("abcde") for _ in range(50)]})
        want = []
        for e, x in zip(pdf["event_id"], pdf["item"]):
            if x not in known:
                known = [*known, x][-3:]
                want.append(e)
        calls.clear()
        got = pd.concat(list(machine.handleInputRows(("s",), iter([pdf]), None)))
        assert got["event_id"].tolist() == want and len(calls) <= 7
        assert sorted(items, key=items.get) == known


def test_safe_id_cuts_before_it_flattens(spark, capsys):
    texts = ["", "a b/c", "é😀x" * 60, "ok-._" * 30, " \t\n" * 50, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", *[safe_id(F.col("t"), m).alias(m) for m in ("state", "debounce", "fired")])
    for r in df.collect():
        flat = None if r.t is None else re.sub(r"[^A-Za-z0-9._-]", "_", r.t)
        assert (r.state, r.debounce) == ((None, None) if flat is None else (flat[:80], flat[:64]))
        assert r.fired == (None if r.t is None else re.sub(r"[^A-Za-z0-9_-]", "", r.t))
    df.select("state").explain()
    assert re.search(r"regexp_replace\((left|substr\w*)\(t", capsys.readouterr().out)
