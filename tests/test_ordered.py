"""Bucketed scans and folds against plain single-pass versions, with small buckets."""

import random

import numpy as np

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agentlake.operators import codex as CX
from agentlake.operators import cursor as CU
from agentlake.operators import health as H
from agentlake.operators import slices as SL
from agentlake.operators.ordered import Running, previous, running


def test_running_equals_window(spark):
    rnd = random.Random(1)
    # one key holds most rows
    rows = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(20)}", i, rnd.choice([None, 1, 2, 5])) for i in range(2_000)]
    df = spark.createDataFrame(rows, "k string, i long, v int")
    got = running(
        df, ["k"], ["i"],
        {"s": Running("sum", F.col("v")), "n": Running("count"), "p": Running("last", F.col("v"), inclusive=False), "m": Running("max", F.col("v"))},
        width=37,
    )
    got = previous(got, ["k"], ["i"], {"lag": "v"}, width=11)
    w = Window.partitionBy("k").orderBy("i")
    upto, prior = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "*", F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("s"), F.count(F.lit(1)).over(upto).alias("n"),
        F.last("v", True).over(prior).alias("p"), F.max("v").over(upto).alias("m"), F.lag("v").over(w).alias("lag"),
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def greedy(sizes, budget):
    out, slice_, used = [], 0, None
    for s in sizes:
        if used is None or used + s > budget:
            slice_, used = slice_ + 1, s
        else:
            used += s
        out.append(slice_)
    return out


def test_slices_equal_greedy(spark):
    rnd = random.Random(2)
    rows, want = [], {}
    for sid, n in (("hot", 3_000), ("a", 1), ("b", 40), ("c", 333)):
        sizes = [rnd.choice([1, 3, 10, 50, 120, 0]) for _ in range(n)]
        rows += [(sid, i, s) for i, s in enumerate(sizes)]
        for i, g in enumerate(greedy(sizes, 100)):
            want[(sid, i)] = g
    df = spark.createDataFrame(rows, "session_id string, seq long, size long")
    for width in (7, 64, 10_000):
        got = {(r.session_id, r.seq): r.slice for r in SL.slices(df, 100, width=width, fan=5).collect()}
        assert got == want
    assert {r.slice for r in SL.slices(df, 0).collect()} == {1}


def test_steps_compose():
    rnd = random.Random(21)
    for _ in range(300):
        budget = rnd.choice([1, 7, 40, 1000])
        runs = [np.array([rnd.choice([0, 1, 2, 5, 30, 90]) for _ in range(rnd.randint(1, 12))], dtype=np.int64) for _ in range(rnd.randint(1, 6))]
        steps = [SL.Step.of_run(x, budget) for x in runs]
        for c in [-1, *range(0, budget + 1, max(1, budget // 9))]:
            used, n = c, 10 if c >= 0 else 0
            for size in np.concatenate(runs).tolist():
                if used < 0 or used + size > budget:
                    n, used = n + 1, size
                else:
                    used += size
            one = steps[0]
            for other in steps[1:]:
                one = one.then(other)
            state = (np.array([c]), np.array([10 if c >= 0 else 0]))
            assert [int(v[0]) for v in one.apply(*state)] == [used, n]


def test_small_records_make_small_functions():
    size = np.full(16_384, 100, dtype=np.int64)
    assert len(SL.Step.of_run(size, 3_500_000).above) <= 16_384
    assert len(SL.Step.of_run(size, 10_000).above) <= 101


def test_stairs_compose():
    rnd = random.Random(22)
    for _ in range(300):
        total, parts = [0, 0, 0, 0], []
        for _ in range(rnd.randint(1, 5)):
            rows = []
            for _ in range(rnd.randint(1, 12)):
                total = [t + rnd.choice([0, 1, 3]) for t in total]
                rows.append([max(0, t - rnd.choice([0, 0, 5])) for t in total])
            parts.append(np.array(rows, dtype=np.int64))
        step = CX.Stairs.of_rows(parts[0])
        for x in parts[1:]:
            step = step.then(CX.Stairs.of_rows(x))
        for state in ([0, 0, 0, 0], parts[0][0].tolist(), [rnd.randint(0, 9) for _ in range(4)]):
            want = state
            for row in np.concatenate(parts).tolist():
                want = row if all(a >= b for a, b in zip(row, want, strict=True)) else want
            assert step.apply(np.array([state], dtype=np.int64))[0].tolist() == want


def test_interleaved_counters_leave_one_step():
    a = np.arange(500)[:, None] * np.ones(4, dtype=np.int64)[None, :]
    both = np.stack([a, a + 100_000], axis=1).reshape(-1, 4).astype(np.int64)
    assert len(CX.Stairs.of_rows(both).at) == 1


def test_usage_deltas_equal_fold(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for sid, n in (("hot", 1_500), ("a", 5), ("b", 60)):
        total, state = [0, 0, 0, 0], [0, 0, 0, 0]
        for i in range(n):
            total = [t + rnd.choice([0, 0, 1, 7]) for t in total]
            snap = [max(0, t - rnd.choice([0, 0, 0, 0, 9])) for t in total]
            rows.append((sid, i, *snap))
            if all(x >= y for x, y in zip(snap, state)):
                d = [x - y for x, y in zip(snap, state)]
                state = snap
                if any(d):
                    want[(sid, i)] = (max(0, d[0] - d[1] - d[2]), d[3], d[1], d[2])
    df = spark.createDataFrame(rows, "session_id string, idx long, " + ", ".join(f"{c} long" for c in CX.COUNTERS))
    for width in (5, 100, 10_000):
        got = {(r[0], r[1]): tuple(r[2:]) for r in CX.usage_deltas(df, width=width).collect()}
        assert got == want


def test_dormancy_equals_machine(spark):
    rnd = random.Random(4)
    rows, want = [], {}
    for sid in ("hot", "a"):
        streak, dormant, since = 0, False, None
        for i in range(400 if sid == "hot" else 30):
            o = rnd.choice(["timeout", "timeout", "timeout", "timeout", "ok", "no_credential", "rate_limited"])
            rows.append((sid, i, i * 10, o))
            if o == "ok":
                streak, dormant, since = 0, False, None
            elif o == "no_credential":
                streak = 0
            elif dormant or streak + 1 >= 5:
                streak, dormant, since = 0, True, i * 10
            else:
                streak += 1
            want[(sid, i)] = (streak, dormant, since)
    df = spark.createDataFrame(rows, "session_id string, event_id long, ts_s long, outcome string")
    got = {(r.session_id, r.event_id): (r.fail_streak, r.dormant, r.unsupported_at) for r in H.dormancy(df, width=13).collect()}
    assert got == want


def test_store_walk(spark):
    # r -> (a, b); a -> b's leaf first: the first visit decides path and clock
    edges = spark.createDataFrame(
        [("s", "r", 0, "a", 5), ("s", "r", 1, "b", None), ("s", "a", 0, "m1", None), ("s", "a", 1, "m2", 7), ("s", "b", 0, "m2", None), ("s", "b", 1, "m3", 9)],
        "session_id string, parent string, ord int, child string, node_ms long",
    )
    roots = spark.createDataFrame([("s", "r")], "session_id string, node string")
    got = {r.node: (list(r.path), r.ms) for r in CU.walk(edges, roots).collect()}
    assert got == {"r": ([], None), "a": ([0], 5), "b": ([1], None), "m1": ([0, 0], 5), "m2": ([0, 1], 7), "m3": ([1, 1], 9)}


def test_store_messages_fall_back(spark):
    blobs = spark.createDataFrame(
        [("s", "x", bytearray(b'{"role":"user","content":"hi"}'), 0), ("s", "y", bytearray(b'{"role":"assistant","content":"yo"}'), 1), ("s", "z", bytearray(b"{bad"), 2)],
        "session_id string, id string, data binary, ins long",
    )
    meta = spark.createDataFrame([("s", None)], "session_id string, latest_root string")
    got = sorted((list(r.path), r.m) for r in CU.cursor_messages(blobs, meta).select("path", F.to_json("msg").alias("m")).collect())
    assert [p for p, _ in got] == [[0], [1]]


def test_sparse_order_values(spark):
    """Every row is a bucket of its own; groups of buckets and their order decide the carry."""
    rnd = random.Random(5)
    rows = [(k, at, rnd.choice([None, *range(-9, 9)])) for k in ("a", "b") for at in rnd.sample(range(-5_000_000, 5_000_000), 300)]
    want = {}
    for key in ("a", "b"):
        total, n, high, last = 0, 0, None, None
        for _, at, v in sorted(r for r in rows if r[0] == key):
            before = last
            total, n = total + (v or 0), n + 1
            high = high if v is None else v if high is None else max(high, v)
            last = last if v is None else v
            want[(key, at)] = (total, n, high, last, before)
    df = spark.createDataFrame(rows, "k string, at long, v long")
    v = F.col("v")
    specs = {"total": Running("sum", v), "n": Running("count"), "high": Running("max", v), "last": Running("last", v), "before": Running("last", v, inclusive=False)}
    two = F.struct((F.col("at") >= 0).alias("late"), F.floor(F.col("at") / 7).alias("b"))
    for more in ({"width": 10}, {"width": 1_000_000}, {"bucket": two}):
        got = {(r.k, r.at): (r.total, r.n, r.high, r["last"], r.before) for r in running(df, ["k"], ["at"], specs, **more).collect()}
        assert got == want
