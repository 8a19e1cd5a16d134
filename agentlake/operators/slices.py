"""Greedy slicing of a session under a byte budget, exact for any session size.

The greedy cut is sequential, but a run of consecutive records acts on the bytes still open in
the current slice as a step function: up to some open bytes the run fits and adds its size; above,
they fix the first cut inside the run, and the first cut fixes everything after it. What follows a
cut is found for all records at once by jump pointers (the record that starts the next slice),
doubled until they rest. So each run is reduced to its step function, the functions of ``FAN``
neighbouring runs are composed, the session's start goes through the composed ones and then, in
parallel, through their parts, and each run is cut on its own. No task sees more than one run's
records, ``FAN`` functions, or one function for each ``FAN`` runs of a session.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.operators.ordered import WIDTH, Running, bucket_of, running

DEFAULT_BUDGET = 3_500_000
RUN, FAN = 16_384, 128
STEPS = "session_id string, run long, total long, first_cuts long, first_left long, steps binary"
ENTRY = "session_id string, run long, open_bytes long, slices_before long"


def _rest(cum: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For a slice starting at record i: the last start reached, and the starts it takes."""
    n = len(cum)
    here = np.arange(n)
    nxt = np.maximum(np.searchsorted(cum, np.concatenate(([0], cum[:-1])) + budget, side="right"), here + 1)
    jump, taken = np.where(nxt < n, nxt, here), (nxt < n).astype(np.int64)
    while not np.array_equal(jump[jump], jump):
        taken, jump = taken + taken[jump], jump[jump]
    return jump, taken + 1


class Step:
    """What a run does to (open bytes, slices before): ``above`` ascends; open bytes beyond
    ``above[k]`` end as ``left[k]`` after ``cuts[k]`` cuts, fewer bytes grow by ``total``."""

    def __init__(self, total: int, first: tuple[int, int], table: np.ndarray):
        self.total, self.first = total, first
        self.above, self.left, self.cuts = table

    @classmethod
    def of_run(cls, size: np.ndarray, budget: int) -> Step:
        cum = size.cumsum()
        last, count = _rest(cum, budget)
        left = cum[-1] - np.concatenate(([0], cum[:-1]))[last]
        # open bytes c make record i the first cut when budget - cum[i] < c <= budget - cum[i - 1]
        feasible = min(int(np.searchsorted(cum, budget, side="right")), len(cum) - 1)
        i = np.arange(feasible, -1, -1)
        # a session's first record always opens a slice, whatever its size
        return cls(int(cum[-1]), (int(left[0]), int(count[0])), _merged(np.stack([budget - cum[i], left[i], count[i]])))

    @classmethod
    def read(cls, row) -> Step:
        return cls(row.total, (row.first_left, row.first_cuts), np.frombuffer(row.steps, np.int64).reshape(3, -1))

    def row(self) -> tuple:
        return self.total, self.first[1], self.first[0], np.stack([self.above, self.left, self.cuts]).astype(np.int64).tobytes()

    def apply(self, open_bytes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Negative open bytes stand for the session's start."""
        k = np.searchsorted(self.above, open_bytes, side="left") - 1
        cut = k >= 0
        k = np.maximum(k, 0)
        some = len(self.above) > 0
        out = np.where(cut, self.left[k] if some else 0, open_bytes + self.total)
        n = np.where(cut, before + (self.cuts[k] if some else 0), before)
        start = open_bytes < 0
        return np.where(start, self.first[0], out), np.where(start, self.first[1], n)

    def then(self, other: Step) -> Step:
        """This run and the next one as one."""
        left, cuts = other.apply(self.left, self.cuts)
        fits = self.above[0] if len(self.above) else np.iinfo(np.int64).max  # up to there no cut so far
        inner = other.above - self.total < fits
        table = np.concatenate([np.stack([other.above - self.total, other.left, other.cuts])[:, inner], np.stack([self.above, left, cuts])], axis=1)
        a, b = other.apply(np.array([self.first[0]]), np.array([self.first[1]]))
        return Step(self.total + other.total, (int(a[0]), int(b[0])), _merged(table))


def _merged(table: np.ndarray) -> np.ndarray:
    """Without steps below any open bytes, and without those that repeat the one before."""
    begin = max(0, int(np.searchsorted(table[0], 0, side="left")) - 1)
    table = table[:, begin:]
    new = np.ones(table.shape[1], dtype=bool)
    new[1:] = (table[1:, 1:] != table[1:, :-1]).any(axis=0)
    return table[:, new]


def _steps_of_run(budget: int):
    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        step = Step.of_run(pdf.sort_values("seq")["size"].to_numpy(dtype="int64"), budget)
        return pd.DataFrame([(*key, *step.row())], columns=["session_id", "run", "total", "first_cuts", "first_left", "steps"])

    return run


def _composed(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
    rows = list(pdf.sort_values("run").itertuples(index=False))
    step = Step.read(rows[0])
    for r in rows[1:]:
        step = step.then(Step.read(r))
    return pd.DataFrame([(*key, *step.row())], columns=["session_id", "run", "total", "first_cuts", "first_left", "steps"])


def _entered(pdf: pd.DataFrame, open_bytes: int, before: int) -> pd.DataFrame:
    """The state in which each of some consecutive runs begins."""
    out, state = [], (np.array([open_bytes]), np.array([before]))
    for r in pdf.sort_values("run").itertuples(index=False):
        out.append((r.session_id, r.run, int(state[0][0]), int(state[1][0])))
        state = Step.read(r).apply(*state)
    return pd.DataFrame(out, columns=["session_id", "run", "open_bytes", "slices_before"])


def _from_start(pdf: pd.DataFrame) -> pd.DataFrame:
    return _entered(pdf, -1, 0)


def _from_above(key: tuple[Any, ...], pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    if not len(pdf):
        return _entered(pdf, -1, 0)
    return _entered(pdf, int(entry["open_bytes"].iloc[0]), int(entry["slices_before"].iloc[0]))


def _cut(budget: int):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by (session, run, seq); each run starts from its own entry state. One
        step a slice, not a record."""
        at, used, n = None, -1, 0
        for pdf in frames:
            size = pdf["size"].to_numpy(dtype="int64")
            cum = np.concatenate(([0], size.cumsum()))
            out = np.empty(len(size), dtype=np.int64)
            session, run = pdf["session_id"].to_numpy(), pdf["run"].to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], (session[1:] != session[:-1]) | (run[1:] != run[:-1])))) if len(size) else []
            opened, before = pdf["open_bytes"].to_numpy(), pdf["slices_before"].to_numpy()
            for a, b in zip(edge, [*edge[1:], len(size)], strict=True):
                if (session[a], run[a]) != at:
                    at, used, n = (session[a], run[a]), int(opened[a]), int(before[a])
                i = a
                while i < b:
                    if used < 0 or used + size[i] > budget:
                        n, used = n + 1, 0
                        j = max(i + 1, int(np.searchsorted(cum, cum[i] + budget, side="right")) - 1)
                    else:
                        j = int(np.searchsorted(cum, cum[i] + budget - used, side="right")) - 1
                    j = min(j, b)
                    out[i:j] = n
                    used, i = used + int(cum[j] - cum[i]), j
            yield pd.DataFrame({"session_id": pdf["session_id"], "seq": pdf["seq"], "size": pdf["size"], "slice": out})

    return cut


def slices(records: DataFrame, budget: int = DEFAULT_BUDGET, width: int = RUN, fan: int = FAN) -> DataFrame:
    """``session_id, seq, size`` to a 1-based ``slice``. Slices are consecutive and
    disjoint; a record over the budget rides alone; ``budget <= 0`` means one slice.

    Sessions of one run need no entry state, so only the longer ones are summarized."""
    rows = records.select("session_id", F.col("seq").cast("long").alias("seq"), F.col("size").cast("long").alias("size"))
    if budget <= 0:
        return rows.withColumn("slice", F.lit(1).cast("long"))
    rows = rows.withColumn("run", bucket_of("seq", width).cast("long"))
    long_ones = rows.groupBy("session_id").agg(F.min("run").alias("a"), F.max("run").alias("b")).filter(F.col("a") < F.col("b"))
    steps = rows.join(long_ones.select("session_id"), "session_id", "left_semi").groupBy("session_id", "run").applyInPandas(_steps_of_run(budget), STEPS)
    grouped = steps.withColumn("part", F.floor(F.col("run") / fan).cast("long"))
    parts = grouped.groupBy("session_id", "part").applyInPandas(_composed, STEPS)
    above = parts.groupBy("session_id").applyInPandas(_from_start, ENTRY).toDF("session_id", "part", "open_bytes", "slices_before")
    entries = grouped.groupBy("session_id", "part").cogroup(above.groupBy("session_id", "part")).applyInPandas(_from_above, ENTRY)
    ready = rows.join(entries, ["session_id", "run"], "left").select(
        "session_id", "run", "seq", "size",
        F.coalesce("open_bytes", F.lit(-1)).alias("open_bytes"), F.coalesce("slices_before", F.lit(0)).alias("slices_before"),
    )
    return (
        ready.repartition("session_id", "run")
        .sortWithinPartitions("session_id", "run", "seq")
        .mapInPandas(_cut(budget), "session_id string, seq long, size long, slice long")
    )


def delivery_report(plan: DataFrame, budget_s: float, min_slice_s: float = 10.0, width: int = WIDTH) -> DataFrame:
    """W08 and W09 on (session_id, slice, records, seconds, failed): which slices a bounded
    sequential send delivers. The first slice always goes; a later one only with at least
    ``min_slice_s`` left and no failure before it."""
    run = running(
        plan,
        ["session_id"],
        ["slice"],
        {
            "__spent": Running("sum", F.col("seconds"), inclusive=False),
            "__failed": Running("max", F.col("failed").cast("int"), inclusive=False),
        },
        width=width,
    )
    tried = (F.coalesce(F.col("__failed"), F.lit(0)) == 0) & (
        (F.col("slice") == 1) | (F.lit(budget_s) - F.col("__spent") >= min_slice_s)
    )
    # the send stops at the first slice not tried, and time spent only grows, so the
    # test above already holds for a prefix only
    sent = tried & ~F.col("failed")
    return (
        run.withColumns({"__tried": tried, "__sent": sent})
        .groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("slices"),
            F.count_if(F.col("__sent")).alias("slices_sent"),
            F.sum(F.when(~F.col("__sent"), F.col("records")).otherwise(0)).alias("records_not_sent"),
            F.max(F.col("__tried") & F.col("failed")).alias("stopped_by_failure"),
        )
    )
