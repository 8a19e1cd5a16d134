"""Keyed state machines over hook and attempt streams.

Each processor keeps a few scalars (or a bounded set) per key. Rows of one key in one
trigger are put in event order before they are applied; the size of a trigger is bounded by
the source (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``). Where the key itself can be
made finer (session *and* item), it is, so a busy session spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WEEK_MS = 7 * 86_400_000


def use_rocksdb(spark: SparkSession) -> None:
    """State larger than memory and named state variables need the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def in_order(rows: Iterator[pd.DataFrame], by: str) -> pd.DataFrame:
    frames = list(rows)
    whole = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return whole.sort_values(by, kind="stable")


def _outer(known: tuple | None, pdf: pd.DataFrame, pick) -> tuple | None:
    """(event_id, ts_s, event, wo) of the first or last event of a chunk and ``known``."""
    if pdf.empty:
        return known
    row = pdf.iloc[pick(pdf["event_id"].to_numpy())]
    found = (int(row["event_id"]), int(row["ts_s"]), row["event"], row["wo"])
    return found if known is None or pick([known[0], found[0]]) == 1 else known


class Throttle(StatefulProcessor):
    """ST04, ST11: pass a row when more than ``gap_s`` went by since the last passed one."""

    def __init__(self, gap_s: int, strict: bool = True, at: str = "ts_s", order: str = "event_id"):
        self.gap_s, self.strict, self.at, self.order = gap_s, strict, at, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, self.order)
        last = self.last.get()[0] if self.last.exists() else None
        keep = []
        for t in pdf[self.at]:
            passed = last is None or (t - last > self.gap_s if self.strict else t - last >= self.gap_s)
            last = int(t) if passed else last
            keep.append(passed)
        self.last.update((last,))
        yield pdf[keep]

    def close(self) -> None:
        pass


class Seen(StatefulProcessor):
    """ST06 with the item in the key: only the first row of a key passes, for the TTL. This is
    the rule for one key; ``once_per_session`` applies it to whole tasks."""

    def __init__(self, ttl_ms: int, order: str):
        self.ttl_ms, self.order = ttl_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, first = self.seen.exists(), None
        for pdf in rows:  # a chunk at a time: one row is kept, however many the key has
            if not known:
                least = pdf.sort_values(self.order, kind="stable").head(1)
                first = least if first is None or least[self.order].iloc[0] < first[self.order].iloc[0] else first
            yield pdf.head(0)
        if first is not None:
            self.seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def _least(keys: list[str], order: str, chunk: int = 65_536):
    """The least row of each key among a task's rows, nulls last; a task holds a row a key and
    at most as many more before it cuts them down again."""

    def cut(held: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(held)
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(order, "ascending")]))
        place = rows.select(keys).append_column("__place", pa.array(np.arange(rows.num_rows)))
        return rows.take(place.group_by(keys, use_threads=False).aggregate([("__place", "min")])["__place_min"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, kept = [], 0, 0
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            n += b.num_rows
            if n > max(chunk, 2 * kept):
                held = [cut(held)]
                n = kept = held[0].num_rows
        if held:
            yield from cut(held).to_batches(max_chunksize=10_000)

    return run


class SeenCapped(StatefulProcessor):
    """ST06 with a session key: a set of at most ``cap`` items, the oldest dropped first."""

    def __init__(self, item: str, cap: int, ttl_ms: int, order: str):
        self.item, self.cap, self.ttl_ms, self.order = item, cap, ttl_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "item string", "place long", self.ttl_ms)
        self.next = handle.getValueState("next", "place long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, self.order)
        place = self.next.get()[0] if self.next.exists() else 0
        # the few items of a session are read and written once, not asked for row by row
        before = {k[0]: p[0] for k, p in self.seen.iterator()}
        seen, keep = dict(sorted(before.items(), key=lambda e: e[1])), []  # oldest first
        for x in pdf[self.item].astype(str):
            new = x not in seen
            keep.append(new)
            if new:
                seen[x] = place
                place += 1
                while place > self.cap and len(seen) > self.cap:
                    del seen[next(iter(seen))]
        for x in before.keys() - seen.keys():
            self.seen.removeKey((x,))
        for x, p in seen.items():
            if before.get(x) != p:
                self.seen.updateValue((x,), (p,))
        self.next.update((place,))
        yield pdf[keep]

    def close(self) -> None:
        pass


class Dormancy(StatefulProcessor):
    """ST05: the streak machine of H07 with the skip rules of H08 and the re-probe timer."""

    def __init__(self, limit: int, neutral: tuple[str, ...], retry_s: int, cooldown_s: int):
        self.limit, self.neutral, self.retry_s, self.cooldown_s = limit, neutral, retry_s, cooldown_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "streak long, dormant boolean, since long, failed_at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, "event_id")
        streak, dormant, since, failed = self.state.get() if self.state.exists() else (0, False, None, None)
        out = []
        for e, t, outcome in zip(pdf["event_id"], pdf["ts_s"], pdf["outcome"]):
            t = int(t)
            probe = bool(dormant and t - since >= self.retry_s)
            cooling = failed is not None and t - failed < self.cooldown_s
            if outcome == "ok":
                streak, dormant, since, failed = 0, False, None, None
            elif outcome in self.neutral:
                streak = 0
            elif dormant or streak + 1 >= self.limit:
                streak, dormant, since, failed = 0, True, t, t
            else:
                streak, failed = streak + 1, t
            out.append((key[0], int(e), streak, dormant, since, probe, cooling))
        self.state.update((streak, dormant, since, failed))
        got = pd.DataFrame(out, columns=["session_id", "event_id", "fail_streak", "dormant", "unsupported_at", "probe", "cooling"])
        got["unsupported_at"] = got["unsupported_at"].astype("Int64")
        yield got

    def close(self) -> None:
        pass


class Drain(StatefulProcessor):
    """ST03: buffer records of a conversation; release them at ``min_records`` or at a row
    that drains now."""

    def __init__(self, min_records: int):
        self.min_records = min_records

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getListState("buffer", "seq long, record string")
        self.drains = handle.getValueState("drains", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, "seq")
        held = [tuple(r) for r in self.buffer.get()]
        n = self.drains.get()[0] if self.drains.exists() else 0
        out = []
        for seq, record, mode in zip(pdf["seq"], pdf["record"], pdf["mode"]):
            held.append((int(seq), record))
            if mode == "now" or len(held) >= self.min_records:
                n += 1
                out.extend((key[0], n, s, r) for s, r in held)
                held = []
        if held:
            self.buffer.put(held)
        else:
            self.buffer.clear()
        self.drains.update((n,))
        yield pd.DataFrame(out, columns=["conversation_id", "drain", "seq", "record"])

    def close(self) -> None:
        pass


class Board(StatefulProcessor):
    """ST07: live board entry per session, gone an hour after its end or after 12 silent
    hours (processing-time timers)."""

    def __init__(self, ended_keep_s: int, active_stale_s: int):
        self.ended_keep_s, self.active_stale_s = ended_keep_s, active_stale_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "started long, last_update long, status string, working_on string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        entry = self.entry.get() if self.entry.exists() else None
        first = last = doing = None
        for pdf in rows:  # three rows of a trigger decide, so chunks are folded as they come
            enters = pdf["event"].isin(("session-start", "prompt"))
            first = _outer(first, pdf[enters], np.argmin)
            last = _outer(last, pdf[enters | (pdf["event"] == "session-end")], np.argmax)
            doing = _outer(doing, pdf[(pdf["event"] == "prompt") & pdf["wo"].notna()], np.argmax)
        if last and (entry or first):  # an end before the first entry registers nothing
            status = "ended" if last[2] == "session-end" else "active"
            entry = (entry[0] if entry else first[1], last[1], status, doing[3] if doing else entry[3] if entry else None)
        if entry:
            self.entry.update(tuple(entry))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            keep = self.ended_keep_s if entry[2] == "ended" else self.active_stale_s
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + keep * 1000)
            yield pd.DataFrame([(key[0], *entry, False)], columns=["session_id", "started", "last_update", "status", "working_on", "gone"])
        else:
            yield pd.DataFrame({"session_id": [], "started": [], "last_update": [], "status": [], "working_on": [], "gone": []})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        entry = self.entry.get()
        self.entry.clear()
        yield pd.DataFrame([(key[0], *entry, True)], columns=["session_id", "started", "last_update", "status", "working_on", "gone"])

    def close(self) -> None:
        pass


class Health(StatefulProcessor):
    """ST08: the newest failure of a session that no later success of any path retracts."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "error string, error_at long, ok_at long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        error, error_at, ok_at = self.state.get() if self.state.exists() else (None, None, None)
        for pdf in rows:
            for t, kind in zip(pdf["ts_s"], pdf["kind"]):
                t = int(t)
                if kind == "ok":
                    ok_at = t if ok_at is None else max(ok_at, t)
                elif kind not in ("local", "unsupported") and (error_at is None or t > error_at):
                    error, error_at = kind, t
        self.state.update((error, error_at, ok_at))
        live = error_at is not None and (ok_at is None or ok_at < error_at)
        yield pd.DataFrame(
            [(key[0], error if live else None, error_at if live else None)], columns=["session_id", "last_error", "last_error_at"]
        ).astype({"last_error_at": "Int64"})

    def close(self) -> None:
        pass


def _same(df: DataFrame) -> StructType:
    return df.schema


def debounce(stream: DataFrame, gap_s: int = 120, key: str = "session_id") -> DataFrame:
    """ST04: at most one row per key every ``gap_s`` seconds."""
    use_rocksdb(stream.sparkSession)
    return stream.groupBy(key).transformWithStateInPandas(Throttle(gap_s), _same(stream), "append", "none")


def throttle(stream: DataFrame, gap_s: int = 6 * 3600, key: str = "brain_id") -> DataFrame:
    """ST11: at most one refresh per key every six hours."""
    use_rocksdb(stream.sparkSession)
    return stream.groupBy(key).transformWithStateInPandas(Throttle(gap_s, strict=False), _same(stream), "append", "none")


def once_per_session(stream: DataFrame, item: str, cap: int | None = None, ttl_ms: int = WEEK_MS, order: str = "event_id") -> DataFrame:
    """ST06: each (session, item) passes once in seven days. With ``cap`` a session remembers
    only its last ``cap`` items, which needs the session as the key.

    Without it there are as many keys as items, so none of them may cost a call to Python: a
    task picks the least row of each of its keys, and Spark's own deduplication remembers keys
    by the time they came. It forgets a key when that time lies two delays back, here the TTL,
    by the clock of the trigger before: never earlier, and after a silence of the whole stream
    one trigger later."""
    use_rocksdb(stream.sparkSession)
    if cap is None:
        keys = list(dict.fromkeys(["session_id", item]))
        least = stream.repartition(*keys).mapInArrow(_least(keys, order), _same(stream))
        came = least.withColumn("__came", F.current_timestamp()).withWatermark("__came", f"{(ttl_ms + 1) // 2} milliseconds")
        return came.dropDuplicatesWithinWatermark(keys).drop("__came")
    return stream.groupBy("session_id").transformWithStateInPandas(
        SeenCapped(item, cap, ttl_ms, order), _same(stream), "append", "processingTime"
    )


def dormancy_stream(attempts: DataFrame, limit: int = 5, retry_s: int = 1_800, cooldown_s: int = 60) -> DataFrame:
    """ST05 on (session_id, event_id, ts_s, outcome)."""
    from agentlake.operators.health import NEUTRAL

    use_rocksdb(attempts.sparkSession)
    return attempts.select("session_id", "event_id", "ts_s", "outcome").groupBy("session_id").transformWithStateInPandas(
        Dormancy(limit, NEUTRAL, retry_s, cooldown_s),
        "session_id string, event_id long, fail_streak long, dormant boolean, unsupported_at long, probe boolean, cooling boolean",
        "append", "none",
    )


def drain(stream: DataFrame, min_records: int) -> DataFrame:
    """ST03 on (conversation_id, seq, record, mode)."""
    use_rocksdb(stream.sparkSession)
    return stream.select("conversation_id", "seq", "record", "mode").groupBy("conversation_id").transformWithStateInPandas(
        Drain(min_records), "conversation_id string, drain long, seq long, record string", "append", "none"
    )


def board_stream(events: DataFrame, ended_keep_s: int = 3_600, active_stale_s: int = 12 * 3_600) -> DataFrame:
    """ST07: board updates per trigger; ``gone`` rows remove an entry."""
    from agentlake.functions.text import working_on

    use_rocksdb(events.sparkSession)
    rows = events.select("session_id", "event_id", "ts_s", "event", working_on(F.col("prompt")).alias("wo"))
    return rows.groupBy("session_id").transformWithStateInPandas(
        Board(ended_keep_s, active_stale_s),
        "session_id string, started long, last_update long, status string, working_on string, gone boolean",
        "update", "processingTime",
    )


def health_stream(attempts: DataFrame, ttl_ms: int = 86_400_000) -> DataFrame:
    """ST08 on (session_id, ts_s, kind): each session's live failure after every trigger; the
    newest one over all sessions is picked where the updates are written."""
    use_rocksdb(attempts.sparkSession)
    return attempts.select("session_id", "ts_s", "kind").groupBy("session_id").transformWithStateInPandas(
        Health(ttl_ms), "session_id string, last_error string, last_error_at long", "update", "processingTime"
    )
