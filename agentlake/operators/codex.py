"""Rollout events to canonical records (``session_id, idx, ts_raw, type, payload VARIANT``)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agentlake.functions import ids as I
from agentlake.functions import text as T
from agentlake.functions import values as V
from agentlake.operators.ordered import WIDTH, Running, bucket_of, running
from agentlake.session import materialize

COUNTERS = ("input_tokens", "cached_input_tokens", "cache_write_input_tokens", "output_tokens")
BLOCK, SHORT, FAN = 1_024, 64, 128
_ENTERED = [f"e_{c}" for c in COUNTERS]
USAGE_TYPE = (
    "struct<input_tokens:bigint,output_tokens:bigint,"
    "cache_read_input_tokens:bigint,cache_creation_input_tokens:bigint>"
)

def _payload_type() -> Column:
    return V.text_at(F.col("payload"), "$.type")


def _role_of() -> Column:
    return V.text_at(F.col("payload"), "$.role")


def _is_tokens() -> Column:
    return F.coalesce((F.col("type") == "event_msg") & (_payload_type() == "token_count"), F.lit(False))


def _is_item() -> Column:
    return F.coalesce(F.col("type") == "response_item", F.lit(False))


def codex_meta(events: DataFrame) -> DataFrame:
    """One row per session with meta fields, first model, title and first time."""
    p = F.col("payload")
    idx = F.col("idx")
    # staged, so that each derived text is computed once
    rows = events.select("session_id", "idx", "ts_raw", "type", "payload", _payload_type().alias("pt"), _role_of().alias("role"))
    rows = rows.select(
        "session_id",
        "idx",
        "ts_raw",
        F.when(
            (F.col("type") == "session_meta") & V.is_kind(p, "object"),
            F.struct(*[V.text_at(p, f"$.{k}").alias(k) for k in ("id", "cwd", "originator", "cli_version")]),
        ).alias("m"),
        F.when(F.col("type") == "turn_context", V.text_at(p, "$.model")).alias("model"),
        F.when((F.col("type") == "event_msg") & (F.col("pt") == "task_complete"), V.text_at(p, "$.last_agent_message")).alias("done"),
        F.when(
            (F.col("type") == "response_item") & (F.col("pt") == "message") & (F.col("role") == "user"),
            V.codex_text(V.path(p, "$.content")),
        ).alias("asked"),
    )
    rows = rows.select(
        "session_id", "idx", "ts_raw", "m",
        F.nullif("model", F.lit("")).alias("model"),
        F.when(T.strip_ws(F.col("done")) != "", F.col("done")).alias("done"),
        T.clean_codex_ask(F.col("asked")).alias("ask"),
    )
    out = rows.groupBy("session_id").agg(
        F.min_by("m", F.when(F.col("m").isNotNull(), idx)).alias("m"),
        F.min_by("model", F.when(F.col("model").isNotNull(), idx)).alias("model"),
        F.max_by("done", F.when(F.col("done").isNotNull(), idx)).alias("done"),
        F.min_by("ask", F.when(F.col("ask").isNotNull(), idx)).alias("ask"),
        F.min_by("ts_raw", F.when(F.col("ts_raw").isNotNull(), idx)).alias("first_ts"),
    )
    return out.select(
        "session_id",
        F.col("m.id").alias("meta_id"),
        F.col("m.cwd").alias("cwd"),
        "model",
        F.col("m.originator").alias("originator"),
        F.col("m.cli_version").alias("cli_version"),
        T.first_line(F.coalesce("ask", "done")).alias("title"),
        "first_ts",
    )


def carry_ts(events: DataFrame, meta: DataFrame, width: int = WIDTH) -> DataFrame:
    """C11: adds ``ts``: the latest time of a response item or token count at or before the
    row, else the first time of the file. ``meta`` brings ``first_ts``."""
    dated = F.when(_is_tokens() | _is_item(), F.col("ts_raw"))
    run = running(events, ["session_id"], ["idx"], {"__ts": Running("last", dated)}, width=width)
    first = meta.select("session_id", "first_ts")
    return run.join(first, "session_id").withColumn("ts", F.coalesce("__ts", "first_ts")).drop("__ts", "first_ts")


def snapshots(events: DataFrame) -> DataFrame:
    """Valid cumulative snapshots: non-negative integers, missing cache fields read as zero."""
    total = V.path(F.col("payload"), "$.info.total_token_usage")
    out = events.filter(_is_tokens()).select("session_id", "idx", total.alias("t"))
    cols = []
    for c in COUNTERS:
        raw = V.path(F.col("t"), f"$.{c}")
        n = V.count_at(F.col("t"), f"$.{c}")
        cols.append((F.when(raw.isNull(), F.lit(0).cast("long")).otherwise(n) if "cache" in c else n).alias(c))
    out = out.filter(V.is_kind(F.col("t"), "object")).select("session_id", "idx", *cols)
    ok = F.lit(True)
    for c in COUNTERS:
        ok = ok & F.coalesce(F.col(c) >= 0, F.lit(False))
    return out.filter(ok)


class Stairs:
    """What consecutive snapshots do to the last accepted one: the first of ``at`` that is nowhere
    below it turns it into its ``to``; if there is none, it stays."""

    def __init__(self, at: np.ndarray, to: np.ndarray):
        self.at, self.to = at, to

    @classmethod
    def of_rows(cls, x: np.ndarray) -> Stairs:
        step = None
        for i in range(0, len(x), BLOCK):
            reach, nxt = _reach(x[i : i + BLOCK]), _next_accepted(x[i : i + BLOCK])
            while not np.array_equal(nxt[nxt], nxt):
                nxt = nxt[nxt]
            first = ~np.tril(reach, -1).any(axis=1)  # an earlier row would be accepted in its place
            part = cls(x[i : i + BLOCK][first], x[i : i + BLOCK][nxt][first])._thin()
            step = step.then(part) if step else part
        return step

    @classmethod
    def read(cls, raw: bytes) -> Stairs:
        both = np.frombuffer(raw, np.int64).reshape(2, -1, len(COUNTERS))
        return cls(both[0], both[1])

    def raw(self) -> bytes:
        return np.stack([self.at, self.to]).astype(np.int64).tobytes()

    def _thin(self) -> Stairs:
        """Without steps whose next one is above them and leads to the same end."""
        spare = np.zeros(len(self.at), dtype=bool)
        spare[:-1] = (self.at[1:] >= self.at[:-1]).all(axis=1) & (self.to[1:] == self.to[:-1]).all(axis=1)
        return Stairs(self.at[~spare], self.to[~spare])

    def apply(self, states: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return states
        hit = (self.at[None, :, :] >= states[:, None, :]).all(axis=2)
        return np.where(hit.any(axis=1)[:, None], self.to[hit.argmax(axis=1)], states)

    def then(self, other: Stairs) -> Stairs:
        """These snapshots and the next ones as one."""
        fresh = ~(self.at[None, :, :] >= other.at[:, None, :]).all(axis=2).any(axis=1) if len(self.at) else np.ones(len(other.at), dtype=bool)
        return Stairs(np.concatenate([self.at, other.at[fresh]]), np.concatenate([other.apply(self.to), other.to[fresh]]))._thin()


def _reach(x: np.ndarray) -> np.ndarray:
    """Whether no counter of row j is below that of row i."""
    out = np.ones((len(x), len(x)), dtype=bool)
    for c in range(x.shape[1]):
        out &= x[:, c][:, None] <= x[:, c][None, :]
    return out


def _next_accepted(x: np.ndarray) -> np.ndarray:
    """The row accepted next after row i, or i itself."""
    later = np.triu(_reach(x), 1)
    return np.where(later.any(axis=1), later.argmax(axis=1), np.arange(len(x)))


def _counters(pdf: pd.DataFrame) -> np.ndarray:
    return pdf.sort_values("run")[list(COUNTERS)].to_numpy(dtype="int64")


def _stairs(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([(*key, Stairs.of_rows(_counters(pdf)).raw())], columns=["session_id", "bucket", "stairs"])


def _joined(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
    steps = [Stairs.read(raw) for raw in pdf.sort_values("bucket")["stairs"]]
    step = steps[0]
    for other in steps[1:]:
        step = step.then(other)
    return pd.DataFrame([(*key, step.raw())], columns=["session_id", "bucket", "stairs"])


def _states(pdf: pd.DataFrame, state: np.ndarray) -> pd.DataFrame:
    """The last accepted snapshot before each of some consecutive buckets."""
    out = []
    for session, bucket, raw in pdf.sort_values("bucket")[["session_id", "bucket", "stairs"]].itertuples(index=False):
        out.append((session, bucket, *state[0].tolist()))
        state = Stairs.read(raw).apply(state)
    return pd.DataFrame(out, columns=["session_id", "bucket", *_ENTERED])


def _from_zero(pdf: pd.DataFrame) -> pd.DataFrame:
    return _states(pdf, np.zeros((1, len(COUNTERS)), dtype=np.int64))


def _from_above(key: tuple[Any, ...], pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    return _states(pdf, entry[_ENTERED].to_numpy(dtype="int64")[:1])


def _accepted(x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last accepted snapshot before each of some rows, and behind them."""
    out = np.empty_like(x)
    for i in range(0, len(x), BLOCK):
        part = x[i : i + BLOCK]
        nxt, at, over = _next_accepted(part), [], (part >= state).all(axis=1)
        j = int(over.argmax()) if over.any() else len(part)
        while j < len(part):
            at.append(j)
            j = int(nxt[j]) if nxt[j] > j else len(part)
        states = np.concatenate([state[None, :], part[at]])
        out[i : i + BLOCK] = states[np.searchsorted(np.array(at, dtype=np.int64), np.arange(len(part)), side="left")]
        state = states[-1]
    return out, state


def _inside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (session, bucket, run), each with the snapshot its bucket begins with."""
    now, state = None, None
    for pdf in frames:
        x, entry = pdf[list(COUNTERS)].to_numpy(dtype="int64"), pdf[_ENTERED].to_numpy(dtype="int64")
        session, bucket = pdf["session_id"].to_numpy(), pdf["bucket"].to_numpy()
        if not len(x):
            continue
        begin = np.flatnonzero(np.concatenate(([True], (session[1:] != session[:-1]) | (bucket[1:] != bucket[:-1]))))
        size = np.diff(np.append(begin, len(x)))
        states = entry[begin]
        if (session[0], bucket[0]) == now:
            states[0] = state
        for k in range(min(SHORT, int(size.max()))):  # row k of all buckets at once
            on = size > k
            at = begin[on] + k
            entry[at] = states[on]
            states[on] = np.where((x[at] >= states[on]).all(axis=1)[:, None], x[at], states[on])
        for i in np.flatnonzero(size > SHORT):
            a, b = begin[i] + SHORT, begin[i] + size[i]
            entry[a:b], states[i] = _accepted(x[a:b], states[i])
        now, state = (session[-1], bucket[-1]), states[-1]
        out = pdf[["session_id", "bucket", "run"]].copy()
        out[_ENTERED] = entry
        yield out


def usage_deltas(snaps: DataFrame, width: int = WIDTH) -> DataFrame:
    """Deltas between accepted snapshots. A snapshot counts only when all four counters
    are at least those of the last accepted one.

    Inside a stretch where no counter falls, one accepted snapshot makes all later ones
    accepted, so a stretch acts on the last accepted snapshot by its last row alone. The
    stretches of a bucket are reduced to ``Stairs``, those of ``FAN`` buckets are composed, and
    the state that enters goes down again; all rows are then judged in parallel."""
    rows = snaps.select(
        F.col("session_id").cast("string").alias("session_id"), F.col("idx").cast("long").alias("idx"),
        *[F.col(c).cast("long").alias(c) for c in COUNTERS],
    ).withColumn("bucket", bucket_of("idx", width).cast("long"))
    w = Window.partitionBy("session_id", "bucket").orderBy("idx")
    falls = F.lit(False)
    for c in COUNTERS:
        falls = falls | (F.col(c) < F.lag(c).over(w))
    rows = rows.withColumn("falls", F.coalesce(falls, F.lit(False)).cast("int"))
    rows = rows.withColumn("run", F.sum("falls").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("falls")
    ends = materialize(rows.groupBy("session_id", "bucket", "run").agg(*[F.max(c).alias(c) for c in COUNTERS]), "stretches")
    entered = ", ".join(f"{c} long" for c in _ENTERED)
    # sessions of one bucket begin at zero; only the longer ones are summarized
    long_ones = ends.groupBy("session_id").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).filter(F.col("a") < F.col("b"))
    stairs = ends.join(long_ones.select("session_id"), "session_id", "left_semi").groupBy("session_id", "bucket").applyInPandas(_stairs, "session_id string, bucket long, stairs binary")
    parts = stairs.withColumn("part", F.floor(F.col("bucket") / FAN).cast("long"))
    tops = parts.groupBy("session_id", "part").applyInPandas(_joined, "session_id string, bucket long, stairs binary")
    above = tops.groupBy("session_id").applyInPandas(_from_zero, f"session_id string, bucket long, {entered}").toDF("session_id", "part", *_ENTERED)
    into = parts.groupBy("session_id", "part").cogroup(above.groupBy("session_id", "part")).applyInPandas(_from_above, f"session_id string, bucket long, {entered}")
    begun = ends.join(into, ["session_id", "bucket"], "left").na.fill(0, _ENTERED)
    entry = begun.repartition("session_id", "bucket").sortWithinPartitions("session_id", "bucket", "run").mapInPandas(_inside, f"session_id string, bucket long, run long, {entered}")
    at = rows.join(entry, ["session_id", "bucket", "run"])
    ok = F.lit(True)
    for c in COUNTERS:
        ok = ok & (F.col(c) >= F.col(f"e_{c}"))
    at = at.withColumn("accepted", ok)
    r = Window.partitionBy("session_id", "bucket", "run").orderBy("idx")
    prior = F.lag("accepted").over(r)
    delta = {
        f"d_{c}": F.col(c) - F.when(prior, F.lag(c).over(r)).otherwise(F.col(f"e_{c}")) for c in COUNTERS
    }
    out = at.withColumns(delta).filter("accepted")
    moved = F.lit(False)
    for c in COUNTERS:
        moved = moved | (F.col(f"d_{c}") > 0)
    fresh = F.greatest(
        F.lit(0).cast("long"),
        F.col("d_input_tokens") - F.col("d_cached_input_tokens") - F.col("d_cache_write_input_tokens"),
    )
    return out.filter(moved).select(
        "session_id",
        "idx",
        fresh.alias("input_tokens"),
        F.col("d_output_tokens").alias("output_tokens"),
        F.col("d_cached_input_tokens").alias("cache_read_input_tokens"),
        F.col("d_cache_write_input_tokens").alias("cache_creation_input_tokens"),
    )


def attach_usage(assistants: DataFrame, deltas: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each delta the ``idx`` of the assistant row it is charged to, or null when
    the latest assistant row already has one (then it becomes a usage-only row)."""
    marks = assistants.select("session_id", "idx", F.lit(True).alias("is_assistant")).unionByName(
        deltas.select("session_id", "idx", F.lit(False).alias("is_assistant"))
    )
    run = running(
        marks,
        ["session_id"],
        ["idx"],
        {
            "__a": Running("max", F.when(F.col("is_assistant"), F.col("idx")), inclusive=False),
            "__d": Running("max", F.when(~F.col("is_assistant"), F.col("idx")), inclusive=False),
        },
        width=width,
    )
    to = run.filter(~F.col("is_assistant")).select(
        "session_id",
        "idx",
        F.when(F.col("__a") > F.coalesce(F.col("__d"), F.lit(-1)), F.col("__a")).alias("target"),
    )
    return deltas.join(to, ["session_id", "idx"])


def _block(**fields):
    names = ("type", "text", "thinking", "id", "name", "input", "tool_use_id", "content")
    return F.struct(*[fields.get(n, F.lit(None)).cast("string").alias(n) for n in names])


def map_items(events: DataFrame) -> DataFrame:
    """What each response item becomes, one row per item that is emitted or
    takes an identity slot. ``form`` is user, recovered, assistant, result or reserved."""
    p = F.col("payload")
    pt, role, text, ask, summary = (F.col(c) for c in ("pt", "role", "text", "ask", "summary"))
    # staged, so that each derived text is computed once
    rows = events.filter(_is_item()).select(
        "session_id", "idx", "ts", "payload", _payload_type().alias("pt"), _role_of().alias("role"),
        T.strip_ws(V.codex_text(V.path(p, "$.content"))).alias("text"),
        T.strip_ws(V.codex_text(V.path(p, "$.summary"))).alias("summary"),
        F.coalesce(F.nullif(V.text_at(p, "$.call_id"), F.lit("")), F.nullif(V.text_at(p, "$.id"), F.lit(""))).alias("given"),
        F.coalesce(F.nullif(V.text_at(p, "$.name"), F.lit("")), F.lit("tool")).alias("name"),
    )
    rows = rows.withColumn("ask", F.when((pt == "message") & (role == "user"), T.clean_codex_ask(text)))
    idx = F.col("idx").cast("string")
    message = F.coalesce((pt == "message") & (text != ""), F.lit(False))
    call = pt.isin("function_call", "custom_tool_call")
    output = pt.isin("function_call_output", "custom_tool_call_output")
    recovered = text.startswith("# AGENTS.md instructions") | text.startswith("<environment_context>")
    form = (
        F.when(message & (role == "user") & ask.isNotNull() & recovered, "recovered")
        .when(message & (role == "user") & ask.isNotNull(), "user")
        .when(message & (role == "user") & text.startswith("<recommended_plugins>"), "reserved")
        .when(message & (role == "assistant"), "assistant")
        .when((pt == "reasoning") & (summary != ""), "assistant")
        .when(call, "assistant")
        .when(output, "result")
    )
    rows = rows.withColumn("form", form)
    block = (
        F.when((pt == "message") & (role == "assistant"), _block(type=F.lit("text"), text=text))
        .when(pt == "reasoning", _block(type=F.lit("thinking"), thinking=summary))
        .when(
            call,
            _block(
                type=F.lit("tool_use"),
                id=F.coalesce("given", F.concat(F.lit("codex-call-"), idx)),
                name=F.col("name"),
                input=F.to_json(V.tool_input(p)),
            ),
        )
        .when(
            output,
            _block(
                type=F.lit("tool_result"),
                tool_use_id=F.coalesce("given", F.concat(F.lit("codex-out-"), idx)),
                content=V.tool_output(V.path(p, "$.output")),
            ),
        )
    )
    # an optional row as a generator: a filter here would be pushed down with all the
    # text cleaning inlined into it and so run everything twice
    row = F.struct(
        "ts", "form", F.when(F.col("form").isin("user", "recovered"), ask).alias("text"), block.alias("block")
    )
    return rows.select("session_id", "idx", F.inline(F.when(F.col("form").isNotNull(), F.array(row))))


def codex_to_records(events: DataFrame, prefix: str = "agentlake", width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """C06-C15 together: ``(records, meta)``. Identities (C10) come from the number of rows
    before that take a slot: every emitted row but a recovered ask, plus dropped pure
    plugin-context rows."""
    meta = codex_meta(events)
    dated = carry_ts(events, meta, width)
    # both are read several times below
    items = materialize(map_items(dated), "items")
    deltas = materialize(usage_deltas(snapshots(events), width), "deltas")
    charged = attach_usage(items.filter(F.col("form") == "assistant"), deltas, width)
    usage = F.struct("input_tokens", "output_tokens", "cache_read_input_tokens", "cache_creation_input_tokens")
    # usage-only rows sit at the place of their token event
    only = (
        charged.filter(F.col("target").isNull())
        .select("session_id", "idx", usage.alias("usage"))
        .join(dated.filter(_is_tokens()).select("session_id", "idx", "ts"), ["session_id", "idx"])
        .select(
            "session_id", "idx", "ts", F.lit("usage-only").alias("form"), F.lit(None).cast("string").alias("text"),
            _block(type=F.lit("text"), text=F.lit("")).alias("block"), "usage",
        )
    )
    own = charged.filter(F.col("target").isNotNull()).select("session_id", F.col("target").alias("idx"), usage.alias("usage"))
    rows = items.join(own, ["session_id", "idx"], "left").unionByName(only)
    slotted = running(
        rows,
        ["session_id"],
        ["idx"],
        {"__slots": Running("count", F.col("form") != "recovered", inclusive=False)},
        width=width,
    ).filter(F.col("form") != "reserved")
    out = slotted.join(meta.select("session_id", "meta_id", "cwd", "model"), "session_id")
    key = F.concat_ws(":", F.lit(prefix), F.lit("codex"), F.coalesce(F.nullif("meta_id", F.lit("")), F.lit("unknown")))
    slot = (
        F.when(F.col("form") == "recovered", F.concat(F.lit("recovered-user:"), F.col("idx").cast("string")))
        .when(F.col("form") == "usage-only", F.concat(F.lit("usage-only:"), F.col("idx").cast("string")))
        .otherwise((F.col("__slots") + 1).cast("string"))
    )
    assistant = F.col("form").isin("assistant", "usage-only")
    who = F.when(assistant, "assistant").otherwise("user")
    asked = F.col("form").isin("user", "recovered")
    records = out.select(
        F.lit("codex").alias("host"),
        "session_id",
        F.col("idx").alias("seq"),
        I.uuid5(F.concat_ws(":", key, slot)).alias("uuid"),
        "ts",
        who.alias("type"),
        who.alias("role"),
        "cwd",
        F.when(assistant, F.col("model")).alias("model"),
        F.when(asked, "string").otherwise("array").alias("content_kind"),
        F.when(asked, F.col("text")).when(F.col("block.type") == "text", F.col("block.text")).otherwise("").alias("text"),
        F.when(~asked, F.array("block")).alias("blocks"),
        "usage",
    )
    return records, meta
