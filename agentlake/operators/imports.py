"""The import pipeline: filter, redact, title, size and slice the records of every session.

Each step works on what the one before left, so no wrapper reaches a slice and no raw secret a
message. All results are built on ``sendable``; nothing else may feed a sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.functions import text as T
from agentlake.functions import values as V
from agentlake.operators import codex as CX
from agentlake.operators import cursor as CU
from agentlake.operators import records as R
from agentlake.operators import slices as SL
from agentlake.operators import titles as TI
from agentlake.sources import state as ST
from agentlake.sources import transcripts as TR

ENVELOPE = 64  # bytes of a record besides its text


def sendable(records: DataFrame, envelope: int = ENVELOPE) -> DataFrame:
    """Records without command wrappers, their text redacted, with ``size``."""
    kept = R.drop_command_wrappers(records).withColumn("text", T.redact_text(F.col("text")))
    return kept.withColumn("size", V.record_size(F.col("text")) + envelope)


def sliced(records: DataFrame, budget: int = SL.DEFAULT_BUDGET) -> DataFrame:
    """W07 over the sendable records."""
    return SL.slices(sendable(records), budget)


def _per_session(records: DataFrame) -> DataFrame:
    wrapper = T.is_command_wrapper(F.col("type"), F.col("text"))
    size = V.record_size(T.redact_text(F.col("text"))) + ENVELOPE
    return records.groupBy("session_id").agg(
        F.count_if(~wrapper).alias("records"),
        F.count_if(wrapper).alias("dropped"),
        F.count_if(~wrapper & T.contains_secret(F.col("text"))).alias("redacted"),
        F.coalesce(F.sum(F.when(~wrapper, size)), F.lit(0)).cast("long").alias("bytes"),
        F.min_by("cwd", F.when(F.col("cwd").isNotNull(), F.col("seq"))).alias("destination"),
    )


def import_summary(records: DataFrame, budget: int = SL.DEFAULT_BUDGET) -> DataFrame:
    """What an import of each session would send, in how many slices, and where to."""
    n = sliced(records, budget).groupBy("session_id").agg(F.max("slice").alias("slices"))
    per = _per_session(records).join(n, "session_id", "left").withColumn("slices", F.coalesce("slices", F.lit(0).cast("long")))
    return per.withColumn("about_tokens", F.floor(F.col("bytes") / 4))


def flush_summary(batches: DataFrame, replies: DataFrame) -> DataFrame:
    """W10 on (session_id, batch, type, text) and one reply per batch: sent and filtered
    records, the bytes of the span, and what the server said."""
    wrapper = T.is_command_wrapper(F.col("type"), F.col("text"))
    sent = batches.groupBy("session_id", "batch").agg(
        F.count_if(~wrapper).alias("sent"),
        F.count_if(wrapper).alias("filtered"),
        F.sum(V.record_size(F.col("text"))).alias("byte_span"),
    )
    return sent.join(replies, ["session_id", "batch"], "left").select("session_id", "batch", "sent", "filtered", "byte_span", "records_new", "pending", "draining")


def session_overview(records: DataFrame, budget: int = SL.DEFAULT_BUDGET) -> DataFrame:
    """One row per session: records sent, wrappers dropped, records redacted, title, slices."""
    per = import_summary(records, budget)
    return per.join(TI.session_title(records), "session_id").select("session_id", "records", F.col("dropped").alias("wrappers_dropped"), "redacted", "title", "slices")


def session_imports(records: DataFrame, sessions: DataFrame, budget: int = SL.DEFAULT_BUDGET) -> DataFrame:
    """One row per slice with its messages, built from sendable records alone. ``sessions``
    brings host and route per session; titles come from the records."""
    rows = sendable(records)
    body = rows.withColumn("record", F.to_json(F.struct("type", "text", "uuid")))
    return ST.build_imports(body, SL.slices(rows, budget), sessions.join(TI.session_title(records), "session_id"))


# A host is a function from its sources to canonical records.
READERS: dict[str, Callable[..., DataFrame]] = {
    "claude": lambda spark, root, **how: TR.claude_records(TR.read_claude(spark, root, **how)),
    "codex": lambda spark, root, **how: CX.codex_to_records(TR.read_codex(spark, root, **how))[0],
    "cursor": lambda messages, meta: CU.cursor_to_records(messages, meta)[0],
}
CANONICAL = ("host", "session_id", "seq", "uuid", "ts", "type", "role", "cwd", "content_kind", "text", "blocks")


def register_reader(host: str, reader: Callable[..., DataFrame]) -> None:
    """Add a host, or replace one."""
    READERS[host] = reader


def read_records(host: str, *sources, **options) -> tuple[DataFrame, DataFrame]:
    """The canonical records of a host and the problems C24 finds in them. An unknown host
    or a reader that lacks a canonical column is refused; records with problems stay, so the
    caller decides."""
    if host not in READERS:
        raise ValueError(f"no reader for host {host!r}; known: {', '.join(sorted(READERS))}")
    records = READERS[host](*sources, **options)
    missing = [c for c in CANONICAL if c not in records.columns]
    if missing:
        raise ValueError(f"the reader of {host!r} gives no {', '.join(missing)}")
    return records, R.validate(records)
