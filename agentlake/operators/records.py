"""Operators over canonical record tables (one row per record, ``seq`` gives the order)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from agentlake.functions import text as T
from agentlake.functions import values as V
from agentlake.operators.ordered import Running, running


def drop_command_wrappers(records: DataFrame) -> DataFrame:
    """F01."""
    return records.filter(~T.is_command_wrapper(F.col("type"), F.col("text")))


def inert_batches(records: DataFrame, keys: tuple[str, ...] = ("session_id", "batch")) -> DataFrame:
    """batches left with nothing, or only display rows, once wrappers are gone."""
    sendable = ~T.is_command_wrapper(F.col("type"), F.col("text"))
    return records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(sendable).alias("sendable"),
        (F.count_if(sendable & ~T.is_inert(F.col("type"))) == 0).alias("inert"),
    )


def _last_keys(text: str | None) -> str | None:
    """JSON text with the last of equal keys in every object."""
    try:
        return None if text is None else json.dumps(json.loads(text), ensure_ascii=False)
    except ValueError:
        return None


last_keys = F.udf(_last_keys, StringType(), useArrow=True)


def redact_records(records: DataFrame, col: str = "v") -> DataFrame:
    """F04 on a VARIANT column: values and keys. When redaction makes two keys equal, the last
    one stays. A record that cannot be read again (``redaction_failed``) becomes null: the
    raw record is never passed on."""
    text = T.redact_json(F.to_json(F.col(col)))
    parsed = records.withColumn("__text", text).withColumn("__v", F.try_parse_json("__text"))
    # nearly always null, so the helper gets nothing to do
    again = F.try_parse_json(last_keys(F.when(F.col("__v").isNull(), F.col("__text"))))
    out = parsed.withColumn("__v", F.coalesce("__v", again)).withColumn("redaction_failed", F.col(col).isNotNull() & F.col("__v").isNull())
    return out.withColumn(col, F.col("__v")).drop("__v", "__text")


def session_meta(records: DataFrame) -> DataFrame:
    """First non-null ``cwd`` of a session."""
    return records.groupBy("session_id").agg(
        F.min_by("cwd", F.when(F.col("cwd").isNotNull(), F.col("seq"))).alias("cwd"),
        F.count(F.lit(1)).alias("records"),
    )


BLOCK_TYPE = (
    "array<struct<type:string,text:string,thinking:string,id:string,name:string,"
    "input:string,tool_use_id:string,content:string>>"
)


def validate(records: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """One row per problem. Needs columns type, uuid, ts, role, content_kind, blocks.

    Sessions of ``sessions`` without any record get the problem ``no records``."""
    typed = F.col("type").isin("user", "assistant")
    roled = F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))
    listed = typed & roled & (F.col("content_kind") == "array")

    def missing(kind: str, field: str) -> Column:
        return F.exists(
            F.coalesce(F.col("blocks"), F.array().cast(BLOCK_TYPE)),
            lambda b: (b["type"] == kind) & (F.coalesce(b[field], F.lit("")) == ""),
        )

    def empty(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) == ""

    checks = [
        (~F.coalesce(typed, F.lit(False)), "bad type"),
        (F.coalesce(typed, F.lit(False)) & empty("uuid"), "missing uuid"),
        (F.coalesce(typed, F.lit(False)) & empty("ts"), "missing timestamp"),
        (F.coalesce(typed, F.lit(False)) & ~roled, "missing role"),
        (
            F.coalesce(typed, F.lit(False)) & roled & ~F.coalesce(F.col("content_kind").isin("string", "array"), F.lit(False)),
            "bad content",
        ),
        (listed & F.exists(F.col("blocks"), lambda b: b["type"].isNull()), "malformed block"),
        (listed & missing("tool_use", "id"), "tool_use without id"),
        (listed & missing("tool_result", "tool_use_id"), "tool_result without tool_use_id"),
    ]
    found = F.filter(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in checks]), lambda x: x.isNotNull()
    )
    out = records.select("session_id", "seq", F.explode(found).alias("problem"))
    if sessions is not None:
        none = sessions.select("session_id").join(records.select("session_id"), "session_id", "left_anti")
        out = out.unionByName(
            none.select("session_id", F.lit(None).cast("long").alias("seq"), F.lit("no records").alias("problem"))
        )
    return out


def tool_calls(records: DataFrame) -> DataFrame:
    """Records whose first block is a tool call, per session."""
    return records.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.get(F.col("blocks"), F.lit(0))["type"] == "tool_use").alias("tool_calls"),
    )


def pair_tools(records: DataFrame) -> DataFrame:
    """Calls and results joined on (session, id); either side may be an orphan."""
    blocks = records.select("session_id", "seq", F.explode("blocks").alias("b"))
    calls = blocks.filter(F.col("b.type") == "tool_use").select(
        "session_id", F.col("b.id").alias("id"), F.col("seq").alias("call_seq"), F.col("b.name").alias("name")
    )
    results = blocks.filter(F.col("b.type") == "tool_result").select(
        "session_id", F.col("b.tool_use_id").alias("id"), F.col("seq").alias("result_seq")
    )
    return calls.join(results, ["session_id", "id"], "full_outer").withColumn(
        "state",
        F.when(F.col("result_seq").isNull(), "no result").when(F.col("call_seq").isNull(), "no call").otherwise("paired"),
    )


def prefix_to_bytes(records: DataFrame, max_bytes: int, width: int = 65_536) -> DataFrame:
    """Records up to and including the one whose running size reaches the cap."""
    run = running(records, ["session_id"], ["seq"], {"__before": Running("sum", F.col("size"), inclusive=False)}, width=width)
    return run.filter(F.col("__before") < max_bytes).drop("__before")


def size_of(records: DataFrame, cols: tuple[str, ...] = ("type", "text")) -> DataFrame:
    """W06 as a column ``size`` over the compact JSON of the given columns."""
    return records.withColumn("size", V.record_size(F.to_json(F.struct(*cols))))
