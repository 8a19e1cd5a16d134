"""Session titles and scope, per session and over incremental batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions import text as T
from agentlake.operators.ordered import Running, running


def _flag(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)) if name in df.columns else F.lit(False)


def _named(kind: str) -> Column:
    t = T.strip_ws(F.col("text"))
    return F.when((F.col("type") == kind) & (t != ""), t)


def _prompt(records: DataFrame, limit: int) -> Column:
    typed = (
        (F.col("type") == "user")
        & ~_flag(records, "is_sidechain")
        & ~_flag(records, "is_meta")
        & ~_flag(records, "has_tool_use_result")
        & ~T.is_command_wrapper(F.col("type"), F.col("text"))
    )
    return F.when(typed, T.title_text(F.col("text"), limit))


def title_parts(records: DataFrame, keys: tuple[str, ...] = ("session_id",), limit: int = 80) -> DataFrame:
    """W01, W02, W03 in one aggregation: last rename, last generated title, first prompt."""
    rows = records.withColumns(
        {"__c": _named("custom-title"), "__g": _named("ai-title"), "__p": _prompt(records, limit)}
    )
    at = F.col("seq")
    return rows.groupBy(*keys).agg(
        F.max_by("__c", F.when(F.col("__c").isNotNull(), at)).alias("custom_title"),
        F.max_by("__g", F.when(F.col("__g").isNotNull(), at)).alias("generated_title"),
        F.min_by("__p", F.when(F.col("__p").isNotNull(), at)).alias("prompt_title"),
    )


def session_title(records: DataFrame, explicit: str | None = None, limit: int = 80) -> DataFrame:
    """Explicit, rename, generated, prompt; chosen by kind, never by position."""
    return title_parts(records, limit=limit).select(
        "session_id",
        T.redact_text(F.coalesce(F.lit(explicit), "custom_title", "generated_title", "prompt_title")).alias("title"),
    )


def title_state(records: DataFrame, width: int = 65_536) -> DataFrame:
    """W05 over (session_id, batch): what each batch sends and remembers.

    A title once sent is remembered, so a prompt names only a session without any title
    before it; a rename is never taken back."""
    parts = title_parts(records, ("session_id", "batch"))
    out = running(
        parts,
        ["session_id"],
        ["batch"],
        {
            "__c": Running("last", F.col("custom_title")),
            "__g": Running("last", F.col("generated_title")),
            "__p": Running("min", F.when(F.col("prompt_title").isNotNull(), F.struct("batch", "prompt_title"))),
        },
        width=width,
    )
    return out.select(
        "session_id",
        "batch",
        T.redact_text(F.coalesce("__c", "__g", F.col("__p.prompt_title"))).alias("title"),
        T.redact_text(F.col("__c")).alias("custom_title"),
    )


def session_scope(batches: DataFrame, width: int = 65_536) -> DataFrame:
    """Cwd and namespace of each batch, each remembered on its own. Inert batches
    resolve neither."""
    live = ~F.col("inert")
    return running(
        batches,
        ["session_id"],
        ["batch"],
        {
            "scope_cwd": Running("last", F.when(live, F.col("cwd"))),
            "scope_namespace": Running("last", F.when(live, F.col("namespace"))),
        },
        width=width,
    )
