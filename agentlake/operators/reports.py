"""Aggregate reports over records, sessions, firings and items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.functions.text import strip_ws
from agentlake.functions import text as T
from agentlake.operators.ordered import Running, running


def wrapper_share(records: DataFrame) -> DataFrame:
    """R01."""
    wrapper = T.is_command_wrapper(F.col("type"), F.col("text"))
    users = records.filter(F.col("type") == "user")
    return users.agg(
        F.count_if(wrapper).alias("wrappers"),
        F.count_if(strip_ws(F.col("text")) != "").alias("text_users"),
        F.count(F.lit(1)).alias("users"),
    ).withColumns(
        {
            "share_of_text": F.round(F.col("wrappers") / F.col("text_users"), 6),
            "share_of_users": F.round(F.col("wrappers") / F.col("users"), 6),
        }
    )


def title_coverage(titles: DataFrame) -> DataFrame:
    """R02 on (session_id, entrypoint, custom_title, generated_title, prompt_title)."""
    own = F.col("custom_title").isNotNull() | F.col("generated_title").isNotNull()
    return titles.groupBy("entrypoint").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(own).alias("titled"),
        F.count_if(~own & F.col("prompt_title").isNotNull()).alias("named_by_prompt"),
    )


def exact_median(df: DataFrame, col: str, width: int = 65_536) -> DataFrame:
    """Exact median of an integer column from its histogram, scanned in buckets, so that
    no task ever holds all values."""
    hist = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    run = running(hist.withColumn("k", F.lit(0)), ["k"], ["v"], {"upto": Running("sum", F.col("n"))}, width=width)
    run = run.withColumn("total", hist.agg(F.sum("n")).scalar())
    lo = F.floor((F.col("total") + 1) / 2)
    hi = F.floor(F.col("total") / 2) + 1
    first = F.col("upto") - F.col("n")
    twice = F.max(F.when((lo > first) & (lo <= F.col("upto")), F.col("v"))) + F.max(
        F.when((hi > first) & (hi <= F.col("upto")), F.col("v"))
    )
    return run.agg((twice / 2).alias("median"))


def size_profile(sessions: DataFrame, budget: int, col: str = "bytes") -> DataFrame:
    """R03 on one row per session."""
    c = F.col(col)
    return sessions.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(c > 1_000_000).alias("over_1mb"),
        F.count_if(c > 5_000_000).alias("over_5mb"),
        F.max(c).alias("largest"),
        F.sum(F.ceil(c / budget)).alias("slices_at_least"),
    ).withColumn("median", exact_median(sessions, col).scalar())


def repeat_share(firings: DataFrame) -> DataFrame:
    """Injections of a directive the session had already seen. One repeat less than
    the injections of each pair, so no ordering is needed."""
    pairs = firings.groupBy("session_id", "directive_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.sum("n").alias("injections"),
        F.sum(F.col("n") - 1).alias("repeats"),
        F.round(F.sum(F.col("n") - 1) / F.sum("n"), 6).alias("repeat_share"),
    )


def usage_check(records_usage: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Stored usage against the raw cumulative counters, per session."""
    stored = records_usage.groupBy("session_id").agg(
        F.sum(
            F.col("input_tokens")
            + F.col("output_tokens")
            + F.col("cache_read_input_tokens")
            + F.col("cache_creation_input_tokens")
        ).alias("stored")
    )
    raw = snapshots.groupBy("session_id").agg(F.max(F.col("input_tokens") + F.col("output_tokens")).alias("raw_total"))
    return raw.join(stored, "session_id", "left").select(
        "session_id",
        "raw_total",
        F.coalesce("stored", F.lit(0)).alias("stored"),
        (F.col("raw_total") - F.coalesce("stored", F.lit(0))).alias("difference"),
    )


def rename_conflicts(records: DataFrame) -> DataFrame:
    """Sessions that carry both kinds of title record."""
    titled = records.filter(F.col("type").isin("custom-title", "ai-title"))
    return (
        titled.groupBy("session_id")
        .agg(
            F.count_if(F.col("type") == "ai-title").alias("generated"),
            F.count_if(F.col("type") == "custom-title").alias("renamed"),
            F.max_by("type", "seq").alias("came_last"),
        )
        .filter((F.col("generated") > 0) & (F.col("renamed") > 0))
    )


def count_by_type(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Items per type; artifacts whose text names a kept word are left out."""
    kept = F.lit(False)
    for word in keep:
        kept = kept | F.lower("content").contains(word.lower())
    return items.filter(~((F.col("type") == "artifact") & kept)).groupBy("type").agg(F.count(F.lit(1)).alias("items"))


def activation_funnel(events: DataFrame) -> DataFrame:
    """R09 on (repo, kind, ts_s): seeded, digest, fired, routed, time to first recall."""
    def first(kind: str):
        return F.min(F.when(F.col("kind") == kind, F.col("ts_s")))

    return events.groupBy("repo").agg(
        F.count_if(F.col("kind") == "seeded").alias("seeded"),
        (F.count_if(F.col("kind") == "digest") > 0).alias("digest_rendered"),
        F.count_if(F.col("kind") == "fired").alias("directives_fired"),
        (F.count_if(F.col("kind") == "routed") > 0).alias("routed"),
        (first("fired") - first("created")).alias("seconds_to_first_recall"),
    )
