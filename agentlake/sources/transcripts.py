"""Transcript scans, the session catalog and reference resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agentlake.functions import ids as I
from agentlake.functions.text import strip_ws
from agentlake.functions import values as V
from agentlake.operators.ordered import Running, running
from agentlake.sources import scan as SC


def allow_repeated_keys(spark: SparkSession) -> None:
    """JSON with a repeated key keeps the last value instead of failing to parse."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def raw_lines(spark: SparkSession, path: str, host: str | None = None, **options: str) -> DataFrame:
    """One row per line with true byte offsets, by Spark's text scan: for stores that only
    the JVM reaches (``lines_of`` needs no shuffle).

    Lines end on ``\\n`` only. The offset of a line is the size of all lines before it in
    its file; the running sum is bucketed by file block, so a huge file stays split. A line
    is complete when the file goes on to its line break."""
    reader = spark.read.option("lineSep", "\n")
    for k, o in options.items():
        reader = reader.option(k, o)
    text = reader.text(path)
    rows = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("raw"),
    ).withColumn("n", (F.octet_length("raw") + 1).cast("long"))
    run = running(
        rows,
        ["path"],
        ["block", "at"],
        {"line_no": Running("count"), "byte_end": Running("sum", F.col("n"))},
        bucket=F.col("block"),
    )
    return run.select(
        F.coalesce(F.lit(host), I.sniff_host(F.col("path"))).alias("host"),
        "path",
        "file_size",
        "modified",
        "line_no",
        (F.col("byte_end") - F.col("n")).alias("byte_start"),
        "byte_end",
        (F.col("byte_end") <= F.col("file_size")).alias("complete"),
        F.regexp_replace(F.make_valid_utf8("raw"), r"\r$", "").alias("raw"),
    )


def _transcripts(spark: SparkSession, root: str, pattern: str, depth: int | None, split_bytes: int, files: str) -> DataFrame:
    spark.dataSource.register(SC.Transcripts)
    options = {"path": root, "pattern": pattern, "split_bytes": str(split_bytes), "files": files}
    return spark.read.format(SC.FORMAT).options(**options, **({} if depth is None else {"depth": str(depth)})).load()


def lines_of(spark: SparkSession, root: str, host: str, pattern: str = "*.jsonl", depth: int | None = None, split_bytes: int = SC.SPLIT) -> DataFrame:
    """One row per line with true byte offsets and line numbers, by the transcript source.

    Bodies are not shuffled. Only files of several byte ranges need to know how many lines their
    earlier ranges have; those counts, one row a range, are joined to them."""
    if not SC.reachable(root):
        below = "/".join([root.rstrip("/"), *["*"] * (depth or 0)])
        more = {"recursiveFileLookup": "true"} if depth is None else {}
        return raw_lines(spark, below, host, pathGlobFilter=pattern, **more)
    rows = _transcripts(spark, root, pattern, depth, split_bytes, "whole").withColumn("line_no", F.col("line_in_split"))
    if any(f.size > split_bytes for f in SC.list_files(root, pattern, depth)):
        cut = _transcripts(spark, root, pattern, depth, split_bytes, "cut")
        n = cut.groupBy("path", "split").agg(F.max("line_in_split").alias("n"))
        earlier = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
        before = n.select("path", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        cut = cut.join(before, ["path", "split"]).withColumn("line_no", F.col("before") + F.col("line_in_split"))
        rows = rows.unionByName(cut.select(rows.columns))
    text = F.regexp_replace(F.make_valid_utf8(F.col("raw").cast("string")), r"\r$", "")
    return rows.select(F.lit(host).alias("host"), "path", "file_size", "modified", "line_no", "byte_start", "byte_end", "complete", text.alias("raw"))


def parse_jsonl(lines: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """``(records, counts)``. Blank lines are ignored, malformed ones skipped and
    counted; a file fails only when none of its lines parses."""
    v = F.try_parse_json(F.col("raw"))
    ready = lines.withColumn("v", v)
    blank = strip_ws(F.col("raw")) == ""
    counts = ready.groupBy(key).agg(
        F.count_if(F.col("v").isNotNull() & ~blank).alias("records"),
        F.count_if(F.col("v").isNull() & ~blank).alias("malformed"),
        F.count_if(blank).alias("blank"),
    )
    counts = counts.withColumn("failed", (F.col("records") == 0) & (F.col("malformed") > 0))
    return ready.filter(F.col("v").isNotNull() & ~blank), counts


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def read_claude(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    """Transcripts one level below ``root/<project>/``; deeper files are not sessions."""
    allow_repeated_keys(spark)
    lines, _ = parse_jsonl(lines_of(spark, root, "claude", pattern, 1))
    return lines.withColumn("session_id", _stem(F.col("path")))


def claude_records(lines: DataFrame) -> DataFrame:
    """T2 columns of transcript lines (``session_id, line_no, v``)."""
    v = F.col("v")
    content = V.path(v, "$.message.content")
    blocks = F.transform(
        V.items(content),
        lambda b: F.struct(
            *[V.text_at(b, f"$.{k}").alias(k) for k in ("type", "text", "thinking", "id", "name")],
            F.to_json(V.path(b, "$.input")).alias("input"),
            V.text_at(b, "$.tool_use_id").alias("tool_use_id"),
            V.tool_output(V.path(b, "$.content")).alias("content"),
        ),
    )
    titled = F.coalesce(V.text_at(v, "$.customTitle"), V.text_at(v, "$.aiTitle"))
    result = V.path(v, "$.toolUseResult")
    return lines.select(
        F.lit("claude").alias("host"),
        "session_id",
        F.col("line_no").alias("seq"),
        V.text_at(v, "$.uuid").alias("uuid"),
        V.text_at(v, "$.timestamp").alias("ts"),
        V.text_at(v, "$.type").alias("type"),
        V.text_at(v, "$.message.role").alias("role"),
        V.text_at(v, "$.cwd").alias("cwd"),
        V.text_at(v, "$.message.model").alias("model"),
        V.kind(content).alias("content_kind"),
        F.coalesce(titled, V.record_text(content)).alias("text"),
        blocks.alias("blocks"),
        F.coalesce(F.try_variant_get(v, "$.isMeta", "boolean"), F.lit(False)).alias("is_meta"),
        F.coalesce(F.try_variant_get(v, "$.isSidechain", "boolean"), F.lit(False)).alias("is_sidechain"),
        (
            (result.isNotNull() & ~F.is_variant_null(result))
            | F.coalesce(F.exists(blocks, lambda b: b["type"] == "tool_result"), F.lit(False))
        ).alias("has_tool_use_result"),
        "v",
    )


def read_codex(spark: SparkSession, root: str, pattern: str = "rollout-*.jsonl") -> DataFrame:
    """Rollouts at any depth as events ``session_id, idx, ts_raw, type, payload``."""
    allow_repeated_keys(spark)
    lines, _ = parse_jsonl(lines_of(spark, root, "codex", pattern))
    v = F.col("v")
    return lines.select(
        I.rollout_session(F.col("path")).alias("session_id"),
        (F.col("line_no") - 1).alias("idx"),
        V.text_at(v, "$.timestamp").alias("ts_raw"),
        V.text_at(v, "$.type").alias("type"),
        V.path(v, "$.payload").alias("payload"),
    )


def cursor_roots(meta: DataFrame) -> DataFrame:
    """Root node of a store: the first meta row (``pos``) whose value names one."""
    root = F.nullif(V.text_at(F.try_parse_json("value"), "$.latestRootBlobId"), F.lit(""))
    return meta.withColumn("root", root).groupBy("session_id").agg(
        F.min_by("root", F.when(F.col("root").isNotNull(), F.col("pos"))).alias("latest_root")
    )


def read_cursor(blobs: DataFrame, meta: DataFrame, info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exported ``blobs`` and ``meta`` tables plus per-session ``info`` (schema_version,
    cwd, created_ms, updated_ms) as inputs of the walk."""
    return blobs, info.join(cursor_roots(meta), "session_id", "left")


def tail(lines: DataFrame, cursors: DataFrame) -> DataFrame:
    """Per session, the complete lines from its cursor on; malformed lines are consumed
    as well, a partial last line is not. ``lines``: session_id, byte_start, byte_end,
    complete, v."""
    at = lines.join(cursors, "session_id", "left").withColumn("offset", F.coalesce("offset", F.lit(0)))
    return at.filter(F.col("complete") & (F.col("byte_start") >= F.col("offset")))


def tail_summary(lines: DataFrame, cursors: DataFrame) -> DataFrame:
    """Rows to ship and the new cursor of each session that grew."""
    return tail(lines, cursors).groupBy("session_id").agg(
        F.count_if(F.col("v").isNotNull()).alias("records"),
        F.count_if(F.col("v").isNull()).alias("malformed"),
        F.max("byte_end").alias("consumed"),
    )


def catalog(spark: SparkSession, root: str, host: str = "claude", pattern: str | None = None) -> DataFrame:
    """(host, session_id, path, size, mtime) of every session file, from the listing alone:
    the scan has no column of contents, so no file is opened."""
    nested = host == "codex"
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern or ("rollout-*.jsonl" if nested else "*.jsonl"))
    files = files.option("recursiveFileLookup", "true").load(root) if nested else files.load(f"{root.rstrip('/')}/*")
    session = I.rollout_session(F.col("path")) if nested else _stem(F.col("path"))
    return files.select(F.lit(host).alias("host"), session.alias("session_id"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def list_sessions(sessions: DataFrame, host: str = "all", limit: int = 20) -> DataFrame:
    """Newest first over all hosts; the session id breaks ties."""
    rows = sessions if host == "all" else sessions.filter(F.col("host") == host)
    return rows.orderBy(F.col("mtime").desc(), "host", "session_id").limit(limit)


def resolve_sessions(refs: DataFrame, sessions: DataFrame, on_ambiguous: str = "refuse") -> DataFrame:
    """References (``ref``) to one catalog row: exact id, path or ``latest``.

    A partial id never matches. Several matches are refused, or with ``largest`` settled by
    file size."""
    pick = F.struct("path", "session_id")
    by_id = sessions.groupBy(F.col("session_id").alias("ref")).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(pick, F.struct("size", "path")).alias("p")
    )
    by_path = sessions.groupBy(F.col("path").alias("ref")).agg(F.count(F.lit(1)).alias("n"), F.max_by(pick, "size").alias("p"))
    latest = sessions.agg(F.max_by(pick, F.struct("mtime", "session_id")).alias("p")).select(
        F.lit("latest").alias("ref"), F.lit(1).cast("long").alias("n"), "p"
    )
    targets = by_id.filter(F.col("ref") != "latest").unionByName(by_path).unionByName(latest)
    targets = targets.groupBy("ref").agg(F.sum("n").alias("n"), F.max("p").alias("p"))
    out = refs.join(targets, "ref", "left")
    n = F.coalesce("n", F.lit(0))
    status = F.when(n == 0, "missing").when((n == 1) | F.lit(on_ambiguous == "largest"), "ok").otherwise("ambiguous")
    return out.select(
        *refs.columns,
        status.alias("status"),
        F.when(status == "ok", F.col("p.path")).alias("path"),
        F.when(status == "ok", F.col("p.session_id")).alias("session_id"),
    )
