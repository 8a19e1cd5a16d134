"""Streaming operators run over the driver tables with all data available, next to the SQL
that gives the same result in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.operators import artifacts as A
from agentlake.plans import artifact_queries as AQ
from agentlake.plans.function_queries import HANDLE_SQL
from agentlake.plans.health_queries import DORMANCY_SQL, _KIND
from agentlake.plans.registry import query
from agentlake.plans.views import VIEW_SQL, Views
from agentlake.session import scratch_folder
from agentlake.streaming import ingest as IN
from agentlake.streaming import state as S


def stream_table(v: Views, name: str) -> DataFrame:
    """A driver table as a file stream. The table is one file or a folder of files: a path that
    is a pattern reads both, a plain one no file and a name filter no folder."""
    schema = v.table(name).schema
    return v.spark.readStream.schema(schema).parquet(f"{v.sf_dir}/{name}.parque[t]")


def stream_view(v: Views, name: str, table: str = "events") -> DataFrame:
    return v.sql(VIEW_SQL[name], **{table: stream_table(v, table)})


def finish(v: Views, stream: DataFrame, mode: str = "append", timed: bool = False) -> DataFrame:
    return IN.run_to_end(stream, scratch_folder(v.spark, "out"), scratch_folder(v.spark, "ckpt"), mode, timed)


def land(v: Views, shrink: bool = False) -> tuple[str, DataFrame]:
    """Transcript lines of every conversation as delta files with byte ranges."""
    from agentlake.operators.ordered import Running, running

    rows = v.sql(
        """SELECT concat('s', conv_id) AS session_id, conv_id, turn, to_json(named_struct('turn', turn, 'uuid', md5(concat(conv_id, ':', turn)))) AS raw FROM {conversations}"""
    ).withColumn("n", (F.octet_length("raw") + 1).cast("long"))
    rows = running(rows, ["session_id"], ["turn"], {"byte_end": Running("sum", F.col("n"))})
    size = rows.groupBy("session_id").agg(F.max("byte_end").alias("file_size"), F.max("turn").alias("last"))
    out = rows.join(size, "session_id").select(
        "session_id", (F.col("byte_end") - F.col("n")).alias("byte_start"), "byte_end",
        (~((F.col("turn") == F.col("last")) & (F.col("conv_id") % 4 == 0))).alias("complete"), "file_size", "raw",
    )
    folder = scratch_folder(v.spark, "landing")
    out.write.parquet(folder)
    return folder, out


_LANDED = "WITH t AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)"


@query("st01_ingest_stream", _LANDED + " SELECT concat('s', conv_id) AS session_id, turn FROM t WHERE NOT (turn = last AND conv_id % 4 = 0)")
def _(v):
    folder, _ = land(v)
    rows = IN.ingest_stream(v.spark, folder, files_per_trigger=3)
    return finish(v, rows.select("session_id", F.try_variant_get("v", "$.turn", "bigint").alias("turn")))


def _sends(v: Views, stream: bool = False) -> DataFrame:
    """Records as they arrive, each conversation's even turns twice."""
    src = stream_table(v, "conversations") if stream else v.table("conversations")
    twice = F.explode(F.when(F.col("turn") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("send")
    return src.select(
        F.concat(F.lit("s"), "conv_id").alias("conversation_id"), F.col("turn").alias("seq"), twice,
        F.when(F.col("turn") % 5 != 4, F.md5(F.concat_ws(":", "conv_id", "turn"))).alias("uuid"),
    ).drop("send")


_STORED = "SELECT concat('s', conv_id) AS conversation_id, md5(concat(arg_max(conv_id, turn), ':', max(turn))) AS ack_through, count(*) AS stored FROM conversations WHERE turn % 5 <> 4 GROUP BY conv_id"


@query("st02_import_merge", _STORED)
def _(v):
    target = scratch_folder(v.spark, "target")
    IN.import_merge(_sends(v, stream=True), target, scratch_folder(v.spark, "ckpt")).awaitTermination()
    return IN.acks(v.spark, target)


@query(
    "st03_drain",
    """WITH RECURSIVE r AS (SELECT concat('s', conv_id) AS conversation_id, turn, turn % 6 = 5 AS now_, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations),
    m AS (SELECT conversation_id, turn, pos, 1 AS drain, CASE WHEN now_ THEN 0 ELSE 1 END AS held FROM r WHERE pos = 1
      UNION ALL SELECT r.conversation_id, r.turn, r.pos, CASE WHEN m.held = 0 THEN m.drain + 1 ELSE m.drain END, CASE WHEN now_ OR m.held + 1 >= 3 THEN 0 ELSE m.held + 1 END
      FROM m JOIN r ON r.conversation_id = m.conversation_id AND r.pos = m.pos + 1)
    SELECT conversation_id, drain, turn AS seq FROM m WHERE drain IN (SELECT n.drain FROM m n WHERE n.conversation_id = m.conversation_id AND n.held = 0)""",
)
def _(v):
    rows = stream_table(v, "conversations").select(
        F.concat(F.lit("s"), "conv_id").alias("conversation_id"), F.col("turn").alias("seq"), F.col("role").alias("record"),
        F.when(F.col("turn") % 6 == 5, "now").otherwise("auto").alias("mode"),
    )
    return finish(v, S.drain(rows, 3).select("conversation_id", "drain", "seq"))


def _throttle_sql(rows: str, key: str, gap: int, op: str) -> str:
    return f"""WITH RECURSIVE r AS ({rows}), m AS (SELECT {key}, event_id, ts_s AS last, pos, true AS passed FROM r WHERE pos = 1
      UNION ALL SELECT r.{key}, r.event_id, CASE WHEN r.ts_s - m.last {op} {gap} THEN r.ts_s ELSE m.last END, r.pos, r.ts_s - m.last {op} {gap} FROM m JOIN r ON r.{key} = m.{key} AND r.pos = m.pos + 1)
    SELECT {key}, event_id FROM m WHERE passed"""


@query("st04_debounce", _throttle_sql("SELECT session_id, event_id, ts_s, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS pos FROM v_hook WHERE tool_name = 'Edit'", "session_id", 20_000, ">"))
def _(v):
    rows = stream_view(v, "v_hook").filter(F.col("tool_name") == "Edit").select("session_id", "event_id", "ts_s")
    return finish(v, S.debounce(rows, 20_000).select("session_id", "event_id"))


@query("st05_dormancy_stream", DORMANCY_SQL + " SELECT event_id, session_id, fail_streak, dormant, unsupported_at FROM m")
def _(v):
    out = S.dormancy_stream(stream_view(v, "v_attempts"))
    return finish(v, out.select("event_id", "session_id", "fail_streak", "dormant", "unsupported_at"))


@query("st06_once_per_session", f"SELECT session_id, {HANDLE_SQL} AS handle_key, min(event_id) AS event_id FROM v_hook GROUP BY 1, 2")
def _(v):
    from agentlake.functions import ids as I

    key = I.handle_key(F.col("tool_name"), F.coalesce("file_path", "command"), F.col("cwd"))
    rows = stream_view(v, "v_hook").select("session_id", key.alias("handle_key"), "event_id")
    return finish(v, S.once_per_session(rows, "handle_key"), timed=True)


@query(
    "st06_once_capped",
    """WITH RECURSIVE r AS (SELECT session_id, event_id, event_id % 5 AS item, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS pos FROM v_hook),
    m AS (SELECT session_id, event_id, pos, [item] AS seen, true AS passed FROM r WHERE pos = 1
      UNION ALL SELECT r.session_id, r.event_id, r.pos, CASE WHEN list_contains(m.seen, r.item) THEN m.seen ELSE list_append(CASE WHEN len(m.seen) >= 3 THEN m.seen[2:] ELSE m.seen END, r.item) END, NOT list_contains(m.seen, r.item)
      FROM m JOIN r ON r.session_id = m.session_id AND r.pos = m.pos + 1) SELECT session_id, event_id FROM m WHERE passed""",
)
def _(v):
    rows = stream_view(v, "v_hook").select("session_id", (F.col("event_id") % 5).cast("string").alias("item"), "event_id")
    return finish(v, S.once_per_session(rows, "item", cap=3).select("session_id", "event_id"), timed=True)


@query(
    "st07_board_stream",
    """WITH e AS (SELECT * FROM v_board_events WHERE event <> 'post-tool'), f AS (SELECT session_id, min(event_id) AS first FROM e WHERE event <> 'session-end' GROUP BY 1)
    SELECT session_id, min(ts_s) AS started, max(ts_s) AS last_update, CASE WHEN arg_max(event, event_id) = 'session-end' THEN 'ended' ELSE 'active' END AS status,
      arg_max(prompt, event_id) FILTER (WHERE event = 'prompt') AS working_on FROM e JOIN f USING (session_id) WHERE event_id >= first GROUP BY session_id""",
)
def _(v):
    out = finish(v, S.board_stream(stream_view(v, "v_board_events").filter("event <> 'post-tool'")), mode="update", timed=True)
    # every trigger writes the entries it changed: the newest one counts
    rest = ["started", "last_update", "status", "working_on"]
    return out.filter("NOT gone").groupBy("session_id").agg(F.max_by(F.struct(*rest), "last_update").alias("e")).select("session_id", "e.*")


@query(
    "st08_health_stream",
    f"""WITH w AS (SELECT session_id, ts_s, {_KIND} AS kind FROM v_attempts), s AS (SELECT session_id, max(ts_s) FILTER (WHERE kind = 'ok') AS ok_at,
      arg_max(kind, ts_s) FILTER (WHERE kind NOT IN ('ok', 'local', 'unsupported')) AS e, max(ts_s) FILTER (WHERE kind NOT IN ('ok', 'local', 'unsupported')) AS e_at FROM w GROUP BY 1)
    SELECT session_id, CASE WHEN ok_at IS NULL OR ok_at < e_at THEN e END AS last_error, CASE WHEN ok_at IS NULL OR ok_at < e_at THEN e_at END AS last_error_at FROM s""",
)
def _(v):
    rows = stream_view(v, "v_attempts").select("session_id", "ts_s", F.expr(_KIND).alias("kind"))
    return finish(v, S.health_stream(rows), mode="update", timed=True)


@query(
    "st09_reset_on_shrink",
    _LANDED + """, b AS (SELECT *, sum(strlen(concat('{"turn":', turn, ',"uuid":"', md5(concat(conv_id, ':', turn)), '"}')) + 1) OVER (PARTITION BY conv_id ORDER BY turn) AS byte_end FROM t),
    c AS (SELECT conv_id, max(byte_end) AS size, max(byte_end) FILTER (WHERE turn <= 1) AS two FROM b GROUP BY conv_id)
    SELECT concat('s', conv_id) AS session_id, count(*) AS lines FROM b JOIN c USING (conv_id)
    WHERE NOT (turn = last AND conv_id % 4 = 0) AND (conv_id % 3 = 0 OR turn > 1) GROUP BY conv_id""",
)
def _(v):
    _, lines = land(v)
    # a third of the cursors lie beyond their file, the others after the second line
    n = F.substring("session_id", 2, 20).cast("long")
    turn = F.try_variant_get(F.try_parse_json("raw"), "$.turn", "bigint")
    cursors = lines.groupBy("session_id").agg(F.max("file_size").alias("size"), F.max(F.when(turn <= 1, F.col("byte_end"))).alias("two")).select(
        "session_id", F.when(n % 3 == 0, F.col("size") + 100).otherwise(F.col("two")).alias("offset")
    )
    return IN.reset_on_shrink(lines, cursors).groupBy("session_id").agg(F.count(F.lit(1)).alias("lines"))


@query("st10_backstop", _STORED)
def _(v):
    target = scratch_folder(v.spark, "target")
    IN.import_merge(_sends(v, stream=True).filter("seq < 3"), target, scratch_folder(v.spark, "ckpt")).awaitTermination()
    IN.backstop(_sends(v), target, 1_000_000)
    return IN.acks(v.spark, target)


@query("st11_throttle", _throttle_sql("SELECT concat('b', user_id % 20) AS brain_id, event_id, 1704067200 + event_id*60 AS ts_s, row_number() OVER (PARTITION BY user_id % 20 ORDER BY event_id) AS pos FROM events", "brain_id", 21_600, ">="))
def _(v):
    rows = stream_table(v, "events").select(
        F.concat(F.lit("b"), (F.col("user_id") % 20).cast("string")).alias("brain_id"), "event_id", (F.lit(1_704_067_200) + F.col("event_id") * 60).alias("ts_s")
    )
    return finish(v, S.throttle(rows).select("brain_id", "event_id"))


@query("st06_first_reminders", f"WITH {AQ._GOVERNED_SQL} SELECT session_id, artifact_id, min(event_id) AS event_id FROM m GROUP BY session_id, artifact_id")
def _(v):
    """Reminders as a stream: edits joined to the static links, each artifact once per session."""
    edits = stream_view(v, "v_hook").filter(F.col("tool_name") == "Edit").select(
        "session_id", "event_id", F.element_at(F.split("file_path", "/"), 3).alias("repo"), F.regexp_replace("file_path", "^/w/[^/]+/", "").alias("rel_path")
    )
    links = A.compiled_links(AQ.links(v)).select("repo", "artifact_id", "regex", "keys")
    hit = A.candidates(edits, links).filter(F.rlike(F.col("rel_path"), F.col("regex"))).select("session_id", "artifact_id", "event_id")
    return finish(v, S.once_per_session(hit, "artifact_id"), timed=True)
