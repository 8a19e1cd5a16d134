"""Queries over capture gates, state and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.operators import health as H
from agentlake.operators.ordered import Running, running
from agentlake.plans.function_queries import AGENT_SQL
from agentlake.plans.registry import query
from agentlake.plans.routing_queries import NOW, _ROOMS_SQL, rooms

LAST_SQL = "(SELECT max(ts_s) FROM v_attempts)"


@query("h01_trusted_offset", "SELECT event_id, CASE WHEN offset_after BETWEEN 0 AND file_size THEN offset_after ELSE 0 END AS trusted FROM v_attempts")
def _(v):
    return v.attempts.select("event_id", H.trusted_offset(F.col("offset_after").cast("string"), F.col("file_size")).alias("trusted"))


@query(
    "h02_flush_due_claude",
    """SELECT event_id, CASE WHEN event_id % 19 = 0 THEN false WHEN event_id % 13 = 0 THEN false WHEN file_size <= 0 THEN false WHEN event_id % 11 = 0 THEN false WHEN event_id % 7 = 0 THEN true
    WHEN event_id % 5 = 0 THEN false ELSE file_size <> offset_after END AS due FROM v_attempts""",
)
def _(v):
    k = F.col("event_id")
    due = H.flush_due_claude(
        F.when(k % 13 == 0, "").otherwise(F.col("session_id")), F.lit("/t"), F.col("file_size"),
        F.when(k % 7 == 0, "junk").otherwise(F.col("offset_after").cast("string")), k % 11 == 0, k % 5 == 0, k % 19 == 0,
    )
    return v.attempts.select("event_id", due.alias("due"))


_CODEX_EVENT = "CASE WHEN event_id % 4 = 0 THEN 'Stop' WHEN event_id % 4 = 1 THEN 'PreToolUse' ELSE 'PostToolUse' END"


@query(
    "h03_flush_due_codex",
    f"""SELECT event_id, CASE WHEN event_id*10 < event_id*9 + 50 THEN true WHEN event_id % 6 = 0 AND event_id % 3000 < 1800 THEN false WHEN event_id*10 <= event_id*9 + 50 THEN false
    WHEN {_CODEX_EVENT} = 'Stop' THEN true WHEN {_CODEX_EVENT} = 'PostToolUse' THEN coalesce({AGENT_SQL.format('command')}, false) ELSE false END AS due FROM v_hook""",
)
def _(v):
    k = F.col("event_id")
    due = H.flush_due_codex(
        F.expr(_CODEX_EVENT), F.col("command"), k * 10, k * 9 + 50, k % 6 == 0, F.lit(NOW) - k % 3000, F.lit(NOW)
    )
    return v.hook.select("event_id", due.alias("due"))


_CURSOR_EVENT = "CASE event_id % 5 WHEN 0 THEN 'beforeShellExecution' WHEN 1 THEN 'afterFileEdit' WHEN 2 THEN 'stop' WHEN 3 THEN 'beforeSubmitPrompt' ELSE 'preToolUse' END"


@query(
    "h04_flush_due_cursor",
    f"""SELECT event_id, CASE WHEN event_id % 7 = 0 AND event_id % 3000 < 1800 THEN false WHEN event_id % 3 = 0 THEN false WHEN {_CURSOR_EVENT} = 'beforeShellExecution' THEN coalesce({AGENT_SQL.format('command')}, false)
    WHEN {_CURSOR_EVENT} = 'afterFileEdit' THEN event_id % 240 > 120 ELSE {_CURSOR_EVENT} IN ('stop', 'beforeSubmitPrompt') END AS due FROM v_hook""",
)
def _(v):
    k = F.col("event_id")
    due = H.flush_due_cursor(
        F.expr(_CURSOR_EVENT), F.col("command"), k % 3, k % 7 == 0, F.lit(NOW) - k % 3000, F.lit(NOW) - k % 240, F.lit(NOW)
    )
    return v.hook.select("event_id", due.alias("due"))


_KIND = "CASE outcome WHEN 'ok' THEN 'ok' WHEN 'no_credential' THEN 'auth' WHEN 'unconfirmed' THEN CASE WHEN event_id % 4 = 0 THEN 'unsupported' ELSE 'local' END ELSE outcome END"


def _writes(v):
    rows = v.attempts.select("session_id", F.col("event_id").alias("at"), F.expr(_KIND).alias("kind"), "offset_after")
    return H.state_writes(rows)


@query(
    "h05_merge_state",
    f"""WITH w AS (SELECT session_id, event_id AS t, {_KIND} AS kind, offset_after FROM v_attempts)
    SELECT session_id, arg_max(offset_after, t) FILTER (WHERE kind IN ('ok', 'local')) AS "offset", max(t) FILTER (WHERE kind = 'ok') AS last_ok_at,
      CASE WHEN arg_max(kind, t) FILTER (WHERE kind <> 'local') NOT IN ('ok', 'unsupported') THEN arg_max(kind, t) FILTER (WHERE kind <> 'local') END AS last_error,
      CASE WHEN arg_max(kind, t) FILTER (WHERE kind <> 'local') NOT IN ('ok', 'unsupported') THEN max(t) FILTER (WHERE kind <> 'local') END AS last_error_at,
      CASE WHEN count(*) FILTER (WHERE kind = 'unsupported') > 0 THEN true END AS unsupported FROM w GROUP BY session_id""",
)
def _(v):
    return H.merge_state(_writes(v), ["offset", "last_ok_at", "last_error", "last_error_at", "unsupported"])


@query(
    "h06_state_writes",
    f"""WITH w AS (SELECT session_id, event_id AS t, {_KIND} AS kind, offset_after FROM v_attempts)
    SELECT session_id, t AS write_at, kind IN ('ok', 'local') AS sets_offset, kind = 'ok' AS sets_ok, kind <> 'local' AS sets_error, CASE WHEN kind NOT IN ('ok', 'local', 'unsupported') THEN kind END AS error FROM w""",
)
def _(v):
    return _writes(v).select(
        "session_id", F.col("at").alias("write_at"), F.col("offset").isNotNull().alias("sets_offset"), F.col("last_ok_at").isNotNull().alias("sets_ok"),
        F.col("last_error").isNotNull().alias("sets_error"), F.col("last_error.v").alias("error"),
    )


DORMANCY_SQL = """WITH RECURSIVE a AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS pos,
    CASE WHEN outcome = 'ok' THEN 'ok' WHEN outcome = 'no_credential' THEN 'neutral' ELSE 'fail' END AS k FROM v_attempts),
m AS (
  SELECT session_id, pos, event_id, CASE WHEN k = 'fail' THEN 1 ELSE 0 END AS fail_streak, false AS dormant, CAST(NULL AS BIGINT) AS unsupported_at FROM a WHERE pos = 1
  UNION ALL
  SELECT a.session_id, a.pos, a.event_id,
    CASE WHEN a.k <> 'fail' OR m.dormant OR m.fail_streak >= 4 THEN 0 ELSE m.fail_streak + 1 END,
    CASE WHEN a.k = 'ok' THEN false WHEN a.k = 'neutral' THEN m.dormant ELSE m.dormant OR m.fail_streak >= 4 END,
    CASE WHEN a.k = 'ok' THEN NULL WHEN a.k = 'neutral' THEN m.unsupported_at WHEN m.dormant OR m.fail_streak >= 4 THEN a.ts_s END
  FROM m JOIN a ON a.session_id = m.session_id AND a.pos = m.pos + 1)"""


@query("h07_dormancy", DORMANCY_SQL + " SELECT event_id, session_id, fail_streak, dormant, unsupported_at FROM m")
def _(v):
    return H.dormancy(v.attempts).select("event_id", "session_id", "fail_streak", "dormant", "unsupported_at")


@query(
    "h08_cooldown",
    f"""SELECT event_id, {_CODEX_EVENT} <> 'Stop' AND ts_s - coalesce(max(CASE WHEN outcome IN ('timeout', 'rate_limited') THEN ts_s END) OVER (PARTITION BY session_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 60 AS waits FROM v_attempts""",
)
def _(v):
    bad = F.when(F.col("outcome").isin("timeout", "rate_limited"), F.col("ts_s"))
    rows = running(v.attempts, ["session_id"], ["event_id"], {"last_error_at": Running("max", bad, inclusive=False)})
    return rows.select("event_id", H.cooldown(F.expr(_CODEX_EVENT), F.col("last_error_at"), F.col("ts_s")).alias("waits"))


_REPLY = """SELECT event_id AS reply_id, concat('c', user_id) AS conversation_id, event_id % 8 = 7 AS is_error,
  CASE event_id % 8 WHEN 0 THEN concat('{"conversation_id":"c', user_id, '","ack_through":"a', event_id, '"}') WHEN 1 THEN concat('{"conversation_id":"c', user_id, '","ack_through":null,"result":{"conversation_id":"c', user_id, '","ack_through":"n', event_id, '"}}')
    WHEN 3 THEN concat('{"conversation_id":"c', user_id, '"}') WHEN 4 THEN concat('{"conversation_id":"other","ack_through":"x"}') WHEN 5 THEN concat('{"conversation_id":"c', user_id, '","ack_through":null}')
    WHEN 6 THEN concat('{"conversation_id":"c', user_id, '","ack_through":"a","records_dropped":2}') WHEN 7 THEN concat('{"conversation_id":"c', user_id, '","ack_through":"a"}') END AS s,
  CASE WHEN event_id % 8 = 2 THEN concat('{"conversation_id":"c', user_id, '","ack_through":"t', event_id, '"}') END AS t FROM {events}"""


def _replies(v):
    r = v.sql(_REPLY)
    return H.pick_ack(r.select("reply_id", "conversation_id", "is_error", F.parse_json("s").alias("structured"), F.array(F.lit('{"note":1}'), F.lit("text"), F.col("t")).alias("texts")))


@query(
    "h09_pick_ack",
    """SELECT event_id AS reply_id, CASE event_id % 8 WHEN 0 THEN concat('a', event_id) WHEN 1 THEN concat('n', event_id) WHEN 2 THEN concat('t', event_id) WHEN 6 THEN 'a' WHEN 7 THEN 'a' END AS ack_through, event_id % 8 <> 4 AS found FROM events""",
)
def _(v):
    return _replies(v).select("reply_id", F.try_variant_get("ack", "$.ack_through", "string").alias("ack_through"), F.col("ack").isNotNull().alias("found"))


@query(
    "h10_verdict",
    """SELECT event_id AS reply_id, CASE WHEN event_id % 8 < 3 THEN 'ok' WHEN event_id % 8 = 3 THEN 'unsupported' ELSE 'unconfirmed' END AS verdict FROM events""",
)
def _(v):
    return _replies(v).select("reply_id", H.verdict(F.col("is_error"), F.col("ack")).alias("verdict"))


@query(
    "h11_classify",
    """SELECT event_id, CASE event_id % 12 WHEN 0 THEN 'ok' WHEN 1 THEN 'rate_limited' WHEN 2 THEN 'auth' WHEN 3 THEN 'forbidden' WHEN 4 THEN 'error' WHEN 5 THEN 'timeout' WHEN 6 THEN 'budget_exhausted' WHEN 7 THEN 'unrecognized_response'
    WHEN 8 THEN 'server_rejected' WHEN 9 THEN 'unrecognized_response' WHEN 10 THEN 'unsupported' ELSE 'error' END AS class FROM events""",
)
def _(v):
    k = F.col("event_id") % 12
    status = F.when(k == 1, 429).when(k == 2, 401).when(k == 3, 403).when(k == 4, 502).otherwise(200)
    c = H.classify(status, k == 5, k == 6, k == 7, k == 8, k != 9, k != 10, k == 11)
    return v.table("events").select("event_id", c.alias("class"))


def _state(v):
    rows = v.attempts.withColumn("kind", F.expr(_KIND))
    bad = ~F.col("kind").isin("ok", "local", "unsupported")
    return rows.groupBy("session_id", "capture_path").agg(
        F.max("ts_s").alias("at"),
        F.max(F.when(F.col("kind") == "ok", F.col("ts_s"))).alias("last_ok_at"),
        F.max_by("kind", F.when(bad, F.col("ts_s"))).alias("last_error"),
        F.max(F.when(bad, F.col("ts_s"))).alias("last_error_at"),
    )


@query(
    "h12_recent_failure",
    f"""WITH w AS (SELECT *, {_KIND} AS kind FROM v_attempts),
    s AS (SELECT session_id, capture_path, max(ts_s) AS at_, max(ts_s) FILTER (WHERE kind = 'ok') AS last_ok_at, arg_max(kind, ts_s) FILTER (WHERE kind NOT IN ('ok', 'local', 'unsupported')) AS last_error,
      max(ts_s) FILTER (WHERE kind NOT IN ('ok', 'local', 'unsupported')) AS last_error_at FROM w GROUP BY 1, 2),
    n AS (SELECT * FROM s WHERE last_error IS NOT NULL AND last_error_at >= {LAST_SQL} - 86400
      AND NOT EXISTS (SELECT 1 FROM s o WHERE o.session_id = s.session_id AND o.last_ok_at >= s.last_error_at))
    SELECT session_id, capture_path, last_error, last_error_at FROM n QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY at_ DESC, capture_path DESC) = 1""",
)
def _(v):
    now = v.attempts.agg(F.max("ts_s")).first()[0]
    return H.recent_failure(_state(v), now)


_CRED = f"""SELECT c_custkey, c_custkey % 17 = 0 AS explicit_token, c_custkey % 3 <> 0 AS has_key, CASE WHEN c_custkey % 4 <> 0 THEN {NOW} + (c_custkey % 20 - 10) * 86400 END AS key_expires_s,
  c_custkey % 5 <> 0 AS has_login, c_custkey % 2 = 0 AS refresh, CASE WHEN c_custkey % 7 <> 0 THEN {NOW} + (c_custkey % 11 - 3) * 7200 END AS exp_s FROM {{customer}}"""


@query(
    "h13_credential_state",
    f"""SELECT c_custkey, CASE WHEN explicit_token THEN NULL WHEN has_key AND (key_expires_s IS NULL OR key_expires_s - {NOW} > 604800) THEN NULL WHEN has_key AND key_expires_s > {NOW} THEN 'key_expiring'
      WHEN NOT has_login AND has_key THEN 'key_expired' WHEN NOT has_login THEN 'never' WHEN refresh THEN NULL WHEN exp_s <= {NOW} THEN 'unrenewable' WHEN exp_s IS NULL OR exp_s - {NOW} <= 21600 THEN 'no_refresh' END AS state
    FROM ({_CRED.replace('{customer}', 'customer')}) x""",
)
def _(v):
    return H.credential_state(v.sql(_CRED), NOW).select("c_custkey", "state")


@query(
    "h14_health_message",
    f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN concat('Capture is not authenticated for h', user_id, '.') WHEN 1 THEN concat('The access key of capture for h', user_id, ' expires soon.')
      WHEN 2 THEN concat('Capture last failed ', CASE WHEN event_id % 300 < 120 THEN concat(event_id % 300, 'm ago') ELSE concat(event_id % 300 // 60, 'h ago') END, ' — the server stopped responding.')
      WHEN 3 THEN concat('Capture last failed ', CASE WHEN event_id % 300 < 120 THEN concat(event_id % 300, 'm ago') ELSE concat(event_id % 300 // 60, 'h ago') END, ' — the capture hook failed.') END AS message FROM events""",
)
def _(v):
    k = F.col("event_id") % 6
    msg = H.health_message(
        F.concat(F.lit("h"), "user_id"), F.when(k == 0, "never").when(k == 1, "key_expiring"),
        F.when(k.isin(0, 2), "timeout").when(k == 3, "novel"), F.lit(NOW) - (F.col("event_id") % 300) * 60, NOW,
    )
    return v.table("events").select("event_id", msg.alias("message"))


@query(
    "h15_first_warnings",
    """WITH w AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN concat('u', user_id) END AS session_id, concat(event_type, '|', event_id % 2) AS signature FROM events)
    SELECT event_id, session_id, signature FROM (SELECT *, lag(signature) OVER (PARTITION BY session_id ORDER BY event_id) AS l FROM w) x WHERE session_id IS NULL OR signature IS DISTINCT FROM l""",
)
def _(v):
    w = v.sql("SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN concat('u', user_id) END AS session_id, concat(event_type, '|', event_id % 2) AS signature FROM {events}")
    return H.first_warnings(w).select("event_id", "session_id", "signature")


_OVERVIEWS = f"SELECT concat('b', s_suppkey) AS brain_id, concat('overview of ', s_name) AS overview, CASE WHEN s_suppkey % 3 <> 0 THEN {NOW} - s_suppkey * 1000 END AS refreshed_at FROM {{supplier}}"


@query("h16_stale_overviews", f"SELECT concat('b', s_suppkey) AS brain_id FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey * 1000 >= 21600")
def _(v):
    return H.stale_overviews(v.sql(_OVERVIEWS), NOW).select("brain_id")


@query(
    "h17_brain_changes",
    """WITH b AS (SELECT event_id, concat('r', user_id) AS room_name, event_type AS env, concat('b', event_id // 700) AS brain_id FROM events)
    SELECT event_id, brain_id FROM (SELECT *, lag(brain_id) OVER (PARTITION BY room_name, env ORDER BY event_id) AS l FROM b) x WHERE brain_id IS DISTINCT FROM l""",
)
def _(v):
    b = v.sql("SELECT event_id, concat('r', user_id) AS room_name, event_type AS env, concat('b', event_id div 700) AS brain_id FROM {events}")
    return H.brain_changes(b).select("event_id", "brain_id")


@query(
    "h18_session_brief",
    f"""WITH {_ROOMS_SQL} SELECT event_id, r.brain_id, CASE WHEN event_id % 4 = 0 THEN 'off' ELSE 'on' END AS writes, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN concat('overview of ', s_name) END, 'none cached') AS digest
    FROM events JOIN rooms r ON r.room_name = concat('Repo: o/r', user_id) AND r.env = 'staging' AND r.brain_id IS NOT NULL LEFT JOIN supplier ON r.brain_id = concat('b', s_suppkey)""",
)
def _(v):
    s = v.sql("SELECT event_id, concat('Repo: o/r', user_id) AS room_name, 'staging' AS env, event_id % 4 <> 0 AS capture_on FROM {events}")
    o = v.sql("SELECT concat('b', s_suppkey) AS brain_id, concat('overview of ', s_name, ' ') AS overview FROM {supplier} WHERE s_suppkey % 2 = 0")
    return H.session_brief(s, rooms(v), o).select("event_id", "brain_id", "writes", "digest")


@query(
    "h19_key_audit",
    """WITH k AS (SELECT c_nationkey AS account, concat('l', c_custkey % 9) AS label, c_custkey AS id FROM customer WHERE c_custkey % 4 <> 0), p AS (SELECT account, label, count(*) AS live, count(*) FILTER (WHERE id % 3 <> 0) AS orphans FROM k GROUP BY 1, 2)
    SELECT account, label, live, orphans, sum(live) OVER (PARTITION BY account) - live < 5 AS can_mint FROM p""",
)
def _(v):
    keys = v.sql("SELECT c_nationkey AS account, concat('l', c_custkey % 9) AS label, c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'x' END AS revoked_at FROM {customer}")
    return H.key_audit(keys, keys.filter("id % 3 = 0"))
