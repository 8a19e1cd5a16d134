"""Queries over directive recall."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.functions import ids as I
from agentlake.operators import directives as D
from agentlake.operators import paths as P
from agentlake.plans.function_queries import ERROR_SQL, HANDLE_SQL, MUTATING_SQL
from agentlake.plans.registry import query

_GENERIC = ", ".join(f"'{t}'" for t in D.GENERIC_TOKENS)


def _tokens_sql(t: str) -> str:
    base = f"split_part({t}, '/', -1)"
    return (
        f"list_distinct(list_filter(list_concat([{t}, CASE WHEN contains({t}, '/') OR contains({t}, '.') THEN {base} END, "
        f"CASE WHEN contains({base}, '.') THEN regexp_replace({base}, '\\.[^.]*$', '') END], "
        f"list_filter(regexp_split_to_array({t}, '[^a-z0-9_]+'), lambda x: length(x) >= 5)), lambda x: x IS NOT NULL AND length(x) >= 4))"
    )


TRIGGERS_SQL = """triggers AS (SELECT id, repo, seen, type, content, 0 AS tpos, lower(trim(trigger_1)) AS t, trigger_1 AS trigger FROM v_directives WHERE trigger_1 IS NOT NULL
  UNION ALL SELECT id, repo, seen, type, content, CASE WHEN trigger_1 IS NULL THEN 0 ELSE 1 END, lower(trim(trigger_2)), trigger_2 FROM v_directives WHERE trigger_2 IS NOT NULL)"""
DTOKENS_SQL = f"""{TRIGGERS_SQL}, dtokens AS (SELECT id, repo, seen, tpos, trigger, unnest({_tokens_sql('t')}) AS token FROM triggers),
  atokens AS (SELECT * FROM dtokens WHERE token NOT IN ({_GENERIC}) AND token <> repo)"""
PROACTIVE_SQL = f"(tool_name = 'Edit' OR (tool_name = 'Bash' AND {MUTATING_SQL}))"
CALLS_SQL = f"""calls AS (SELECT event_id AS call_id, session_id, split_part(cwd, '/', 3) AS repo, lower(coalesce(file_path, command)) AS hay FROM v_hook WHERE {PROACTIVE_SQL}),
  hays AS (SELECT DISTINCT repo, hay FROM calls)"""
HIT_SQL = "regexp_matches(hay, '(^|[^a-z0-9])' || regexp_escape(token) || '($|[^a-z0-9])')"
MATCH_SQL = f"""{DTOKENS_SQL}, {CALLS_SQL},
  matched AS (SELECT h.repo, h.hay, a.id, arg_min(trigger, (-length(token), tpos, token)) AS trigger, arg_min(token, (-length(token), tpos, token)) AS token, max(length(token)) AS match_len, any_value(seen) AS seen
    FROM hays h JOIN atokens a ON a.repo = h.repo AND contains(h.hay, a.token) AND {HIT_SQL} GROUP BY h.repo, h.hay, a.id)"""


def directives(v):
    return v.directives.select(
        "id", "type", "content", "repo", "seen", F.col("id").alias("pos"),
        F.filter(F.array("trigger_1", "trigger_2"), lambda x: x.isNotNull()).alias("triggers"),
        F.lit(None).cast("date").alias("as_of"), F.lit(None).cast("string").alias("source_session_id"),
    )


def _call_rows(events):
    return events.select(
        F.col("event_id").alias("call_id"), "session_id", F.element_at(F.split("cwd", "/"), 3).alias("repo"),
        D.haystack(F.coalesce("file_path", "command")).alias("hay"),
    )


def calls(v):
    return _call_rows(D.proactive_calls(v.hook))


@query("d01_trigger_tokens", f"WITH {TRIGGERS_SQL} SELECT id, trigger, unnest({_tokens_sql('t')}) AS token FROM triggers")
def _(v):
    rows = directives(v).select("id", F.explode("triggers").alias("trigger"))
    return rows.select("id", "trigger", F.explode(D.trigger_tokens(F.col("trigger"))).alias("token"))


@query(
    "d02_blocked_tokens",
    f"""WITH r AS (SELECT DISTINCT lower(concat('Repo-', p_brand)) AS n FROM part),
    t AS (SELECT n, unnest(list_distinct(list_filter(list_concat([{_GENERIC}], [n, 'alice-dev', 'alice'], regexp_split_to_array(n, '[^a-z0-9]+')), lambda x: length(x) >= 4))) AS token FROM r)
    SELECT n AS repo, token FROM t""",
)
def _(v):
    r = v.table("part").select(F.concat(F.lit("Repo-"), "p_brand").alias("n")).distinct()
    return r.select(F.lower("n").alias("repo"), F.explode(D.blocked_tokens(F.col("n"), F.lit("Alice-dev"))).alias("token"))


@query("d03_token_hit", f"SELECT event_id, {HIT_SQL} AS hit FROM (SELECT event_id, lower(coalesce(file_path, command)) AS hay, CASE event_id % 3 WHEN 0 THEN 'app/retry.py' WHEN 1 THEN 'part' ELSE 'commit' END AS token FROM v_hook) x")
def _(v):
    tok = F.expr("CASE event_id % 3 WHEN 0 THEN 'app/retry.py' WHEN 1 THEN 'part' ELSE 'commit' END")
    return v.hook.select("event_id", D.token_hit(tok, D.haystack(F.coalesce("file_path", "command"))).alias("hit"))


@query("d04_match_directives", f"WITH {MATCH_SQL} SELECT repo, hay, id, trigger, token, match_len FROM matched")
def _(v):
    return D.match_directives(calls(v), directives(v)).select("repo", "hay", "id", "trigger", "token", "match_len")


_RANK_SQL = """ranked AS (SELECT c.call_id, m.id, m.trigger, m.match_len, m.seen, row_number() OVER (PARTITION BY c.call_id ORDER BY m.match_len DESC, m.seen DESC, m.id) AS rank
  FROM calls c JOIN {0} m ON m.repo = c.repo AND m.hay = c.hay)"""


@query("d05_rank_directives", f"WITH {MATCH_SQL}, {_RANK_SQL.format('matched')} SELECT call_id, id, trigger, match_len, rank FROM ranked WHERE rank <= 2")
def _(v):
    return D.recall(calls(v), directives(v)).select("call_id", "id", "trigger", "match_len", "rank")


# what each session has been shown before: one directive per event and per 5 events another
_FIRED = "SELECT concat('u', user_id) AS session_id, event_id % 300 AS directive_id FROM {events}"
_FIRED_SQL = "fired AS (SELECT DISTINCT concat('u', user_id) AS session_id, event_id % 300 AS directive_id FROM events)"


@query(
    "d06_drop_fired",
    f"""WITH {MATCH_SQL}, {_FIRED_SQL}, left_over AS (SELECT c.call_id, m.id, m.trigger, m.match_len, m.seen FROM calls c JOIN matched m ON m.repo = c.repo AND m.hay = c.hay
      WHERE NOT EXISTS (SELECT 1 FROM fired f WHERE f.session_id = c.session_id AND f.directive_id = m.id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY match_len DESC, seen DESC, id) AS rank FROM left_over)
    SELECT call_id, id, match_len, rank FROM ranked WHERE rank <= 2""",
)
def _(v):
    return D.recall(calls(v), directives(v), v.sql(_FIRED)).select("call_id", "id", "match_len", "rank")


_ANSWERED = "event_id % 3 <> 1"


@query(
    "d07_first_touch",
    f"""WITH k AS (SELECT event_id, session_id, {HANDLE_SQL} AS handle_key, {_ANSWERED} AS answered FROM v_hook WHERE {PROACTIVE_SQL})
    SELECT event_id, session_id, handle_key FROM k a WHERE NOT EXISTS (SELECT 1 FROM k b WHERE b.session_id = a.session_id AND b.handle_key = a.handle_key AND b.answered AND b.event_id < a.event_id)""",
)
def _(v):
    key = I.handle_key(F.col("tool_name"), F.coalesce("file_path", "command"), F.col("cwd"))
    rows = D.proactive_calls(v.hook).select("event_id", "session_id", key.alias("handle_key"), F.expr(_ANSWERED).alias("answered"))
    return D.first_touch(rows).select("event_id", "session_id", "handle_key")


@query(
    "d08_self_echo",
    f"""WITH {MATCH_SQL}, left_over AS (SELECT c.call_id, m.id, m.match_len, m.seen FROM calls c JOIN matched m ON m.repo = c.repo AND m.hay = c.hay WHERE c.session_id <> concat('u', m.id % 40)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY match_len DESC, seen DESC, id) AS rank FROM left_over)
    SELECT call_id, id, match_len, rank FROM ranked WHERE rank <= 2""",
)
def _(v):
    d = directives(v).withColumn("source_session_id", F.concat(F.lit("u"), (F.col("id") % 40).cast("string")))
    return D.recall(calls(v), d).select("call_id", "id", "match_len", "rank")


_ROOTS = "SELECT concat('/w/repo', s_suppkey % 7) AS root, concat('repo', s_suppkey % 7) AS repo FROM {supplier} UNION SELECT concat('/w/repo', s_suppkey % 7, '/app/net'), concat('net', s_suppkey % 7) FROM {supplier}"


@query(
    "d09_scope_repo",
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 2 THEN concat('repo', user_id % 7)
    WHEN event_type IN ('click', 'view') AND event_id % 5 = 1 THEN concat('net', user_id % 7) ELSE concat('repo', user_id % 7) END AS repo FROM events""",
)
def _(v):
    # the file of another folder (case 2) never steers the scope; without a folder there is none
    e = v.hook.select(
        "event_id",
        F.when(F.col("event_id") % 4 != 3, F.col("cwd")).alias("cwd"),
        F.when(F.col("event_id") % 4 == 2, F.lit("/elsewhere/app/x.py")).otherwise(F.col("file_path")).alias("file_path"),
    )
    return P.scope_repo(e, v.sql(_ROOTS)).select("event_id", "repo")


@query("d10_reactive_calls", f"SELECT event_id, trim(response) AS error, lower(concat(coalesce(file_path, command), ' ', trim(response))) AS hay FROM v_hook WHERE {ERROR_SQL.format('response')}")
def _(v):
    r = D.reactive_calls(v.hook)
    return r.select("event_id", "error", D.haystack(F.coalesce("file_path", "command"), F.col("error")).alias("hay"))


@query("d11_proactive_calls", f"SELECT event_id, tool_name FROM v_hook WHERE {PROACTIVE_SQL}")
def _(v):
    return D.proactive_calls(v.hook).select("event_id", "tool_name")


@query(
    "d12_render_directives",
    f"""WITH {MATCH_SQL}, {_RANK_SQL.format('matched')}, lines AS (SELECT call_id, rank, concat('- **[', upper(type), ']** ', trim(content), '  _(fired on: ', trigger, CASE WHEN d.seen > 1 THEN concat('; seen ', d.seen, '×') ELSE '' END, ')_') AS line
      FROM ranked r JOIN v_directives d ON d.id = r.id WHERE rank <= 2)
    SELECT call_id, string_agg(line, chr(10) ORDER BY rank) AS context FROM lines GROUP BY call_id""",
)
def _(v):
    d = directives(v)
    top = D.recall(calls(v), d).select("call_id", "id", "rank", "trigger")
    return D.render_directives(top.join(d, "id"))


@query(
    "d13_prune_firings",
    """WITH k AS (SELECT *, max(ts_s) OVER (PARTITION BY session_id) AS last FROM v_hook)
    SELECT session_id, event_id FROM k WHERE last >= (SELECT max(ts_s) FROM v_hook) - 3600*6""",
)
def _(v):
    now = v.hook.agg(F.max("ts_s")).first()[0]
    return D.prune_firings(v.hook, now, max_age_s=3600 * 6).select("session_id", "event_id")


@query(
    "d14_merge_context",
    """SELECT event_id, concat(CASE WHEN event_id % 3 <> 0 THEN concat('a', event_id) ELSE '' END, CASE WHEN event_id % 3 <> 0 AND event_id % 2 = 0 THEN chr(10) || chr(10) ELSE '' END, CASE WHEN event_id % 2 = 0 THEN concat('b', event_id) ELSE '' END) AS context
    FROM events WHERE event_id % 3 <> 0 OR event_id % 2 = 0""",
)
def _(v):
    rows = v.sql(
        """SELECT event_id, 2 AS source, CASE WHEN event_id % 2 = 0 THEN concat('b', event_id) ELSE '  ' END AS context FROM {events}
        UNION ALL SELECT event_id, 1, CASE WHEN event_id % 3 <> 0 THEN concat('a', event_id) END FROM {events}"""
    )
    return D.merge_context(rows)


@query(
    "d15_parse_recall",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE 1 END AS items FROM events""",
)
def _(v):
    rows = v.sql(
        """SELECT event_id, event_id % 6 = 3 AS is_error, CASE event_id % 6 WHEN 0 THEN '{"items":[1,2]}' WHEN 1 THEN '{"result":{"items":[1]}}' WHEN 2 THEN '{"items":null}' WHEN 3 THEN '{"items":[1]}' END AS s,
        CASE event_id % 6 WHEN 4 THEN 'oops' WHEN 5 THEN '{"items":[7]}' END AS t FROM {events}"""
    )
    items = D.parse_recall(F.col("is_error"), F.parse_json("s"), F.array(F.lit("note"), F.col("t")))
    return rows.select("event_id", F.when(items.isNotNull(), F.size(items)).alias("items"))


@query(
    "r05_token_noise",
    f"""WITH {MATCH_SQL} SELECT token, count(*) AS injections FROM calls c JOIN matched m ON m.repo = c.repo AND m.hay = c.hay GROUP BY token ORDER BY injections DESC, token LIMIT 20""",
)
def _(v):
    c = calls(v)
    return D.token_noise(D.match_directives(c, directives(v)), c)


