"""Queries over the scalar classifiers and name rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.functions import commands as C
from agentlake.functions import globs as G
from agentlake.functions import ids as I
from agentlake.functions import text as T
from agentlake.functions import times as TM
from agentlake.functions import values as V
from agentlake.plans.registry import query

# Own statements of the rules for the command forms that the hook view holds.
STRICT_SQL = """regexp_matches({0}, '(^|[;&|(] *)(git( +-C +[^ ]+)* +commit|gh +pr +(create|merge))( |$)')"""
AGENT_SQL = """regexp_matches({0}, '(^|[;&|] *|sh -lc ")(sudo +)*(git( +-C +[^ ]+)* +commit|gh +pr +(create|merge|ready|edit|close|reopen|comment))\\b')"""
ERROR_SQL = """(contains({0}, 'Traceback (most recent call last)') OR contains({0}, 'error:') OR contains({0}, 'fatal:') OR regexp_matches({0}, '\\b(ERROR|[A-Z]?[A-Za-z]*Error)\\b|(FAILED|Exception)\\b'))"""
MUTATING_SQL = """regexp_matches(command, '(^|[;&|] *)(sudo +)*(git +(commit|push|rebase)|rm|npm +install|gh +pr +create)( |$)|[^0-9&]> *[^ &]')"""


@query("f06_strict_milestone", f"SELECT event_id, {STRICT_SQL.format('command')} AS hit FROM v_hook WHERE command IS NOT NULL")
def _(v):
    return v.hook.filter("command IS NOT NULL").select("event_id", C.is_milestone(F.col("command")).alias("hit"))


_WRAPPED = """CASE event_id % 3 WHEN 0 THEN command WHEN 1 THEN concat('bash -lc "', command, '"') ELSE concat('sudo ', command) END"""


@query("f07_agent_milestone", f"SELECT event_id, {AGENT_SQL.format(_WRAPPED)} AS hit FROM v_hook WHERE command IS NOT NULL")
def _(v):
    return v.hook.filter("command IS NOT NULL").select("event_id", C.is_milestone(F.expr(_WRAPPED), "agent").alias("hit"))


@query(
    "f08_command_text",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN command WHEN 1 THEN concat('run ', event_id, ' now') ELSE concat('{"n":', event_id, '}') END AS text FROM v_hook WHERE command IS NOT NULL""",
)
def _(v):
    k = F.col("event_id") % 3
    j = (
        F.when(k == 0, F.to_json(F.struct("command")))
        .when(k == 1, F.concat(F.lit('{"command":["run",'), F.col("event_id"), F.lit(',"now"]}')))
        .otherwise(F.concat(F.lit('{"n":'), F.col("event_id"), F.lit("}")))
    )
    return v.hook.filter("command IS NOT NULL").select("event_id", V.command_text(F.parse_json(j)).alias("text"))


@query("f09_mutating_command", f"SELECT event_id, {MUTATING_SQL} AS mutates FROM v_hook WHERE command IS NOT NULL")
def _(v):
    return v.hook.filter("command IS NOT NULL").select("event_id", C.is_mutating(F.col("command")).alias("mutates"))


@query("f10_error_tail", f"SELECT event_id, CASE WHEN {ERROR_SQL.format('response')} THEN trim(response) END AS tail, {ERROR_SQL.format('response')} AS gate FROM v_hook")
def _(v):
    j = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("response").alias("stdout")))).otherwise(F.to_json(F.struct(F.col("response").alias("r"))))
    v_ = F.parse_json(j)
    resp = V.response_text(F.when(F.col("event_id") % 2 == 0, v_).otherwise(V.path(v_, "$.r")))
    return v.hook.select("event_id", resp.alias("r")).select("event_id", C.error_tail(F.col("r")).alias("tail"), C.error_gate(F.col("r")).alias("gate"))


@query(
    "f11_pr_created",
    """SELECT event_id, regexp_extract(response, 'https?://[^/\\s"]+/[^/\\s"]+/[^/\\s"]+/pull/\\d+') AS url FROM v_hook
    WHERE regexp_matches(command, '^gh pr create') AND regexp_matches(response, 'https?://[^/\\s"]+/[^/\\s"]+/[^/\\s"]+/pull/\\d+')""",
)
def _(v):
    hit = v.hook.filter(C.creates_pr(F.col("command"))).select("event_id", C.pr_url(F.col("response")).alias("url"))
    return hit.filter("url IS NOT NULL")


@query(
    "f12_event_host",
    """SELECT event_id, event_id % 5 IN (0, 1, 2) AS is_cursor FROM events""",
)
def _(v):
    e, k = F.col("event_id"), F.col("event_id") % 5
    rows = v.table("events").select(
        e,
        F.when(k.isin(2, 3), "Stop").when(k == 4, "SessionStart").alias("event"),
        F.when(k == 0, "1.2").alias("version"),
        F.when(k == 1, F.concat(F.lit("C:\\u\\.cursor\\x"), e)).alias("transcript"),
        F.when(k.isin(2, 3, 4), F.concat(F.lit("c"), e)).alias("conversation"),
        F.when(k.isin(2, 4), "g").alias("generation"),
    )
    return rows.select(
        "event_id",
        I.is_cursor_event(F.col("event"), F.col("version"), F.col("transcript"), F.col("conversation"), F.col("generation"), F.lit(False)).alias("is_cursor"),
    )


@query("f13_boundary", "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'stop' END AS boundary FROM events")
def _(v):
    e = F.when(F.col("event_type") == "view", "Stop").when(F.col("event_type") == "click", "SessionEnd").otherwise("PreToolUse")
    return v.table("events").select("event_id", I.boundary(e).alias("boundary"))


_UUID = "concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS VARCHAR(12)), 12, '0'))"


@query(
    "f14_cursor_session_id",
    f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN concat('u', user_id) WHEN 3 THEN NULL ELSE {_UUID} END AS sid,
    event_id % 4 IN (1, 2) AS usable FROM events""",
)
def _(v):
    rows = v.sql(
        f"""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN concat(' u', user_id) END AS sid,
        CASE event_id % 4 WHEN 1 THEN concat('/t/', {_UUID}, '/x.jsonl') WHEN 2 THEN concat('/agent-transcripts/', {_UUID}, '.jsonl') WHEN 3 THEN '/agent-transcripts/none.jsonl' END AS path FROM {{events}}"""
    )
    sid = I.cursor_session_id(F.col("sid"), F.lit(None).cast("string"), F.col("path"))
    return rows.select("event_id", sid.alias("sid")).select("event_id", "sid", I.is_uuid(F.col("sid")).alias("usable"))


@query(
    "f15_codex_session_id",
    f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'refused' WHEN 3 THEN 'refused' WHEN 4 THEN 'refused' ELSE 'missing' END AS status,
    CASE WHEN event_id % 6 < 2 THEN {_UUID} END AS sid FROM events""",
)
def _(v):
    from agentlake.operators.health import codex_session_id

    catalog = v.sql(f"SELECT concat('/s/rollout-x-', {_UUID}, '.jsonl') AS path FROM {{events}} WHERE event_id % 6 < 3")
    rows = v.sql(
        f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN {_UUID} WHEN 1 THEN {_UUID} WHEN 2 THEN concat('u', user_id) WHEN 4 THEN 'latest' WHEN 5 THEN 'nobody' END AS session_id,
        CASE event_id % 6 WHEN 0 THEN concat('/s/rollout-x-', {_UUID}, '.jsonl') WHEN 2 THEN concat('/s/rollout-x-', {_UUID}, '.jsonl') WHEN 3 THEN '/etc/passwd' END AS transcript_path FROM {{events}}"""
    )
    return codex_session_id(rows, catalog).select("event_id", "status", "sid")


@query(
    "f16_safe_id",
    """SELECT doc_id, left(regexp_replace(text, '[^A-Za-z0-9._-]', '_', 'g'), 80) AS state, left(regexp_replace(text, '[^A-Za-z0-9._-]', '_', 'g'), 64) AS debounce,
    regexp_replace(text, '[^A-Za-z0-9_-]', '', 'g') AS fired FROM documents""",
)
def _(v):
    t = F.col("text")
    return v.table("documents").select("doc_id", *[I.safe_id(t, m).alias(m) for m in ("state", "debounce", "fired")])


@query("f17_handle", """SELECT event_id, coalesce(file_path, command) AS handle, CASE WHEN event_id % 2 = 0 THEN coalesce(file_path, command) ELSE repeat(response, 40) END AS args FROM v_hook""")
def _(v):
    handle = I.handle_of(F.col("file_path"), F.lit(None).cast("string"), F.col("command"))
    m = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("command"), handle, F.lit("content"), F.lit("long"))).otherwise(
        F.create_map(F.lit("body"), F.repeat("response", F.lit(40)))
    )
    return v.hook.select("event_id", handle.alias("handle"), F.get(F.map_values(I.handle_args(m)), F.lit(0)).alias("args"))


HANDLE_SQL = """concat(cwd, ':', tool_name, ':', left(trim(regexp_replace(coalesce(file_path, command), '\\s+', ' ', 'g')), 120), ':', left(sha256(trim(regexp_replace(coalesce(file_path, command), '\\s+', ' ', 'g'))), 16))"""


@query("f18_handle_key", f"SELECT event_id, {HANDLE_SQL} AS handle_key FROM v_hook")
def _(v):
    handle = I.handle_of(F.col("file_path"), F.lit(None).cast("string"), F.col("command"))
    return v.hook.select("event_id", I.handle_key(F.col("tool_name"), handle, F.col("cwd")).alias("handle_key"))


_REMOTE = """CASE o_orderkey % 6 WHEN 0 THEN concat('git@host:Org/r', o_custkey, '.git') WHEN 1 THEN concat('https://host/org/r', o_custkey, '.git/') WHEN 2 THEN concat('ssh://git@host:22/a/b/org/r', o_custkey)
 WHEN 3 THEN concat('host:r', o_custkey) WHEN 4 THEN '' ELSE concat('https://host/Org/r', o_custkey) END"""


@query(
    "f19_room_name",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN concat('Repo: Org/r', o_custkey) WHEN 1 THEN concat('Repo: org/r', o_custkey) WHEN 2 THEN concat('Repo: org/r', o_custkey)
    WHEN 3 THEN concat('Repo: r', o_custkey) WHEN 4 THEN NULL ELSE concat('Repo: Org/r', o_custkey) END AS room FROM orders""",
)
def _(v):
    return v.table("orders").select("o_orderkey", I.room_name(F.expr(_REMOTE)).alias("room"))


@query("f20_room_name_local", "SELECT o_orderkey, concat('Repo: r', o_custkey) AS room FROM orders")
def _(v):
    d = F.expr("CASE o_orderkey % 3 WHEN 0 THEN concat('/w/r', o_custkey, '/.git') WHEN 1 THEN concat('/srv/r', o_custkey, '.git') ELSE concat('/w/r', o_custkey, '/') END")
    return v.table("orders").select("o_orderkey", I.room_name_local(d).alias("room"))


@query("f21_namespace", "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 3 THEN concat('host:r', o_custkey) ELSE concat('r', o_custkey) END AS ns FROM orders")
def _(v):
    return v.table("orders").select("o_orderkey", I.namespace(F.expr(_REMOTE)).alias("ns"))


@query("f22_env_for_url", "SELECT page_id, CASE WHEN lower(concat(url, CASE WHEN page_id % 3 = 0 THEN '/Staging' ELSE '' END)) LIKE '%staging%' THEN 'staging' ELSE 'production' END AS env FROM pages")
def _(v):
    return v.table("pages").select("page_id", I.env_for_url(F.expr("concat(url, CASE WHEN page_id % 3 = 0 THEN '/Staging' ELSE '' END)")).alias("env"))


# fixed link globs and, for the twin, what they must match
GLOBS = (
    ("g1", "app/*.py", r"^app/[^/]*\.py$"),
    ("g2", "app/**/*.py", r"^app/(?:.*/)?[^/]*\.py$"),
    ("g3", "app/{net,serve}/*|docs/**", r"^(?:app/(?:net|serve)/[^/]*|docs/.*)$"),
    ("g4", "**/README.md", r"^(?:.*/)?README\.md$"),
    ("g5", "app/ma?n.py", r"^app/ma[^/]n\.py$"),
    ("g6", " | ", None),
)
_GLOBS_SQL = ", ".join(f"('{g}', {'NULL' if r is None else chr(39) + r + chr(39)})" for g, _, r in GLOBS)


def link_globs(spark):
    """The fixed link globs with their compiled patterns."""
    return spark.createDataFrame([(g, t) for g, t, _ in GLOBS], "glob_id string, glob string").withColumn("regex", G.compile_glob("glob"))


@query(
    "f23_path_glob",
    f"""WITH links AS (SELECT * FROM (VALUES {_GLOBS_SQL}) t(glob_id, re)), paths AS (SELECT DISTINCT regexp_replace(file_path, '^/w/[^/]+/', '') AS path FROM v_hook WHERE file_path IS NOT NULL)
    SELECT path, glob_id FROM paths JOIN links ON regexp_matches(path, re)""",
)
def _(v):
    paths = v.hook.filter("file_path IS NOT NULL").select(F.regexp_replace("file_path", "^/w/[^/]+/", "").alias("path")).distinct()
    # the links are a fixed handful: each becomes one element of an array, so a path is
    # tested in place and no pair of rows is formed
    links = F.array(*[F.struct(F.lit(g).alias("glob_id"), F.lit(G.glob_regex(t)).alias("regex")) for g, t, _ in GLOBS])
    hit = F.filter(links, lambda g: g["regex"].isNotNull() & F.coalesce(F.rlike(F.col("path"), g["regex"]), F.lit(False)))
    return paths.select("path", F.explode(hit).alias("g")).select("path", "g.glob_id")


@query("f24_edited_path", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN file_path WHEN event_id % 3 = 1 THEN concat(cwd, '/app/', event_id, '.ipynb') END AS path FROM v_hook WHERE file_path IS NOT NULL""")
def _(v):
    k = F.col("event_id") % 3
    fp = F.when(k == 0, F.col("file_path"))
    nb = F.when(k != 0, F.concat(F.lit("app/"), F.col("event_id"), F.lit(".ipynb")))
    return v.hook.filter("file_path IS NOT NULL").select("event_id", I.edited_path(fp, nb, F.when(k != 2, F.col("cwd"))).alias("path"))


_ISO = "strftime(make_timestamp(CAST((1600000000 + o_orderkey) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S')"


@query(
    "f25_parse_utc",
    """SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN 1600000000 + o_orderkey WHEN 1 THEN 1600000000 + o_orderkey - 5400 WHEN 2 THEN 1600000000 + o_orderkey + 3600
    WHEN 3 THEN 1600000000 + o_orderkey + 0.5 WHEN 4 THEN 1600000000 + o_orderkey ELSE NULL END AS DOUBLE) AS epoch FROM orders""",
)
def _(v):
    iso = F.regexp_replace(TM.iso_millis((F.lit(1_600_000_000) + F.col("o_orderkey")) * 1000), r"\.000Z$", "")
    k = F.col("o_orderkey") % 6
    raw = (
        F.when(k == 0, F.concat(iso, F.lit("Z")))
        .when(k == 1, F.concat(iso, F.lit("+01:30")))
        .when(k == 2, F.concat(iso, F.lit("-0100")))
        .when(k == 3, F.concat(iso, F.lit(".5Z")))
        .when(k == 4, iso)
        .otherwise(F.lit("soon"))
    )
    return v.table("orders").select("o_orderkey", TM.parse_utc(raw).alias("epoch"))


@query("f26_jwt_exp", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(1700000000 + o_orderkey AS DOUBLE) END AS exp FROM orders")
def _(v):
    body = F.concat(F.lit('{"sub":"?>'), F.col("o_orderkey"), F.lit('","exp":'), F.lit(1_700_000_000) + F.col("o_orderkey"), F.lit("}"))
    enc = F.regexp_replace(F.translate(F.regexp_replace(F.base64(F.encode(body, "UTF-8")), r"\s", ""), "+/", "-_"), "=+$", "")
    k = F.col("o_orderkey") % 3
    token = F.when(k == 0, F.concat(F.lit("h."), enc, F.lit(".s"))).when(k == 1, F.lit("opaque")).otherwise(F.lit("a.b!.c"))
    return v.table("orders").select("o_orderkey", TM.jwt_exp(token).alias("exp"))


AGO_SQL = "CASE WHEN greatest({0}, 0) < 90 THEN concat(greatest({0}, 0), 's ago') WHEN {0} < 5400 THEN concat({0} // 60, 'm ago') ELSE concat({0} // 3600, 'h ago') END"


@query("f27_ago", f"SELECT event_id, {AGO_SQL.format('(event_id*7 - 20)')} AS board, CASE WHEN greatest(event_id*7 - 20, 0) // 60 < 120 THEN concat(greatest(event_id*7 - 20, 0) // 60, 'm ago') ELSE concat((event_id*7 - 20) // 60 // 60, 'h ago') END AS health FROM events")
def _(v):
    s = F.col("event_id") * 7 - 20
    return v.table("events").select("event_id", TM.ago(s).alias("board"), TM.ago(s, "health").alias("health"))


@query(
    "f28_working_on",
    """WITH p AS (SELECT conv_id, turn, trim(regexp_replace(CASE turn % 4 WHEN 3 THEN concat('/', text) ELSE text END, '\\s+', ' ', 'g')) AS p FROM conversations)
    SELECT conv_id, turn, CASE WHEN length(p) >= 20 AND p NOT LIKE '/%' AND p NOT LIKE '!%' THEN concat(left(p, 120), CASE WHEN length(p) > 120 THEN '…' ELSE '' END) END AS working_on FROM p""",
)
def _(v):
    p = F.expr("CASE turn % 4 WHEN 3 THEN concat('/', text) ELSE text END")
    return v.table("conversations").select("conv_id", "turn", T.working_on(p).alias("working_on"))


@query("f29_clip", """SELECT doc_id, CASE WHEN length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <= 1800 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') ELSE concat(regexp_replace(left(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 1800), '\\s+$', ''), '… (cut)') END AS clipped FROM documents""")
def _(v):
    return v.table("documents").select("doc_id", T.clip(F.col("text"), 1800, "… (cut)").alias("clipped"))


@query(
    "f30_overview_text",
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN text WHEN 3 THEN '' ELSE text END AS overview FROM documents""",
)
def _(v):
    k = F.col("doc_id") % 5
    structured = F.when(k == 0, F.parse_json(F.to_json(F.struct(F.col("text").alias("overview")))))
    first = (
        F.when(k == 1, F.to_json(F.struct(F.col("text").alias("overview"))))
        .when(k == 2, F.to_json(F.struct("text")))
        .when(k == 3, F.lit('{"overview":null}'))
        .otherwise(F.col("text"))
    )
    return v.table("documents").select("doc_id", V.overview_text(structured, F.array(F.lit(None).cast("string"), first)).alias("overview"))


@query("f31_missing_brain", "SELECT event_id, event_type = 'error' AS missing FROM events")
def _(v):
    texts = F.array(F.lit("ok"), F.when(F.col("event_type") == "error", F.concat(F.lit("Agent BRAIN not found: "), F.col("event_id"))))
    return v.table("events").select("event_id", T.is_missing_brain(texts).alias("missing"))


@query("f32_cwd_ok", "SELECT event_id, event_id % 4 < 2 AS ok FROM events")
def _(v):
    c = F.expr("CASE event_id % 4 WHEN 0 THEN concat('/w/', user_id) WHEN 1 THEN 'C:\\\\w' WHEN 2 THEN '-upload' END")
    return v.table("events").select("event_id", I.cwd_ok(c).alias("ok"))


@query(
    "f33_artifact_type",
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'spec' WHEN 1 THEN 'adr' WHEN 2 THEN 'runbook' WHEN 3 THEN 'design_doc' ELSE 'document' END AS type,
    concat(CASE doc_id % 5 WHEN 0 THEN 'Search Spec ' WHEN 1 THEN 'Adr ' WHEN 2 THEN 'Db Runbook ' WHEN 3 THEN 'Design Doc ' ELSE 'Note ' END, doc_id) AS name FROM documents""",
)
def _(v):
    p = F.expr("concat('docs/', CASE doc_id % 5 WHEN 0 THEN 'search-spec-' WHEN 1 THEN 'adr-' WHEN 2 THEN 'db_runbook_' WHEN 3 THEN 'design-doc-' ELSE 'note-' END, doc_id, '.md')")
    return v.table("documents").select("doc_id", T.artifact_type(p).alias("type"), T.artifact_name(p).alias("name"))


@query(
    "f34_spec_tags",
    """SELECT p_partkey, concat('spec:', regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug_tag, concat('docs/specs/', p_partkey, '.md') AS path FROM part""",
)
def _(v):
    tags = T.spec_tags(F.col("p_name"), F.concat(F.lit("docs/specs/"), F.col("p_partkey"), F.lit(".md")))
    return v.table("part").select("p_partkey", F.get(tags, F.lit(1)).alias("slug_tag"), T.tag_value(tags, "path").alias("path"))
