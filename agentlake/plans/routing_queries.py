"""Queries over rooms, listings and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.operators import cursor as CU
from agentlake.operators import routing as RT
from agentlake.plans.registry import query

NOW = 1_704_800_000

# one room entry per supplier
_ROOMS = """SELECT concat('Repo: o/r', s_suppkey) AS room_name, CASE WHEN s_suppkey % 2 = 0 THEN 'staging' ELSE 'production' END AS env,
  CASE WHEN s_suppkey % 5 <> 4 THEN concat('b', s_suppkey) END AS brain_id, CASE WHEN s_suppkey % 3 = 0 THEN concat('org', s_nationkey) END AS org_id,
  CAST(1704700000 + s_suppkey * 1000 AS DOUBLE) AS resolved_at, CASE WHEN s_suppkey % 5 = 4 THEN CAST(1704700000 + s_suppkey * 900 AS DOUBLE) END AS missed_at,
  CASE WHEN s_suppkey % 7 = 0 THEN CAST(1704799000 + s_suppkey * 10 AS DOUBLE) END AS probed_at FROM {supplier}"""
_ROOMS_SQL = "rooms AS (" + _ROOMS.replace("{", "").replace("}", "") + ")"
# rooms touched in a later pass: some known, some new, one row each
_CHANGES = """SELECT concat('Repo: o/r', c_custkey * 3) AS room_name, CASE WHEN c_custkey * 3 % 2 = 0 THEN 'staging' ELSE 'production' END AS env, concat('n', c_custkey) AS brain_id,
  'org1' AS org_id, CAST(1704790000 AS DOUBLE) AS resolved_at, CAST(NULL AS DOUBLE) AS missed_at, CAST(NULL AS DOUBLE) AS probed_at, CAST(1704795000 AS DOUBLE) AS at FROM {customer}"""
_CHANGES_SQL = "changes AS (" + _CHANGES.replace("{", "").replace("}", "") + ")"


def rooms(v):
    return v.sql(_ROOMS)


def changes(v):
    return v.sql(_CHANGES)


@query(
    "j01_route_sessions",
    f"""WITH {_ROOMS_SQL} SELECT event_id, brain_id, org_id, CASE WHEN brain_id IS NULL THEN 'personal' ELSE 'room' END AS target FROM events
    LEFT JOIN (SELECT * FROM rooms WHERE brain_id IS NOT NULL) r ON r.room_name = concat('Repo: o/r', user_id) AND r.env = CASE WHEN event_id % 2 = 0 THEN 'staging' ELSE 'production' END""",
)
def _(v):
    s = v.sql("SELECT event_id, concat('Repo: o/r', user_id) AS room_name, CASE WHEN event_id % 2 = 0 THEN 'staging' ELSE 'production' END AS env FROM {events}")
    return RT.route(s, rooms(v)).select("event_id", "brain_id", "org_id", "target")


@query(
    "j02_route_artifacts",
    f"""WITH {_ROOMS_SQL}, known AS (SELECT * FROM rooms WHERE brain_id IS NOT NULL AND env = 'staging')
    SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'given' WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN f.brain_id ELSE c.brain_id END AS brain_id FROM documents
    LEFT JOIN known f ON doc_id % 2 = 0 AND f.room_name = concat('Repo: o/r', doc_id % 30) LEFT JOIN known c ON c.room_name = concat('Repo: o/r', doc_id % 20)""",
)
def _(v):
    a = v.sql(
        """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'given' END AS explicit_id, CASE WHEN doc_id % 2 = 0 THEN concat('Repo: o/r', doc_id % 30) END AS file_room,
        concat('Repo: o/r', doc_id % 20) AS caller_room, 'staging' AS env, doc_id % 7 = 0 AS opt_out FROM {documents}"""
    )
    return RT.route_artifacts(a, rooms(v)).select("doc_id", "brain_id")


_GUARDED = """SELECT *, CASE WHEN echo IS NULL OR echo = org_name THEN ok ELSE false END AS good, CASE WHEN echo IS NOT NULL THEN org_id END AS attributed
  FROM (SELECT *, CASE WHEN org_id % 11 = 5 THEN 'elsewhere' ELSE applied_org_name END AS echo FROM v_listings) x"""


def _listings(v, answered: bool = False):
    """Listing rows with their rank; with ``answered`` every listing answered and echoes its
    own organisation, otherwise some failed or echo another one."""
    rank = F.when(F.col("is_default"), 0).otherwise(1) * 1000 + F.col("org_id")
    rows = v.listings.withColumn("rank", rank)
    if answered:
        return rows.withColumn("ok", F.lit(True))
    echo = F.when(F.col("org_id") % 11 == 5, "elsewhere").otherwise(F.col("applied_org_name"))
    return rows.withColumn("applied_org_name", echo)


def _resolve_sql(guarded: str) -> str:
    return f"""WITH g AS ({guarded}),
    h AS (SELECT brain_name, min(brain_id) AS lo, max(brain_id) AS hi, arg_min(attributed, CASE WHEN is_default THEN 0 ELSE 1000 END + org_id) FILTER (WHERE attributed IS NOT NULL) AS org FROM g WHERE good GROUP BY brain_name),
    a AS (SELECT bool_and(good) AS listings_ok FROM g), d AS (SELECT c_custkey, lo, org,
      CASE WHEN lo = hi AND listings_ok THEN 'commit' WHEN NOT listings_ok THEN 'backoff' WHEN lo IS NOT NULL THEN 'refuse' ELSE 'miss' END AS decision
      FROM customer LEFT JOIN h ON h.brain_name = concat('Repo: o/r', c_custkey % 80), a)
    SELECT c_custkey, decision, CASE WHEN decision = 'commit' THEN lo END AS brain_id, CASE WHEN decision = 'commit' THEN org END AS org_id FROM d"""


def _repos(v):
    return v.sql("SELECT c_custkey, concat('Repo: o/r', c_custkey % 80) AS room_name FROM {customer}")


@query("j03_resolve_brains", _resolve_sql("SELECT *, true AS good, CASE WHEN applied_org_name IS NOT NULL THEN org_id END AS attributed FROM v_listings"))
def _(v):
    return RT.resolve_brains(_repos(v), _listings(v, answered=True)).select("c_custkey", "decision", "brain_id", "org_id")


@query("j03_resolve_brains_partial", _resolve_sql(_GUARDED))
def _(v):
    return RT.resolve_brains(_repos(v), _listings(v)).select("c_custkey", "decision", "brain_id", "org_id")


@query(
    "j03_resolve_brains_by_account",
    f"""WITH g AS (SELECT *, org_id % 3 AS account FROM ({_GUARDED}) x),
    h AS (SELECT account, brain_name, min(brain_id) AS lo, max(brain_id) AS hi, arg_min(attributed, CASE WHEN is_default THEN 0 ELSE 1000 END + org_id) FILTER (WHERE attributed IS NOT NULL) AS org FROM g WHERE good GROUP BY 1, 2),
    a AS (SELECT account, bool_and(good) AS listings_ok FROM g GROUP BY 1), d AS (SELECT c_custkey, lo, org,
      CASE WHEN lo = hi AND coalesce(listings_ok, true) THEN 'commit' WHEN NOT coalesce(listings_ok, true) THEN 'backoff' WHEN lo IS NOT NULL THEN 'refuse' ELSE 'miss' END AS decision
      FROM customer LEFT JOIN h ON h.brain_name = concat('Repo: o/r', c_custkey % 80) AND h.account = c_custkey % 4 LEFT JOIN a ON a.account = c_custkey % 4)
    SELECT c_custkey, decision, CASE WHEN decision = 'commit' THEN lo END AS brain_id, CASE WHEN decision = 'commit' THEN org END AS org_id FROM d""",
)
def _(v):
    repos = _repos(v).withColumn("account", F.col("c_custkey") % 4)
    out = RT.resolve_brains(repos, _listings(v).withColumn("account", F.col("org_id") % 3))
    return out.select("c_custkey", "decision", "brain_id", "org_id")


@query("j04_scope_guard", f"SELECT org_id, brain_id, brain_name, good AS ok, attributed AS attributed_org, count(*) AS n FROM ({_GUARDED}) GROUP BY ALL")
def _(v):
    return RT.scope_guard(_listings(v)).groupBy("org_id", "brain_id", "brain_name", "ok", "attributed_org").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j05_order_orgs",
    """SELECT c_nationkey AS account, c_custkey AS pos, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_custkey % 50 = 7 THEN 0 ELSE 1 END, c_custkey) AS rank FROM customer WHERE c_custkey % 6 <> 0""",
)
def _(v):
    o = v.sql("SELECT c_nationkey AS account, c_custkey AS pos, CASE WHEN c_custkey % 6 <> 0 THEN concat('org', c_custkey) ELSE '' END AS org_id, c_custkey % 50 = 7 AS is_default FROM {customer}")
    return RT.order_orgs(o).select("account", "pos", "rank")


@query(
    "j06_resolve_due",
    f"""WITH {_ROOMS_SQL} SELECT room_name, env, CASE WHEN {NOW} - coalesce(probed_at, 0) < 300 THEN false WHEN brain_id IS NOT NULL AND org_id IS NOT NULL THEN false
    WHEN brain_id IS NOT NULL THEN {NOW} - resolved_at > 86400 ELSE {NOW} - coalesce(missed_at, 0) > 86400 END AS due FROM rooms""",
)
def _(v):
    return rooms(v).select("room_name", "env", RT.resolve_due(NOW).alias("due"))


@query(
    "j07_upsert_rooms",
    f"""WITH {_ROOMS_SQL}, {_CHANGES_SQL} SELECT coalesce(c.room_name, r.room_name) AS room_name, coalesce(c.env, r.env) AS env,
    CASE WHEN c.room_name IS NULL THEN r.brain_id ELSE c.brain_id END AS brain_id, CASE WHEN c.room_name IS NULL THEN r.resolved_at ELSE c.resolved_at END AS resolved_at
    FROM rooms r FULL JOIN changes c ON c.room_name = r.room_name AND c.env = r.env""",
)
def _(v):
    return RT.upsert_rooms(rooms(v), changes(v)).select("room_name", "env", "brain_id", "resolved_at")


@query(
    "j08_apply_misses",
    f"""WITH {_ROOMS_SQL}, {_CHANGES_SQL} SELECT coalesce(c.room_name, r.room_name) AS room_name, coalesce(c.env, r.env) AS env, r.brain_id,
    CASE WHEN c.room_name IS NULL OR r.brain_id IS NOT NULL THEN r.resolved_at END AS resolved_at,
    CASE WHEN c.room_name IS NULL OR r.brain_id IS NOT NULL THEN r.missed_at ELSE c.at END AS missed_at
    FROM rooms r FULL JOIN changes c ON c.room_name = r.room_name AND c.env = r.env""",
)
def _(v):
    return RT.apply_misses(rooms(v), changes(v)).select("room_name", "env", "brain_id", "resolved_at", "missed_at")


@query(
    "j08_apply_probes",
    f"""WITH {_ROOMS_SQL}, {_CHANGES_SQL} SELECT coalesce(c.room_name, r.room_name) AS room_name, coalesce(c.env, r.env) AS env, r.brain_id, r.missed_at, coalesce(c.at, r.probed_at) AS probed_at
    FROM rooms r FULL JOIN changes c ON c.room_name = r.room_name AND c.env = r.env""",
)
def _(v):
    return RT.apply_probes(rooms(v), changes(v)).select("room_name", "env", "brain_id", "missed_at", "probed_at")


@query(
    "j09_forget_rooms",
    f"WITH {_ROOMS_SQL}, {_CHANGES_SQL} SELECT room_name, env, brain_id FROM rooms r WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.room_name = r.room_name AND c.env = r.env)",
)
def _(v):
    return RT.forget_rooms(rooms(v), changes(v)).select("room_name", "env", "brain_id")


@query(
    "j10_reroute",
    """SELECT 'resend' AS kind, CAST(event_id AS VARCHAR) AS what FROM events WHERE event_type = 'error' AND event_id % 2 = 0 AND user_id % 5 <> 0
    UNION ALL SELECT DISTINCT 'forget', concat('Repo: o/r', user_id) FROM events WHERE event_type = 'error' AND event_id % 2 = 0 AND user_id % 5 <> 0 AND event_id % 3 <> 0""",
)
def _(v):
    imports = v.sql(
        """SELECT event_id AS import_id, concat('Repo: o/r', user_id) AS room_name, 'staging' AS env, CASE WHEN user_id % 5 <> 0 THEN concat('b', user_id) END AS brain_id,
        'o' AS org_id, CASE WHEN event_id % 3 <> 0 THEN '/w' END AS cwd FROM {events}"""
    )
    replies = v.sql("SELECT event_id AS import_id, event_type = 'error' AS is_error, event_id % 2 = 0 AS missing_brain FROM {events}")
    resend, forget = RT.reroute(imports, replies)
    return resend.select(F.lit("resend").alias("kind"), F.col("import_id").cast("string").alias("what")).unionByName(
        forget.select(F.lit("forget").alias("kind"), F.col("room_name").alias("what"))
    )


@query(
    "j11_match_brain",
    """WITH n AS (SELECT DISTINCT concat(CASE WHEN c_custkey % 2 = 0 THEN 'Repo: o/r' ELSE 'Repo: p/R' END, c_custkey % 80) AS name FROM customer),
    h AS (SELECT name, min(brain_id) AS lo, max(brain_id) AS hi FROM n JOIN v_listings ON brain_name = name GROUP BY name),
    k AS (SELECT DISTINCT brain_name, lower(split_part(brain_name, '/', -1)) AS base FROM v_listings),
    r AS (SELECT *, count(*) OVER (PARTITION BY base) AS candidates FROM k)
    SELECT name, CASE WHEN lo = hi THEN 'exact' ELSE 'ambiguous' END AS state, CASE WHEN lo = hi THEN lo END AS brain_id, NULL AS candidate, 0 AS candidates FROM h
    UNION ALL SELECT name, CASE WHEN brain_name IS NULL THEN 'none' ELSE 'near' END, NULL, brain_name, coalesce(candidates, 0) FROM n LEFT JOIN r ON r.base = lower(split_part(name, '/', -1))
      WHERE name NOT IN (SELECT name FROM h)""",
)
def _(v):
    names = v.sql("SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN 'Repo: o/r' ELSE 'Repo: p/R' END, c_custkey % 80) AS name FROM {customer}")
    return RT.match_brain(names, v.listings)


_BLOBS = "SELECT concat('s', l_orderkey) AS session_id, concat('b', l_partkey, '-', l_linenumber, '-', l_suppkey) AS id, min(l_linenumber) AS line FROM {lineitem} GROUP BY ALL"
_BLOBS_SQL = "blobs AS (" + _BLOBS.replace("{", "").replace("}", "") + ")"


@query("j12_new_blobs", f"WITH {_BLOBS_SQL} SELECT session_id, count(*) AS blobs, count(*) FILTER (WHERE NOT line % 3 = 1) AS new_blobs FROM blobs GROUP BY session_id")
def _(v):
    b = v.sql(_BLOBS)
    return CU.new_blobs(b, b.filter("line % 3 = 1"))


@query(
    "j13_advance_blobs",
    f"""WITH {_BLOBS_SQL} SELECT session_id, id FROM blobs JOIN orders ON session_id = concat('s', o_orderkey)
    WHERE o_orderkey % 4 <> 0 AND (o_orderkey % 3 = 0 OR line % 5 <> 2)""",
)
def _(v):
    b = v.sql(_BLOBS)
    sends = v.sql("SELECT concat('s', o_orderkey) AS session_id, o_orderkey % 4 <> 0 AS ok, o_orderkey % 3 <> 0 AS post_read FROM {orders}")
    return CU.advance_blobs(b.select("session_id", "id"), b.filter("line % 5 <> 2").select("session_id", "id"), sends)
