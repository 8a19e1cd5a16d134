"""Queries over the board of parallel agents, memory search and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.operators import fleet as L
from agentlake.operators import memory as M
from agentlake.plans.function_queries import AGO_SQL
from agentlake.plans.registry import query
from agentlake.plans.views import Views

_REPO = "concat('repo', CAST(substr(session_id, 2) AS BIGINT) % 7)"
_BE = f"""SELECT *, {_REPO} AS repo, CASE event_id % 4 WHEN 0 THEN 'git commit -m x' WHEN 1 THEN 'git -C . commit' WHEN 2 THEN 'GIT_EDITOR=true git commit --amend' ELSE 'echo git commit' END AS command FROM {{v}}"""


def board_events(v: Views):
    return v.sql(_BE, v=v.board_events)


def commits(v: Views):
    """One commit per event; some belong to another repo, some are old."""
    return v.sql(
        f"""SELECT commit_hash, CASE WHEN event_id % 11 = 5 THEN 'elsewhere' ELSE {_REPO} END AS repo, concat('fix ', file) AS message,
        array(file, concat('lib/', event_id % 3, '.py')) AS files, ts_s - event_id % 150 AS at FROM {{v}}""",
        v=v.board_events,
    )


def board(v: Views):
    e = board_events(v)
    return L.fold_board(e, L.commit_updates(e, commits(v)))


_UPDATES_SQL = f"""be AS ({_BE.replace('{v}', 'v_board_events')}),
upd AS (SELECT *, ts_s - event_id % 150 AS commit_at FROM be WHERE event = 'post-tool' AND event_id % 4 < 3 AND event_id % 11 <> 5 AND event_id % 150 <= 120)"""
BOARD_SQL = f"""{_UPDATES_SQL},
ev AS (SELECT event_id, ts_s, session_id, repo, event, branch, worktree, CASE WHEN event = 'prompt' THEN prompt END AS wo, NULL AS commit_hash, NULL AS file, NULL AS commit_at, NULL AS m3 FROM be WHERE event <> 'post-tool'
  UNION ALL SELECT event_id, ts_s, session_id, repo, event, branch, worktree, NULL, commit_hash, file, commit_at, event_id % 3 FROM upd),
reg AS (SELECT session_id, min(event_id) AS first FROM ev WHERE event IN ('session-start', 'prompt') GROUP BY 1),
board AS (SELECT e.session_id, any_value(repo) AS repo, min(ts_s) AS started, max(ts_s) AS last_update,
  CASE WHEN arg_max(event, event_id) FILTER (WHERE event <> 'post-tool') = 'session-end' THEN 'ended' ELSE 'active' END AS status,
  any_value(branch) AS branch, any_value(worktree) AS worktree, arg_max(wo, event_id) FILTER (WHERE wo IS NOT NULL) AS working_on,
  arg_max(commit_hash, event_id) FILTER (WHERE commit_hash IS NOT NULL) AS hash, arg_max(concat('fix ', file), event_id) FILTER (WHERE commit_hash IS NOT NULL) AS message,
  arg_max(concat(file, ', lib/', m3, '.py'), event_id) FILTER (WHERE commit_hash IS NOT NULL) AS files, arg_max(commit_at, event_id) FILTER (WHERE commit_hash IS NOT NULL) AS commit_at
  FROM ev e JOIN reg USING (session_id) WHERE event_id >= first GROUP BY e.session_id),
clock AS (SELECT max(ts_s) + 600 AS now_ FROM v_board_events)"""


def _now(v: Views) -> int:
    return v.board_events.agg(F.max("ts_s")).first()[0] + 600


def _flat(b):
    return b.select(
        "session_id", "repo", "started", "last_update", "status", "branch", "worktree", "working_on",
        F.col("last_commit.hash").alias("hash"), F.col("last_commit.message").alias("message"),
        F.array_join("last_commit.files", ", ").alias("files"), F.col("last_commit.at").alias("commit_at"),
    )


@query("l01_fold_board", f"WITH {BOARD_SQL} SELECT * FROM board")
def _(v):
    return _flat(board(v))


_KEPT_SQL = "kept AS (SELECT board.* FROM board, clock WHERE NOT (status = 'ended' AND now_ - last_update > 3600) AND NOT (status = 'active' AND now_ - last_update > 43200) AND CAST(substr(session_id, 2) AS BIGINT) % 10 <> 3)"


@query("l02_prune_board", f"WITH {BOARD_SQL}, {_KEPT_SQL} SELECT session_id, status, last_update FROM kept")
def _(v):
    trees = v.sql("SELECT DISTINCT concat('/w/t', user_id) AS worktree FROM {events} WHERE user_id % 10 <> 3")
    return L.prune_board(board(v), trees, _now(v)).select("session_id", "status", "last_update")


# in each repo the agent that acted last is the one asking for the board
_ASK_SQL = "ask AS (SELECT arg_max(session_id, (last_update, session_id)) AS session_id, repo FROM board GROUP BY repo), sib AS (SELECT ask.session_id AS asker, b.* FROM ask JOIN board b ON b.repo = ask.repo AND b.session_id <> ask.session_id)"


def asking(b):
    return b.groupBy("repo").agg(F.max_by("session_id", F.struct("last_update", "session_id")).alias("session_id"))


@query("l03_siblings", f"WITH {BOARD_SQL}, {_ASK_SQL} SELECT asker AS session_id, session_id AS sibling, status FROM sib")
def _(v):
    b = board(v)
    return L.siblings(b, asking(b)).select("session_id", "sibling", "status")


@query("l04_commit_updates", f"WITH {_UPDATES_SQL} SELECT event_id, session_id, commit_hash, concat(file, ', lib/', event_id % 3, '.py') AS files FROM upd")
def _(v):
    out = L.commit_updates(board_events(v), commits(v))
    return out.select("event_id", "session_id", "commit_hash", F.array_join("files", ", ").alias("files"))


@query("l05_snapshot_seen", f"WITH {BOARD_SQL}, {_ASK_SQL} SELECT asker AS session_id, session_id AS sibling, last_update AS lu, status AS st, working_on AS wo, hash AS ch FROM sib")
def _(v):
    b = board(v)
    return L.snapshot_seen(b, asking(b))


_SEEN_SQL = """seen AS (SELECT asker, session_id, CASE WHEN n % 5 = 1 THEN CASE WHEN status = 'active' THEN 'ended' ELSE 'active' END ELSE status END AS st, CASE WHEN n % 5 = 2 THEN 'older work' ELSE working_on END AS wo,
  CASE WHEN n % 5 = 3 THEN 'older' ELSE hash END AS ch FROM (SELECT *, CAST(substr(session_id, 2) AS BIGINT) AS n FROM sib) s WHERE n % 5 <> 0)"""


@query(
    "l06_board_delta",
    f"""WITH {BOARD_SQL}, {_ASK_SQL}, {_SEEN_SQL}, d AS (SELECT b.*, s.asker AS known, st, wo, ch FROM sib b LEFT JOIN seen s ON s.asker = b.asker AND s.session_id = b.session_id),
    c AS (SELECT *, CASE WHEN known IS NULL AND status = 'active' THEN 'joined' WHEN known IS NULL THEN 'already ended' WHEN status = 'ended' AND st = 'active' THEN 'ended' WHEN status = 'active' AND st = 'ended' THEN 'rejoined'
      WHEN hash IS NOT NULL AND hash IS DISTINCT FROM ch THEN 'committed' WHEN working_on IS NOT NULL AND working_on IS DISTINCT FROM wo THEN 'refocused' END AS change,
      CASE WHEN working_on IS NOT NULL THEN concat(' — working on: ', working_on) ELSE '' END AS doing, CASE WHEN message IS NOT NULL THEN concat(' — last commit: "', message, '"') ELSE '' END AS said FROM d)
    SELECT asker AS session_id, session_id AS sibling, change, concat('- `', branch, '` ', CASE change WHEN 'joined' THEN concat('joined the fleet', doing, said)
      WHEN 'already ended' THEN concat('ended its session ', {AGO_SQL.format('(now_ - last_update)')}, said) WHEN 'ended' THEN 'ended its session'
      WHEN 'rejoined' THEN concat('rejoined the fleet', doing, CASE WHEN hash IS DISTINCT FROM ch THEN said ELSE '' END)
      WHEN 'committed' THEN concat('committed "', message, '" touching ', files) ELSE concat('is now working on: ', working_on) END) AS line FROM c, clock WHERE change IS NOT NULL""",
)
def _(v):
    b = board(v)
    ask = asking(b)
    n = F.substring("sibling", 2, 20).cast("long")
    other = F.when(F.col("st") == "active", "ended").otherwise("active")
    seen = L.snapshot_seen(b, ask).filter(n % 5 != 0).select(
        "session_id", "sibling", F.when(n % 5 == 1, other).otherwise(F.col("st")).alias("st"),
        F.when(n % 5 == 2, "older work").otherwise(F.col("wo")).alias("wo"), F.when(n % 5 == 3, "older").otherwise(F.col("ch")).alias("ch"),
    )
    return L.board_delta(b, ask, seen, _now(v))


@query(
    "l07_render_board",
    f"""WITH {BOARD_SQL} SELECT session_id, concat('- `', branch, '` ', CASE WHEN status = 'ended' THEN concat('(ended ', {AGO_SQL.format('(now_ - last_update)')}, ')') ELSE concat('(active, last update ', {AGO_SQL.format('(now_ - last_update)')}, ')') END,
      CASE WHEN working_on IS NOT NULL THEN concat(' — working on: ', working_on) ELSE '' END, CASE WHEN hash IS NOT NULL THEN concat(' — last commit ', {AGO_SQL.format('(now_ - commit_at)')}, ': "', message, '" [', files, ']') ELSE '' END,
      ' — worktree ', worktree, ' — session ', left(session_id, 8)) AS line FROM board, clock""",
)
def _(v):
    return board(v).select("session_id", L.render_line(_now(v)).alias("line"))


@query("l08_fleet_status", f"WITH {BOARD_SQL} SELECT session_id, status, last_update, status = 'active' AND now_ - last_update > 3600 AS stale, {AGO_SQL.format('(now_ - last_update)')} AS seen_ago FROM board, clock")
def _(v):
    return L.fleet_status(board(v), _now(v)).select("session_id", "status", "last_update", "stale", "seen_ago")


@query(
    "l09_collisions",
    f"""WITH {BOARD_SQL}, f AS (SELECT repo, session_id, unnest(string_split(files, ', ')) AS file FROM board WHERE files IS NOT NULL)
    SELECT repo, session_id, file, agents FROM f JOIN (SELECT repo, file, count(*) AS agents FROM f GROUP BY 1, 2 HAVING count(*) > 1) g USING (repo, file)""",
)
def _(v):
    return L.collisions(board(v))


@query(
    "l10_fleet_summary",
    f"""WITH {BOARD_SQL} SELECT repo, count(*) FILTER (WHERE status = 'active') AS active, count(DISTINCT worktree) FILTER (WHERE status = 'active') AS worktrees, max(commit_at) AS newest_commit_at,
    arg_max(branch, (commit_at, session_id)) FILTER (WHERE commit_at IS NOT NULL) AS newest_commit_branch FROM board GROUP BY repo""",
)
def _(v):
    return L.fleet_summary(board(v))


# ---------------------------------------------------------------- memory and reviews

_ITEMS_SQL = """items AS (SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN 'fact' WHEN 1 THEN 'episode' WHEN 2 THEN 'artifact' ELSE 'document' END AS type, source AS brain_id, 1704067200 + doc_id*600 AS created_s,
  [lang, concat('s', doc_id % 5)] AS tags, embedding FROM documents JOIN embeddings ON doc_id = vec_id)"""


def _cos_sql(n: int) -> str:
    """Cosine with the embedding of one vector, in double precision, from element pairs."""
    return f"""s{n} AS (SELECT i.id, sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) AS score FROM (SELECT id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS k FROM items) i
  JOIN (SELECT unnest(embedding)::DOUBLE AS y, generate_subscripts(embedding, 1) AS k FROM embeddings WHERE vec_id = {n}) q USING (k) GROUP BY i.id)"""


def items(v: Views):
    docs = v.table("documents").select("doc_id", "source", "lang")
    k = F.col("doc_id") % 4
    return docs.join(v.table("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id").select(
        F.col("doc_id").alias("id"), F.when(k == 0, "fact").when(k == 1, "episode").when(k == 2, "artifact").otherwise("document").alias("type"),
        F.col("source").alias("brain_id"), (F.lit(1_704_067_200) + F.col("doc_id") * 600).alias("created_s"),
        F.array("lang", F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string"))).alias("tags"), "embedding",
    )


def query_vector(v: Views, n: int):
    """The one vector a caller searches for, as a literal."""
    row = v.table("embeddings").filter(F.col("vec_id") == n).select("embedding").first()
    return F.array(*[F.lit(float(x)) for x in row[0]])


@query("m01_search", f"WITH {_ITEMS_SQL}, {_cos_sql(0)} SELECT id, type, round(score, 6) AS score FROM items JOIN s0 USING (id) ORDER BY round(score, 6) DESC, id LIMIT 8")
def _(v):
    return M.search(items(v), F.round(M.cosine(F.col("embedding"), query_vector(v, 0)), 6)).select("id", "type", "score")


@query("m01_search_artifacts", f"WITH {_ITEMS_SQL}, {_cos_sql(0)} SELECT id, type, round(score, 6) AS score FROM items JOIN s0 USING (id) WHERE type = 'artifact' ORDER BY round(score, 6) DESC, id LIMIT 90")
def _(v):
    return M.search(items(v), F.round(M.cosine(F.col("embedding"), query_vector(v, 0)), 6), "artifacts", 90).select("id", "type", "score")


@query(
    "m02_search_both",
    f"""WITH {_ITEMS_SQL}, {_cos_sql(0)}, s AS (SELECT id, brain_id, round(score, 6) AS score FROM items JOIN s0 USING (id)), a AS (SELECT id, score, 0 AS scope FROM s WHERE brain_id = 'src3' ORDER BY score DESC, id LIMIT 8),
    b AS (SELECT id, score, 1 AS scope FROM s ORDER BY score DESC, id LIMIT 8), u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
    SELECT id, any_value(score) AS score, CASE WHEN min(scope) = 0 THEN 'brain' ELSE 'personal' END AS origin FROM u GROUP BY id""",
)
def _(v):
    return M.search_both(items(v), F.round(M.cosine(F.col("embedding"), query_vector(v, 0)), 6), "src3").select("id", "score", "origin")


@query("m03_with_tags", f"WITH {_ITEMS_SQL} SELECT id, 'all' AS match FROM items WHERE type = 'artifact' AND list_has_all(tags, ['en', 's2']) UNION ALL SELECT id, 'any' FROM items WHERE type = 'artifact' AND list_has_any(tags, ['en', 's2'])")
def _(v):
    i = items(v)
    return M.with_tags(i, ["en", "s2"]).select("id", F.lit("all").alias("match")).unionByName(M.with_tags(i, ["en", "s2"], "any").select("id", F.lit("any").alias("match")))


@query("m03_tag_counts", f"WITH {_ITEMS_SQL} SELECT tag, count(*) AS items FROM (SELECT unnest(tags) AS tag FROM items) x GROUP BY tag")
def _(v):
    return M.tag_counts(items(v))


@query("m04_between_created", f"WITH {_ITEMS_SQL} SELECT id, created_s FROM items WHERE created_s >= 1704067200 + 36000 AND created_s < 1704067200 + 600000")
def _(v):
    return M.between_created(items(v), F.lit(1_704_067_200 + 36_000), F.lit(1_704_067_200 + 600_000)).select("id", "created_s")


@query(
    "m05_sweep",
    f"""WITH {_ITEMS_SQL}, {_cos_sql(0)}, {_cos_sql(1)}, {_cos_sql(2)}, r AS (SELECT id, 0 AS query_no, round(score, 6) AS score FROM s0 UNION ALL SELECT id, 1, round(score, 6) FROM s1 UNION ALL SELECT id, 2, round(score, 6) FROM s2),
    k AS (SELECT id, type, query_no, row_number() OVER (PARTITION BY type, query_no ORDER BY score DESC, id) AS rank FROM r JOIN items USING (id) WHERE type <> 'document')
    SELECT id, arg_min(type, (t, query_no, rank)) AS type, arg_min(query_no, (t, query_no, rank)) AS query_no, arg_min(rank, (t, query_no, rank)) AS rank
    FROM (SELECT *, CASE type WHEN 'fact' THEN 0 WHEN 'episode' THEN 1 ELSE 2 END AS t FROM k WHERE rank <= 50) x GROUP BY id""",
)
def _(v):
    scores = [F.round(M.cosine(F.col("embedding"), query_vector(v, n)), 6) for n in (0, 1, 2)]
    return M.sweep(items(v), scores)


@query(
    "m06_new_findings",
    """SELECT finding_id, pr, pass_no, login, 'comment' AS kind FROM v_findings WHERE login <> 'human' AND finding_id % 4 <> 0
    UNION ALL SELECT 10000000 + o_orderkey, o_custkey, o_orderkey % 10, 'ci', 'check' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus = 'F'""",
)
def _(v):
    checks = v.sql("SELECT 10000000 + o_orderkey AS finding_id, o_custkey AS pr, o_orderkey % 10 AS pass_no, 'ci' AS login, o_orderkey % 3 = 0 AS required, CASE WHEN o_orderstatus = 'F' THEN 'failing' ELSE 'ok' END AS state FROM {orders}")
    f = v.findings
    return M.new_findings(f, checks, f.filter("finding_id % 4 = 0").select("finding_id")).select("finding_id", "pr", "pass_no", "login", "kind")


_PASS = "SELECT user_id AS pr, event_id % 12 AS pass_no, max(event_id % 7) = 6 AS pushed, min(event_id % 3) AS new_findings, min(event_id % 2) AS bad_checks, max(event_id % 5) > 3 AS bot_reviewed, max(event_id) % 2400 AS head_age_s FROM {events} GROUP BY 1, 2"


@query(
    "m07_pr_status",
    f"""WITH p AS ({_PASS.replace('{events}', 'events')}), l AS (SELECT *, max(pass_no) OVER (PARTITION BY pr) AS passes FROM p)
    SELECT pr, passes, CASE WHEN NOT pushed AND new_findings = 0 AND bad_checks = 0 AND (bot_reviewed OR head_age_s >= 1200) THEN 'clean' WHEN passes >= 10 THEN 'stop' ELSE 'again' END AS decision FROM l WHERE pass_no = passes""",
)
def _(v):
    return M.pr_status(v.sql(_PASS))


@query(
    "m08_review_record",
    """SELECT pr, login, count(*) AS findings, count(*) FILTER (WHERE verdict = 'fixed') AS accepted, count(*) FILTER (WHERE verdict = 'rejected') AS rejected, count(DISTINCT CASE WHEN verdict = 'fixed' THEN pass_no END) AS fix_commits
    FROM v_findings WHERE login <> 'human' GROUP BY pr, login""",
)
def _(v):
    f = v.findings.withColumn("fix_sha", F.when(F.col("verdict") == "fixed", F.concat(F.lit("sha"), F.col("pass_no").cast("string"))))
    return M.review_record(f)
