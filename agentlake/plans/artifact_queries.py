"""Queries over governed artifacts, links and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.functions import ids as I
from agentlake.operators import artifacts as A
from agentlake.operators import paths as P
from agentlake.plans.directive_queries import _ROOTS
from agentlake.plans.function_queries import GLOBS
from agentlake.plans.registry import query
from agentlake.plans.views import Views

_RE = {g: r for g, _, r in GLOBS}
# every repo has the fixed globs as links
_LINKS_SQL = "links AS (SELECT concat('repo', n) AS repo, concat('a', n, '-', g) AS artifact_id, concat('b', n) AS brain_id, CASE WHEN g = 'g1' THEN NULL ELSE concat('Doc ', g) END AS artifact_name, re FROM range(0, 7) r(n), (VALUES %s) t(g, re))" % ", ".join(
    f"('{g}', '{r}')" for g, r in _RE.items() if r
)
EDITS_SQL = "edits AS (SELECT event_id, ts_s, session_id, split_part(file_path, '/', 3) AS repo, regexp_replace(file_path, '^/w/[^/]+/', '') AS rel_path FROM v_hook WHERE tool_name = 'Edit')"
_GOVERNED_SQL = f"{EDITS_SQL}, {_LINKS_SQL}, m AS (SELECT e.*, l.artifact_id, l.brain_id, l.artifact_name FROM edits e JOIN links l ON l.repo = e.repo AND regexp_matches(e.rel_path, l.re))"


def repo_roots(v: Views):
    return v.sql("SELECT DISTINCT concat('/w/repo', s_suppkey % 7) AS root, concat('repo', s_suppkey % 7) AS repo FROM {supplier}")


def links(v: Views):
    globs = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(t).alias("glob")) for g, t, _ in GLOBS])
    rows = v.sql("SELECT DISTINCT s_suppkey % 7 AS n FROM {supplier}").select("n", F.inline(globs))
    return rows.select(
        F.concat(F.lit("repo"), "n").alias("repo"), "glob", F.concat(F.lit("a"), "n", F.lit("-"), "g").alias("artifact_id"),
        F.concat(F.lit("b"), "n").alias("brain_id"), F.when(F.col("g") != "g1", F.concat(F.lit("Doc "), "g")).alias("artifact_name"),
    )


def edits(v: Views):
    e = v.hook.filter(F.col("tool_name") == "Edit").withColumn("path", I.edited_path(F.col("file_path"), F.lit(None).cast("string"), F.col("cwd")))
    return P.rel_path(e, repo_roots(v)).select("event_id", "ts_s", "session_id", "repo", "rel_path")


@query(
    "a01_rel_path",
    """SELECT event_id, CASE WHEN event_id % 5 = 1 THEN concat('net', user_id % 7) ELSE concat('repo', user_id % 7) END AS repo,
    CASE WHEN event_id % 5 = 1 THEN 'backoff.py' ELSE regexp_replace(file_path, '^/w/[^/]+/', '') END AS rel_path FROM events JOIN v_hook USING (event_id) WHERE tool_name = 'Edit'""",
)
def _(v):
    e = v.hook.filter(F.col("tool_name") == "Edit").withColumn("path", F.col("file_path"))
    return P.rel_path(e, v.sql(_ROOTS)).select("event_id", "repo", "rel_path")


@query("a02_governing_artifacts", f"WITH {_GOVERNED_SQL} SELECT event_id, rel_path, artifact_id, brain_id FROM m")
def _(v):
    return A.governing_artifacts(edits(v), links(v)).select("event_id", "rel_path", "artifact_id", "brain_id")


@query("a03_first_reminders", f"WITH {_GOVERNED_SQL} SELECT session_id, artifact_id, min(event_id) AS event_id FROM m GROUP BY session_id, artifact_id")
def _(v):
    return A.first_reminders(A.governing_artifacts(edits(v), links(v))).select("session_id", "artifact_id", "event_id")


@query(
    "a04_render_reminders",
    f"""WITH {_GOVERNED_SQL}, f AS (SELECT session_id, artifact_id, arg_min(rel_path, event_id) AS rel_path, any_value(brain_id) AS brain_id, any_value(artifact_name) AS artifact_name FROM m GROUP BY 1, 2)
    SELECT session_id, artifact_id, concat('You edited ', rel_path, ', governed by artifact "', coalesce(artifact_name, '(unnamed artifact)'), '" (id ', artifact_id, ', space ', brain_id,
      '). If the change alters what it says, save a new version with parent_id=', artifact_id, '.') AS reminder FROM f""",
)
def _(v):
    m = A.first_reminders(A.governing_artifacts(edits(v), links(v)))
    text = A.render_reminder(F.col("rel_path"), F.col("artifact_name"), F.col("artifact_id"), F.col("brain_id"))
    return m.select("session_id", "artifact_id", text.alias("reminder"))


@query(
    "a05_upsert_links",
    """WITH l AS (SELECT concat('a', p_partkey % 500) AS artifact_id, concat('app/', p_partkey, '/**') AS g, p_partkey AS w FROM part UNION ALL SELECT concat('a', p_partkey % 700), concat('docs/', p_partkey), 1000000 + p_partkey FROM part WHERE p_size > 25)
    SELECT artifact_id, arg_max(g, w) AS "glob" FROM l GROUP BY artifact_id""",
)
def _(v):
    base = v.sql("SELECT concat('a', p_partkey % 500) AS artifact_id, concat('app/', p_partkey, '/**') AS glob, p_partkey AS at FROM {part}")
    new = v.sql("SELECT concat('a', p_partkey % 700) AS artifact_id, concat('docs/', p_partkey) AS glob, 1000000 + p_partkey AS at FROM {part} WHERE p_size > 25")
    return A.upsert_links(base, new).select("artifact_id", "glob")


@query("a06_links_for", "SELECT p_partkey, concat('a', p_partkey) AS artifact_id FROM part WHERE p_size IN (7, 8)")
def _(v):
    ls = v.sql("SELECT p_partkey, CASE p_size WHEN 7 THEN 'app/**' WHEN 8 THEN 'x|app/{net,serve}/*.py' ELSE concat('app/', p_size, '/*') END AS glob, concat('a', p_partkey) AS artifact_id, 'b' AS brain_id FROM {part}")
    return A.links_for(ls, "app/net/backoff.py").select("p_partkey", "artifact_id")


VERSIONS_SQL = """ver AS (SELECT *, first_value(artifact_id) OVER (PARTITION BY name ORDER BY artifact_id) AS root_id, row_number() OVER (PARTITION BY name ORDER BY artifact_id) AS version FROM v_versions)"""


def versions(v: Views):
    return A.lineage(v.versions.select("artifact_id", "name", "parent_id", "created_s", "rationale", "tag", "content"))


@query("a07_lineage", f"WITH {VERSIONS_SQL} SELECT artifact_id, root_id, version FROM ver")
def _(v):
    return versions(v).select("artifact_id", "root_id", "version")


@query("a08_current_versions", f"WITH {VERSIONS_SQL} SELECT root_id, max(version) AS version, arg_max(artifact_id, version) AS artifact_id FROM ver GROUP BY root_id")
def _(v):
    return A.current_versions(versions(v).select("root_id", "version", "artifact_id"))


_DRIFT_SQL = f"""{VERSIONS_SQL}, newest AS (SELECT root_id, max(version) AS newest FROM ver GROUP BY root_id),
  loc AS (SELECT root_id, newest, CASE root_id % 3 WHEN 0 THEN newest WHEN 1 THEN newest - 2 END AS want FROM newest),
  files AS (SELECT l.root_id, l.newest, coalesce(v.content, 'edited') AS content FROM loc l LEFT JOIN ver v ON v.root_id = l.root_id AND v.version = l.want),
  drift AS (SELECT f.root_id, f.newest, (SELECT max(version) FROM ver v WHERE v.root_id = f.root_id AND v.content = f.content) AS matched FROM files f)"""


def _drift_inputs(v: Views):
    ver = versions(v).select("root_id", "version", "content", "rationale")
    newest = ver.groupBy("root_id").agg(F.max("version").alias("newest"))
    k = F.col("root_id") % 3
    want = newest.withColumn("version", F.when(k == 0, F.col("newest")).when(k == 1, F.col("newest") - 2))
    files = want.join(ver.select("root_id", "version", "content"), ["root_id", "version"], "left")
    return files.select("root_id", F.coalesce("content", F.lit("edited")).alias("content")), ver


@query("a09_spec_drift", f"WITH {_DRIFT_SQL} SELECT root_id, CASE WHEN matched = newest THEN 'in sync' WHEN matched IS NOT NULL THEN 'spec moved' ELSE 'unlanded edits' END AS state, matched, newest FROM drift")
def _(v):
    return A.spec_drift(*_drift_inputs(v))


@query("a09_newer_rationales", f"WITH {_DRIFT_SQL} SELECT v.root_id, v.version, v.rationale FROM ver v JOIN drift d ON d.root_id = v.root_id AND d.matched < d.newest AND v.version > d.matched")
def _(v):
    files, ver = _drift_inputs(v)
    return A.newer_rationales(A.spec_drift(files, ver), ver)


@query(
    "a10_local_file",
    """WITH c AS (SELECT p_partkey AS root_id, unnest([CASE WHEN p_partkey % 3 = 0 THEN concat('given/', p_partkey) END, CASE WHEN p_partkey % 2 = 0 THEN concat('path/', p_partkey) END, concat('docs/specs/s', p_partkey, '.md')]) AS path, unnest([0, 1, 2]) AS w FROM part),
    f AS (SELECT concat('given/', p_partkey) AS path FROM part WHERE p_size > 30 UNION ALL SELECT concat('path/', p_partkey) FROM part WHERE p_size > 20 UNION ALL SELECT concat('docs/specs/s', p_partkey, '.md') FROM part WHERE p_size > 10)
    SELECT root_id, arg_min(path, w) AS path FROM c JOIN f USING (path) GROUP BY root_id""",
)
def _(v):
    given = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("given/"), "p_partkey"))
    tagged = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("path/"), "p_partkey"))
    specs = v.table("part").select(F.col("p_partkey").alias("root_id"), A.pick_file(given, tagged, F.concat(F.lit("s"), "p_partkey")).alias("candidates"))
    files = v.sql(
        """SELECT concat('given/', p_partkey) AS path, p_name AS content FROM {part} WHERE p_size > 30 UNION ALL SELECT concat('path/', p_partkey), p_name FROM {part} WHERE p_size > 20
        UNION ALL SELECT concat('docs/specs/s', p_partkey, '.md'), p_name FROM {part} WHERE p_size > 10"""
    )
    return A.local_files(specs, files).select("root_id", "path")


@query(
    "a11_code_moved",
    f"""WITH {_GOVERNED_SQL} SELECT event_id, artifact_id FROM m WHERE ts_s > (SELECT min(ts_s) FROM v_hook) + 60000 * (ascii(right(artifact_id, 1)) - 48)""",
)
def _(v):
    commits = edits(v)
    first = v.hook.agg(F.min("ts_s")).scalar()
    newest = links(v).select("artifact_id", (first + 60_000 * (F.ascii(F.right("artifact_id", F.lit(1))) - 48)).alias("created_s"))
    return A.code_moved(commits, links(v), newest).select("event_id", "artifact_id")


@query(
    "a12_version_diff",
    f"""WITH {VERSIONS_SQL}, p AS (SELECT b.artifact_id AS pair, a.content AS old, b.content AS new FROM ver b JOIN ver a ON a.artifact_id = b.parent_id),
    l AS (SELECT pair, unnest(string_split(old, chr(10))) AS line, -1 AS n FROM p UNION ALL SELECT pair, unnest(string_split(new, chr(10))), 1 FROM p),
    s AS (SELECT pair, line, sum(n) AS n FROM l GROUP BY pair, line)
    SELECT pair, line, CASE WHEN n > 0 THEN 'added' ELSE 'removed' END AS change, abs(n) AS times FROM s WHERE n <> 0""", longs=('times',),
)
def _(v):
    ver = v.versions
    old = ver.select(F.col("artifact_id").alias("parent_id"), F.col("content").alias("old"))
    pairs = ver.select(F.col("artifact_id").alias("pair"), "parent_id", F.col("content").alias("new")).join(old, "parent_id")
    return A.version_diff(pairs)


@query(
    "a13_spec_status",
    """SELECT tag, count(*) AS versions, arg_max(rationale, (created_s, artifact_id)) AS latest_rationale FROM (SELECT concat('spec:', tag) AS tag, * EXCLUDE tag FROM v_versions UNION ALL SELECT 'spec', * EXCLUDE tag FROM v_versions) x GROUP BY tag""",
)
def _(v):
    tagged = v.versions.select(F.array(F.lit("spec"), F.concat(F.lit("spec:"), "tag")).alias("tags"), F.lit(1).alias("version"), "created_s", "artifact_id", "rationale")
    return A.spec_status(tagged)


