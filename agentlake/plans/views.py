"""Adapter views that give the operators full-size inputs from the driver tables.

The SQL texts are valid unchanged in Spark SQL and DuckDB; ``{events}`` style marks
stand for the driver tables. Three views are written a second time as DataFrame code
where the plain text would scan a table several times or window a whole key.
"""

from __future__ import annotations

from functools import cached_property
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.operators.ordered import Running, previous, running
from agentlake.session import materialize

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_VIEW_NO = count()

VIEW_SQL = {
    "v_records": """
SELECT concat('s', conv_id) AS session_id, turn*10 AS seq, role AS type, text, md5(concat(conv_id, ':', turn)) AS uuid,
       1704067200 + conv_id*3600 + turn*60 AS ts_s, concat('/w/repo', conv_id % 7) AS cwd FROM {conversations}
UNION ALL SELECT concat('s', conv_id), turn*10+1, 'user', concat('<command-name>/model</command-name> <command-args>', turn, '</command-args>'),
       md5(concat(conv_id, ':', turn, ':w')), 1704067200 + conv_id*3600 + turn*60 + 1, concat('/w/repo', conv_id % 7) FROM {conversations} WHERE (conv_id + turn) % 5 = 0
UNION ALL SELECT concat('s', conv_id), turn*10+2, 'user', concat('<command-name>/x</command-name> also bump turn ', turn),
       md5(concat(conv_id, ':', turn, ':p')), 1704067200 + conv_id*3600 + turn*60 + 2, concat('/w/repo', conv_id % 7) FROM {conversations} WHERE (conv_id + turn) % 11 = 0
UNION ALL SELECT concat('s', conv_id), turn*10+3, 'user', concat('export K=mhk_', md5(text), ' now'),
       md5(concat(conv_id, ':', turn, ':k')), 1704067200 + conv_id*3600 + turn*60 + 3, NULL FROM {conversations} WHERE turn = 1
UNION ALL SELECT concat('s', conv_id), turn*10+4, 'ai-title', concat('Title ', conv_id, ' v', turn),
       NULL, 1704067200 + conv_id*3600 + turn*60 + 4, NULL FROM {conversations} WHERE turn % 2 = 0 AND conv_id % 3 <> 0
UNION ALL SELECT concat('s', conv_id), turn*10+5, 'custom-title', concat('Renamed ', conv_id),
       NULL, 1704067200 + conv_id*3600 + turn*60 + 5, NULL FROM {conversations} WHERE turn = 1 AND conv_id % 4 = 0
""",
    "v_hook": """
SELECT event_id, 1704067200 + event_id*60 AS ts_s, concat('u', user_id) AS session_id, concat('/w/repo', user_id % 7) AS cwd,
       CASE WHEN event_type = 'click' THEN 'Edit' WHEN event_type = 'view' THEN 'Read' ELSE 'Bash' END AS tool_name,
       CASE WHEN event_type IN ('click','view') THEN concat('/w/repo', user_id % 7, '/app/', CASE event_id % 5 WHEN 0 THEN 'retry.py' WHEN 1 THEN 'net/backoff.py' WHEN 2 THEN 'serve/entities.py' WHEN 3 THEN 'README.md' ELSE 'main.py' END) END AS file_path,
       CASE WHEN event_type NOT IN ('click','view') THEN CASE event_id % 12 WHEN 0 THEN 'git commit -m x' WHEN 1 THEN 'git log --oneline | grep commit'
            WHEN 2 THEN 'cd /x && git -C /repo commit -m y' WHEN 3 THEN 'echo git commit' WHEN 4 THEN 'gh pr create --fill' WHEN 5 THEN 'gh pr list'
            WHEN 6 THEN 'git rebase origin/staging' WHEN 7 THEN 'npm install left-pad' WHEN 8 THEN 'sudo rm -rf build' WHEN 9 THEN 'cat app/retry.py'
            WHEN 10 THEN 'python app/serve/entities.py > out.txt' ELSE 'git push origin topic' END END AS command,
       CASE WHEN event_type = 'error' THEN concat('Traceback (most recent call last): app/net/backoff.py ValueError ', event_id)
            WHEN event_id % 12 = 4 THEN concat('https://git.example.com/o/r/pull/', event_id) ELSE 'ok' END AS response
FROM {events}
""",
    "v_tokens": """
SELECT l_orderkey AS session_id, pos AS idx,
       CASE WHEN pos = 4 THEN 1 ELSE inp END AS input_tokens, cached AS cached_input_tokens, cw AS cache_write_input_tokens, outp AS output_tokens
FROM (SELECT l_orderkey, pos, SUM(CAST(l_quantity AS BIGINT)*10) OVER w AS inp, SUM(CAST(l_quantity AS BIGINT)*6) OVER w AS cached,
             SUM(CAST(l_quantity AS BIGINT)) OVER w AS cw, SUM(CAST(l_quantity AS BIGINT)*2) OVER w AS outp
      FROM (SELECT l_orderkey, l_quantity, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM {lineitem}) x
      WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) y
""",
    "v_edges": """
SELECT 'root' AS parent, r_regionkey AS ord, concat('r', r_regionkey) AS child, CAST(NULL AS BIGINT) AS node_ms FROM {region}
UNION ALL SELECT concat('r', n_regionkey), n_nationkey, concat('n', n_nationkey), CAST(1700000000000 + n_nationkey AS BIGINT) FROM {nation}
UNION ALL SELECT concat('n', c_nationkey), c_custkey, concat('c', c_custkey), CAST(NULL AS BIGINT) FROM {customer}
UNION ALL SELECT 'n0', c_custkey, concat('c', c_custkey), CAST(NULL AS BIGINT) FROM {customer} WHERE c_custkey % 2 = 0 AND c_nationkey <> 0
""",
    "v_directives": """
SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'lesson' ELSE 'procedure' END AS type, p_name AS content, p_size AS seen, concat('repo', p_partkey % 7) AS repo,
       CASE p_partkey % 9 WHEN 0 THEN 'origin/staging' WHEN 1 THEN 'app/retry.py' WHEN 2 THEN 'app/net/backoff.py' WHEN 3 THEN 'part' WHEN 4 THEN 'left-pad'
            WHEN 5 THEN 'origin' WHEN 6 THEN 'serve/entities.py' WHEN 7 THEN NULL ELSE 'gh pr create' END AS trigger_1,
       concat(p_brand, '.py') AS trigger_2
FROM {part}
""",
    "v_attempts": """
SELECT event_id, 1704067200 + event_id*60 AS ts_s, concat('u', user_id) AS session_id, CASE WHEN event_id % 2 = 0 THEN 'turn' ELSE 'backstop' END AS capture_path,
       CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'timeout' WHEN 'view' THEN 'unconfirmed' WHEN 'click' THEN 'no_credential' ELSE 'rate_limited' END AS outcome,
       event_id*100 AS offset_after, CASE WHEN event_id % 17 = 0 THEN event_id*50 ELSE event_id*100 END AS file_size
FROM {events}
""",
    "v_listings": """
SELECT s_nationkey AS org_id, concat('org', s_nationkey) AS org_name, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE concat('org', s_nationkey) END AS applied_org_name,
       s_nationkey % 9 <> 0 AS ok, s_nationkey = 1 AS is_default, concat('b', s_suppkey % 70) AS brain_id, concat('Repo: o/r', s_suppkey % 70 % 60) AS brain_name
FROM {supplier}
""",
    "v_versions": """
SELECT doc_id AS artifact_id, source AS name, LAG(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS parent_id, 1704067200 + doc_id*600 AS created_s,
       concat('why ', doc_id) AS rationale, lang AS tag, text AS content
FROM {documents}
""",
    "v_board_events": """
SELECT event_id, 1704067200 + event_id*60 AS ts_s, concat('u', user_id) AS session_id, concat('/w/t', user_id) AS worktree, concat('feat/', user_id) AS branch,
       CASE event_type WHEN 'signup' THEN 'session-start' WHEN 'error' THEN 'session-end' WHEN 'purchase' THEN 'post-tool' ELSE 'prompt' END AS event,
       concat('please work on task number ', event_id % 50) AS prompt, md5(concat('h', event_id)) AS commit_hash, concat('app/f', event_id % 40, '.py') AS file
FROM {events}
""",
    "v_findings": """
SELECT event_id AS finding_id, user_id AS pr, event_id % 10 AS pass_no,
       CASE event_type WHEN 'click' THEN 'cursor[bot]' WHEN 'view' THEN 'chatgpt-codex[bot]' WHEN 'error' THEN 'bugbot' ELSE 'human' END AS login,
       CASE WHEN event_id % 3 = 0 THEN 'rejected' ELSE 'fixed' END AS verdict
FROM {events}
""",
}


def view_sql(name: str) -> str:
    """The view text over the bare table names."""
    text = VIEW_SQL[name].strip()
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


class Views:
    """Lazily opened driver tables and adapter views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL over driver tables (``{events}``) and given frames (``{x}``)."""
        for name in (*TABLES, *frames):
            mark = "{" + name + "}"
            if mark in text:
                df = frames[name] if name in frames else self.table(name)
                view = f"agentlake_{name}_{next(_VIEW_NO)}"
                df.createOrReplaceTempView(view)
                text = text.replace(mark, view)
        return self.spark.sql(text)

    def _view(self, name: str) -> DataFrame:
        return self.sql(VIEW_SQL[name])

    @cached_property
    def records(self) -> DataFrame:
        """``v_records`` in one scan: each turn expands to the rows whose condition holds."""
        return self.table("conversations").selectExpr(
            "concat('s', conv_id) AS session_id",
            """inline(filter(array(
              named_struct('keep', true, 'seq', turn*10, 'type', role, 'text', text, 'uuid', md5(concat(conv_id, ':', turn)),
                           'ts_s', 1704067200 + conv_id*3600 + turn*60, 'cwd', concat('/w/repo', conv_id % 7)),
              named_struct('keep', (conv_id + turn) % 5 = 0, 'seq', turn*10+1, 'type', 'user',
                           'text', concat('<command-name>/model</command-name> <command-args>', turn, '</command-args>'),
                           'uuid', md5(concat(conv_id, ':', turn, ':w')), 'ts_s', 1704067200 + conv_id*3600 + turn*60 + 1, 'cwd', concat('/w/repo', conv_id % 7)),
              named_struct('keep', (conv_id + turn) % 11 = 0, 'seq', turn*10+2, 'type', 'user',
                           'text', concat('<command-name>/x</command-name> also bump turn ', turn),
                           'uuid', md5(concat(conv_id, ':', turn, ':p')), 'ts_s', 1704067200 + conv_id*3600 + turn*60 + 2, 'cwd', concat('/w/repo', conv_id % 7)),
              named_struct('keep', turn = 1, 'seq', turn*10+3, 'type', 'user', 'text', concat('export K=mhk_', md5(text), ' now'),
                           'uuid', md5(concat(conv_id, ':', turn, ':k')), 'ts_s', 1704067200 + conv_id*3600 + turn*60 + 3, 'cwd', CAST(NULL AS STRING)),
              named_struct('keep', turn % 2 = 0 AND conv_id % 3 <> 0, 'seq', turn*10+4, 'type', 'ai-title', 'text', concat('Title ', conv_id, ' v', turn),
                           'uuid', CAST(NULL AS STRING), 'ts_s', 1704067200 + conv_id*3600 + turn*60 + 4, 'cwd', CAST(NULL AS STRING)),
              named_struct('keep', turn = 1 AND conv_id % 4 = 0, 'seq', turn*10+5, 'type', 'custom-title', 'text', concat('Renamed ', conv_id),
                           'uuid', CAST(NULL AS STRING), 'ts_s', 1704067200 + conv_id*3600 + turn*60 + 5, 'cwd', CAST(NULL AS STRING))
            ), x -> x.keep))""",
        ).drop("keep")

    @cached_property
    def tokens(self) -> DataFrame:
        """``v_tokens`` as one bucketed running sum per order, written once."""
        q = F.col("l_quantity").cast("long")
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
        rows = self.table("lineitem").select("l_orderkey", "l_quantity", *order)
        out = running(
            rows,
            ["l_orderkey"],
            order,
            {
                "pos": Running("count"),
                "inp": Running("sum", q * 10),
                "cached": Running("sum", q * 6),
                "cw": Running("sum", q),
                "outp": Running("sum", q * 2),
            },
            bucket=F.struct("l_linenumber", F.floor(F.col("l_partkey") / 65_536)),
        )
        out = out.select(
            F.col("l_orderkey").alias("session_id"),
            F.col("pos").alias("idx"),
            F.when(F.col("pos") == 4, F.lit(1).cast("long")).otherwise(F.col("inp")).alias("input_tokens"),
            F.col("cached").alias("cached_input_tokens"),
            F.col("cw").alias("cache_write_input_tokens"),
            F.col("outp").alias("output_tokens"),
        )
        # every reader goes over the snapshots two or three times; the running sums are formed once
        return materialize(out, "tokens")

    @cached_property
    def versions(self) -> DataFrame:
        """``v_versions`` with the parent taken by a bucketed lag."""
        docs = self.table("documents")
        out = previous(docs, ["source"], ["doc_id"], {"parent_id": "doc_id"})
        return out.selectExpr(
            "doc_id AS artifact_id",
            "source AS name",
            "parent_id",
            "1704067200 + doc_id*600 AS created_s",
            "concat('why ', doc_id) AS rationale",
            "lang AS tag",
            "text AS content",
        )

    @cached_property
    def hook(self) -> DataFrame:
        return self._view("v_hook")

    @cached_property
    def edges(self) -> DataFrame:
        return self._view("v_edges")

    @cached_property
    def directives(self) -> DataFrame:
        return self._view("v_directives")

    @cached_property
    def attempts(self) -> DataFrame:
        return self._view("v_attempts")

    @cached_property
    def listings(self) -> DataFrame:
        return self._view("v_listings")

    @cached_property
    def board_events(self) -> DataFrame:
        return self._view("v_board_events")

    @cached_property
    def findings(self) -> DataFrame:
        return self._view("v_findings")
