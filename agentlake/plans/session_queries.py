"""Queries over session records: filters, redaction, titles, slices, summaries, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.functions import text as T
from agentlake.functions import values as V
from agentlake.operators import imports as IM
from agentlake.operators import records as R
from agentlake.operators import reports as RP
from agentlake.operators import slices as SL
from agentlake.operators import titles as TI
from agentlake.operators.ordered import previous
from agentlake.plans.registry import query
from agentlake.plans.views import Views

_TAGS = "|".join(T.WRAPPER_TAGS)


def _elements(tags) -> str:
    return "|".join(f"<{t}>.*?</{t}>" for t in tags)


WRAPPER_SQL = (
    f"(type = 'user' AND regexp_matches(text, '^\\s*<(?:{_TAGS})>') AND "
    f"regexp_replace(regexp_replace(text, '(?s){_elements(T.WRAPPER_TAGS)}', '', 'g'), '\\s', '', 'g') = '')"
)
INERT_SQL = "type IN ('mode','last-prompt','pr-link','queue-operation','permission-mode','ai-title','custom-title','file-history-snapshot','file-history-delta')"
REDACT_SQL = "regexp_replace({0}, '\\b((?:mhk|xtk)_)[A-Za-z0-9_\\-]{{16,}}', '\\1<redacted>', 'g')"
SIZE_SQL = (
    "(length({0}) + 5*(length(regexp_replace({0}, '[\\x00-\\x7F]', '', 'g')) - length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
    " + 11*length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
)
_T = f"trim(regexp_replace(regexp_replace(text, '(?s){_elements(T.TITLE_STRIP_TAGS)}', ' ', 'g'), '\\s+', ' ', 'g'))"
TITLES_SQL = f"""
titled AS (SELECT *, {_T} AS t, left({_T}, 79) AS head, {WRAPPER_SQL} AS wrapper FROM v_records),
prompts AS (SELECT *, CASE WHEN type <> 'user' OR wrapper OR t = '' OR t LIKE '<%' THEN NULL
    WHEN length(t) <= 80 THEN t
    ELSE rtrim(CASE WHEN strpos(reverse(head), ' ') > 0 AND 79 - strpos(reverse(head), ' ') >= 40 THEN left(head, 79 - strpos(reverse(head), ' ')) ELSE head END, ' ,.;:—-') || '…' END AS prompt
  FROM titled)"""


def sized(v: Views) -> DataFrame:
    """Records with the size of their text plus a fixed envelope."""
    return v.records.select("session_id", "seq", "type", (V.record_size(F.col("text")) + 64).alias("size"))


def batched(v: Views) -> DataFrame:
    return v.records.withColumn("batch", F.floor(F.col("seq") / 20))


@query("f01_drop_command_wrappers", f"SELECT session_id, seq, type, text FROM v_records WHERE NOT coalesce({WRAPPER_SQL}, false)")
def _(v):
    return R.drop_command_wrappers(v.records).select("session_id", "seq", "type", "text")


@query(
    "f02_inert_batches",
    f"""SELECT session_id, seq // 20 AS batch, count(*) AS records, count(*) FILTER (WHERE NOT {WRAPPER_SQL}) AS sendable,
    count(*) FILTER (WHERE NOT {WRAPPER_SQL} AND NOT {INERT_SQL}) = 0 AS inert FROM v_records GROUP BY ALL""",
)
def _(v):
    return R.inert_batches(batched(v))


@query("f03_redact_text", f"SELECT session_id, seq, {REDACT_SQL.format('text')} AS text FROM v_records")
def _(v):
    return v.records.select("session_id", "seq", T.redact_text(F.col("text")).alias("text"))


@query("f04_redact_records", f"SELECT session_id, seq, {REDACT_SQL.format('text')} AS text, type, false AS redaction_failed FROM v_records")
def _(v):
    r = v.records.select("session_id", "seq", F.parse_json(F.to_json(F.struct("type", "text"))).alias("v"))
    out = R.redact_records(r)
    return out.select(
        "session_id", "seq", V.text_at(F.col("v"), "$.text").alias("text"), V.text_at(F.col("v"), "$.type").alias("type"), "redaction_failed"
    )


@query(
    "f05_secret_audit",
    """SELECT type, count(*) AS records, count(*) FILTER (WHERE regexp_matches(text, '\\b(?:mhk|xtk)_[A-Za-z0-9_\\-]{16,}')) AS with_secret,
    0 AS surviving FROM v_records GROUP BY type""",
)
def _(v):
    j = F.to_json(F.struct("type", "text"))
    return v.records.groupBy("type").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(T.json_contains_secret(j)).alias("with_secret"),
        F.count_if(T.json_contains_secret(T.redact_json(j))).alias("surviving"),
    )


@query(
    "w01_custom_title",
    "SELECT session_id, arg_max(trim(text), seq) FILTER (WHERE type = 'custom-title' AND trim(text) <> '') AS custom_title FROM v_records GROUP BY session_id",
)
def _(v):
    return TI.title_parts(v.records).select("session_id", "custom_title")


@query(
    "w02_generated_title",
    "SELECT session_id, arg_max(trim(text), seq) FILTER (WHERE type = 'ai-title' AND trim(text) <> '') AS generated_title FROM v_records GROUP BY session_id",
)
def _(v):
    return TI.title_parts(v.records).select("session_id", "generated_title")


@query("w03_prompt_title", f"WITH {TITLES_SQL} SELECT session_id, arg_min(prompt, seq) FILTER (WHERE prompt IS NOT NULL) AS prompt_title FROM prompts GROUP BY session_id")
def _(v):
    return TI.title_parts(v.records).select("session_id", "prompt_title")


_TITLE_AGGS = """arg_max(trim(text), seq) FILTER (WHERE type = 'custom-title' AND trim(text) <> '') AS c,
  arg_max(trim(text), seq) FILTER (WHERE type = 'ai-title' AND trim(text) <> '') AS g,
  arg_min(prompt, seq) FILTER (WHERE prompt IS NOT NULL) AS p"""


@query(
    "w04_session_title",
    f"WITH {TITLES_SQL}, parts AS (SELECT session_id, {_TITLE_AGGS} FROM prompts GROUP BY session_id) SELECT session_id, {REDACT_SQL.format('coalesce(c, g, p)')} AS title FROM parts",
)
def _(v):
    return TI.session_title(v.records)


@query(
    "w05_title_state",
    f"""WITH {TITLES_SQL}, parts AS (SELECT session_id, seq // 20 AS batch, {_TITLE_AGGS} FROM prompts GROUP BY 1, 2),
    st AS (SELECT session_id, batch, last_value(c IGNORE NULLS) OVER w AS c, last_value(g IGNORE NULLS) OVER w AS g, first_value(p IGNORE NULLS) OVER w AS p FROM parts
      WINDOW w AS (PARTITION BY session_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT session_id, batch, {REDACT_SQL.format('coalesce(c, g, p)')} AS title, {REDACT_SQL.format('c')} AS custom_title FROM st""",
)
def _(v):
    return TI.title_state(batched(v))


@query("w06_record_size", f"SELECT doc_id, {SIZE_SQL.format('text')} AS size FROM documents")
def _(v):
    return v.table("documents").select("doc_id", V.record_size(F.col("text")).alias("size"))


SLICE_BUDGET = 1_500
SLICES_SQL = f"""
sized AS (SELECT session_id, seq, {SIZE_SQL.format('text')} + 64 AS size, row_number() OVER (PARTITION BY session_id ORDER BY seq) AS pos FROM v_records),
cut AS (
  SELECT session_id, pos, seq, size, 1 AS slice, size AS open_bytes FROM sized WHERE pos = 1
  UNION ALL
  SELECT s.session_id, s.pos, s.seq, s.size,
         CASE WHEN c.open_bytes + s.size > {SLICE_BUDGET} THEN c.slice + 1 ELSE c.slice END,
         CASE WHEN c.open_bytes + s.size > {SLICE_BUDGET} THEN s.size ELSE c.open_bytes + s.size END
  FROM cut c JOIN sized s ON s.session_id = c.session_id AND s.pos = c.pos + 1)"""


# The import pipeline slices what is left after filter and redaction.
_CLEAN = REDACT_SQL.format("text")
CLEAN_SLICES_SQL = SLICES_SQL.replace("FROM v_records", f"FROM (SELECT * REPLACE ({_CLEAN} AS text) FROM v_records WHERE NOT coalesce({WRAPPER_SQL}, false)) clean")


@query("w07_slices", f"WITH RECURSIVE {SLICES_SQL} SELECT session_id, seq, size, slice FROM cut")
def _(v):
    return SL.slices(sized(v), SLICE_BUDGET)


def _plan(v: Views) -> DataFrame:
    """Slices with a measured duration and an outcome."""
    return (
        SL.slices(sized(v), SLICE_BUDGET)
        .groupBy("session_id", "slice")
        .agg(F.count(F.lit(1)).alias("records"), F.floor(F.sum("size") / 100).alias("seconds"))
        .withColumn("failed", (F.col("slice") == 3) & F.col("session_id").endswith("5"))
    )


PLAN_SQL = f"{SLICES_SQL}, plan AS (SELECT session_id, slice, count(*) AS records, sum(size) // 100 AS seconds, slice = 3 AND session_id LIKE '%5' AS failed FROM cut GROUP BY session_id, slice)"


@query(
    "w08_delivery_report",
    f"""WITH RECURSIVE {PLAN_SQL},
    run AS (SELECT *, coalesce(sum(seconds) OVER w, 0) AS spent FROM plan WINDOW w AS (PARTITION BY session_id ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT session_id, count(*) AS slices, count(*) FILTER (WHERE slice = 1 OR 40 - spent >= 10) AS slices_sent,
      coalesce(sum(records) FILTER (WHERE NOT (slice = 1 OR 40 - spent >= 10)), 0) AS records_not_sent, false AS stopped_by_failure
    FROM run GROUP BY session_id""", longs=('records_not_sent',),
)
def _(v):
    return SL.delivery_report(_plan(v).withColumn("failed", F.lit(False)), 40.0)


@query(
    "w09_stop_at_first_failure",
    f"""WITH RECURSIVE {PLAN_SQL},
    run AS (SELECT *, coalesce(bool_or(failed) OVER w, false) AS broken FROM plan WINDOW w AS (PARTITION BY session_id ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT session_id, count(*) AS slices, count(*) FILTER (WHERE NOT broken AND NOT failed) AS slices_sent,
      coalesce(sum(records) FILTER (WHERE broken OR failed), 0) AS records_not_sent, bool_or(NOT broken AND failed) AS stopped_by_failure
    FROM run GROUP BY session_id""", longs=('records_not_sent',),
)
def _(v):
    return SL.delivery_report(_plan(v), 1e12)


@query(
    "w10_flush_summary",
    f"""WITH b AS (SELECT session_id, seq // 20 AS batch, count(*) FILTER (WHERE NOT {WRAPPER_SQL}) AS sent, count(*) FILTER (WHERE {WRAPPER_SQL}) AS filtered,
      sum({SIZE_SQL.format('text')}) AS byte_span FROM v_records GROUP BY 1, 2)
    SELECT session_id, batch, sent, filtered, byte_span, n AS records_new, CASE WHEN n IS NOT NULL THEN batch END AS pending, CASE WHEN n IS NOT NULL THEN batch % 3 = 0 END AS draining FROM b
    LEFT JOIN (SELECT concat('s', conv_id) AS session_id, turn*10 // 20 AS batch, count(*) AS n FROM conversations GROUP BY 1, 2) USING (session_id, batch)""", longs=('byte_span',),
)
def _(v):
    replies = (
        v.table("conversations")
        .groupBy(F.concat(F.lit("s"), "conv_id").alias("session_id"), F.floor(F.col("turn") * 10 / 20).alias("batch"))
        .agg(F.count(F.lit(1)).alias("records_new"))
        .withColumns({"pending": F.col("batch"), "draining": F.col("batch") % 3 == 0})
    )
    return IM.flush_summary(batched(v), replies)


@query(
    "w11_import_summary",
    f"""WITH RECURSIVE {CLEAN_SLICES_SQL}, n AS (SELECT session_id, max(slice) AS slices FROM cut GROUP BY session_id)
    SELECT session_id, count(*) FILTER (WHERE NOT coalesce({WRAPPER_SQL}, false)) AS records, count(*) FILTER (WHERE {WRAPPER_SQL}) AS dropped,
      coalesce(sum({SIZE_SQL.format(_CLEAN)} + 64) FILTER (WHERE NOT coalesce({WRAPPER_SQL}, false)), 0) AS bytes, coalesce(sum({SIZE_SQL.format(_CLEAN)} + 64) FILTER (WHERE NOT coalesce({WRAPPER_SQL}, false)), 0) // 4 AS about_tokens,
      coalesce(any_value(slices), 0) AS slices, arg_min(cwd, seq) FILTER (WHERE cwd IS NOT NULL) AS destination
    FROM v_records LEFT JOIN n USING (session_id) GROUP BY session_id""", longs=('bytes', 'about_tokens'),
)
def _(v):
    return IM.import_summary(v.records, SLICE_BUDGET).drop("redacted")


@query(
    "w12_session_scope",
    f"""WITH b AS (SELECT session_id, seq // 20 AS batch, count(*) FILTER (WHERE NOT {WRAPPER_SQL} AND NOT {INERT_SQL}) = 0 AS inert,
      arg_min(cwd, seq) FILTER (WHERE cwd IS NOT NULL) AS cwd FROM v_records GROUP BY 1, 2),
    n AS (SELECT *, CASE WHEN batch % 2 = 0 THEN split_part(cwd, '/', 3) END AS namespace FROM b)
    SELECT session_id, batch, last_value(CASE WHEN NOT inert THEN cwd END IGNORE NULLS) OVER w AS scope_cwd,
      last_value(CASE WHEN NOT inert THEN namespace END IGNORE NULLS) OVER w AS scope_namespace FROM n
    WINDOW w AS (PARTITION BY session_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(v):
    sendable = ~T.is_command_wrapper(F.col("type"), F.col("text")) & ~T.is_inert(F.col("type"))
    b = batched(v).groupBy("session_id", "batch").agg(
        (F.count_if(sendable) == 0).alias("inert"),
        F.min_by("cwd", F.when(F.col("cwd").isNotNull(), F.col("seq"))).alias("cwd"),
    )
    b = b.withColumn("namespace", F.when(F.col("batch") % 2 == 0, F.element_at(F.split("cwd", "/"), 3)))
    return TI.session_scope(b).select("session_id", "batch", "scope_cwd", "scope_namespace")


def gist_changes(episodes: DataFrame) -> DataFrame:
    """Gists of a session whose content differs from the gist before."""
    gist = episodes.withColumn("gist", F.regexp_replace("content", r"(?U)\A\s+", "")).filter(F.col("gist").startswith("## GOAL"))
    hashed = gist.select("session_id", "seq", F.sha2("gist", 256).alias("hash"))
    out = previous(hashed, ["session_id"], ["seq"], {"before": "hash"})
    return out.filter(~F.col("hash").eqNullSafe(F.col("before"))).select("session_id", "seq", "hash")


@query(
    "w13_gist_changes",
    """WITH g AS (SELECT source AS session_id, doc_id AS seq, sha256(CASE WHEN doc_id % 3 = 0 THEN concat('## GOAL ', doc_id // 400 % 5) ELSE text END) AS hash
      FROM documents WHERE CASE WHEN doc_id % 3 = 0 THEN true ELSE text LIKE '## GOAL%' END)
    SELECT session_id, seq, hash FROM (SELECT *, lag(hash) OVER (PARTITION BY session_id ORDER BY seq) AS before FROM g) x WHERE hash IS DISTINCT FROM before""",
)
def _(v):
    docs = v.table("documents").select(
        F.col("source").alias("session_id"),
        F.col("doc_id").alias("seq"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("## GOAL "), F.floor(F.col("doc_id") / 400) % 5)).otherwise(F.col("text")).alias("content"),
    )
    return gist_changes(docs)


@query(
    "r01_wrapper_share",
    f"""SELECT count(*) FILTER (WHERE {WRAPPER_SQL}) AS wrappers, count(*) FILTER (WHERE trim(text) <> '') AS text_users, count(*) AS users,
    round(count(*) FILTER (WHERE {WRAPPER_SQL}) / count(*) FILTER (WHERE trim(text) <> ''), 6) AS share_of_text,
    round(count(*) FILTER (WHERE {WRAPPER_SQL}) / count(*), 6) AS share_of_users FROM v_records WHERE type = 'user'""",
)
def _(v):
    return RP.wrapper_share(v.records)


@query(
    "r02_title_coverage",
    f"""WITH {TITLES_SQL}, parts AS (SELECT session_id, {_TITLE_AGGS} FROM prompts GROUP BY session_id)
    SELECT CASE CAST(substr(session_id, 2) AS BIGINT) % 3 WHEN 0 THEN 'cli' WHEN 1 THEN 'sdk-cli' ELSE 'desktop' END AS entrypoint, count(*) AS sessions,
      count(*) FILTER (WHERE c IS NOT NULL OR g IS NOT NULL) AS titled, count(*) FILTER (WHERE c IS NULL AND g IS NULL AND p IS NOT NULL) AS named_by_prompt
    FROM parts GROUP BY 1""",
)
def _(v):
    n = F.substring("session_id", 2, 20).cast("long") % 3
    entry = F.when(n == 0, "cli").when(n == 1, "sdk-cli").otherwise("desktop")
    return RP.title_coverage(TI.title_parts(v.records).withColumn("entrypoint", entry))


@query(
    "r03_size_profile",
    f"""WITH s AS (SELECT session_id, sum({SIZE_SQL.format('text')} + 64) AS bytes FROM v_records GROUP BY session_id)
    SELECT count(*) AS sessions, count(*) FILTER (WHERE bytes > 1000000) AS over_1mb, count(*) FILTER (WHERE bytes > 5000000) AS over_5mb,
      max(bytes) AS largest, sum(ceil(bytes / {SLICE_BUDGET})) AS slices_at_least, median(bytes) AS median FROM s""", longs=('largest', 'slices_at_least'),
)
def _(v):
    return RP.size_profile(sized(v).groupBy("session_id").agg(F.sum("size").alias("bytes")), SLICE_BUDGET)


@query(
    "r04_repeat_share",
    """WITH p AS (SELECT session_id, event_id % 40 AS d, row_number() OVER (PARTITION BY session_id, event_id % 40 ORDER BY event_id) AS k FROM v_hook)
    SELECT count(*) AS injections, count(*) FILTER (WHERE k > 1) AS repeats, round(count(*) FILTER (WHERE k > 1) / count(*), 6) AS repeat_share FROM p""",
)
def _(v):
    return RP.repeat_share(v.hook.select("session_id", (F.col("event_id") % 40).alias("directive_id")))


@query(
    "r07_rename_conflicts",
    """SELECT session_id, count(*) FILTER (WHERE type = 'ai-title') AS generated, count(*) FILTER (WHERE type = 'custom-title') AS renamed, arg_max(type, seq) AS came_last
    FROM v_records WHERE type IN ('ai-title', 'custom-title') GROUP BY session_id
    HAVING count(*) FILTER (WHERE type = 'ai-title') > 0 AND count(*) FILTER (WHERE type = 'custom-title') > 0""",
)
def _(v):
    return RP.rename_conflicts(v.records)


@query(
    "r08_count_by_type",
    """WITH i AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'fact' WHEN 1 THEN 'episode' ELSE 'artifact' END AS type, text FROM documents)
    SELECT type, count(*) AS items FROM i WHERE NOT (type = 'artifact' AND contains(lower(text), 'the')) GROUP BY type""",
)
def _(v):
    k = F.col("doc_id") % 3
    items = v.table("documents").select(
        F.when(k == 0, "fact").when(k == 1, "episode").otherwise("artifact").alias("type"), F.col("text").alias("content")
    )
    return RP.count_by_type(items, ("The",))


@query(
    "r09_activation_funnel",
    """WITH e AS (SELECT concat('repo', user_id % 7) AS repo, 1704067200 + event_id*60 AS ts_s,
      CASE event_type WHEN 'signup' THEN 'created' WHEN 'view' THEN 'seeded' WHEN 'click' THEN 'digest' WHEN 'purchase' THEN 'fired' ELSE 'routed' END AS kind FROM events)
    SELECT repo, count(*) FILTER (WHERE kind = 'seeded') AS seeded, count(*) FILTER (WHERE kind = 'digest') > 0 AS digest_rendered,
      count(*) FILTER (WHERE kind = 'fired') AS directives_fired, count(*) FILTER (WHERE kind = 'routed') > 0 AS routed,
      min(ts_s) FILTER (WHERE kind = 'fired') - min(ts_s) FILTER (WHERE kind = 'created') AS seconds_to_first_recall FROM e GROUP BY repo""",
)
def _(v):
    e = v.sql(
        """SELECT concat('repo', user_id % 7) AS repo, 1704067200 + event_id*60 AS ts_s,
        CASE event_type WHEN 'signup' THEN 'created' WHEN 'view' THEN 'seeded' WHEN 'click' THEN 'digest' WHEN 'purchase' THEN 'fired' ELSE 'routed' END AS kind FROM {events}"""
    )
    return RP.activation_funnel(e)


@query(
    "s18_prefix_to_bytes",
    f"""WITH s AS (SELECT session_id, seq, {SIZE_SQL.format('text')} + 64 AS size FROM v_records)
    SELECT session_id, seq, size FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s) x WHERE before < 1200""",
)
def _(v):
    return R.prefix_to_bytes(sized(v), 1200).select("session_id", "seq", "size")


@query(
    "c22_session_meta",
    "SELECT session_id, arg_min(cwd, seq) FILTER (WHERE cwd IS NOT NULL) AS cwd, count(*) AS records FROM v_records GROUP BY session_id",
)
def _(v):
    return R.session_meta(v.records)


@query(
    "session_summary",
    f"""WITH RECURSIVE {TITLES_SQL}, {CLEAN_SLICES_SQL}, n AS (SELECT session_id, max(slice) AS slices FROM cut GROUP BY session_id),
    parts AS (SELECT session_id, {_TITLE_AGGS}, count(*) FILTER (WHERE NOT coalesce(wrapper, false)) AS records, count(*) FILTER (WHERE wrapper) AS wrappers_dropped,
      count(*) FILTER (WHERE NOT coalesce(wrapper, false) AND regexp_matches(text, '\\b(?:mhk|xtk)_[A-Za-z0-9_\\-]{{16,}}')) AS redacted FROM prompts GROUP BY session_id)
    SELECT session_id, records, wrappers_dropped, redacted, {REDACT_SQL.format('coalesce(c, g, p)')} AS title, coalesce(slices, 0) AS slices FROM parts LEFT JOIN n USING (session_id)""",
)
def session_summary(v):
    """The flagship query: filter, redact, title, slice and summarize every session."""
    return IM.session_overview(v.records, SLICE_BUDGET)
