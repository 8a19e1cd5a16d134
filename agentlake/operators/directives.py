"""Directive recall: which lessons concretely match a tool call, ranked and cut to a few."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agentlake.functions.text import strip_ws
from agentlake.functions import commands as C
from agentlake.functions import values as V
from agentlake.session import materialize

# Words too common to anchor a directive on their own.
GENERIC_TOKENS = (
    "true", "false", "none", "null", "self", "this", "that", "with",
    "from", "when", "into", "your", "code", "file", "path", "main",
    "test", "tests", "todo", "temp", "data",
    "origin", "staging", "master", "branch", "commit",
    "users", "home", "desktop", "documents", "downloads", "appdata",
    "roaming", "local", "share", "config", "projects", "workspace",
)
MIN_TOKEN = 4
TOP_K = 2
KEEP_FIRED_S = 7 * 86_400
# Tools that always change a file, and tools that run a shell command.
EDIT_TOOLS = ("Edit", "MultiEdit", "Write", "NotebookEdit", "apply_patch")
SHELL_TOOLS = ("Bash", "shell", "local_shell")

_ANY = "*"  # carried by every directive, hit by calls without a handle
_FREE = ""  # carried by directives without triggers, hit by every call


def trigger_tokens(trigger: Column) -> Column:
    """The concrete tokens of one trigger."""
    t = F.replace(F.lower(strip_ws(trigger)), F.lit("\\"), F.lit("/"))
    base = F.substring_index(t, "/", -1)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    pathlike = t.contains("/") | t.contains(".")
    words = F.filter(F.split(t, r"[^a-z0-9_]+"), lambda w: F.length(w) >= 5)
    own = F.array(t, F.when(pathlike, base), F.when(pathlike & base.contains("."), stem))
    return F.array_distinct(F.filter(F.concat(own, words), lambda x: x.isNotNull() & (F.length(x) >= MIN_TOKEN)))


def name_tokens(name: Column) -> Column:
    """A repo or account name and its longer parts."""
    n = F.lower(F.coalesce(name, F.lit("")))
    parts = F.filter(F.split(n, r"[^a-z0-9]+"), lambda w: F.length(w) >= MIN_TOKEN)
    return F.array_distinct(F.filter(F.concat(F.array(n), parts), lambda x: x != ""))


def blocked_tokens(repo: Column, account: Column) -> Column:
    """Everything that may not be a sole anchor."""
    return F.array_distinct(
        F.concat(F.array(*[F.lit(t) for t in GENERIC_TOKENS]), name_tokens(account), name_tokens(repo))
    )


def token_hit(token: Column, haystack: Column) -> Column:
    """The token with no letter or digit right before or after it. Tokens hold no
    backslash (D01 turns it into a slash), so the quoting is safe."""
    return F.coalesce(
        haystack.contains(token)
        & F.rlike(haystack, F.concat(F.lit(r"(?<![a-z0-9])\Q"), token, F.lit(r"\E(?![a-z0-9])"))),
        F.lit(False),
    )


def haystack(*parts: Column) -> Column:
    """The lowered handle (and failing output) that tokens are looked for in."""
    return F.replace(F.lower(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])), F.lit("\\"), F.lit("/"))


def _grams(text: Column) -> Column:
    return F.when(
        F.length(text) >= 4, F.transform(F.sequence(F.lit(1), F.length(text) - 3), lambda i: F.substr(text, i, F.lit(4)))
    ).otherwise(F.array().cast("array<string>"))


def hay_keys(hay: Column) -> Column:
    """Join keys of a haystack: its runs of letters and digits, and the 4-grams of what lies
    between them."""
    runs = F.regexp_extract_all(hay, F.lit("[a-z0-9]+"), F.lit(0))
    rest = F.regexp_extract_all(hay, F.lit("[^a-z0-9]{4,}"), F.lit(0))
    return F.array_distinct(F.concat(runs, F.flatten(F.transform(rest, _grams))))


def token_key(token: Column) -> Column:
    """One key of a token that every haystack it hits must have: its longest run (a hit is
    bounded, so a run inside the token is a whole run of the haystack), else its first 4
    characters."""
    runs = F.regexp_extract_all(token, F.lit("[a-z0-9]+"), F.lit(0))
    best = F.aggregate(runs, F.lit(""), lambda a, r: F.when(F.length(r) > F.length(a), r).otherwise(a))
    return F.when(best != "", best).otherwise(F.substring(token, 1, 4))


def directive_tokens(directives: DataFrame, account: str | None = None) -> DataFrame:
    """One row per (directive, trigger, token), generic and account words left out."""
    stop = set(GENERIC_TOKENS)
    rows = directives.select(
        "id", F.coalesce("repo", F.lit("")).alias("scope"), "seen", "pos", F.posexplode("triggers").alias("trigger_pos", "trigger")
    )
    rows = rows.select("*", F.explode(trigger_tokens(F.col("trigger"))).alias("token"))
    out = rows.filter(~F.col("token").isin(*sorted(stop)))
    return out if not account else out.filter(~F.array_contains(name_tokens(F.lit(account)), F.col("token")))


def _spread(tokens: DataFrame) -> DataFrame:
    """Tokens as a side of a join. They are many times the bytes of the directives they come
    from, but Spark estimates them by the directives' file: it must not broadcast them."""
    return tokens.hint("merge")


def token_hits(calls: DataFrame, tokens: DataFrame) -> DataFrame:
    """Which tokens hit which haystacks, on distinct (repo, hay) and distinct (scope, token):
    candidates by equality on one key, then the exact test."""
    hays = calls.filter(F.col("hay") != "").select(F.coalesce("repo", F.lit("")).alias("repo"), "hay").distinct()
    keys = hays.select("repo", "hay", F.explode(hay_keys(F.col("hay"))).alias("key"))
    toks = tokens.select("scope", "token").distinct().withColumn("key", token_key(F.col("token")))
    scoped = keys.withColumn("scope", F.col("repo")).filter("repo <> ''").join(_spread(toks.filter("scope <> ''")), ["scope", "key"])
    free = keys.join(_spread(toks.filter("scope = ''")), "key")
    cols = ["repo", "hay", "scope", "token"]
    found = scoped.select(*cols).unionByName(free.select(*cols))
    return found.filter(
        token_hit(F.col("token"), F.col("hay")) & ~F.array_contains(name_tokens(F.col("repo")), F.col("token"))
    )


def match_directives(calls: DataFrame, directives: DataFrame, account: str | None = None) -> DataFrame:
    """Directives whose longest unblocked token hits the haystack, per distinct
    (repo, hay), with the matched trigger. Ties go to the earlier trigger, then the token.

    Directives without triggers are kept for every call of their scope; they are not
    multiplied here, ``recall`` ranks them in."""
    tokens = directive_tokens(directives, account)
    hit = token_hits(calls, tokens).join(_spread(tokens), ["scope", "token"])
    order = F.struct((-F.length("token")).alias("l"), "trigger_pos", "token")
    best = F.min_by(F.struct("trigger", "token", F.length("token").alias("match_len"), "seen", "pos"), order)
    return hit.groupBy("repo", "hay", "id").agg(best.alias("b")).select("repo", "hay", "id", "b.*")


def rank_directives(matches: DataFrame, call: Sequence[str] = ("call_id",), k: int = TOP_K) -> DataFrame:
    """Matched first, longer token, higher ``seen``, then input order; the first k."""
    w = Window.partitionBy(*call).orderBy(F.coalesce("match_len", F.lit(0)).desc(), F.col("seen").desc(), "pos")
    return matches.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def drop_fired(matches: DataFrame, firings: DataFrame) -> DataFrame:
    """Without the directives a session has already been shown."""
    return matches.join(firings.select("session_id", F.col("directive_id").alias("id")).distinct(), ["session_id", "id"], "left_anti")


def recall(
    calls: DataFrame, directives: DataFrame, firings: DataFrame | None = None, k: int = TOP_K, account: str | None = None
) -> DataFrame:
    """The k best directives of each call ``(call_id, session_id, repo, hay)``,
    without those its session has seen (``firings``) or minted itself.

    A call never meets all matching directives. Of the directives that share a token, only
    the k best plus as many as the session excludes can reach its top k: any other one is
    outranked by k that match at least as long. So each (scope, token) is cut to k before the
    join, a session with exclusions adds as many places as it excludes there, and the result
    stays exact; no session's exclusions widen the join of another."""
    cols = ["id", "scope", "seen", "pos", "trigger_pos", "trigger", "token"]
    base = directives.select("id", F.coalesce("repo", F.lit("")).alias("scope"), "seen", "pos", "triggers")
    none = [F.lit(None).cast("int").alias("trigger_pos"), F.lit(None).cast("string").alias("trigger")]
    bare = base.filter(F.coalesce(F.size("triggers"), F.lit(0)) <= 0).select("id", "scope", "seen", "pos", *none, F.lit(_FREE).alias("token"))
    every = base.select("id", "scope", "seen", "pos", *none, F.lit(_ANY).alias("token"))
    real = directive_tokens(directives, account)
    tokens = real.select(*cols).unionByName(bare).unionByName(every)

    out_of = directives.filter(F.col("source_session_id").isNotNull()).select(F.col("source_session_id").alias("session_id"), "id")
    if firings is not None:
        out_of = out_of.unionByName(firings.select("session_id", F.col("directive_id").alias("id")))
    # the calls are read four times below; keeping the four narrow columns costs less than
    # classifying every event again
    own = materialize(
        calls.select("call_id", "session_id", F.coalesce("repo", F.lit("")).alias("repo"), "hay"), "calls"
    )

    # a session asks in the scopes of its calls alone: what it excludes in others changes nothing
    scopes = own.select("session_id", F.explode(F.array("repo", F.lit(""))).alias("scope")).distinct()
    out_of = out_of.distinct().join(_spread(base.select("id", "scope").distinct()), "id").join(scopes, ["session_id", "scope"], "left_semi")
    out_of = materialize(out_of.select("session_id", "id", "scope"), "excluded")
    excluded = (
        out_of.join(_spread(tokens.select("id", "scope", "token").distinct()), ["id", "scope"])
        .groupBy("session_id", "scope", "token")
        .agg(F.count(F.lit(1)).alias("excluded"))
    )
    per_token = tokens.groupBy("scope", "token", "id").agg(
        F.min_by(F.struct("trigger_pos", "trigger"), F.col("trigger_pos")).alias("t"), F.first("seen").alias("seen"), F.first("pos").alias("pos")
    )
    w = Window.partitionBy("scope", "token").orderBy(F.col("seen").desc(), "pos")
    ranked = per_token.withColumn("place", F.row_number().over(w))
    top = ranked.filter(F.col("place") <= k).drop("place")
    # what moves up for a session: one place for each directive it excludes
    places = excluded.withColumn("place", F.explode(F.expr(f"sequence({k} + 1, cast({k} + excluded AS int))"))).drop("excluded")
    deeper = places.join(ranked, ["scope", "token", "place"]).drop("place")

    def open_to(asked: DataFrame) -> DataFrame:
        """The directives of each asked (session, scope, token) that can still reach a top k."""
        near = asked.join(top, ["scope", "token"])
        far = asked.join(deeper, ["session_id", "scope", "token"])
        return near.unionByName(far).join(out_of, ["session_id", "id", "scope"], "left_anti")

    fields = ["call_id", "session_id", "id", "token", "t", "seen", "pos"]
    hits = token_hits(own, real)
    by_hay = open_to(own.filter("hay <> ''").join(hits, ["repo", "hay"]).select("call_id", "session_id", "scope", "token")).select(*fields)
    # directives that need no hit: the k best once for each session and repo, then handed to its calls
    kind = F.when(F.col("hay") == "", F.lit(_ANY)).otherwise(F.lit(_FREE)).alias("token")
    asking = own.select("session_id", "repo", kind).distinct().withColumn("scope", F.explode(F.array_distinct(F.array("repo", F.lit("")))))
    best_first = Window.partitionBy("session_id", "repo", "token").orderBy(F.col("seen").desc(), "pos", "id")
    always = open_to(asking).withColumn("n", F.row_number().over(best_first)).filter(F.col("n") <= k)
    always = own.select("call_id", "session_id", "repo", kind).join(always.drop("scope"), ["session_id", "repo", "token"]).select(*fields)
    cand = by_hay.unionByName(always)
    size = F.when(F.col("token").isin(_FREE, _ANY), F.lit(0)).otherwise(F.length("token"))
    best = F.min_by(
        F.struct(size.alias("match_len"), F.col("t.trigger").alias("trigger"), "seen", "pos"),
        F.struct((-size).alias("l"), F.coalesce(F.col("t.trigger_pos"), F.lit(0)).alias("p"), "token"),
    )
    one = cand.groupBy("call_id", "session_id", "id").agg(best.alias("b")).select("call_id", "session_id", "id", "b.*")
    return rank_directives(one, ("call_id",), k)


def first_touch(calls: DataFrame, order: str = "event_id") -> DataFrame:
    """Calls to ask about: no earlier *answered* call of the session has the same
    handle. A failed recall records nothing, so its repeats stay."""
    first = calls.filter("answered").groupBy("session_id", "handle_key").agg(F.min(order).alias("__first"))
    out = calls.join(first, ["session_id", "handle_key"], "left")
    return out.filter(F.col("__first").isNull() | (F.col(order) <= F.col("__first"))).drop("__first")


def proactive_calls(events: DataFrame) -> DataFrame:
    """Edits always, shell commands only when they change something."""
    mutating = F.when(F.col("tool_name").isin(*SHELL_TOOLS), C.is_mutating(F.col("command"))).otherwise(F.lit(False))
    return events.filter(F.col("tool_name").isin(*EDIT_TOOLS) | mutating)


def reactive_calls(events: DataFrame) -> DataFrame:
    """Failing results with the error tail."""
    gate = events.filter(C.error_gate(F.col("response")))
    return gate.withColumn("error", C.error_tail(F.col("response"))).filter(F.col("error").isNotNull())


def render_directives(ranked: DataFrame) -> DataFrame:
    """D12 on (call_id, rank, type, content, trigger, triggers, as_of, seen): one block per
    call. A call holds at most k rows."""
    anchor = F.coalesce(
        F.concat(F.lit("fired on: "), F.nullif(strip_ws(F.col("trigger")), F.lit(""))),
        F.concat(F.lit("triggers: "), F.nullif(F.array_join(F.slice("triggers", F.lit(1), F.lit(4)), ", "), F.lit(""))),
    )
    notes = F.concat_ws(
        "; ",
        anchor,
        F.concat(F.lit("as of "), F.col("as_of").cast("string")),
        F.when(F.col("seen") > 1, F.concat(F.lit("seen "), F.col("seen").cast("string"), F.lit("×"))),
    )
    line = F.concat(
        F.lit("- **["), F.upper("type"), F.lit("]** "), strip_ws(F.col("content")),
        F.when(notes != "", F.concat(F.lit("  _("), notes, F.lit(")_"))).otherwise(F.lit("")),
    )
    lines = F.transform(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"])
    return ranked.groupBy("call_id").agg(F.array_join(lines, "\n").alias("context"))


def prune_firings(firings: DataFrame, now: int, keep: int | None = None, max_age_s: int = KEEP_FIRED_S) -> DataFrame:
    """Idle sessions are dropped; of the others all ids stay, or the last ``keep``."""
    w = Window.partitionBy("session_id").orderBy(F.col("ts_s").desc(), F.col("event_id").desc())
    last = firings if keep is None else firings.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= keep).drop("__k")
    live = firings.groupBy("session_id").agg(F.max("ts_s").alias("__t")).filter(F.col("__t") >= now - max_age_s)
    return last.join(live.select("session_id"), "session_id", "left_semi")


def merge_context(rows: DataFrame) -> DataFrame:
    """The contexts of an event's few sources in source order, blank ones dropped."""
    kept = rows.filter(F.coalesce(strip_ws(F.col("context")), F.lit("")) != "")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("source", "context"))), lambda x: x["context"])
    return kept.groupBy("event_id").agg(F.array_join(parts, "\n\n").alias("context"))


def parse_recall(is_error: Column, structured: Column, texts: Column) -> Column:
    """Items of a reply as ARRAY<VARIANT>: null is a failure, empty an answer."""
    objects = F.filter(F.transform(texts, F.try_parse_json), lambda v: v.isNotNull())
    inner = V.path(structured, "$.result")
    out = (
        F.when(V.is_kind(structured, "object") & V.path(structured, "$.items").isNull() & V.is_kind(inner, "object"), inner)
        .when(V.is_kind(structured, "object"), structured)
        .otherwise(F.get(objects, F.lit(0)))
    )
    items = V.items(V.path(out, "$.items"))
    none = F.array().cast("array<variant>")
    return F.when(~F.coalesce(is_error, F.lit(False)) & V.is_kind(out, "object"), F.coalesce(items, none))


def token_noise(matches: DataFrame, calls: DataFrame, k: int = 20) -> DataFrame:
    """Injections driven by each matched token; matches are per distinct haystack and
    weighted by the calls that have it."""
    per = matches.groupBy("repo", "hay", "token").agg(F.count(F.lit(1)).alias("n"))
    weight = calls.groupBy(F.coalesce("repo", F.lit("")).alias("repo"), "hay").agg(F.count(F.lit(1)).alias("calls"))
    out = per.join(weight, ["repo", "hay"]).groupBy("token").agg(F.sum(F.col("n") * F.col("calls")).alias("injections"))
    return out.orderBy(F.col("injections").desc(), "token").limit(k)
