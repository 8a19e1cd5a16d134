"""Capture gates, capture state, health and briefs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions.text import strip_ws
from agentlake.functions import commands as C
from agentlake.functions import ids as I
from agentlake.functions import times as TM
from agentlake.functions import values as V
from agentlake.operators.ordered import WIDTH, Running, previous, running

DORMANT_RETRY_S = 1_800
ERROR_COOLDOWN_S = 60
EDIT_DEBOUNCE_S = 120
MAX_UNCONFIRMED = 5


def _n(c: Column, default: int = 0) -> Column:
    return F.coalesce(c, F.lit(default))


def codex_session_id(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """identity of an event from its path and id against the stored rollouts.

    A path outside the store, a path and an id that disagree, ``latest`` and path-shaped ids
    are refused."""
    known = catalog.select("path", I.rollout_session(F.col("path")).alias("stored"))
    by_path = known.select(F.col("path").alias("transcript_path"), F.col("stored").alias("from_path"))
    by_id = known.groupBy(F.col("stored").alias("session_id")).agg(F.count(F.lit(1)).alias("files"))
    out = events.join(by_path, "transcript_path", "left").join(by_id, "session_id", "left")
    tp = F.coalesce(strip_ws(F.col("transcript_path")) != "", F.lit(False))
    sid = F.coalesce(strip_ws(F.col("session_id")) != "", F.lit(False))
    status = (
        F.when(tp & F.col("from_path").isNull(), "refused")
        .when(tp & sid & (F.col("from_path") != F.col("session_id")), "refused")
        .when(tp, "ok")
        .when(sid & ((F.col("session_id") == "latest") | F.col("session_id").contains("/")), "refused")
        .when(sid & (F.col("files") == 1), "ok")
        .when(sid & (F.col("files") > 1), "refused")
        .otherwise("missing")
    )
    out = out.withColumn("status", status)
    return out.withColumn(
        "sid", F.when(F.col("status") == "ok", I.flat_id(F.coalesce("from_path", "session_id")))
    ).drop("from_path", "files")


def trusted_offset(offset: Column, size: Column) -> Column:
    """A cursor only counts inside the file, else the file is read from the start."""
    n = offset.try_cast("long")
    return F.when((n >= 0) & (n <= size), n).otherwise(F.lit(0).cast("long"))


def flush_due_claude(
    session_id: Column, transcript: Column, size: Column, offset: Column, in_flight: Column, dormant: Column, off: Column | None = None
) -> Column:
    """Per-turn gate. No readable cursor yet means flush; otherwise any size change."""
    n = offset.try_cast("long")
    out = (
        F.when(_n(strip_ws(session_id), "") == "", False)
        .when(_n(strip_ws(transcript), "") == "", False)
        .when(_n(size) <= 0, False)
        .when(F.coalesce(in_flight, F.lit(False)), False)
        .when(n.isNull(), True)
        .when(F.coalesce(dormant, F.lit(False)), False)
        .otherwise(size != n)
    )
    return out if off is None else F.when(F.coalesce(off, F.lit(False)), False).otherwise(out)


def _dormant(unsupported: Column, unsupported_at: Column, now: Column) -> Column:
    return F.coalesce(unsupported, F.lit(False)) & (now - _n(unsupported_at) < DORMANT_RETRY_S)


def flush_due_codex(event: Column, command: Column, size: Column, watermark: Column, unsupported: Column, unsupported_at: Column, now: Column) -> Column:
    """H03."""
    w = _n(watermark)
    return (
        F.when(size < w, True)
        .when(_dormant(unsupported, unsupported_at, now), False)
        .when(size <= w, False)
        .when(event == "Stop", True)
        .when(event == "PostToolUse", C.is_milestone(command, "agent"))
        .otherwise(False)
    )


def flush_due_cursor(event: Column, command: Column, new_blobs: Column, unsupported: Column, unsupported_at: Column, last_flush_at: Column, now: Column) -> Column:
    """H04; ``new_blobs`` is the count of J12."""
    return (
        F.when(_dormant(unsupported, unsupported_at, now), False)
        .when(_n(new_blobs) == 0, False)
        .when(event == "beforeShellExecution", C.is_milestone(command, "agent"))
        .when(event == "afterFileEdit", now - _n(last_flush_at) > EDIT_DEBOUNCE_S)
        .otherwise(event.isin("stop", "beforeSubmitPrompt"))
    )


def cooldown(event: Column, last_error_at: Column, now: Column) -> Column:
    """True when the event must wait after a recent error."""
    return (event != "Stop") & (now - _n(last_error_at) < ERROR_COOLDOWN_S)


def merge_state(log: DataFrame, fields: list[str], keys: tuple[str, ...] = ("session_id",), at: str = "at") -> DataFrame:
    """Latest state per key, field by field. Each field is a ``struct<v>``: null means
    the write did not name it, a struct with a null inside means it was cleared."""
    return log.groupBy(*keys).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(at))).getField("v").alias(f) for f in fields]
    )


def state_writes(attempts: DataFrame) -> DataFrame:
    """What each attempt writes to the state. ``kind``: ok, local (inert batch),
    unsupported, or an error slug."""
    kind = F.col("kind")
    failed = ~kind.isin("ok", "local", "unsupported")
    clears = kind.isin("ok", "unsupported")

    def put(value: Column, type_: str, *when: Column) -> Column:
        named = when[0]
        return F.when(named, F.struct(value.cast(type_).alias("v")))

    return attempts.select(
        "session_id",
        "at",
        put(F.col("offset_after"), "long", kind.isin("ok", "local")).alias("offset"),
        put(F.col("at"), "long", kind == "ok").alias("last_ok_at"),
        F.coalesce(put(kind, "string", failed), put(F.lit(None), "string", clears)).alias("last_error"),
        F.coalesce(put(F.col("at"), "long", failed), put(F.lit(None), "long", clears)).alias("last_error_at"),
        put(F.lit(True), "boolean", kind == "unsupported").alias("unsupported"),
    )


# Attempts that reached the server and failed; the others never count as failures.
NEUTRAL = ("no_credential", "empty", "resolve_error")


def dormancy(attempts: DataFrame, order: str = "event_id", at: str = "ts_s", limit: int = MAX_UNCONFIRMED, width: int = WIDTH) -> DataFrame:
    """Failure streak and dormancy after every attempt ``(session_id, outcome)``.

    A success wakes the session; a neutral outcome clears the streak but not the dormancy.
    Since the streak restarts at zero whenever dormancy begins or ends, the state follows
    from two running values: failures since the last clearing attempt, and whether that
    count has reached the limit since the last success."""
    ok = F.col("outcome") == "ok"
    neutral = F.col("outcome").isin(*NEUTRAL)
    failed = ~ok & ~neutral
    rows = attempts.withColumns({"__ok": ok, "__clear": ok | neutral, "__fail": failed})
    key, seq = ["session_id"], [order]
    rows = running(
        rows, key, seq,
        {"__fails": Running("count", F.col("__fail")), "__oks": Running("count", F.col("__ok")), "__clears": Running("count", F.col("__clear"))},
        width=width,
    )
    # failures up to the last clearing attempt, so the difference is the current streak
    rows = running(
        rows, key, seq, {"__base": Running("last", F.when(F.col("__clear"), F.col("__fails")))}, width=width
    ).withColumn("__streak", F.col("__fails") - F.coalesce("__base", F.lit(0)))
    # the session is dormant once a streak reached the limit after the last success
    rows = running(
        rows, key, seq,
        {
            "__hit": Running("max", F.when(F.col("__fail") & (F.col("__streak") >= limit), F.col("__oks"))),
            "__timer": Running("last", F.when(F.col("__fail") & (F.col("__streak") >= 1), F.struct(F.col(at).alias("t"), F.col("__oks").alias("oks")))),
        },
        width=width,
    )
    dormant = F.coalesce(F.col("__hit") == F.col("__oks"), F.lit(False))
    return rows.select(
        *attempts.columns,
        F.when(dormant, F.lit(0)).otherwise(F.col("__streak")).cast("long").alias("fail_streak"),
        dormant.alias("dormant"),
        F.when(dormant, F.col("__timer.t")).alias("unsupported_at"),
    )


def pick_ack(replies: DataFrame) -> DataFrame:
    """The ack among the wrapped candidates of each reply
    ``(reply_id, conversation_id, is_error, structured VARIANT, texts ARRAY<STRING>)``."""
    none = F.array().cast("array<variant>")
    parsed = F.filter(F.transform("texts", F.try_parse_json), lambda v: F.coalesce(V.is_kind(v, "object"), F.lit(False)))
    first = F.when(V.is_kind(F.col("structured"), "object"), F.array("structured")).otherwise(none)
    rows = replies.withColumn("__d", F.concat(first, F.coalesce(parsed, none)))
    rows = rows.withColumn(
        "__c",
        F.flatten(
            F.transform(
                "__d",
                lambda d: F.when(V.is_kind(V.path(d, "$.result"), "object"), F.array(d, V.path(d, "$.result"))).otherwise(F.array(d)),
            )
        ),
    )
    rows = rows.withColumn("__own", F.filter("__c", lambda c: F.coalesce(V.text_at(c, "$.conversation_id") == F.col("conversation_id"), F.lit(False))))
    confirms = F.filter("__own", lambda c: F.coalesce(V.text_at(c, "$.ack_through") != "", F.lit(False)))
    keyed = F.filter("__own", lambda c: V.path(c, "$.ack_through").isNotNull())
    pick = F.coalesce(F.get(confirms, F.lit(0)), F.get(keyed, F.lit(0)), F.get("__own", F.lit(0)))
    return rows.withColumn("ack", pick).drop("__d", "__c", "__own")


def verdict(is_error: Column, ack: Column) -> Column:
    """Absent, null and empty differ; only a non-empty ack confirms."""
    through = V.path(ack, "$.ack_through")
    dropped = F.coalesce(F.try_variant_get(ack, "$.records_dropped", "bigint"), F.lit(0))
    return (
        F.when(F.coalesce(is_error, F.lit(False)), "unconfirmed")
        .when(ack.isNull(), "unconfirmed")
        .when(dropped > 0, "unconfirmed")
        .when(through.isNull(), "unsupported")
        .when(F.coalesce(V.text_at(ack, "$.ack_through"), F.lit("")) == "", "unconfirmed")
        .otherwise("ok")
    )


def classify(
    status: Column, timed_out: Column, out_of_budget: Column, no_answer: Column, is_error: Column, has_ack_body: Column, has_ack_key: Column, failed: Column | None = None
) -> Column:
    """Outcome class of an attempt."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = (
        F.when(yes(out_of_budget), "budget_exhausted")
        .when(yes(timed_out), "timeout")
        .when(status == 429, "rate_limited")
        .when(status == 401, "auth")
        .when(status == 403, "forbidden")
        .when(status >= 400, "error")
    )
    if failed is not None:
        out = out.when(yes(failed), "error")
    return (
        out.when(yes(no_answer), "unrecognized_response")
        .when(yes(is_error), "server_rejected")
        .when(~yes(has_ack_body), "unrecognized_response")
        .when(~yes(has_ack_key), "unsupported")
        .otherwise("ok")
    )


def recent_failure(state: DataFrame, now: int, window_s: int = 86_400, by: str = "session_id") -> DataFrame:
    """For each session (or other column ``by``, such as an account) the newest failure of
    the last day, unless some path of its session succeeded at or after it."""
    bad = state.filter(F.col("last_error").isNotNull() & (F.col("last_error_at") >= now - window_s))
    good = state.filter(F.col("last_ok_at").isNotNull()).groupBy("session_id").agg(F.max("last_ok_at").alias("__ok"))
    live = bad.join(good, "session_id", "left").filter(F.col("__ok").isNull() | (F.col("__ok") < F.col("last_error_at")))
    row = F.struct("session_id", "capture_path", "last_error", "last_error_at")
    newest = F.struct(F.col("at"), -F.xxhash64("session_id", "capture_path").cast("decimal(20,0)")) if by != "session_id" else F.struct(F.col("at"), "capture_path")
    return live.groupBy(F.col(by).alias("__by")).agg(F.max_by(row, newest).alias("r")).select("r.*")


def credential_state(rows: DataFrame, now: int) -> DataFrame:
    """H13 on one row per host: explicit_token BOOLEAN, has_key, key_expires_s, has_login,
    refresh BOOLEAN, exp_s. Null state means healthy."""
    left = F.col("key_expires_s") - now
    key = (
        F.when(~F.coalesce("has_key", F.lit(False)), "none")
        .when(F.col("key_expires_s").isNull(), "healthy")
        .when(left <= 0, "expired")
        .when(left <= 7 * 86_400, "expiring")
        .otherwise("healthy")
    )
    refresh = F.coalesce("refresh", F.lit(False))
    expired = F.coalesce(F.col("exp_s") <= now, F.lit(False))
    state = (
        F.when(F.coalesce("explicit_token", F.lit(False)), F.lit(None).cast("string"))
        .when(F.col("__key") == "healthy", F.lit(None).cast("string"))
        .when(F.col("__key") == "expiring", "key_expiring")
        .when(~F.coalesce("has_login", F.lit(False)) & (F.col("__key") == "expired"), "key_expired")
        .when(~F.coalesce("has_login", F.lit(False)), "never")
        .when(refresh, F.lit(None).cast("string"))
        .when(expired, "unrenewable")
        .when(F.col("exp_s").isNull() | (F.col("exp_s") - now <= 6 * 3600), "no_refresh")
    )
    return rows.withColumn("__key", key).withColumn("state", state).drop("__key")


# Why a capture attempt failed, by outcome class.
REASONS = {
    "auth": "the plugin's saved login expired and could not be renewed",
    "server_rejected": "the server rejected the last upload",
    "rate_limited": "capture is being throttled and is retrying on its own",
    "forbidden": "the credential is valid but not permitted to write here (check its scopes and org access)",
    "unrecognized_response": "the server sent a reply the plugin could not read",
    "timeout": "the server stopped responding",
    "budget_exhausted": "capture ran out of time before it finished sending",
    "error": "the capture hook hit an unexpected error",
}
CREDENTIAL_NOTES = {
    "never": "Capture is not authenticated for {host}.",
    "unrenewable": "Capture is broken: the saved login for {host} expired and cannot be renewed.",
    "key_expired": "Capture is not running: its access key for {host} has expired.",
    "key_expiring": "The access key of capture for {host} expires soon.",
    "no_refresh": "Capture for {host} will stop soon: its login has no refresh token.",
}


def health_message(host: Column, credential: Column, reason: Column, failed_at: Column, now: int) -> Column:
    """A credential problem outranks a failure; unknown reasons get a general text."""
    out = None
    for state, note in CREDENTIAL_NOTES.items():
        head, tail = note.split("{host}")
        text = F.concat(F.lit(head), host, F.lit(tail))
        out = F.when(credential == state, text) if out is None else out.when(credential == state, text)
    table = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    detail = F.coalesce(F.try_element_at(table, reason), F.lit("the capture hook failed"))
    ago = TM.ago(F.lit(now) - failed_at, "health")
    return out.when(reason.isNotNull(), F.concat(F.lit("Capture last failed "), ago, F.lit(" — "), detail, F.lit(".")))


def first_warnings(warnings: DataFrame, order: str = "event_id", width: int = WIDTH) -> DataFrame:
    """A warning shows when its signature differs from the session's last one; without
    a session it always shows."""
    named = warnings.filter(F.coalesce(F.col("session_id"), F.lit("")) != "")
    open_ = warnings.filter(F.coalesce(F.col("session_id"), F.lit("")) == "")
    seen = previous(named, ["session_id"], [order], {"__last": "signature"}, width=width)
    return seen.filter(~F.col("signature").eqNullSafe(F.col("__last"))).drop("__last").unionByName(open_)


def stale_overviews(cache: DataFrame, now: int, max_age_s: int = 6 * 3600) -> DataFrame:
    """Overviews to fetch again."""
    return cache.filter(F.lit(now) - F.coalesce("refreshed_at", F.lit(0)) >= max_age_s)


def brain_changes(briefs: DataFrame, order: str = "event_id", width: int = WIDTH) -> DataFrame:
    """Briefs whose space differs from the one last announced for the room."""
    out = previous(briefs, ["room_name", "env"], [order], {"__last": "brain_id"}, width=width)
    return out.filter(~F.col("brain_id").eqNullSafe(F.col("__last"))).drop("__last")


def session_brief(sessions: DataFrame, rooms: DataFrame, overviews: DataFrame, n: int = 1_800) -> DataFrame:
    """One brief per session of a repo with a known space; silent otherwise."""
    from agentlake.functions.text import clip

    known = rooms.filter(F.col("brain_id").isNotNull()).select("room_name", "env", "brain_id")
    out = sessions.join(known, ["room_name", "env"]).join(overviews.select("brain_id", "overview"), "brain_id", "left")
    text = F.coalesce(F.nullif(clip(F.col("overview"), n, "\n… (truncated)"), F.lit("")), F.lit("none cached"))
    return out.select(*sessions.columns, "brain_id", F.when(F.col("capture_on"), "on").otherwise("off").alias("writes"), text.alias("digest"))


def key_audit(keys: DataFrame, held: DataFrame, max_keys: int = 5) -> DataFrame:
    """Per account and label, live keys whose secret nobody holds, and whether a new key
    fits under the cap counted over the account's other labels."""
    live = keys.filter(F.col("revoked_at").isNull())
    mine = live.join(held.select("id").distinct().withColumn("__held", F.lit(True)), "id", "left")
    per = mine.groupBy("account", "label").agg(
        F.count(F.lit(1)).alias("live"), F.count_if(F.col("__held").isNull()).alias("orphans")
    )
    total = live.groupBy("account").agg(F.count(F.lit(1)).alias("__all"))
    return per.join(total, "account").select(
        "account", "label", "live", "orphans", (F.col("__all") - F.col("live") < max_keys).alias("can_mint")
    )
