"""Rooms, organisations and the routing of sessions and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agentlake.operators.ordered import WIDTH, position

MISS_TTL_S = 86_400
PROBE_BACKOFF_S = 300
ROOM_FIELDS = ("brain_id", "org_id", "resolved_at", "missed_at", "probed_at")
ROOM_KEY = ["room_name", "env"]


def route(sessions: DataFrame, rooms: DataFrame) -> DataFrame:
    """The space of a session's room; sessions without one stay personal."""
    known = rooms.filter(F.col("brain_id").isNotNull()).select(*ROOM_KEY, "brain_id", "org_id")
    return sessions.join(known, ROOM_KEY, "left").withColumn(
        "target", F.when(F.col("brain_id").isNull(), "personal").otherwise("room")
    )


def route_artifacts(artifacts: DataFrame, rooms: DataFrame) -> DataFrame:
    """J02 on (explicit_id, file_room, caller_room, env, opt_out): explicit id, then the
    file's own repo, then the caller's. A file in a repo without a space stays personal."""
    known = rooms.filter(F.col("brain_id").isNotNull())
    by_file = known.select(F.col("room_name").alias("file_room"), "env", F.col("brain_id").alias("__file"))
    by_caller = known.select(F.col("room_name").alias("caller_room"), "env", F.col("brain_id").alias("__caller"))
    out = artifacts.join(by_file, ["file_room", "env"], "left").join(by_caller, ["caller_room", "env"], "left")
    brain = (
        F.when(F.col("explicit_id").isNotNull(), F.col("explicit_id"))
        .when(F.coalesce("opt_out", F.lit(False)), F.lit(None).cast("string"))
        .when(F.col("file_room").isNotNull(), F.col("__file"))
        .otherwise(F.col("__caller"))
    )
    return out.select(*artifacts.columns, brain.alias("brain_id"))


def order_orgs(orgs: DataFrame, width: int = WIDTH) -> DataFrame:
    """J05 on (account, pos, org_id, is_default): ``rank`` inside the account, default first,
    input order kept, rows without an id dropped."""
    good = orgs.filter(F.coalesce("org_id", F.lit("")) != "").withColumn("__later", ~F.coalesce("is_default", F.lit(False)))
    return position(
        good, ["account"], ["__later", "pos"], "rank", bucket=F.struct("__later", F.floor(F.col("pos") / width))
    ).drop("__later")


def scope_guard(listings: DataFrame) -> DataFrame:
    """A listing whose echoed organisation differs fails; without an echo its rows count
    but stay without an organisation."""
    echo = F.col("applied_org_name")
    named = F.col("org_name").isNotNull()
    wrong = F.coalesce(named & (echo != "") & (echo != F.col("org_name")), F.lit(False))
    return listings.withColumns(
        {
            "ok": F.col("ok") & ~wrong,
            "attributed_org": F.when(~named | (F.coalesce(echo, F.lit("")) != ""), F.col("org_id")),
        }
    )


def resolve_brains(repos: DataFrame, listings: DataFrame, orgs_known: bool = True) -> DataFrame:
    """J03 on repos (room_name) and listing rows (org_id, org_name, applied_org_name, ok,
    rank, brain_id, brain_name): commit, backoff, refuse or miss.

    With a column ``account`` on both sides each account is decided by its own listings alone;
    without it the pass is one account's. The match is one equi join on the name; whether every
    listing of an account answered is one row per account."""
    account = ["account"] if "account" in repos.columns and "account" in listings.columns else []
    rows = scope_guard(listings)
    good = F.col("ok") & (F.coalesce("brain_id", F.lit("")) != "")
    hits = rows.filter(good).groupBy(*account, F.col("brain_name").alias("room_name")).agg(
        F.min("brain_id").alias("lo"),
        F.max("brain_id").alias("hi"),
        F.min_by("attributed_org", F.when(F.col("attributed_org").isNotNull(), F.col("rank"))).alias("org"),
    )
    out = repos.join(hits, [*account, "room_name"], "left")
    if account:
        answered = rows.groupBy("account").agg(F.bool_and("ok").alias("listings_ok"))
        out = out.join(answered, "account", "left").withColumn("listings_ok", F.coalesce("listings_ok", F.lit(True)))
    else:
        out = out.withColumn("listings_ok", rows.agg(F.coalesce(F.bool_and("ok"), F.lit(True))).scalar())
    one = F.col("lo") == F.col("hi")
    decision = (
        F.when(F.col("lo").isNotNull() & one & F.col("listings_ok"), "commit")
        .when(~F.col("listings_ok"), "backoff")
        .when(F.col("lo").isNotNull(), "refuse")
        .otherwise("miss" if orgs_known else "backoff")
    )
    return out.select(
        *repos.columns,
        decision.alias("decision"),
        F.when(decision == "commit", F.col("lo")).alias("brain_id"),
        F.when(decision == "commit", F.col("org")).alias("org_id"),
    )


def resolve_due(now: int, exists: Column | None = None) -> Column:
    """J06 over room columns."""
    age = lambda c: F.lit(now) - F.coalesce(F.col(c), F.lit(0))
    id_ = F.coalesce("brain_id", F.lit("")) != ""
    org = F.coalesce("org_id", F.lit("")) != ""
    due = (
        F.when(age("probed_at") < PROBE_BACKOFF_S, False)
        .when(id_ & org, False)
        .when(id_, age("resolved_at") > MISS_TTL_S)
        .otherwise(age("missed_at") > MISS_TTL_S)
    )
    return due if exists is None else F.when(~F.coalesce(exists, F.lit(False)), True).otherwise(due)


def upsert_rooms(rooms: DataFrame, updates: DataFrame) -> DataFrame:
    """An update replaces its whole (room, env) entry; all others stay."""
    cols = [*ROOM_KEY, *ROOM_FIELDS]
    return rooms.join(updates.select(*ROOM_KEY), ROOM_KEY, "left_anti").select(*cols).unionByName(updates.select(*cols))


def apply_misses(rooms: DataFrame, misses: DataFrame) -> DataFrame:
    """A miss replaces the entry, but never one with a space id."""
    out = rooms.join(misses.select(*ROOM_KEY, F.col("at").alias("__at")), ROOM_KEY, "full_outer")
    keep = F.col("__at").isNull() | (F.coalesce("brain_id", F.lit("")) != "")
    return out.select(
        *ROOM_KEY,
        *[F.when(keep, F.col(c)).alias(c) for c in ROOM_FIELDS if c != "missed_at"],
        F.when(keep, F.col("missed_at")).otherwise(F.col("__at")).alias("missed_at"),
    )


def apply_probes(rooms: DataFrame, probes: DataFrame) -> DataFrame:
    """A backoff stamp touches neither id nor miss."""
    out = rooms.join(probes.select(*ROOM_KEY, F.col("at").alias("__at")), ROOM_KEY, "full_outer")
    return out.select(
        *ROOM_KEY, *[F.col(c) for c in ROOM_FIELDS if c != "probed_at"], F.coalesce("__at", "probed_at").alias("probed_at")
    )


def forget_rooms(rooms: DataFrame, keys: DataFrame) -> DataFrame:
    """A repo without any entry left is gone by itself."""
    return rooms.join(keys.select(*ROOM_KEY), ROOM_KEY, "left_anti")


def reroute(imports: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(resend, forget)`` for imports refused because their space does not exist.
    Only entries with a known folder are forgotten."""
    dead = imports.join(
        replies.filter(F.col("is_error") & F.col("missing_brain")).select("import_id"), "import_id", "left_semi"
    ).filter(F.col("brain_id").isNotNull())
    resend = dead.withColumns({"brain_id": F.lit(None).cast("string"), "org_id": F.lit(None).cast("string")})
    forget = dead.filter(F.col("cwd").isNotNull()).select(*ROOM_KEY).distinct()
    return resend, forget


def match_brain(names: DataFrame, brains: DataFrame, near: int | None = None) -> DataFrame:
    """Exact name match; a name without one gets near candidates, never a pick.

    Near means the same base name (last path segment, letter case aside). All such brains are
    candidates; ``near`` shows only the first so many of a base name next to their count."""
    hit = (
        names.select("name").distinct()
        .join(brains.select(F.col("brain_name").alias("name"), "brain_id"), "name")
        .groupBy("name")
        .agg(F.min("brain_id").alias("brain_id"), F.max("brain_id").alias("__hi"))
    )
    base = lambda c: F.lower(F.substring_index(c, "/", -1))
    rest = names.select("name").distinct().join(hit.select("name"), "name", "left_anti").withColumn("base", base(F.col("name")))
    known = brains.select("brain_name").distinct().withColumn("base", base(F.col("brain_name")))
    counts = known.groupBy("base").agg(F.count(F.lit(1)).alias("candidates"))
    w = Window.partitionBy("base").orderBy("brain_name")
    first = known if near is None else known.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= near).drop("__k")
    shown = rest.join(first.join(counts, "base"), "base", "left")
    one = F.col("brain_id") == F.col("__hi")
    exact_rows = hit.select(
        "name",
        F.when(one, "exact").otherwise("ambiguous").alias("state"),
        F.when(one, F.col("brain_id")).alias("brain_id"),
        F.lit(None).cast("string").alias("candidate"),
        F.lit(0).cast("long").alias("candidates"),
    )
    return exact_rows.unionByName(
        shown.select(
            "name",
            F.when(F.col("brain_name").isNull(), "none").otherwise("near").alias("state"),
            F.lit(None).cast("string").alias("brain_id"),
            F.col("brain_name").alias("candidate"),
            F.coalesce("candidates", F.lit(0)).alias("candidates"),
        )
    )
