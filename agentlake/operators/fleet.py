"""The board of parallel agents: folding events to state, siblings, deltas and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions import commands as C
from agentlake.functions import text as T
from agentlake.functions import times as TM
from agentlake.operators.ordered import WIDTH, previous

ACTIVE_STALE_S = 12 * 3_600
ENDED_KEEP_S = 3_600
LINE_FILES = 8  # files that a rendered line names; the board keeps all
COMMIT_FRESH_S = 120


def commit_updates(events: DataFrame, commits: DataFrame, width: int = WIDTH) -> DataFrame:
    """Commit events that change the board: a real commit command, a commit of the same
    repo made in the last two minutes, not the hash announced before, with all its files."""
    made = events.filter((F.col("event") == "post-tool") & C.is_git_commit(F.col("command")))
    got = made.join(
        commits.select("commit_hash", F.col("repo").alias("__repo"), "message", "files", F.col("at").alias("commit_at")), "commit_hash"
    ).filter((F.col("repo") == F.col("__repo")) & (F.col("ts_s") - F.col("commit_at") <= COMMIT_FRESH_S)).drop("__repo")
    seen = previous(got, ["session_id"], ["event_id"], {"__last": "commit_hash"}, width=width)
    return seen.filter(~F.col("commit_hash").eqNullSafe(F.col("__last"))).drop("__last")


def fold_board(events: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """One entry per session. A start or prompt registers or revives it and keeps what it
    had; commits and ends count only once it is registered. ``commits`` are the accepted ones
    of L04."""
    cols = ["repo", "session_id", "event_id", "ts_s", "event", "branch", "worktree"]
    none = F.lit(None)
    rows = events.filter(F.col("event") != "post-tool").select(
        *cols, T.working_on(F.col("prompt")).alias("wo"), none.cast("struct<hash:string,message:string,files:array<string>,at:bigint>").alias("commit")
    )
    if commits is not None:
        rows = rows.unionByName(
            commits.select(
                *cols, none.cast("string").alias("wo"),
                F.struct(F.col("commit_hash").alias("hash"), "message", "files", F.col("commit_at").cast("long").alias("at")).alias("commit"),
            )
        )
    opens = F.col("event").isin("session-start", "prompt")
    first = rows.filter(opens).groupBy("session_id").agg(F.min("event_id").alias("first"))
    live = rows.join(first, "session_id").filter(F.col("event_id") >= F.col("first"))
    at = F.col("event_id")
    enters = (F.col("event") == "session-start") | (at == F.col("first"))
    return live.groupBy("session_id").agg(
        F.first("repo").alias("repo"),
        F.min("ts_s").alias("started"),
        F.max("ts_s").alias("last_update"),
        F.when(F.max_by("event", F.when(F.col("event") != "post-tool", at)) == "session-end", "ended").otherwise("active").alias("status"),
        F.max_by("branch", F.when(enters | F.col("commit").isNotNull(), at)).alias("branch"),
        F.max_by("worktree", F.when(enters, at)).alias("worktree"),
        F.max_by("wo", F.when((F.col("event") == "prompt") & F.col("wo").isNotNull(), at)).alias("working_on"),
        F.max_by("commit", F.when(F.col("commit").isNotNull(), at)).alias("last_commit"),
    )


def prune_board(board: DataFrame, worktrees: DataFrame, now: int) -> DataFrame:
    """Without entries that ended an hour ago, were silent for 12 hours or lost their
    worktree."""
    silent = F.lit(now) - F.col("last_update")
    dead = ((F.col("status") == "ended") & (silent > ENDED_KEEP_S)) | ((F.col("status") == "active") & (silent > ACTIVE_STALE_S))
    return board.filter(~dead).join(worktrees.select("worktree").distinct(), "worktree", "left_semi")


def siblings(board: DataFrame, asking: DataFrame) -> DataFrame:
    """The other agents of the repo of each asking session (``session_id, repo``), ordered
    by id. Only sessions that ask are expanded, as only they are shown the board."""
    other = board.withColumnRenamed("session_id", "sibling")
    out = asking.select("session_id", "repo").join(other, "repo").filter(F.col("session_id") != F.col("sibling"))
    return out.orderBy("session_id", "sibling")


def snapshot_seen(board: DataFrame, asking: DataFrame) -> DataFrame:
    """What each asking session has now seen, one row per sibling."""
    return siblings(board, asking).select(
        "session_id", "sibling", F.col("last_update").alias("lu"), F.col("status").alias("st"),
        F.col("working_on").alias("wo"), F.col("last_commit.hash").alias("ch"),
    )


def board_delta(board: DataFrame, asking: DataFrame, seen: DataFrame, now: int) -> DataFrame:
    """One line per sibling that changed since the session's snapshot."""
    rows = siblings(board, asking).join(seen.withColumn("__seen", F.lit(True)).select("session_id", "sibling", "st", "wo", "ch", "__seen"), ["session_id", "sibling"], "left")
    c = F.col("last_commit")
    new = F.col("__seen").isNull()
    active = F.col("status") == "active"
    fresh = F.coalesce(c["hash"] != F.coalesce("ch", F.lit("")), F.lit(False))
    doing = F.coalesce(F.concat(F.lit(" — working on: "), F.col("working_on")), F.lit(""))
    said = F.when(F.coalesce(c["message"], F.lit("")) != "", F.concat(F.lit(' — last commit: "'), c["message"], F.lit('"'))).otherwise("")
    said_new = F.when(fresh, said).otherwise("")
    files = F.array_join(F.slice(c["files"], F.lit(1), F.lit(LINE_FILES)), ", ")
    touching = F.when(files != "", F.concat(F.lit(" touching "), files)).otherwise("")
    refocused = F.col("working_on").isNotNull() & ~F.col("working_on").eqNullSafe(F.col("wo"))
    change = (
        F.when(new & active, "joined")
        .when(new, "already ended")
        .when((F.col("status") == "ended") & (F.col("st") == "active"), "ended")
        .when(active & (F.col("st") == "ended"), "rejoined")
        .when(fresh, "committed")
        .when(refocused, "refocused")
    )
    head = F.concat(F.lit("- `"), F.coalesce("branch", F.lit("?")), F.lit("` "))
    line = (
        F.when(change == "joined", F.concat(head, F.lit("joined the fleet"), doing, said))
        .when(change == "already ended", F.concat(head, F.lit("ended its session "), TM.ago(F.lit(now) - F.col("last_update")), said))
        .when(change == "ended", F.concat(head, F.lit("ended its session")))
        .when(change == "rejoined", F.concat(head, F.lit("rejoined the fleet"), doing, said_new))
        .when(change == "committed", F.concat(head, F.lit('committed "'), F.coalesce(c["message"], F.lit("")), F.lit('"'), touching))
        .when(change == "refocused", F.concat(head, F.lit("is now working on: "), F.col("working_on")))
    )
    return rows.select("session_id", "sibling", change.alias("change"), line.alias("line")).filter(F.col("change").isNotNull())


def render_line(now: int) -> Column:
    """The board line of an entry."""
    c = F.col("last_commit")
    more = F.size(c["files"]) - 3
    files = F.concat(
        F.array_join(F.slice(c["files"], F.lit(1), F.lit(3)), ", "),
        F.when(more > 0, F.concat(F.lit(" +"), more.cast("string"), F.lit(" more"))).otherwise(""),
    )
    since = TM.ago(F.lit(now) - F.col("last_update"))
    return F.concat_ws(
        " ",
        F.concat(F.lit("- `"), F.coalesce("branch", F.lit("?")), F.lit("`")),
        F.when(F.col("status") == "ended", F.concat(F.lit("(ended "), since, F.lit(")"))).otherwise(
            F.concat(F.lit("(active, last update "), since, F.lit(")"))
        ),
        F.concat(F.lit("— working on: "), F.col("working_on")),
        F.when(
            c.isNotNull(),
            F.concat(
                F.lit("— last commit "), TM.ago(F.lit(now) - c["at"]), F.lit(': "'), F.coalesce(c["message"], F.lit("")), F.lit('"'),
                F.when(files != "", F.concat(F.lit(" ["), files, F.lit("]"))).otherwise(""),
            ),
        ),
        F.concat(F.lit("— worktree "), F.coalesce("worktree", F.lit("?"))),
        F.concat(F.lit("— session "), F.left("session_id", F.lit(8))),
    )


def fleet_status(board: DataFrame, now: int) -> DataFrame:
    """Active first, newest first; active but silent for over an hour is ``stale?``."""
    silent = F.lit(now) - F.col("last_update")
    return board.withColumns(
        {"stale": (F.col("status") == "active") & (silent > 3_600), "seen_ago": TM.ago(silent)}
    ).orderBy((F.col("status") == "active").desc(), F.col("last_update").desc(), "session_id")


def collisions(board: DataFrame) -> DataFrame:
    """Files in the last commit of more than one agent of a repo, one row per agent and
    file with how many agents share it. Agents of one (repo, file) collide with each other;
    the pairs are not written out, so a file everybody touched stays linear."""
    rows = board.select("repo", "session_id", F.explode(F.array_distinct("last_commit.files")).alias("file"))
    shared = rows.groupBy("repo", "file").agg(F.count(F.lit(1)).alias("agents")).filter(F.col("agents") > 1)
    return rows.join(shared, ["repo", "file"])


def fleet_summary(board: DataFrame) -> DataFrame:
    """L10 per repo."""
    return board.groupBy("repo").agg(
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_distinct(F.when(F.col("status") == "active", F.col("worktree"))).alias("worktrees"),
        F.max("last_commit.at").alias("newest_commit_at"),
        F.max_by("branch", F.struct("last_commit.at", "session_id")).alias("newest_commit_branch"),
    )
