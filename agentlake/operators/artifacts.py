"""Governed artifacts, their links and their versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions.globs import compile_glob, compile_keys, path_keys
from agentlake.operators.ordered import WIDTH, position
from agentlake.session import materialize


def compiled_links(links: DataFrame) -> DataFrame:
    """links with a usable glob and its pattern, compiled once per distinct glob."""
    good = links.filter(F.col("glob").isNotNull() & F.col("artifact_id").isNotNull() & F.col("brain_id").isNotNull())
    globs = good.select("glob").distinct().select("glob", compile_glob("glob").alias("regex"), compile_keys("glob").alias("keys"))
    return good.join(globs, "glob").filter(F.col("regex").isNotNull())


def candidates(paths: DataFrame, compiled: DataFrame) -> DataFrame:
    """Rows of ``paths`` (repo, rel_path, ..) with the compiled links of their repo that agree with
    the path in depth and in every segment a glob spells out, by equality alone. A repo has few
    shapes of globs however many links it has, so a path makes one key for each of them."""
    shapes = compiled.select("repo", F.explode("keys.shape").alias("shape")).groupBy("repo").agg(F.collect_set("shape").alias("shapes"))
    keyed = paths.join(shapes, "repo").withColumn("k", F.explode(path_keys(F.col("rel_path"), F.col("shapes")))).drop("shapes")
    by_key = compiled.withColumn("k", F.explode("keys")).drop("keys")
    return keyed.select("*", "k.shape", "k.key").drop("k").join(by_key.select("*", "k.shape", "k.key").drop("k"), ["repo", "shape", "key"]).drop("shape", "key")


def governing_artifacts(edits: DataFrame, links: DataFrame) -> DataFrame:
    """Links whose glob covers an edited path of the same repo.

    Candidates agree in depth and spelled-out segments (``candidates``); the pattern test, for
    wildcards inside a segment and texts between two ``**``, then runs on distinct (repo, path)
    only, and edits join their path's result by equality."""
    paths = edits.select("repo", "rel_path").distinct()
    hit = candidates(paths, compiled_links(links)).filter(F.rlike(F.col("rel_path"), F.col("regex"))).drop("regex", "glob")
    return edits.join(hit.distinct(), ["repo", "rel_path"])


def first_reminders(matches: DataFrame, order: str = "event_id") -> DataFrame:
    """The first match per (session, artifact), by a partial aggregate."""
    rest = [c for c in matches.columns if c not in ("session_id", "artifact_id")]
    return matches.groupBy("session_id", "artifact_id").agg(F.min_by(F.struct(*rest), order).alias("m")).select(
        "session_id", "artifact_id", "m.*"
    )


def render_reminder(path: Column, name: Column, artifact_id: Column, brain_id: Column) -> Column:
    """A04."""
    n = F.coalesce(F.nullif(name, F.lit("")), F.lit("(unnamed artifact)"))
    return F.format_string(
        'You edited %s, governed by artifact "%s" (id %s, space %s). '
        "If the change alters what it says, save a new version with parent_id=%s.",
        path, n, artifact_id, brain_id, artifact_id,
    )


def upsert_links(links: DataFrame, updates: DataFrame, key: tuple[str, ...] = ("artifact_id",)) -> DataFrame:
    """One link per artifact, the last write (column ``at``) wins."""
    both = links.unionByName(updates)
    rest = [c for c in both.columns if c not in key]
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), "at").alias("l")).select(*key, "l.*")


def links_for(links: DataFrame, path: str | None = None) -> DataFrame:
    """All links, or those that govern one path."""
    rows = compiled_links(links)
    return rows if path is None else rows.filter(F.rlike(F.lit(path), F.col("regex")))


def lineage_roots(artifacts: DataFrame) -> DataFrame:
    """The root of every version, by doubling: each round replaces a pointer by its
    target's pointer, so a chain of n versions takes about log2(n) joins. A pointer that has
    reached its root is done and takes no part in later joins."""
    ids = artifacts.select(F.col("artifact_id").alias("parent_id")).withColumn("__known", F.lit(True))
    # a parent that is not in the table starts its own lineage
    start = artifacts.select("artifact_id", "parent_id").join(ids, "parent_id", "left").select(
        F.col("artifact_id").alias("id"),
        F.when(F.col("__known"), F.col("parent_id")).otherwise(F.col("artifact_id")).alias("up"),
        F.col("__known").isNull().alias("done"),
    )
    pending = materialize(start, "lineage")
    finished, left, rounds = pending.filter("done").select("id", "up"), pending.filter("NOT done").count(), 0
    open_rows = left
    while left:
        # a chain of n versions is done after log2(n) rounds; what is left then runs in a circle
        if rounds > open_rows.bit_length() + 1:
            raise RuntimeError(f"{left} versions are their own ancestors")
        target = pending.select(F.col("id").alias("up"), F.col("up").alias("next"), "done")
        closed = finished.select(F.col("id").alias("up"), F.col("up").alias("next"), F.lit(True).alias("done"))
        moved = pending.filter("NOT done").select("id", "up").join(target.filter("NOT done").unionByName(closed), "up").select("id", F.col("next").alias("up"), "done")
        pending, rounds = materialize(moved, "lineage"), rounds + 1  # finished pointers are written once
        finished = finished.unionByName(pending.filter("done").select("id", "up"))
        left = pending.filter("NOT done").count()
    return finished


def lineage(artifacts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Root and version number of every version. A version without a parent extends the
    lineage of its name, so lineages of one name are one; numbers follow creation."""
    roots = lineage_roots(artifacts).select(F.col("id").alias("artifact_id"), F.col("up").alias("__root"))
    rows = artifacts.join(roots, "artifact_id")
    named = rows.filter(F.col("artifact_id") == F.col("__root")).groupBy("name").agg(
        F.min_by("artifact_id", F.struct("created_s", "artifact_id")).alias("root_id")
    )
    own = rows.filter(F.col("artifact_id") == F.col("__root")).select(F.col("artifact_id").alias("__root"), "name").join(named, "name")
    out = rows.join(own.select("__root", "root_id"), "__root").drop("__root")
    return position(out, ["root_id"], ["created_s", "artifact_id"], "version", width=width * 600)


def current_versions(versions: DataFrame) -> DataFrame:
    """The newest version of each lineage."""
    rest = [c for c in versions.columns if c != "root_id"]
    return versions.groupBy("root_id").agg(F.max_by(F.struct(*rest), "version").alias("v")).select("root_id", "v.*")


def pick_file(given: Column, tagged: Column, slug: Column) -> Column:
    """A10: candidate paths of a local spec file, best first."""
    return F.filter(
        F.array(given, tagged, F.concat(F.lit("docs/specs/"), slug, F.lit(".md"))), lambda p: p.isNotNull()
    )


def local_files(specs: DataFrame, files: DataFrame) -> DataFrame:
    """A10: the first candidate that exists. ``specs``: root_id, candidates; ``files``: path,
    content."""
    cand = specs.select("root_id", F.posexplode("candidates").alias("at", "path"))
    found = cand.join(files, "path")
    return found.groupBy("root_id").agg(F.min_by(F.struct("path", "content"), "at").alias("f")).select("root_id", "f.*")


def spec_drift(files: DataFrame, versions: DataFrame) -> DataFrame:
    """A09 on files (root_id, content): in sync, spec moved (how many newer versions) or
    unlanded edits."""
    hashed = versions.select("root_id", "version", F.sha2("content", 256).alias("h"))
    newest = versions.groupBy("root_id").agg(F.max("version").alias("newest"))
    local = files.select("root_id", F.sha2("content", 256).alias("h"))
    hit = local.join(hashed, ["root_id", "h"]).groupBy("root_id").agg(F.max("version").alias("matched"))
    out = local.join(newest, "root_id").join(hit, "root_id", "left")
    return out.select(
        "root_id",
        F.when(F.col("matched") == F.col("newest"), "in sync").when(F.col("matched").isNotNull(), "spec moved").otherwise("unlanded edits").alias("state"),
        "matched",
        "newest",
    )


def newer_rationales(drift: DataFrame, versions: DataFrame) -> DataFrame:
    """What moved: one row per newer version, in version order."""
    moved = drift.filter(F.col("state") == "spec moved").select("root_id", "matched")
    return versions.join(moved, "root_id").filter(F.col("version") > F.col("matched")).select("root_id", "version", "rationale")


def code_moved(commits: DataFrame, links: DataFrame, newest: DataFrame) -> DataFrame:
    """Commits that touch a governed path after the artifact's latest version.
    ``commits``: repo, rel_path, commit_hash, ts_s; ``newest``: artifact_id, created_s."""
    hit = governing_artifacts(commits, links)
    return hit.join(newest.select("artifact_id", "created_s"), "artifact_id").filter(F.col("ts_s") > F.col("created_s"))


def version_diff(pairs: DataFrame) -> DataFrame:
    """A12 on (pair, old, new): multiset line difference, one row per line and direction."""
    def lines(col: str, sign: int) -> DataFrame:
        return pairs.select("pair", F.explode(F.split(col, "\n")).alias("line"), F.lit(sign).alias("n"))

    both = lines("old", -1).unionByName(lines("new", 1)).groupBy("pair", "line").agg(F.sum("n").alias("n"))
    return both.filter("n <> 0").select("pair", "line", F.when(F.col("n") > 0, "added").otherwise("removed").alias("change"), F.abs("n").alias("times"))


def spec_status(versions: DataFrame) -> DataFrame:
    """Version count and latest rationale per spec tag."""
    rows = versions.select(F.explode("tags").alias("tag"), "version", "created_s", "artifact_id", "rationale")
    return rows.groupBy("tag").agg(
        F.count(F.lit(1)).alias("versions"), F.max_by("rationale", F.struct("created_s", "artifact_id")).alias("latest_rationale")
    )
