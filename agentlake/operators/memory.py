"""Retrieval over memory items and the review record of pull requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MEMORY_TYPES = {"facts": "fact", "artifacts": "artifact", "episodes": "episode", "documents": "document"}
DEFAULT_TOP_K = 8


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays, in double precision."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def of_type(items: DataFrame, memory_type: str) -> DataFrame:
    return items if memory_type == "all" else items.filter(F.col("type") == MEMORY_TYPES[memory_type])


def search(items: DataFrame, score: Column, memory_type: str = "all", top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """The k best items by score; a top-k per partition, then one small merge."""
    return of_type(items, memory_type).withColumn("score", score).orderBy(F.col("score").desc(), "id").limit(top_k)


def search_both(items: DataFrame, score: Column, brain: str, memory_type: str = "all", top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """The space first, then everything; merged by id, the first scope is the origin."""
    inside = search(items.filter(F.col("brain_id") == brain), score, memory_type, top_k).withColumn("scope", F.lit(0))
    outside = search(items, score, memory_type, top_k).withColumn("scope", F.lit(1))
    both = inside.unionByName(outside)
    rest = [c for c in both.columns if c not in ("id", "scope")]
    merged = both.groupBy("id").agg(F.min_by(F.struct(*rest), "scope").alias("i"), F.min("scope").alias("scope"))
    return merged.select("id", "i.*", F.when(F.col("scope") == 0, "brain").otherwise("personal").alias("origin"))


def with_tags(items: DataFrame, tags: list[str], match: str = "all") -> DataFrame:
    """A tag filter also restricts to artifacts."""
    want = F.array(*[F.lit(t) for t in tags])
    hit = F.size(F.array_except(want, F.col("tags"))) == 0 if match == "all" else F.arrays_overlap(want, F.col("tags"))
    return items.filter((F.col("type") == "artifact") & hit)


def tag_counts(items: DataFrame) -> DataFrame:
    """The tag vocabulary."""
    return items.select(F.explode(F.array_distinct("tags")).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("items"))


def between_created(items: DataFrame, after: Column | None = None, before: Column | None = None, col: str = "created_s") -> DataFrame:
    """Bounds on the capture time."""
    out = items
    if after is not None:
        out = out.filter(F.col(col) >= after)
    return out if before is None else out.filter(F.col(col) < before)


def sweep(items: DataFrame, queries: list[Column], types: tuple[str, ...] = ("fact", "episode", "artifact"), top_k: int = 50) -> DataFrame:
    """Many queries times types, each its top k, then distinct by id with the first hit
    kept. The queries are a short list given by the caller: their scores are columns of one
    scan, unpivoted; the top k per (query, type) is cut before the shuffle."""
    scores = F.array(*[F.struct(F.lit(i).alias("query_no"), s.alias("score")) for i, s in enumerate(queries)])
    order = F.create_map(*[x for i, t in enumerate(types) for x in (F.lit(t), F.lit(i))])
    rows = items.filter(F.col("type").isin(*types)).select("id", "type", F.try_element_at(order, F.col("type")).alias("type_no"), F.inline(scores))
    w = Window.partitionBy("type", "query_no").orderBy(F.col("score").desc(), "id")
    top = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)
    first = F.struct("type_no", "query_no", "rank")
    return top.groupBy("id").agg(F.min_by(F.struct("type", "query_no", "rank"), first).alias("h")).select("id", "h.*")


BOT_WORDS = ("cursor", "bugbot", "codex", "chatgpt")


def is_bot(login: Column) -> Column:
    out = F.lit(False)
    for w in BOT_WORDS:
        out = out | F.lower(login).contains(w)
    return F.coalesce(out, F.lit(False))


def new_findings(comments: DataFrame, checks: DataFrame, handled: DataFrame) -> DataFrame:
    """Bot comments and failing required checks that no earlier pass handled."""
    cols = ["pr", "pass_no", "finding_id", "login"]
    found = comments.filter(is_bot(F.col("login"))).select(*cols, F.lit("comment").alias("kind")).unionByName(
        checks.filter(F.col("required") & (F.col("state") == "failing")).select(*cols, F.lit("check").alias("kind"))
    )
    return found.join(handled.select("finding_id").distinct(), "finding_id", "left_anti")


def pr_status(passes: DataFrame, max_passes: int = 10, quiet_s: int = 1_200) -> DataFrame:
    """M07 on (pr, pass_no, pushed, new_findings, bad_checks, bot_reviewed, head_age_s): the
    latest pass decides: clean, again or stop."""
    last = passes.groupBy("pr").agg(
        F.max("pass_no").alias("passes"),
        F.max_by(F.struct("pushed", "new_findings", "bad_checks", "bot_reviewed", "head_age_s"), "pass_no").alias("p"),
    )
    p = F.col("p")
    clean = (
        ~p["pushed"] & (p["new_findings"] == 0) & (p["bad_checks"] == 0) & (p["bot_reviewed"] | (p["head_age_s"] >= quiet_s))
    )
    return last.select("pr", "passes", F.when(clean, "clean").when(F.col("passes") >= max_passes, "stop").otherwise("again").alias("decision"))


def review_record(findings: DataFrame) -> DataFrame:
    """Findings per PR and bot with what became of them."""
    return findings.filter(is_bot(F.col("login"))).groupBy("pr", "login").agg(
        F.count(F.lit(1)).alias("findings"),
        F.count_if(F.col("verdict") == "fixed").alias("accepted"),
        F.count_if(F.col("verdict") == "rejected").alias("rejected"),
        F.count_distinct("fix_sha").alias("fix_commits"),
    )
