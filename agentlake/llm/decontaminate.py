"""Benchmark decontamination with a positional inverted index over the training tokens.

A benchmark item becomes windows of consecutive words. The corpus is counted for the benchmark's
terms, and the postings (term, document, position) of each window's two rarest terms are stored.
A window's candidates come from its rarest term; intersecting them with the second list, both
adjusted by the term's offset in the window, leaves starts where both terms stand right
(phrase candidates) or some words apart (proximity matches). Phrase candidates are verified word
by word in the few documents that have any. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agentlake.llm.native import ascii_lower, own_columns
from agentlake.session import materialize

WINDOW, SLACK = 10, 5
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, a-z and all beyond ASCII, A-Z lower-cased first; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _terms(docs: DataFrame) -> DataFrame:
    """(h, pos, term) of every word; h stands for the text, so copies share their postings."""
    return docs.select(F.xxhash64("text").alias("h"), F.posexplode(words(F.col("text"))).alias("pos", "term"))


def windows(items: DataFrame, size: int) -> DataFrame:
    """(item_id, phrase) of every window: ``size`` consecutive words, or a shorter item's all."""
    w = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    return w.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1)), lambda i: F.slice("w", i, size))).alias("phrase")).distinct()


def found_in(docs: DataFrame, items: DataFrame, size: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """(h, n_hit, list, n_near) of the texts with phrase or proximity matches; h is their hash."""
    wins = materialize(windows(items, size), "windows")
    phrases = wins.groupBy("phrase").agg(F.collect_set("item_id").alias("items"))  # an item twice in a set: once; null ids are in no list
    vocabulary = phrases.select(F.explode("phrase").alias("term")).distinct()
    # counted first: one row a term and task is shuffled, however frequent the term
    counts = _terms(docs).groupBy("term").agg(F.count("*").alias("n")).join(vocabulary, "term")
    # the two rarest terms of each phrase; a phrase with a term the corpus lacks cannot occur
    places = phrases.select("phrase", F.posexplode("phrase").alias("off", "term")).join(counts, "term", "left")
    by = W.partitionBy("phrase").orderBy("n", "off")
    rare = (
        places.withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("rank", F.row_number().over(by))
        .filter("rank <= 2")
        .groupBy("phrase")
        .agg(*(F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c}{r}") for r in (1, 2) for c in ("term", "off")), F.min("n").alias("least"))
        .filter("least > 0")
        .withColumn("pid", F.xxhash64("phrase"))
    )
    rare = materialize(rare, "rare")
    needed = rare.select(F.explode(F.array("term1", "term2")).alias("term")).filter("term is not null").distinct()
    postings = materialize(_terms(docs).join(needed, "term", "left_semi").distinct(), "postings")
    first = postings.join(rare.select("phrase", "pid", F.col("term1").alias("term"), "off1", "term2", "off2"), "term")
    first = first.select("h", "phrase", "pid", "term2", "off2", (F.col("pos") - F.col("off1")).alias("start"))
    alone = first.filter("term2 is null").select("h", "phrase", "start", F.lit(0).alias("gap"))
    # starts within the slack of each other share a block or lie in neighbouring ones
    width = max(1, slack)
    second = postings.join(rare.select("pid", F.col("term2").alias("term"), "off2"), "term").select("h", "pid", (F.col("pos") - F.col("off2")).alias("start2"))
    near = first.filter("term2 is not null").withColumn("block", F.explode(F.array(*(F.floor(F.col("start") / width) + i for i in (-1, 0, 1)))))
    near = near.join(second.withColumn("block", F.floor(F.col("start2") / width)), ["h", "pid", "block"]).filter(F.abs(F.col("start") - F.col("start2")) <= slack)
    met = near.select("h", "phrase", "start", (F.col("start") - F.col("start2")).alias("gap")).union(alone)
    met = materialize(met.groupBy("h", "phrase", "start").agg(F.min(F.abs("gap")).alias("gap")).filter("gap = 0 or start is not null"), "met")
    # verify phrases where they seem to be; one text of each hash
    exact = met.filter("gap = 0").groupBy("h").agg(F.collect_set(F.struct("phrase", "start")).alias("found"))
    texts = docs.select(F.xxhash64("text").alias("h"), "text").join(exact.select("h"), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))
    checked = (
        exact.join(texts, "h")
        .withColumn("w", words(F.col("text")))
        .select("h", F.explode(F.expr("transform(found, f -> struct(f.phrase, f.start, f.start >= 0 and slice(w, greatest(f.start, 0) + 1, size(f.phrase)) = f.phrase as right))")).alias("f"))
        .select("h", "f.phrase", "f.start", "f.right")
    )
    checked = materialize(checked, "checked")
    right = checked.filter("right").drop("right")
    length = F.size("phrase")
    # words covered by the union of [start, start + length): cut at gaps, then sum
    w = W.partitionBy("h").orderBy("start", "upto")
    covered = (
        right.select("h", "start", (F.col("start") + length).alias("upto")).distinct()
        .withColumn("reached", F.coalesce(F.max("upto").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .groupBy("h").agg(F.sum(F.greatest(F.lit(0), F.col("upto") - F.greatest("start", "reached"))).cast("long").alias("n_hit"))
    )
    items_of = lambda x: x.select("h", "phrase").distinct().join(phrases, "phrase").select("h", F.explode("items").alias("item"))
    listed = items_of(right).distinct().groupBy("h").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("list"))
    # near: all within the slack but the phrases, also where both terms stand right and other words differ
    close = items_of(met.filter("gap > 0").select("h", "phrase").union(checked.filter("not right").select("h", "phrase"))).groupBy("h").agg(F.count_distinct("item").alias("n_near"))
    return covered.join(listed, "h", "full").join(close, "h", "full")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near of every row.

    n_near counts items of which the two rarest terms of a window stand in the window's order
    and at most ``slack`` words off, in this text, and the window itself does not stand there. Null texts have no words; empty items have no
    window; repeated items count once; items without an id make words hit and are in neither
    n_items nor the list; repeated rows and null doc_ids
    keep a row each; further columns are ignored; an empty benchmark hits nothing."""
    found = found_in(docs, items, size, slack)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.size(words(F.col("text"))).cast("long").alias("n_words")).join(found, "h", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n(F.col("n_hit")).alias("n_hit"), n(F.size(F.coalesce("list", F.array()))).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("list", ","), F.lit("")), 256).alias("items_sha256"), (n(F.col("n_hit")) > 0).alias("contaminated"), n(F.col("n_near")).alias("n_near"),
    )


def uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any hit, with their own columns."""
    hit = found_in(docs, items).filter("n_hit > 0").select("h")
    return docs.select(own_columns(docs), F.xxhash64("text").alias("h")).join(hit, "h", "left_anti").select("row.*")
