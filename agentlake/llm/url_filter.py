"""URL filter: rules first, then gradient-boosted trees on lexical features.

The rules label the URLs they match; a bounded sample of those trains the trees (numpy in the
driver, a few thousand rows of ten numbers); the statistics of host suffixes count all rows. Each
tree becomes a CASE expression, so every URL is judged by plain column arithmetic after a join
with the suffixes' statistics, without Python on the executors.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.session import materialize

#: (verdict, rule); a rule is a host, then a path from its first slash.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
FEATURES = ("length", "host_length", "depth", "host_depth", "digit_ratio", "entropy", "n_params", "n_marks", "suffix_rate", "suffix_share")
#: Bound of the training sample, and the trees' sizes.
SAMPLE, TREES, DEPTH, RATE, BINS = 6000, 20, 3, 0.3, 32


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(slash + p))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features of ``url`` and ``suffix``, the last label of the host."""
    url = F.coalesce(F.col("url"), F.lit(""))
    count = lambda c, x: (F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))).cast("double")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    chars = F.split(url, "")
    share = lambda ch: (F.length(url) - F.length(F.replace(url, ch, F.lit("")))) / n
    entropy = F.aggregate(F.filter(F.array_distinct(chars), lambda ch: ch != ""), F.lit(0.0), lambda acc, ch: acc - share(ch) * F.log2(share(ch)))
    return df.withColumns({
        "length": n, "host_length": F.length("host").cast("double"), "depth": count(F.col("path"), "/"), "host_depth": count(F.col("host"), "."),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / n, "entropy": entropy,
        "n_params": F.when(F.length(query) > 0, F.length(query) - F.length(F.replace(query, F.lit("="), F.lit("")))).otherwise(0).cast("double"),
        "n_marks": count(url, "-") + count(url, "_") + count(url, "%"), "suffix": F.substring_index("host", ".", -1),
    })


@dataclass
class Trees:
    """Boosted regression trees of log odds: nested (feature, threshold, left, right) or a number.

    ``suffixes`` has (rate, share) of the sample's suffixes, ``table`` (suffix, suffix_rate,
    suffix_share) of all; without a table the sample's are all there are."""

    base: float
    trees: list
    suffixes: dict[str, tuple[float, float]]
    default: tuple[float, float]
    table: DataFrame | None = None

    def margin(self) -> Column:
        def walk(t) -> Column:
            return F.lit(float(t)) if not isinstance(t, tuple) else F.when(F.col(FEATURES[t[0]]) <= F.lit(t[1]), walk(t[2])).otherwise(walk(t[3]))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + walk(t)
        return out

    def with_suffixes(self, df: DataFrame) -> DataFrame:
        table = self.table
        if table is None:
            table = df.sparkSession.createDataFrame([(k, *map(float, v)) for k, v in sorted(self.suffixes.items())], "suffix string, suffix_rate double, suffix_share double")
        known = {c: F.coalesce(c, F.lit(d)) for c, d in zip(FEATURES[-2:], self.default, strict=True)}
        return df.join(table, "suffix", "left").withColumns(known)


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, edges: list[np.ndarray], depth: int):
    leaf = float(-RATE * g.sum() / (h.sum() + 1))
    if depth == 0 or len(g) < 20:
        return leaf
    best = (1e-6, None, None)
    total = g.sum() ** 2 / (h.sum() + 1)
    for f, cuts in enumerate(edges):
        at = np.searchsorted(cuts, x[:, f], side="left")  # value <= cuts[i] goes left of cut i
        gs, hs = np.bincount(at, g, len(cuts) + 1).cumsum()[:-1], np.bincount(at, h, len(cuts) + 1).cumsum()[:-1]
        gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - total
        if len(gain) and gain.max() > best[0]:
            best = (gain.max(), f, float(cuts[gain.argmax()]))
    if best[1] is None:
        return leaf
    left = x[:, best[1]] <= best[2]
    return (best[1], best[2], _grow(x[left], g[left], h[left], edges, depth - 1), _grow(x[~left], g[~left], h[~left], edges, depth - 1))


def _apply(t, x: np.ndarray) -> np.ndarray:
    if not isinstance(t, tuple):
        return np.full(len(x), t)
    return np.where(x[:, t[0]] <= t[1], _apply(t[2], x), _apply(t[3], x))


def _smooth(blocked, labelled, rate):
    return (blocked + 5 * rate) / (labelled + 5)


def fit(rows: list[dict], labels: list[int], stats: dict[str, tuple[float, float]] | None = None) -> Trees:
    """Trees for labelled feature rows (with ``suffix``); without both classes the base rate alone.
    ``stats`` has (rate, share) of the rows' suffixes; without it the rows themselves are counted."""
    y = np.array(labels, dtype=float)
    if not len(y):
        return Trees(-1.0, [], {}, (0.5, 0.0))
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    if stats is None:
        seen: dict[str, list[float]] = {}
        for r, label in zip(rows, labels, strict=True):
            seen.setdefault(r["suffix"], []).append(label)
        stats = {s: (_smooth(sum(v), len(v), rate), len(v) / len(y)) for s, v in seen.items()}
    model = Trees(base, [], stats, (float(rate), 0.0))
    if y.min() == y.max():
        return model
    x = np.array([[*(r[f] for f in FEATURES[:-2]), *stats.get(r["suffix"], model.default)] for r in rows], dtype=float)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    margin = np.full(len(y), base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        model.trees.append(_grow(x, p - y, p * (1 - p), edges, DEPTH))
        margin = margin + _apply(model.trees[-1], x)
    return model


def suffix_statistics(judged: DataFrame, block: list[str]) -> tuple[DataFrame, float]:
    """(suffix, suffix_rate, suffix_share) of every suffix, and the rate of all: the smoothed share
    of blocked ones among the rows that a rule decides, and the suffix's share of all rows."""
    one = lambda c: F.sum(c.cast("long"))
    counts = judged.groupBy(F.substring_index("host", ".", -1).alias("suffix")).agg(F.count("*").alias("n"), one(F.col("rule").isNotNull()).alias("labelled"), one(F.coalesce(F.col("rule").isin(block), F.lit(False))).alias("blocked"))
    counts = materialize(counts, "suffixes")
    n, labelled, blocked = (x or 0 for x in counts.agg(F.sum("n"), F.sum("labelled"), F.sum("blocked")).first())
    rate = (blocked + 0.5) / (labelled + 1)
    return counts.select("suffix", _smooth(F.col("blocked"), F.col("labelled"), F.lit(rate)).alias("suffix_rate"), (F.col("n") / F.lit(max(n, 1))).alias("suffix_share")), rate


def train(judged: DataFrame, rules, sample: int = SAMPLE) -> Trees:
    """Fits URLs that a rule decides: at most ``sample`` distinct ones, by their hash. Suffixes are
    counted over all rows."""
    block = [rule for verdict, rule in rules if verdict == "block"]
    table, rate = suffix_statistics(judged, block)
    picked = judged.filter("rule is not null").select("url", "host", "path", F.col("rule").isin(block).cast("int").alias("label")).distinct().orderBy(F.xxhash64("url"), "url").limit(sample)
    rows = sorted((r.asDict() for r in lexical(picked).join(table, "suffix").collect()), key=lambda r: r["url"])
    model = fit(rows, [r["label"] for r in rows], {r["suffix"]: (r["suffix_rate"], r["suffix_share"]) for r in rows})
    model.default, model.table = (rate, 0.0), table
    return model


def filter_urls(pages: DataFrame, rules=RULES, model: Trees | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row.

    ``rules`` is a list that the driver holds. A null URL, or one without ``://``, has empty host
    and path and is judged by the trees like the rest; repeated rows and null ids keep a row each;
    further columns are ignored; an empty table gives no rows. Without labelled URLs the trees
    allow all."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    host, path = parts(F.col("url"))
    judged = rows.withColumns({"host": host, "path": path}).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    model = model or train(judged, rules)
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    scored = model.with_suffixes(lexical(judged)).withColumn("score", 1 / (1 + F.exp(-model.margin())))
    verdict = F.when(F.col("rule").isNotNull(), F.when(F.col("rule").isin(blocked), "block").otherwise("allow")).otherwise(F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
