"""Secret scans with a trigram inverted index.

Each rule's pattern yields a Boolean trigram query: any of some alternatives, each of which
needs all its trigrams (of the lower-cased text). Postings (trigram, text) are stored for the
trigrams that queries name, alternatives intersect them, and only candidates are verified with
the pattern. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.llm.native import own_columns
from agentlake.session import materialize


@dataclass(frozen=True)
class Rule:
    """``least`` characters at least in group ``group`` of a match, else it is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules of the contract, then rules of this operator's own.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # a maximal run of 24 or more, the same as a run that is checked for its length
)
MORE = (
    Rule("private", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"(?i)bearer\x20+[a-z0-9._~+/-]{20,}"),
)


def _split_top(pattern: str) -> list[str]:
    """Alternatives of a pattern at its outermost level."""
    out, depth, start, i = [], 0, 0, 0
    in_class = False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*out, pattern[start:]]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of mandatory trigrams; an empty set among them means that any text may match.

    Reads literals, classes, groups, alternatives and quantifiers. Only runs of literals that
    every match of an alternative holds count; an optional literal splits an alternative in two."""
    return [frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)) for runs in _runs(re.sub(r"^\(\?i\)", "", pattern))]


def _runs(pattern: str) -> list[list[str]]:
    """For each alternative the runs of literals; "" breaks a run."""
    every = []
    for alternative in _split_top(pattern):
        ways, i = [[""]], 0
        while i < len(alternative):
            if alternative[i] == "(":
                depth, j = 1, i + 1
                while depth:
                    j += 2 if alternative[j] == "\\" else 1
                    depth += {"(": 1, ")": -1}.get(alternative[j - 1] if alternative[j - 2] != "\\" else "", 0)
                inner = re.sub(r"^\?:", "", alternative[i + 1 : j - 1])
                atom = _runs(inner)
            elif alternative[i] == "[":
                j = alternative.index("]", i + 2) + 1
                atom = [["", ""]]
            elif alternative[i] == "\\":
                j = i + (4 if alternative[i + 1] == "x" else 2)
                atom = [[chr(int(alternative[i + 2 : j], 16)) if alternative[i + 1] == "x" else alternative[i + 1]]] if alternative[i + 1] == "x" or not alternative[i + 1].isalnum() else [["", ""]]
            else:
                j, atom = i + 1, [[alternative[i].lower()]] if alternative[i] not in ".^$" else [["", ""]]
            quantifier = re.match(r"[?*+]|\{\d*,?\d*\}", alternative[j:])
            if quantifier:
                j += quantifier.end()
                q = quantifier.group()
                if q == "?":
                    atom = [*atom, [""]]
                elif q == "*" or q.startswith(("{0", "{,")):
                    atom = [["", ""]]
                else:  # at least once: its ends do not touch what stands beside it
                    atom = [["", *a, ""] for a in atom]
            # joined alternatives: the last run of one grows by the first run of the other
            ways = [[*w[:-1], w[-1] + a[0], *a[1:]] for w in ways for a in atom]
            i = j
        every += ways
    return every


def _spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as (begin, end, kind) in code points.

    What stands between the matches and the matches themselves add up to the places."""
    between, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    span = "struct<begin:int,end:int,ok:boolean>"
    steps = F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.struct(F.length(F.get(between, i)).alias("gap"), F.length(F.get(found, i)).alias("size"), (F.length(F.get(judged, i)) >= rule.least).alias("ok")))
    walk = F.aggregate(
        F.when(F.size(found) > 0, steps).otherwise(F.array().cast("array<struct<gap:int,size:int,ok:boolean>>")),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("list")),
        lambda acc, x: F.struct((acc.at + x.gap + x.size).alias("at"), F.concat(acc.list, F.array(F.struct((acc.at + x.gap).alias("begin"), (acc.at + x.gap + x["size"]).alias("end"), x.ok.alias("ok")))).alias("list")),
        lambda acc: acc.list,
    )
    return F.transform(F.filter(walk, lambda s: s.ok), lambda s: F.struct(s.begin.alias("begin"), s.end.alias("end")))


def _numbered(spans: Column, k: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s.begin.alias("begin"), F.lit(k).alias("rule"), s.end.alias("end")))


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, list[str]]:
    """(gram, h): the texts that hold each trigram some rule asks for; the trigrams by number."""
    grams = sorted({g for r in rules for way in trigram_query(r.pattern) if all(trigram_query(r.pattern)) for g in way})
    low = docs.select(F.xxhash64("text").alias("h"), F.lower("text").alias("low")).filter("low is not null")
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams))))
    return low.select(F.explode(held).alias("gram"), "h"), grams


def candidates(posted: DataFrame, grams: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """(h, rules): numbers of the rules whose query the postings of a text satisfy."""
    held = posted.groupBy("h").agg(F.collect_set("gram").alias("held"))  # at most one entry a trigram
    number = {g: i for i, g in enumerate(grams)}
    fits = []
    for k, r in enumerate(rules):
        ways = trigram_query(r.pattern)
        if all(ways):
            each = [F.size(F.array_intersect("held", F.array(*(F.lit(number[g]) for g in sorted(way))))) == len(way) for way in ways]
            any_way = each[0]
            for e in each[1:]:
                any_way = any_way | e
            fits.append(F.when(any_way, F.lit(k)))
    return held.select("h", F.array_compact(F.array(*fits)).alias("rules")).filter(F.size("rules") > 0)


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """All columns of ``docs`` and ``__found``: the spans (begin, end, kind) by begin, then kind as listed."""
    posted, grams = postings(docs, rules)
    picked = candidates(materialize(posted.distinct(), "grams"), grams, rules)
    rows = docs.withColumn("__h", F.xxhash64("text")).join(picked.select(F.col("h").alias("__h"), F.col("rules").alias("__rules")), "__h", "left")
    parts = []
    for k, r in enumerate(rules):
        indexed = all(trigram_query(r.pattern))
        maybe = F.coalesce(F.array_contains("__rules", k), F.lit(False)) if indexed else F.rlike("text", F.lit(r.pattern))
        none = F.array().cast("array<struct<begin:int,end:int>>")
        parts.append(_numbered(F.coalesce(F.when(maybe, _spans(F.col("text"), r)), none), k))
    return rows.withColumn("__found", F.array_sort(F.concat(*parts))).drop("__h", "__rules")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row.

    Spans are kind:start:end by start, then kind as listed, in code points with an exclusive
    end. Null texts count as empty; repeated rows and null ids keep a row each; further columns
    are ignored; an empty table gives no rows."""
    rows = secret_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), rules)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat(F.get(kinds, s.rule), F.lit(":"), s.begin.cast("string"), F.lit(":"), s.end.cast("string"))), ",")
    rows = rows.select("doc_id", F.col("__found").alias("found"))
    count = lambda k: F.size(F.filter("found", lambda s: s.rule == k)).cast("long")
    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(line(F.filter("found", lambda s: s.rule < len(BASE))), 256).alias("base_sha256"), line(F.col("found")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mask: str = "[secret]", size: str | None = None) -> DataFrame:
    """The documents with every span of ``text`` replaced by ``mask``, other columns as they are;
    ``size`` names a column that becomes the text's length where the text changed."""
    text = F.col("text")
    step = lambda acc, s: F.struct(
        F.when(s.begin >= acc["at"], F.concat(acc["out"], F.substr(text, acc["at"] + 1, s.begin - acc["at"]), F.lit(mask))).otherwise(acc["out"]).alias("out"),
        F.greatest(acc["at"], s.end).alias("at"),
    )
    masked = F.aggregate("__found", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    rows = secret_spans(docs.select(own_columns(docs), "text"), rules).select("row", "text", (F.size("__found") > 0).alias("changed"), masked.alias("masked"))
    row = F.col("row").withField("text", F.when(F.col("changed"), F.col("masked")).otherwise(text))
    if size:
        old = F.col("row").getField(size)
        row = row.withField(size, F.when(F.col("changed") & old.isNotNull(), F.length("masked").cast(docs.schema[size].dataType)).otherwise(old))
    return rows.select(row.alias("row")).select("row.*")
