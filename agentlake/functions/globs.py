"""path globs compiled to regular expressions once per link."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

# What a glob sign means inside a path. Longest sign first.
_SIGNS = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
_SIGN = re.compile(r"\*\*/|\*\*|\*|\?")
_BRACES = re.compile(r"\{([^{}]*)\}")


def _literal(text: str) -> str:
    """Quote plain text so that Python and Java read the same pattern."""
    return re.sub(r"([\\.^$|()\[\]{}+*?\-#&~ ])", r"\\\1", text)


def _alternatives(glob: str) -> list[str]:
    todo = [g.strip() for g in glob.split("|") if g.strip()]
    done: list[str] = []
    while todo:
        g = todo.pop(0)
        m = _BRACES.search(g)
        if m is None:
            done.append(g)
        else:
            todo.extend(g[: m.start()] + option + g[m.end():] for option in m.group(1).split(","))
    return done


def glob_regex(glob: str | None) -> str | None:
    """Full-match pattern of a glob, null when no alternative is usable."""
    out = []
    for alt in _alternatives(glob or ""):
        pattern, at = "", 0
        for m in _SIGN.finditer(alt):
            pattern += _literal(alt[at:m.start()]) + _SIGNS[m.group()]
            at = m.end()
        out.append(pattern + _literal(alt[at:]))
    return r"\A(?:" + "|".join(out) + r")\z" if out else None


def _held(segment: str) -> tuple[str, str] | None:
    """What a segment of a path must have for one segment of a glob: all its text (``=``) or its
    extension (``.``); nothing for other wildcards."""
    if not _SIGN.search(segment):
        return "=", segment
    tail = _SIGN.split(segment)[-1].rpartition(".")
    return (".", tail[2]) if tail[1] and tail[2] else None


def glob_keys(glob: str | None) -> list[tuple[str, str]]:
    """(shape, key) of each alternative. A shape says how deep a path is (``3``, or at least that
    with ``+``) and which of its segments are read, counted from the front (``2=``) or the back
    (``-1.`` for an extension); the key is what stands there. Segments behind the first ``**``
    are read from the back, those between two are not read. Without any segment of that kind, a
    text between two ``**`` must be some segment of the path (shape ``any=``)."""
    keys = set()
    for alt in _alternatives(glob or ""):
        segments = alt.split("/")
        deep = [i for i, s in enumerate(segments) if "**" in s]
        if not deep:
            places = [(i + 1, s) for i, s in enumerate(segments)]
            depth = str(len(segments))
        else:
            first, last = deep[0], deep[-1]
            # text that touches a ``**`` may share a segment of the path with other text
            places = [(i + 1, s) for i, s in enumerate(segments[:first])]
            behind = segments[last + 1 :] if segments[last] == "**" else []
            places += [(i - len(behind), s) for i, s in enumerate(behind)]
            depth = f"{first + max(1, len(behind))}+" if segments[last] == "**" else f"{first + 1}+"
            between = [s for s in segments[first + 1 : last] if not _SIGN.search(s) and s]
            if between and not any(_held(s) for _, s in places) and all(s == "**" for i, s in enumerate(segments) if i in deep):
                keys.add(("any=", max(between, key=len)))
                continue
        read = [(at, *held) for at, s in places if (held := _held(s))]
        keys.add((",".join([depth, *(f"{at}{kind}" for at, kind, _ in read)]), "/".join(text for _, _, text in read)))
    return sorted(keys)


@F.pandas_udf(ArrayType(StructType().add("shape", "string").add("key", "string")))
def compile_keys(globs: pd.Series) -> pd.Series:
    return globs.map(lambda g: [{"shape": s, "key": k} for s, k in glob_keys(g)])


def path_key(path: Column, shape: Column) -> Column:
    """What a path has where a shape reads it; null when it is not that deep."""
    parts, fields = F.split(path, "/"), F.split(shape, ",")
    depth, least = F.size(parts), F.regexp_extract(shape, r"\A\d+", 0).try_cast("int")
    deep = F.when(F.get(fields, F.lit(0)).endswith("+"), depth >= least).otherwise(depth == least)

    def read(field: Column) -> Column:
        at = F.regexp_extract(field, r"-?\d+", 0).try_cast("int")
        segment = F.get(parts, F.when(at < 0, depth + at).otherwise(at - 1))
        return F.when(field.endswith("="), segment).when(segment.contains("."), F.substring_index(segment, ".", -1))

    found = F.transform(F.slice(fields, F.lit(2), F.size(fields)), read)
    return F.when(deep & ~F.exists(found, lambda x: x.isNull()), F.array_join(found, "/"))


def path_keys(path: Column, shapes: Column) -> Column:
    """(shape, key) of a path for each of ``shapes``."""
    of_shape = F.filter(F.transform(shapes, lambda s: F.struct(s.alias("shape"), path_key(path, s).alias("key"))), lambda k: k["key"].isNotNull())
    any_segment = F.transform(F.array_distinct(F.split(path, "/")), lambda x: F.struct(F.lit("any=").alias("shape"), x.alias("key")))
    return F.when(F.array_contains(shapes, "any="), F.concat(of_shape, any_segment)).otherwise(of_shape)


@F.pandas_udf(StringType())
def compile_glob(globs: pd.Series) -> pd.Series:
    """Runs on the link table only, never on the edits."""
    return globs.map(glob_regex)


def glob_match(path: Column, regex: Column) -> Column:
    return F.coalesce(F.rlike(path, regex), F.lit(False))
