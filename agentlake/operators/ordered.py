"""Ordered per-key computations that never put a whole key into one task.

A plain ``Window.partitionBy(session)`` sends every row of a session to one task, so
one session with a third of all rows decides the run time. Here a key is cut into
consecutive buckets of its order column. Each bucket is reduced to one summary row,
the summaries are scanned per key (thousands of times fewer rows), and the carry-in
is joined back onto the bucket. The result equals the plain window. Sparse order values can
make a bucket of every row, so the summaries are scanned in the same two steps: inside groups
of neighbouring buckets, and over the groups of a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

WIDTH = 65_536

SPAN = 1_024  # neighbouring buckets whose summaries are scanned together

_B, _G = "__bucket", "__group"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, count, max, min or last (last non-null)."""

    kind: str
    col: Column | None = None
    inclusive: bool = True


def _local(spec: Running, w) -> Column:
    if spec.kind == "sum":
        return F.sum(spec.col).over(w)
    if spec.kind == "count":
        return F.count(F.lit(1) if spec.col is None else F.when(spec.col, 1)).over(w)
    if spec.kind == "max":
        return F.max(spec.col).over(w)
    if spec.kind == "min":
        return F.min(spec.col).over(w)
    if spec.kind == "last":
        return F.last(spec.col, ignorenulls=True).over(w)
    raise ValueError(spec.kind)


def _summary(spec: Running, order: Sequence[str]) -> Column:
    if spec.kind == "sum":
        return F.sum(spec.col)
    if spec.kind == "count":
        return F.count(F.lit(1) if spec.col is None else F.when(spec.col, 1))
    if spec.kind == "max":
        return F.max(spec.col)
    if spec.kind == "min":
        return F.min(spec.col)
    return F.max_by(spec.col, F.when(spec.col.isNotNull(), F.struct(*order)))


def _carry(spec: Running, name: str, w) -> Column:
    c = F.col(name)
    if spec.kind in ("sum", "count"):
        return F.sum(c).over(w)
    if spec.kind == "max":
        return F.max(c).over(w)
    if spec.kind == "min":
        return F.min(c).over(w)
    return F.last(c, ignorenulls=True).over(w)


def _fold(spec: Running, name: str) -> Column:
    """The summary of a group of buckets."""
    c = F.col(name)
    if spec.kind == "last":
        return F.max_by(c, F.when(c.isNotNull(), F.col(_B)))
    return {"max": F.max, "min": F.min}.get(spec.kind, F.sum)(c)


def _merge(spec: Running, carry: Column, local: Column) -> Column:
    if spec.kind in ("sum", "count"):
        zero = F.lit(0)
        return F.coalesce(carry, zero) + F.coalesce(local, zero)
    if spec.kind == "max":
        return F.greatest(carry, local)
    if spec.kind == "min":
        return F.least(carry, local)
    return F.coalesce(local, carry)


def _group(kind: T.DataType) -> Column:
    """``SPAN`` neighbouring buckets; of a bucket of several columns the last one is cut."""
    if not isinstance(kind, T.StructType):
        return F.floor(F.col(_B) / F.lit(SPAN))
    *outer, inner = [F.col(_B).getField(f.name) for f in kind.fields]
    return F.struct(*[c.alias(f"c{i}") for i, c in enumerate(outer)], F.floor(inner / F.lit(SPAN)).alias("at"))


def _carries(parts: DataFrame, keys: Sequence[str], specs: dict[str, Running]) -> DataFrame:
    """Keys, bucket and ``__c_<name>``, what all earlier buckets of the key come to."""
    grouped, at = parts.withColumn(_G, _group(parts.schema[_B].dataType)), [*keys, _G]
    groups = grouped.groupBy(*at).agg(*[_fold(s, n).alias(n) for n, s in specs.items()])
    before = Window.partitionBy(*keys).orderBy(_G).rowsBetween(Window.unboundedPreceding, -1)
    entry = groups.select(*at, *[_carry(s, n, before).alias(f"__g_{n}") for n, s in specs.items()])
    inside = Window.partitionBy(*at).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    merged = [_merge(s, F.col(f"__g_{n}"), _carry(s, n, inside)).alias(f"__c_{n}") for n, s in specs.items()]
    return grouped.join(entry, at).select(*keys, _B, *merged)


def bucket_of(order: str, width: int = WIDTH) -> Column:
    """Consecutive buckets of an integer order column."""
    return F.floor(F.col(order) / F.lit(width))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: dict[str, Running],
    bucket: Column | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """Add running values per key. ``order`` must be a total order inside a key, and
    ``bucket`` must not decrease along it and end in a number (default: the first order column cut in steps
    of ``width``). Keys must not be null."""
    if bucket is None:
        bucket = bucket_of(order[0], width)
    rows = df.withColumn(_B, bucket)
    at = [*keys, _B]
    parts = rows.groupBy(*at).agg(*[_summary(s, order).alias(n) for n, s in specs.items()])
    ordered = Window.partitionBy(*at).orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    prior = ordered.rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(_carries(parts, keys, specs), at)
    keep = list(df.columns)
    return out.select(
        *keep,
        *[
            _merge(s, F.col(f"__c_{n}"), _local(s, upto if s.inclusive else prior)).alias(n)
            for n, s in specs.items()
        ],
    )


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos", **kw) -> DataFrame:
    """1-based row number per key, without one task per key."""
    return running(df, keys, order, {out: Running("count")}, **kw)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str], **kw) -> DataFrame:
    """``lag(col, 1)`` per key; ``cols`` maps output name to input column."""
    tmp = {f"__p_{o}": Running("last", F.struct(F.col(c).alias("v")), inclusive=False) for o, c in cols.items()}
    out = running(df, keys, order, tmp, **kw)
    return out.select(*df.columns, *[F.col(f"__p_{o}.v").alias(o) for o in cols])
