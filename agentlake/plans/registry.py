"""Registry of named queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agentlake.plans.views import VIEW_SQL, Views, view_sql

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
TWINS: dict[str, str] = {}
LONGS: dict[str, tuple[str, ...]] = {}


def query(name: str, twin: str | None = None, longs: tuple[str, ...] = ()):
    """Register a query; ``twin`` is SQL that may name driver tables and ``v_`` views.
    ``longs`` are twin columns to bring from wide sums back to 64 bits."""

    def add(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        if twin is not None:
            TWINS[name] = twin
            LONGS[name] = longs
        return fn

    return add


def as_entry(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]
    return lambda spark, sf_dir: fn(Views(spark, sf_dir))


def full_twin(name: str) -> str:
    """The twin with the views it names put in front as common table expressions."""
    text = TWINS[name].strip()
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", text)]
    ctes = ",\n".join(f"{v} AS ({view_sql(v)})" for v in used)
    head = re.match(r"(?is)^with(\s+recursive)?\s+", text)
    if ctes and head:
        word = "WITH RECURSIVE" if head.group(1) else "WITH"
        text = f"{word} {ctes},\n{text[head.end():]}"
    elif ctes:
        text = f"WITH {ctes}\n{text}"
    if LONGS[name]:
        casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in LONGS[name])
        text = f"SELECT * REPLACE ({casts}) FROM ({text}) wide"
    return text
