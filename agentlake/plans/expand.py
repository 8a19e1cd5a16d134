"""One source row to several rows: the same list of row shapes as Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame

Shape = dict[str, str]


def spark_expand(df: DataFrame, shapes: list[Shape], keys: list[str]) -> DataFrame:
    """Single scan: every shape whose ``when`` holds gives one row."""
    structs = []
    for s in shapes:
        fields = ", ".join(f"'{c}', {e}" for c, e in s.items() if c != "when")
        structs.append(f"named_struct('keep', {s.get('when', 'true')}, {fields})")
    return df.selectExpr(*keys, f"inline(filter(array({', '.join(structs)}), x -> x.keep))").drop("keep")


def sql_expand(table: str, shapes: list[Shape], keys: list[str]) -> str:
    """The same rows as a UNION ALL."""
    parts = []
    for s in shapes:
        cols = ", ".join(f"{e} AS {c}" for c, e in s.items() if c != "when")
        parts.append(f"SELECT {', '.join(keys)}, {cols} FROM {table} WHERE {s.get('when', 'true')}")
    return "\nUNION ALL ".join(parts)


def fill(shapes: list[Shape], columns: dict[str, str]) -> list[Shape]:
    """Give every shape all columns, typed nulls where it has none."""
    return [
        {"when": s.get("when", "true"), **{c: f"CAST({s.get(c, 'NULL')} AS {t})" for c, t in columns.items()}} for s in shapes
    ]
