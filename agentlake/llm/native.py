"""Column expressions shared by the native operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else; texts of ASCII alone take the built-in short way."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def own_columns(docs: DataFrame) -> Column:
    """The caller's columns as one, ``row``: whatever they are called, no helper column clashes."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
