"""Nearest-ancestor joins of paths on a table of checkout roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ancestors(path: Column) -> Column:
    """All folders above an absolute path, longest first, without the path itself."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def nearest_root(paths: DataFrame, roots: DataFrame, col: str = "path") -> DataFrame:
    """Distinct paths with the longest root at or above them: an equality join on the
    exploded ancestors instead of a prefix test of every pair."""
    own = paths.select(col).filter(F.col(col).isNotNull()).distinct()
    up = own.select(col, F.explode(F.concat(F.array(col), ancestors(F.col(col)))).alias("root"))
    return up.join(roots, "root").groupBy(col).agg(
        *[F.max_by(c, F.length("root")).alias(c) for c in ("root", *[c for c in roots.columns if c != "root"])]
    )


def rel_path(edits: DataFrame, roots: DataFrame, col: str = "path") -> DataFrame:
    """Repo and path below the nearest checkout root."""
    near = nearest_root(edits, roots, col)
    return edits.join(near, col).withColumn("rel_path", F.expr(f"substring({col}, length(root) + 2)"))


def scope_repo(calls: DataFrame, roots: DataFrame) -> DataFrame:
    """Repo of the acted-on file when it lies inside the session's folder, else of the
    folder itself, else null. ``calls``: cwd, file_path; ``roots``: root, repo."""
    full = F.when(F.col("file_path").startswith("/"), F.col("file_path")).otherwise(F.concat_ws("/", "cwd", "file_path"))
    folder = F.regexp_replace(full, r"/[^/]*$", "")
    inside = (folder == F.col("cwd")) | folder.startswith(F.concat("cwd", F.lit("/")))
    rows = calls.withColumn("__dir", F.when(F.col("cwd").isNotNull() & F.col("file_path").isNotNull() & inside, folder))
    by_dir = nearest_root(rows, roots, "__dir").select("__dir", F.col("repo").alias("__file_repo"))
    by_cwd = nearest_root(rows, roots, "cwd").select("cwd", F.col("repo").alias("__cwd_repo"))
    out = rows.join(by_dir, "__dir", "left").join(by_cwd, "cwd", "left")
    return out.withColumn("repo", F.coalesce("__file_repo", "__cwd_repo")).drop("__dir", "__file_repo", "__cwd_repo")
