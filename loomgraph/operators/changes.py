"""Change sets: normalised status, touched, scope and reconcile sets, cache misses, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import paths as P


def normal_status(status: Column) -> Column:
    """First letter of git's status; a copy adds, a type change modifies; null for letters unknown."""
    c = F.upper(F.substring(F.trim(status), 1, 1))
    return F.when(c.isin("A", "M", "D", "R"), c).when(c == "C", "A").when(c == "T", "M")


def normalise(changes: DataFrame) -> DataFrame:
    """Rows of known status; only renames keep old_path, and deletions have no sha."""
    s = normal_status(F.col("status"))
    return (
        changes.withColumn("status", s)
        .filter(F.col("status").isNotNull())
        .withColumn("old_path", F.when(F.col("status") == "R", F.col("old_path")))
        .withColumn("content_sha", F.when(F.col("status") != "D", F.nullif(F.lower(F.col("content_sha")), F.lit(""))))
    )


def touched(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct paths: every path, and the old path of a rename."""
    both = F.array(F.col("path"), F.when(F.col("status") == "R", F.nullif(F.col("old_path"), F.lit(""))))
    return changes.select(*keys, F.explode(both).alias("path")).filter(F.col("path").isNotNull()).distinct()


def scope(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Paths to analyse: added, modified or renamed."""
    return changes.filter(F.col("status").isin("A", "M", "R")).select(*keys, "path").distinct()


def without(paths: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """``paths`` minus failed or quarantined ones."""
    return paths.join(dropped.select(*keys, "path").distinct(), [*keys, "path"], "left_anti")


def reconcile_set(touched_paths: DataFrame, failed: DataFrame, keys: list[str], full_set: bool = False) -> DataFrame:
    """Paths whose old rows are replaced: touched and not failed; none in a full run, which only inserts."""
    return touched_paths.limit(0) if full_set else without(touched_paths, failed, keys)


def cache_misses(files: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Files with a sha that the cache does not hold under their path."""
    wanted = files.filter(F.col("content_sha").isNotNull() & (F.col("content_sha") != ""))
    return wanted.join(cache.select(*keys, "path", "content_sha").distinct(), [*keys, "path", "content_sha"], "left_anti")


def route(files: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``analyzer``, first match wins: suffixes, then charts, then documents; unmatched files are dropped.

    A file belongs to a chart when its chart root holds a ``Chart.yaml`` among the files.
    """
    f = files.withColumn("_root", P.chart_root(F.col("path")))
    charts = files.filter(P.basename(F.col("path")) == "Chart.yaml").select(*keys, P.dirname(F.col("path")).alias("_root")).distinct().withColumn("_chart", F.lit(True))
    joined = f.join(charts, [*keys, "_root"], "left")
    helm = F.when((P.basename(F.col("path")) == "Chart.yaml") | F.col("_chart"), "helm")
    analyzer = F.coalesce(P.analyzer_by_suffix(F.col("path")), helm, F.when(P.is_doc(F.col("path")), "docs"))
    return joined.withColumn("analyzer", analyzer).filter(F.col("analyzer").isNotNull()).drop("_root", "_chart")


def route_alone(path: Column) -> Column:
    """Analyzer of a path when nothing else of the repository is known."""
    b = P.basename(path)
    helm = F.when(b.isin("Chart.yaml", "values.yaml") | P.is_template(path), "helm")
    return F.coalesce(P.analyzer_by_suffix(path), helm, F.when(P.is_doc(path), "docs"))
