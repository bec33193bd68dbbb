"""File contents of working trees, by Spark's own binary reader."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.paths import pruned


def read_tree(spark: SparkSession, root: str, repo: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(repo, path, content, content_sha, n_bytes) of the files below ``root``, without pruned directories."""
    base = root.rstrip("/") + "/"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    path = F.substr(F.regexp_replace("path", "^file:/*", "/"), F.lit(len(base.removeprefix("file:")) + 1))
    out = raw.select(F.lit(repo).alias("repo"), path.alias("path"), F.col("content").alias("raw"), F.col("length").alias("n_bytes")).filter(~pruned(F.col("path")))
    if suffixes:
        out = out.filter(reduce(or_, [F.endswith("path", F.lit(x)) for x in suffixes]))
    return out.select("repo", "path", F.try_validate_utf8(F.col("raw").cast("string")).alias("content"), F.sha2("raw", 256).alias("content_sha"), "n_bytes")
