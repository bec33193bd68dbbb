"""Source files that do not parse as the language their path claims.

Each file is lexed and recognised by a generalised LL parser over a graph-structured stack
(``loomgraph.llm.parse``), with the grammars of all dialects of its language side by side; a file that
every dialect rejects is a case. A conflict left by a merge, a text cut off, another language under a
wrong extension and plain mistakes are all found in this one way.

Languages go by the path's extension: .py Python 3; .js, .mjs, .cjs JavaScript, as module or script;
.go Go; .tf Terraform; .yaml and .yml YAML, or a Go template below a ``templates`` directory. Files of
other extensions, null paths and null contents are never cases; empty files are valid except in Go.
Repeated rows count once, and if rows of one file_id differ, one invalid content makes the case.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EXTENSIONS = {"py": "python", "js": "javascript", "mjs": "javascript", "cjs": "javascript", "go": "golang", "tf": "terraform", "yaml": "yaml", "yml": "yaml"}


def language_of(path: Column) -> Column:
    """Grammar of a path, null where there is none."""
    extension = F.regexp_extract(path, r"\.([^./]+)$", 1)
    out = F.when(extension.isin("yaml", "yml") & F.array_contains(F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), "templates"), "gotemplate")
    for e, name in _EXTENSIONS.items():
        out = out.when(extension == e, name)
    return out


def dialects(language: str, content: str) -> set[str]:
    """Dialects of the language that accept the content."""
    from loomgraph.llm.parse import golang, gotemplate, javascript, python, terraform, yaml

    modules = {"python": python, "javascript": javascript, "golang": golang, "terraform": terraform, "yaml": yaml, "gotemplate": gotemplate}
    return modules[language].accepts(content)


def judged(files: DataFrame) -> DataFrame:
    """(file_id, repo, path, language, valid) of the files that have a grammar and content."""

    def judge(batches):
        for batch in batches:
            valid = [bool(dialects(k, c)) for k, c in zip(batch["language"], batch["content"])]
            yield pd.DataFrame({"file_id": batch["file_id"], "repo": batch["repo"], "path": batch["path"], "language": batch["language"], "valid": pd.Series(valid, dtype=bool)})

    rows = files.select("file_id", "repo", "path", language_of(F.col("path")).alias("language"), "content").filter(F.col("language").isNotNull() & F.col("content").isNotNull())
    return rows.mapInPandas(judge, "file_id bigint, repo string, path string, language string, valid boolean")


def find_unparsable(files: DataFrame) -> DataFrame:
    """Distinct file_id of files that no dialect of their language accepts."""
    return judged(files).filter(~F.col("valid")).select("file_id").distinct()


def failure_rates(files: DataFrame, results: DataFrame) -> DataFrame:
    """Per repo and language: files, those that fail, their rate, and how the analyzers' own reports compare."""
    one = judged(files).groupBy("repo", "path", "language").agg(F.min("valid").alias("valid"))
    reported = results.select("repo", F.explode("failed_files").alias("path")).filter(F.col("path").isNotNull()).distinct().withColumn("reported", F.lit(1))
    n = lambda c: F.sum(c.cast("bigint"))
    both = one.join(reported, ["repo", "path"], "left").withColumn("reported", F.col("reported").isNotNull())
    return both.groupBy("repo", "language").agg(
        F.count(F.lit(1)).alias("n_files"),
        n(~F.col("valid")).alias("n_failed"),
        F.round(n(~F.col("valid")) / F.count(F.lit(1)), 6).alias("rate"),
        n(F.col("reported")).alias("n_reported"),
        n(F.col("reported") & ~F.col("valid")).alias("n_reported_right"),
    )
