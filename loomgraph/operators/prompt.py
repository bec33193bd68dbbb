"""Prompts for model extraction: files of a chunk rendered into one text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Placeholders stand once each and are filled in one pass, so that file contents cannot introduce any.
TEMPLATE = (
    "Part {number} of {total} of repository {repo}.\n"
    "Name the concepts, the reasons and the relations that these files state. Answer with one JSON object\n"
    "with the lists nodes, edges and hyperedges.\n\nFiles:\n{files}\n\n{contents}\n"
)


def render_prompts(files: DataFrame) -> DataFrame:
    """(repo, chunk_no, n_chunks, n_files, prompt) of files (repo, path, content, chunk_no).

    A chunk is bounded by its budget, so collecting its files is; they stand in order of path.
    """
    ordered = F.array_sort(F.collect_list(F.struct("path", "content")))
    groups = files.groupBy("repo", "chunk_no").agg(ordered.alias("fs"))
    total = files.groupBy("repo").agg((F.max("chunk_no") + 1).alias("n_chunks"))
    names = F.array_join(F.transform("fs", lambda f: F.concat(F.lit("- "), f["path"])), "\n")
    bodies = F.array_join(F.transform("fs", lambda f: F.concat(F.lit("### "), f["path"], F.lit("\n```\n"), f["content"], F.lit("\n```"))), "\n\n")
    parts = {"number": (F.col("chunk_no") + 1).cast("string"), "total": F.col("n_chunks").cast("string"), "repo": F.col("repo"), "files": names, "contents": bodies}
    pieces, rest = [], TEMPLATE
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += [F.lit(head), parts[name]]
    return groups.join(total, "repo").select("repo", "chunk_no", "n_chunks", F.size("fs").alias("n_files"), F.concat(*pieces, F.lit(rest)).alias("prompt"))
