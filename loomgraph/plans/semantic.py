"""The model stage: files whose content is not cached are packed, asked about and parsed into the graph.

It is best effort: a chunk that fails is left out and reported, and never ends the run.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.paths import escapes
from loomgraph.operators import changes as C
from loomgraph.operators import fragments, packing
from loomgraph.operators.prompt import render_prompts

#: Model calls at a time.
CONCURRENCY = 4


def enabled(env: dict, key: str = "OPENAI_API_KEY", switch: str = "SEMANTIC_INGEST") -> bool:
    """On when a key is set and the switch is not off."""
    return bool(env.get(key)) and env.get(switch, "").lower() != "false"


def semantic_stage(files: DataFrame, changes: DataFrame, cache: DataFrame, complete: Callable[[str], str]) -> dict[str, DataFrame]:
    """Entities, edges, hyperedges, shas and outcomes; files (repo, path, content), cache (repo, path, content_sha).

    ``complete`` maps a prompt to an answer and runs in the tasks.
    """
    known = C.normalise(changes).filter(F.col("status").isin("A", "M", "R"))
    misses = C.cache_misses(known.select("repo", "path", "content_sha"), cache, ["repo"]).filter(~escapes(F.col("path"))).distinct()
    loaded = files.filter(F.col("content").isNotNull()).join(misses, ["repo", "path"])
    packed = packing.pack_files(loaded, ["repo"]).select("repo", "path", "chunk_no")
    parts = loaded.select("repo", "path", "content").join(packed, ["repo", "path"])
    asked = render_prompts(parts).join(parts.groupBy("repo", "chunk_no").agg(F.collect_list("path").alias("valid_files")), ["repo", "chunk_no"])

    def ask(batches):
        for batch in batches:
            out = []
            for p in batch["prompt"]:
                try:
                    out.append(complete(p))
                except Exception:  # noqa: BLE001 - best effort
                    out.append(None)
            yield pd.DataFrame({"repo": batch["repo"], "chunk_no": batch["chunk_no"], "valid_files": batch["valid_files"], "body": out})

    answers = asked.select("repo", "chunk_no", "valid_files", "prompt").repartition(CONCURRENCY).mapInPandas(ask, "repo string, chunk_no int, valid_files array<string>, body string")
    from loomgraph.session import cut_lineage

    answers = cut_lineage(answers)  # a model is not asked twice
    parsed = fragments.parse(answers)
    nodes = fragments.concepts(parsed)
    outcomes = answers.join(parsed.select("repo", "chunk_no").withColumn("ok", F.lit(True)), ["repo", "chunk_no"], "left").select("repo", "chunk_no", F.coalesce("ok", F.lit(False)).alias("ok"))
    return {"entities": nodes, "edges": fragments.edges(parsed, nodes), "hyperedges": fragments.hyperedges(parsed, nodes), "file_shas": misses, "outcomes": outcomes}
