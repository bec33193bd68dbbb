"""Unresolved facts of single files, and the registry of the analyzers that give them.

Every analyzer is a function of (path, content) that yields facts in one flat shape. Facts say what a
file holds and names; which names mean what is decided later, by joins over the facts of all files.
A file that an analyzer cannot read through gives one fact of kind ``failed``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ("kind", "entity_id", "parent_id", "name", "target", "form", "ord", "line_start", "line_end", "header", "body", "note")
SCHEMA = (
    "repo string, path string, analyzer string, kind string, entity_id string, parent_id string, name string, target string, form string, "
    "ord int, line_start int, line_end int, header string, body string, note string"
)

Extract = Callable[[str, str], Iterator[dict]]
_REGISTRY: dict[str, Extract] = {}


def register(name: str, extract: Extract) -> None:
    """Adds or replaces the analyzer of a name."""
    _REGISTRY[name] = extract


def fact(kind: str, **values) -> dict:
    return {"kind": kind, **values}


def extract_facts(files: DataFrame, registry: dict[str, Extract] | None = None) -> DataFrame:
    """Facts of files (repo, path, analyzer, content); files without content fail.

    An analyzer that raises loses its one file, not the batch.
    """
    table = dict(_REGISTRY if registry is None else registry)

    def run(batches):
        for batch in batches:
            rows = []
            for repo, path, analyzer, content in zip(batch["repo"], batch["path"], batch["analyzer"], batch["content"]):
                if content is None:
                    found = [fact("failed", note="unreadable")]
                elif analyzer not in table:
                    found = []
                else:
                    try:
                        found = list(table[analyzer](path, content))
                    except Exception as e:  # noqa: BLE001 - one bad file must not end the run
                        found = [fact("failed", note=type(e).__name__)]
                rows += [(repo, path, analyzer, *(f.get(c) for c in COLUMNS)) for f in found]
            out = pd.DataFrame(rows, columns=["repo", "path", "analyzer", *COLUMNS])
            for c in ("ord", "line_start", "line_end"):
                out[c] = out[c].astype("Int32")
            yield out

    return files.select("repo", "path", "analyzer", "content").mapInPandas(run, SCHEMA)


def quarantine(files: DataFrame, failing: list[str]) -> DataFrame:
    """Paths of whole analyzers held back after a hard failure."""
    return files.filter(F.col("analyzer").isin(failing)).select("repo", "path").distinct()
