"""Payloads of pushes: the rows of a batch as one JSON object, without empty values.

A batch is bounded by its caps, so its lists are. Batches of a push go to the sink in order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _object(fields: dict[str, Column]) -> Column:
    """A JSON object of named columns; nulls are left out, and so are empty texts, zeros and empty maps."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def _quoted(c: str) -> Column:
    """A text as a JSON string."""
    j = F.to_json(F.struct(F.col(c).alias("r")))
    return F.substring(j, F.lit(6), F.length(j) - 6)


def _text(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def _number(c: str) -> Column:
    return F.when(F.col(c) != 0, F.col(c))


def _props(c: str) -> Column:
    return F.when(F.size(c) > 0, F.col(c))


def entity_json() -> Column:
    return _object({"id": F.col("entity_id"), "name": F.coalesce("ent_name", F.lit("")), "type": F.col("ent_type"), "file_path": F.coalesce("file_path", F.lit("")), "line_start": _number("line_start"), "line_end": _number("line_end"), "source_url": _text("source_url"), "author": _text("author"), "captured_at": _text("captured_at"), "properties": _props("props")})


def edge_json() -> Column:
    return _object({"from": F.col("src_id"), "to": F.col("dst_id"), "relation": F.col("relation"), "src_file": F.coalesce("src_file", F.lit("")), "confidence_score": _number("confidence_score"), "confidence_tier": _text("confidence_tier"), "properties": _props("props")})


def symbol_json() -> Column:
    return _object({c: F.coalesce(c, F.lit("")) for c in ("symbol", "lang", "kind", "role", "entity_id", "src_file")})


def hyperedge_json() -> Column:
    return _object({"id": F.col("he_key"), "label": F.coalesce("label", F.lit("")), "relation": F.coalesce("relation", F.lit("")), "confidence_score": _number("confidence_score"), "src_file": F.coalesce("src_file", F.lit("")), "members": F.filter("members", lambda m: m.isNotNull())})


def payloads(packed: DataFrame, entities: DataFrame, edges: DataFrame, symbols: DataFrame, commit: str, extractor: str, hyperedges: DataFrame | None = None, shas: DataFrame | None = None) -> DataFrame:
    """(repo, batch_no, payload) of packed files (repo, path, batch_no); rows of no listed file join batch 0.

    ``hyperedges`` and the content hashes ``shas`` (repo, path, content_sha) of the files are there after a
    model stage.
    """
    files = packed.select("repo", "path", "batch_no")

    def placed(df: DataFrame, column: str, value: Column, what: str) -> DataFrame:
        rows = df.select("repo", F.col(column).alias("path"), value.alias("j"))
        return rows.join(files, ["repo", "path"], "left").select("repo", F.coalesce("batch_no", F.lit(0)).alias("batch_no"), F.lit(what).alias("what"), "j")

    rows = (
        placed(entities, "file_path", entity_json(), "entities")
        .unionByName(placed(edges, "src_file", edge_json(), "edges"))
        .unionByName(placed(symbols, "src_file", symbol_json(), "symbols"))
        .unionByName(files.select("repo", "batch_no", F.lit("files").alias("what"), _quoted("path").alias("j")))
    )
    if hyperedges is not None:
        rows = rows.unionByName(placed(hyperedges, "src_file", hyperedge_json(), "hyperedges"))
    if shas is not None:
        known = files.join(shas.filter(F.col("content_sha") != "").select("repo", "path", "content_sha").distinct(), ["repo", "path"])
        rows = rows.unionByName(known.select("repo", "batch_no", F.lit("file_shas").alias("what"), F.concat(_quoted("path"), F.lit(":"), _quoted("content_sha")).alias("j")))
    lists = rows.groupBy("repo", "batch_no").pivot("what", ["entities", "edges", "symbols", "files", "hyperedges", "file_shas"]).agg(F.array_join(F.array_sort(F.collect_list("j")), ","))
    part = lambda c, always: F.when(F.lit(always) | (F.col(c) != ""), F.concat(F.lit(f',"{c}":['), F.coalesce(c, F.lit("")), F.lit("]"))).otherwise("")
    text = F.concat(F.lit('{"repo":'), _quoted("repo"), F.lit(f',"commit":{json.dumps(commit)},"extractor":{json.dumps(extractor)},"files":['), F.coalesce("files", F.lit("")), F.lit("]"), part("entities", True), part("edges", True), part("symbols", False), part("hyperedges", False), F.when(F.col("file_shas") != "", F.concat(F.lit(',"file_shas":{'), F.col("file_shas"), F.lit("}"))).otherwise(""), F.lit("}"))
    return lists.select("repo", "batch_no", text.alias("payload"))


def in_order(rows: DataFrame) -> Iterator[dict]:
    """Payloads one after the other, by repo and batch; the driver holds one partition at a time."""
    for r in rows.orderBy("repo", "batch_no").toLocalIterator():
        yield json.loads(r.payload)
