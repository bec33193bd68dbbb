"""Graph fragments from model answers: JSON to entities, edges and hyperedges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.scalars import concept_id, from_first_brace, hyperedge_id, tier_of
from loomgraph.schema import HYPEREDGE_CAP, HYPEREDGE_MIN

SCHEMA = (
    "nodes array<struct<id string, label string, file_type string, source_file string, source_url string, captured_at string, author string>>, "
    "edges array<struct<source string, target string, relation string, confidence string, confidence_score double, source_file string>>, "
    "hyperedges array<struct<id string, label string, nodes array<string>, relation string, confidence_score double, source_file string>>, _bad string"
)


def parse(answers: DataFrame) -> DataFrame:
    """Answers (repo, chunk_no, valid_files, body) with the fragment ``f``; malformed ones are dropped."""
    f = F.from_json(from_first_brace(F.col("body")), SCHEMA, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    return answers.withColumn("f", f).filter(F.col("f").isNotNull() & F.col("f._bad").isNull())


def _sent(path):
    """Whether a path was sent; everything counts where the list is null."""
    return F.col("valid_files").isNull() | F.coalesce(F.array_contains("valid_files", F.coalesce(path, F.lit(""))), F.lit(False))


def concepts(parsed: DataFrame) -> DataFrame:
    """Concept and rationale nodes with their canonical ids; paths that were not sent become empty."""
    n = parsed.select("repo", "chunk_no", "valid_files", F.posexplode("f.nodes").alias("ord", "n")).filter(F.col("n.file_type").isin("concept", "rationale"))
    path = F.coalesce("n.source_file", F.lit(""))
    return n.select(
        "repo", "chunk_no", "ord", F.coalesce("n.id", F.lit("")).alias("model_id"), concept_id(F.col("repo"), F.coalesce("n.label", F.lit(""))).alias("entity_id"), F.coalesce("n.label", F.lit("")).alias("ent_name"),
        F.col("n.file_type").alias("ent_type"), F.when(_sent(path), path).otherwise("").alias("file_path"), "n.source_url", "n.author", "n.captured_at",
    )


def remap_table(nodes: DataFrame) -> DataFrame:
    """Per chunk, model ids to canonical ids: the last node of an id wins."""
    one = nodes.groupBy("repo", "chunk_no", "model_id").agg(F.max_by("entity_id", "ord").alias("entity_id"))
    return one.groupBy("repo", "chunk_no").agg(F.map_from_entries(F.collect_list(F.struct("model_id", "entity_id"))).alias("remap"))


def _mapped(x):
    return F.coalesce(F.try_element_at(F.col("remap"), F.coalesce(x, F.lit(""))), x, F.lit(""))


def edges(parsed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with mapped ends; those without an end, onto themselves or from files not sent are dropped."""
    e = parsed.select("repo", "chunk_no", "valid_files", F.posexplode("f.edges").alias("ord", "e")).join(remap_table(nodes), ["repo", "chunk_no"], "left")
    rows = e.select("repo", "chunk_no", "valid_files", "ord", _mapped(F.col("e.source")).alias("src_id"), _mapped(F.col("e.target")).alias("dst_id"), F.col("e.relation").alias("relation"), F.col("e.source_file").alias("src_file"), F.coalesce("e.confidence_score", F.lit(0.0)).alias("confidence_score"))
    good = (F.col("src_id") != "") & (F.col("dst_id") != "") & (F.col("src_id") != F.col("dst_id")) & _sent(F.col("src_file"))
    return rows.filter(good).drop("valid_files").withColumn("confidence_tier", tier_of(F.col("confidence_score")))


def hyperedges(parsed: DataFrame, nodes: DataFrame, cap: int = HYPEREDGE_CAP) -> DataFrame:
    """The first ``cap`` valid hyperedges of every chunk; invalid ones do not count."""
    h = parsed.select("repo", "chunk_no", "valid_files", F.posexplode("f.hyperedges").alias("ord", "h"))
    valid = h.filter((F.size("h.nodes") >= HYPEREDGE_MIN) & _sent(F.col("h.source_file")))
    first = valid.withColumn("n", F.row_number().over(Window.partitionBy("repo", "chunk_no").orderBy("ord"))).filter(F.col("n") <= cap)
    m = first.join(remap_table(nodes), ["repo", "chunk_no"], "left").withColumn("members", F.transform("h.nodes", _mapped))
    return m.select(
        "repo", "chunk_no", "ord", hyperedge_id(F.col("repo"), F.col("h.source_file"), F.col("h.id"), F.col("h.label"), F.col("members")).alias("he_key"),
        F.col("h.label").alias("label"), F.col("h.relation").alias("relation"), F.coalesce("h.confidence_score", F.lit(0.0)).alias("confidence_score"), F.col("h.source_file").alias("src_file"), "members",
    )
