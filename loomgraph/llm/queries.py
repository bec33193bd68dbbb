"""Queries of the text operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.llm import leakage, mixing, origin, secrets, split, subjects, syntax
from loomgraph.sources.tables import table


def p1_found(spark, sf):
    return syntax.find_unparsable(table(spark, sf, "source_files"))


def p1_rates(spark, sf):
    return syntax.failure_rates(table(spark, sf, "source_files"), table(spark, sf, "analyzer_results"))


def _texts(spark, sf):
    return secrets.texts_of(table(spark, sf, "chunks"), table(spark, sf, "ingest_items"))


def p2_found(spark, sf):
    return secrets.find_credentials(_texts(spark, sf))


def p2_redacted(spark, sf):
    return secrets.redact_credentials(_texts(spark, sf))


def p4_found(spark, sf):
    return origin.find_not_handwritten(table(spark, sf, "chunks"))


def p4_validation(spark, sf):
    return origin.validate(table(spark, sf, "chunks"))


def _oversized(spark, sf):
    return split.oversized(spark, *(table(spark, sf, t) for t in ("chunks", "source_files", "chunk_budgets")))


def p6_found(spark, sf):
    """Items cut into more than one piece."""
    return split.plan(split.ranges_of_rows(_oversized(spark, sf))).filter("piece_no = 1").select("item_kind", "row_id").distinct()


def p6_pieces(spark, sf):
    return split.split_items(_oversized(spark, sf))


def p7_found(spark, sf):
    return leakage.find_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_items(spark, sf):
    """Per item that leaked: its suite and the number of documents."""
    items = table(spark, sf, "eval_items").select("item_id", "suite").distinct()
    counts = p7_found(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.join(items, "item_id")


def p8_mixture(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p8_shares(spark, sf):
    return mixing.shares(p8_mixture(spark, sf), table(spark, sf, "mix_targets"))


def _subjects(spark, sf):
    return subjects.assign_subjects(*(table(spark, sf, t) for t in ("documents", "subject_labels", "subject_areas")))


def p9_found(spark, sf):
    return _subjects(spark, sf).select("doc_id", "subject").distinct()


def p9_composition(spark, sf):
    return subjects.composition(table(spark, sf, "documents"), _subjects(spark, sf))


QUERIES = {f.__name__: f for f in (p1_found, p1_rates, p2_found, p2_redacted, p4_found, p4_validation, p6_found, p6_pieces, p7_found, p7_items, p8_mixture, p8_shares, p9_found, p9_composition)}
SQL: dict = {
    "p6_found": """SELECT DISTINCT 'chunk' AS item_kind, chunk_id AS row_id FROM chunks c JOIN chunk_budgets b
      ON b.item_kind = 'chunk' AND b.lang = coalesce(c.lang, '*') AND strlen(c.body) > b.max_bytes
      UNION SELECT DISTINCT 'file', file_id FROM source_files f JOIN chunk_budgets b
      ON b.item_kind = 'file' AND b.lang = coalesce(f.lang, '*') AND strlen(f.content) > b.max_bytes""",
}
