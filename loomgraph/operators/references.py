"""References to records that do not exist.

A reference is an entity id named by ``edges`` (src_id, dst_id) or ``hyperedges`` (members). It is an
orphan when no entity row of its repo with that id was pushed at or before the reference, or when all
such entity rows are deleted. Null and empty ids are no references. A reference without pushed_at has
no entity pushed before it and is an orphan. Repeated rows and repeated members count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def references(edges: DataFrame, hyperedges: DataFrame) -> DataFrame:
    """Distinct references: (ref_table, row_id, field, repo, entity_id, pushed_at)."""
    ends = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("entity_id")) for c in ("src_id", "dst_id")])
    from_edges = edges.select(F.lit("edges").alias("ref_table"), F.col("edge_id").alias("row_id"), "repo", "pushed_at", F.explode(ends).alias("e")).select("ref_table", "row_id", "repo", "pushed_at", "e.*")
    from_members = hyperedges.select(F.lit("hyperedges").alias("ref_table"), F.col("hyper_id").alias("row_id"), "repo", "pushed_at", F.lit("members").alias("field"), F.explode("members").alias("entity_id"))
    return from_edges.unionByName(from_members).filter(F.col("entity_id").isNotNull() & (F.col("entity_id") != ""))


def parents(entities: DataFrame) -> DataFrame:
    """Live parent keys with the time of their first push; keys without a live row are no parents."""
    return (
        entities.groupBy("repo", "entity_id")
        .agg(F.min("pushed_at").alias("first_push"), F.max(F.col("deleted_at").isNull()).alias("live"))
        .filter(F.col("live") & F.col("first_push").isNotNull())
        .select("repo", "entity_id", "first_push")
    )


def orphan_references(refs: DataFrame, parent: DataFrame) -> DataFrame:
    """Orphans by an anti-join of distinct keys, joined back to the references.

    The distinct keys carry their earliest reference; a key whose parent was there by then has no
    orphan at all. Only the remaining keys, with the first push where there is a parent, meet the
    references again. A hot key is one row in the first join; in the second, AQE splits it.
    """
    earliest = F.min(F.coalesce("pushed_at", F.lit("0001-01-01 00:00:00").cast("timestamp")))
    keys = refs.groupBy("repo", "entity_id").agg(earliest.alias("earliest"))
    k, p = keys.alias("k"), parent.alias("p")
    same = F.col("k.repo").eqNullSafe(F.col("p.repo")) & (F.col("k.entity_id") == F.col("p.entity_id"))
    bad = k.join(p, same & (F.col("p.first_push") <= F.col("k.earliest")), "left_anti").alias("k")
    bad = bad.join(p, same, "left").select(F.col("k.repo").alias("bad_repo"), F.col("k.entity_id").alias("bad_id"), "first_push")
    back = refs.join(bad, refs["repo"].eqNullSafe(bad["bad_repo"]) & (refs["entity_id"] == bad["bad_id"]))
    late = F.coalesce(F.col("first_push") <= F.col("pushed_at"), F.lit(False))
    return back.filter(~late).select("ref_table", "row_id", "field", "entity_id", "repo", "pushed_at")


def _inputs(edges: DataFrame, hyperedges: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    refs = references(edges.select("edge_id", "repo", "src_id", "dst_id", "pushed_at"), hyperedges.select("hyper_id", "repo", "members", "pushed_at"))
    return refs, parents(entities.select("repo", "entity_id", "pushed_at", "deleted_at"))


def find_orphans(edges: DataFrame, hyperedges: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct (ref_table, row_id, field, entity_id) of orphan references."""
    refs, parent = _inputs(edges, hyperedges, entities)
    return orphan_references(refs, parent).select("ref_table", "row_id", "field", "entity_id").distinct()


def orphan_counts(edges: DataFrame, hyperedges: DataFrame, entities: DataFrame) -> DataFrame:
    """Per table, field and month of pushed_at (UTC): references, orphans and their share."""
    refs, parent = _inputs(edges, hyperedges, entities)
    month = F.date_format(F.to_utc_timestamp("pushed_at", F.current_timezone()), "yyyy-MM")
    group = ["ref_table", "field", "period"]
    what = ["ref_table", "row_id", "field", "entity_id", month.alias("period")]
    total = refs.select(*what).distinct().groupBy(*group).agg(F.count(F.lit(1)).alias("n_refs"))
    bad = orphan_references(refs, parent).select(*what).distinct().groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    t, b = total.alias("t"), bad.alias("b")
    same = (F.col("t.ref_table") == F.col("b.ref_table")) & (F.col("t.field") == F.col("b.field")) & F.col("t.period").eqNullSafe(F.col("b.period"))
    n = F.coalesce("n", F.lit(0))
    return t.join(b, same, "left").select("t.ref_table", "t.field", "t.period", "n_refs", n.alias("n_orphans"), F.round(n / F.col("n_refs"), 6).alias("share"))
