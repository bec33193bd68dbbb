"""Queries over the graph tables: confidence, name resolution, enclosing definitions, symbols, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import scalars as S
from loomgraph.operators import resolve as R
from loomgraph.operators import store
from loomgraph.sources.tables import table


def confidence_tiers(spark, sf):
    """Edges per resolution with the score and tier it stands for, and how many rows carry that tier."""
    e = table(spark, sf, "edges").withColumn("resolution", F.col("props")["resolution"]).filter(F.col("resolution").isNotNull())
    score = S.confidence_score(F.col("resolution"))
    return e.groupBy("resolution").agg(
        F.max(score).alias("score"), F.max(S.confidence_text(F.col("resolution"))).alias("printed"), F.max(S.tier_of(score)).alias("tier"),
        F.count(F.lit(1)).alias("n"), F.sum((S.tier_of(score) == F.col("confidence_tier")).cast("bigint")).alias("n_same_tier"),
    )


def degrade_cap(spark, sf):
    """Calls from decorated callers: the score is capped and the reason appended."""
    e = table(spark, sf, "edges").filter((F.col("relation") == "calls") & F.col("props")["resolution"].isNotNull()).dropDuplicates(["edge_id"])
    p = S.degrade(F.map_concat(F.map_filter("props", lambda k, _: k == "degraded_by"), S.edge_props(F.col("props")["resolution"])), "decorator")
    score = S.props_score(F.col("p"))
    return e.withColumn("p", p).select("edge_id", F.col("p")["confidence"].alias("confidence"), F.col("p")["degraded_by"].alias("degraded_by"), S.tier_of(score).alias("tier"))


def _defs(spark, sf):
    """Definitions of functions and classes from the entity table."""
    e = table(spark, sf, "entities").filter(F.col("ent_type").isin("py_func", "py_class", "js_func", "js_class"))
    name = F.regexp_extract("entity_id", "([^.:]+)$", 1)
    return e.groupBy("repo", F.col("file_path").alias("path"), name.alias("name"), "entity_id").agg(F.min("line_start").alias("ord"))


def _calls(spark, sf):
    """Calls from the edge table; what is called is the last word of the target's id."""
    e = table(spark, sf, "edges").filter((F.col("relation") == "calls") & F.col("dst_id").isNotNull() & F.col("dst_id").rlike("^(py|js):"))
    return e.groupBy("repo", F.col("src_file").alias("path"), F.col("src_id").alias("caller"), F.regexp_extract("dst_id", "([^.:]+)$", 1).alias("callee")).agg(F.min("edge_id").alias("ord"))


def _imports(spark, sf):
    """Imports from the edge table: a file names what another file defines."""
    e = table(spark, sf, "edges").filter((F.col("relation") == "references") & F.col("dst_id").rlike("^(py|js):(func|class):"))
    return e.select("repo", F.col("src_file").alias("path"), F.regexp_extract("dst_id", "([^.:]+)$", 1).alias("name"), F.col("dst_id").alias("entity_id")).distinct()


def _resolved(spark, sf):
    return R.call_ladder(_calls(spark, sf), _defs(spark, sf), _imports(spark, sf))


def name_table(spark, sf):
    """Last definition of every name in a file."""
    return R.name_table(_defs(spark, sf))


def repo_index(spark, sf):
    """Ids of every name of a repo in walk order."""
    return R.repo_index(R.name_table(_defs(spark, sf))).select("repo", "name", F.array_join("ids", ",").alias("ids"), "n_ids")


def call_ladder(spark, sf):
    return R.call_edges(_resolved(spark, sf))


def call_ladder_levels(spark, sf):
    r = _resolved(spark, sf)
    return r.groupBy("repo", "resolution").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("src").alias("n_callers"))


def dangling_calls(spark, sf):
    return R.dangling_calls(_resolved(spark, sf))


def edge_dedup_first(spark, sf):
    """One edge per repo, ends and relation: the first pushed."""
    e = table(spark, sf, "edges").filter(F.col("dst_id").isNotNull() & (F.col("dst_id") != "")).select("repo", "src_id", "dst_id", "relation", "pushed_at", "edge_id", "src_file")
    return R.first_wins(e, ["repo", "src_id", "dst_id", "relation"], ["pushed_at", "edge_id"]).drop("pushed_at")


def enclosing_innermost(spark, sf):
    """Innermost definition whose lines hold the first line of another; a module reaches to the end of its file."""
    e = table(spark, sf, "entities").filter(F.col("line_start").isNotNull() & F.col("line_end").isNotNull())
    own = e.groupBy("repo", F.col("file_path").alias("path"), "entity_id").agg(F.min("line_start").alias("start"), F.max("line_end").alias("stop"), F.max(F.col("ent_type").isin("py_module", "js_module", "go_package")).alias("module"))
    end = e.groupBy("repo", F.col("file_path").alias("path")).agg(F.max("line_end").alias("file_end"))
    one = own.join(end, ["repo", "path"]).withColumn("stop", F.when(F.col("module"), F.col("file_end")).otherwise(F.col("stop")))
    defs = one.select("repo", "path", F.col("entity_id").alias("def_id"), "start", (F.col("stop") + 1).alias("end"), F.col("entity_id").alias("ord"))
    refs = one.select("repo", "path", F.col("entity_id").alias("ref_id"), F.col("start").alias("line"), F.col("entity_id").alias("self_id"))
    return R.innermost_enclosing(defs, refs)


def external_placeholders(spark, sf):
    return R.placeholders(table(spark, sf, "edges"), table(spark, sf, "entities"))


def _provides(spark, sf):
    return R.name_table(_defs(spark, sf)).select("repo", "entity_id", F.col("name").alias("symbol"))


def _requires(spark, sf):
    return _resolved(spark, sf).filter(F.col("dst").isNull()).select("repo", F.col("src").alias("entity_id"), F.col("callee").alias("symbol"))


def provides_requires(spark, sf):
    """Names that repos export and another calls without defining them, with every provider of the name."""
    return R.link_symbols(_provides(spark, sf), _requires(spark, sf))


def live_entities(spark, sf):
    """Last row of every entity that is not deleted."""
    e = table(spark, sf, "entities").select("repo", "entity_id", "ent_name", "ent_type", "file_path", "pushed_at", "deleted_at", "line_start")
    last = store.upsert(e, ["repo", "entity_id"], ["pushed_at", "ent_name", "line_start"])
    return last.filter(F.col("deleted_at").isNull()).select("repo", "entity_id", "ent_type", "file_path")


def reconciled_edges(spark, sf):
    """Edges that remain when every push replaces what its file and extractor pushed on earlier days."""
    e = table(spark, sf, "edges").select("edge_id", "repo", "src_file", "extractor", F.to_date("pushed_at").alias("day")).distinct()
    kept = store.latest_push(e, ["repo", "src_file", "extractor"], "day")
    return kept.groupBy("repo", "extractor").agg(F.count(F.lit(1)).alias("n_edges"), F.sum("edge_id").alias("id_sum"))


QUERIES = {
    f.__name__: f
    for f in (confidence_tiers, degrade_cap, name_table, repo_index, call_ladder, call_ladder_levels, dangling_calls, edge_dedup_first, enclosing_innermost, external_placeholders, provides_requires, live_entities, reconciled_edges)
}

_SCORE = "CASE {r} WHEN 'type_resolved' THEN 0.98 WHEN 'scoped_name_match' THEN 0.85 WHEN 'imported_name_match' THEN 0.7 WHEN 'global_name_match' THEN 0.45 WHEN 'ambiguous_multi_def' THEN 0.2 ELSE 0.0 END::DOUBLE"
_TIER = "CASE WHEN {s} >= 1.0 THEN 'EXTRACTED' WHEN {s} > 0.3 THEN 'INFERRED' ELSE 'AMBIGUOUS' END"
_RES = "props['resolution']"
_FACTS = r"""
WITH defs AS (
  SELECT repo, file_path AS path, regexp_extract(entity_id, '([^.:]+)$', 1) AS name, entity_id, min(line_start) AS ord FROM entities
  WHERE ent_type IN ('py_func', 'py_class', 'js_func', 'js_class') GROUP BY ALL
), tbl AS (
  SELECT repo, path, name, max({'o': coalesce(ord, -1), 'e': entity_id}).e AS entity_id FROM defs GROUP BY repo, path, name
), idx AS (
  SELECT repo, name, list_transform(list_sort(list({'w': string_split(path, '/'), 'e': entity_id})), lambda x: x.e) AS ids, count(*) AS n_ids FROM tbl GROUP BY repo, name
), calls AS (
  SELECT repo, src_file AS path, src_id AS caller, regexp_extract(dst_id, '([^.:]+)$', 1) AS callee, min(edge_id) AS ord FROM edges
  WHERE relation = 'calls' AND regexp_matches(dst_id, '^(py|js):') GROUP BY ALL
), imps AS (
  SELECT repo, src_file AS path, regexp_extract(dst_id, '([^.:]+)$', 1) AS name, max(dst_id) AS entity_id FROM edges
  WHERE relation = 'references' AND regexp_matches(dst_id, '^(py|js):(func|class):') GROUP BY ALL
), near AS (
  SELECT c.*, t.entity_id AS sid, i.entity_id AS iid FROM calls c
  LEFT JOIN tbl t ON t.repo = c.repo AND t.path = c.path AND t.name = c.callee
  LEFT JOIN imps i ON i.repo = c.repo AND i.path = c.path AND i.name = c.callee
), resolved AS (
  SELECT repo, path, caller AS src, coalesce(sid, iid) AS dst, CASE WHEN sid IS NOT NULL THEN 'scoped_name_match' ELSE 'imported_name_match' END AS resolution, callee, ord
  FROM near WHERE coalesce(sid, iid) IS NOT NULL
  UNION ALL
  SELECT n.repo, n.path, n.caller, unnest(CASE WHEN x.ids IS NULL THEN [NULL::VARCHAR] ELSE x.ids END), CASE WHEN x.n_ids = 1 THEN 'global_name_match' WHEN x.n_ids > 1 THEN 'ambiguous_multi_def' ELSE 'unresolved' END, n.callee, n.ord
  FROM near n LEFT JOIN idx x ON x.repo = n.repo AND x.name = n.callee WHERE coalesce(n.sid, n.iid) IS NULL
)
"""
SQL = {
    "confidence_tiers": f"""SELECT {_RES} AS resolution, max({_SCORE.format(r=_RES)}) AS score,
      max(CASE {_RES} WHEN 'type_resolved' THEN '0.98' WHEN 'scoped_name_match' THEN '0.85' WHEN 'imported_name_match' THEN '0.7' WHEN 'global_name_match' THEN '0.45' WHEN 'ambiguous_multi_def' THEN '0.2' ELSE '0' END) AS printed,
      max({_TIER.format(s=_SCORE.format(r=_RES))}) AS tier, count(*) AS n, CAST(sum(CASE WHEN {_TIER.format(s=_SCORE.format(r=_RES))} = confidence_tier THEN 1 ELSE 0 END) AS BIGINT) AS n_same_tier
      FROM edges WHERE {_RES} IS NOT NULL GROUP BY 1""",
    "degrade_cap": f"""WITH e AS (SELECT DISTINCT edge_id, {_RES} AS r, props['degraded_by'] AS d, {_SCORE.format(r=_RES)} AS s FROM edges WHERE relation = 'calls' AND {_RES} IS NOT NULL)
      SELECT edge_id, CASE WHEN s > 0.45 THEN '0.45' WHEN s = 0.45 THEN '0.45' WHEN s = 0.2 THEN '0.2' ELSE '0' END AS confidence, CASE WHEN d <> '' THEN d || ',decorator' ELSE 'decorator' END AS degraded_by,
      {_TIER.format(s='least(s, 0.45)')} AS tier FROM e""",
    "name_table": _FACTS + "SELECT repo, path, name, entity_id FROM tbl",
    "repo_index": _FACTS + "SELECT repo, name, array_to_string(ids, ',') AS ids, n_ids FROM idx",
    "call_ladder": _FACTS + f""", f AS (SELECT repo, src, dst, min({{'o': ord, 'r': resolution, 'p': path}}) AS s FROM resolved WHERE dst IS NOT NULL GROUP BY ALL)
      SELECT repo, src, dst, s.p AS src_file, s.r AS resolution, {_SCORE.format(r='s.r')} AS confidence_score, {_TIER.format(s=_SCORE.format(r='s.r'))} AS confidence_tier FROM f""",
    "call_ladder_levels": _FACTS + "SELECT repo, resolution, count(*) AS n, count(DISTINCT src) AS n_callers FROM resolved GROUP BY repo, resolution",
    "dangling_calls": _FACTS + ", f AS (SELECT repo, src, callee, min(ord) AS ord FROM resolved WHERE dst IS NULL GROUP BY ALL) SELECT repo, src, string_agg(callee, ',' ORDER BY ord, callee) AS dangling_call FROM f GROUP BY repo, src",
    "edge_dedup_first": "SELECT repo, src_id, dst_id, relation, s.e AS edge_id, s.f AS src_file FROM (SELECT repo, src_id, dst_id, relation, min({'p': pushed_at, 'e': edge_id, 'f': src_file}) AS s FROM edges WHERE dst_id <> '' GROUP BY ALL)",
    "enclosing_innermost": """WITH own AS (SELECT repo, file_path AS path, entity_id, min(line_start) AS a, max(line_end) AS z, bool_or(ent_type IN ('py_module', 'js_module', 'go_package')) AS m FROM entities WHERE line_start IS NOT NULL AND line_end IS NOT NULL GROUP BY ALL),
      one AS (SELECT repo, path, entity_id, a, CASE WHEN m THEN max(z) OVER (PARTITION BY repo, path) ELSE z END AS z FROM own)
      SELECT r.repo, r.path, r.entity_id AS ref_id, min({'s': d.z + 1 - d.a, 'o': d.entity_id}).o AS def_id FROM one r JOIN one d ON d.repo = r.repo AND d.path = r.path AND d.a <= r.a AND r.a < d.z + 1 AND d.entity_id <> r.entity_id GROUP BY ALL""",
    "external_placeholders": "SELECT DISTINCT repo, dst_id AS entity_id FROM edges e WHERE dst_id <> '' AND NOT EXISTS (SELECT 1 FROM entities x WHERE x.repo = e.repo AND x.entity_id = e.dst_id)",
    "provides_requires": _FACTS + "SELECT DISTINCT r.callee AS symbol, r.repo AS from_repo, r.src AS from_id, t.repo AS to_repo, t.entity_id AS to_id FROM resolved r JOIN tbl t ON t.name = r.callee AND t.repo <> r.repo WHERE r.dst IS NULL",
    "live_entities": """WITH l AS (SELECT *, row_number() OVER (PARTITION BY repo, entity_id ORDER BY pushed_at DESC, ent_name DESC, line_start DESC NULLS LAST) AS n FROM entities)
      SELECT repo, entity_id, ent_type, file_path FROM l WHERE n = 1 AND deleted_at IS NULL""",
    "reconciled_edges": """WITH e AS (SELECT DISTINCT edge_id, repo, src_file, extractor, CAST(pushed_at AT TIME ZONE 'UTC' AS DATE) AS day FROM edges), m AS (SELECT repo, src_file, extractor, max(day) AS d FROM e GROUP BY ALL)
      SELECT e.repo, e.extractor, count(*) AS n_edges, CAST(sum(edge_id) AS BIGINT) AS id_sum FROM e JOIN m ON m.repo = e.repo AND m.src_file IS NOT DISTINCT FROM e.src_file AND m.extractor = e.extractor AND m.d = e.day GROUP BY ALL""",
}
