"""Queries over chunks, items, pushes and model answers: packing, keys, fragments, prompts, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import paths as P
from loomgraph.functions import scalars as S
from loomgraph.operators import fragments, metrics, packing
from loomgraph.operators.prompt import TEMPLATE, render_prompts
from loomgraph.schema import HISTOGRAM_ROWS, HYPEREDGE_CAP, HYPEREDGE_MIN
from loomgraph.sources.tables import table


def _chunks(spark, sf):
    return table(spark, sf, "chunks").select("chunk_id", "repo", "entity_id", "ent_type", "file_path", "lang", "header", "body").distinct()


def chunk_items(spark, sf):
    """Items of all chunks by key, the last chunk wins."""
    i = packing.chunk_items(_chunks(spark, sf), ["chunk_id"])
    return i.select("idempotency_key", F.col("first.chunk_id").alias("first_chunk"), F.octet_length("text").cast("bigint").alias("n_bytes"), F.col("metadata")["file_path"].alias("file_path"), F.col("metadata")["language"].alias("language"))


def item_dedup_last_wins(spark, sf):
    """Sent items by key: the last text, the place of the first."""
    i = table(spark, sf, "ingest_items").select("item_no", "repo", "idempotency_key", "text").distinct()
    one = i.groupBy("repo", "idempotency_key").agg(F.min("item_no").alias("first_no"), F.max_by("text", "item_no").alias("text"), F.count(F.lit(1)).alias("n_sent"))
    return one.select("repo", "idempotency_key", "first_no", "n_sent", S.sha256(F.col("text")).alias("text_sha"))


def items_sent(spark, sf):
    """Chunks per repo that were sent as an item with the key their text gives."""
    keys = packing.chunk_items(_chunks(spark, sf), ["chunk_id"]).select("repo", "idempotency_key")
    sent = table(spark, sf, "ingest_items").select("idempotency_key").distinct().withColumn("sent", F.lit(1))
    return keys.join(sent, "idempotency_key", "left").groupBy("repo").agg(F.count(F.lit(1)).alias("n_items"), F.count("sent").alias("n_sent"))


def _owned(spark, sf):
    """Rows per file and push: one push a repo and month."""
    month = F.date_format(F.to_utc_timestamp("pushed_at", F.current_timezone()), "yyyy-MM").alias("month")
    e = table(spark, sf, "entities").select("repo", month, "file_path", "entity_id", "pushed_at").distinct().select("repo", "month", "file_path")
    d = table(spark, sf, "edges").dropDuplicates(["edge_id"]).select("repo", month, "src_file")
    h = table(spark, sf, "hyperedges").dropDuplicates(["hyper_id"]).select("repo", month, "src_file")
    return packing.graph_rows_per_file(e, d, h, ["repo", "month"])


def pack_graph_batches(spark, sf):
    """Pushes packed into batches of at most 40 rows and 12 files; small bounds, so that pushes do split."""
    owned = _owned(spark, sf)
    return packing.pack_graph(owned.filter(F.col("path") != ""), owned, ["repo", "month"], 40, 12).select("repo", "month", "path", "n_rows", "batch_no")


def batch_totals(spark, sf):
    """Batches, files and rows per push."""
    b = pack_graph_batches(spark, sf)
    return b.groupBy("repo", "month").agg((F.max("batch_no") + 1).alias("n_batches"), F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


def pack_chunks(spark, sf):
    """Files of every repo packed into chunks of at most eight files and 48 KiB."""
    f = table(spark, sf, "source_files").filter(F.col("content").isNotNull()).dropDuplicates(["file_id"])
    return packing.pack_files(f, ["repo"])


def slug_concept_ids(spark, sf):
    h = table(spark, sf, "hyperedges").select("repo", "label").distinct()
    return h.select("repo", "label", S.slug(F.col("label")).alias("slug"), S.concept_id(F.col("repo"), F.col("label")).alias("concept_id"))


def hyperedge_ids(spark, sf):
    """Ids of hyperedges from file and last part of the key, and the fallback from label and members."""
    h = table(spark, sf, "hyperedges").dropDuplicates(["hyper_id"])
    members = F.filter("members", lambda m: m.isNotNull())
    model = F.split_part("he_key", F.lit(":"), F.lit(-1))
    return h.select("hyper_id", S.hyperedge_id(F.col("repo"), F.col("src_file"), model, F.col("label"), members).alias("by_file"), S.hyperedge_id(F.col("repo"), F.lit(""), model, F.col("label"), members).alias("by_hash"))


def hyperedges_capped(spark, sf):
    """The first three hyperedges per file that have three members or more."""
    from pyspark.sql import Window

    h = table(spark, sf, "hyperedges").dropDuplicates(["hyper_id"]).filter(F.size("members") >= HYPEREDGE_MIN)
    n = F.row_number().over(Window.partitionBy("repo", "src_file").orderBy("hyper_id"))
    return h.withColumn("n", n).filter(F.col("n") <= HYPEREDGE_CAP).select("hyper_id", "n", F.size("members").alias("n_members"))


def _answers(spark, sf):
    """Model answers of one hyperedge each, as text with prose around the JSON."""
    h = table(spark, sf, "hyperedges").dropDuplicates(["hyper_id"])
    node = F.struct(F.lit("n1").alias("id"), F.col("label").alias("label"), F.lit("concept").alias("file_type"), F.col("src_file").alias("source_file"))
    edges = F.transform("members", lambda m: F.struct(F.lit("n1").alias("source"), m.alias("target"), F.lit("cites").alias("relation"), F.col("confidence_score").alias("confidence_score"), F.col("src_file").alias("source_file")))
    he = F.struct(F.col("he_key").alias("id"), F.col("label").alias("label"), F.col("members").alias("nodes"), F.col("relation").alias("relation"), F.col("confidence_score").alias("confidence_score"), F.col("src_file").alias("source_file"))
    text = F.concat(F.lit("Answer:\n```json\n"), F.to_json(F.struct(F.array(node).alias("nodes"), edges.alias("edges"), F.array(he).alias("hyperedges"))), F.lit("\n```"))
    return h.select("repo", F.col("hyper_id").alias("chunk_no"), F.array("src_file").alias("valid_files"), text.alias("body"))


def fragment_parse(spark, sf):
    """Edges of model answers with mapped ends, scores and tiers."""
    p = fragments.parse(_answers(spark, sf))
    return fragments.edges(p, fragments.concepts(p)).select("chunk_no", "src_id", "dst_id", "relation", "src_file", "confidence_score", "confidence_tier").distinct()


def fragment_hyperedges(spark, sf):
    p = fragments.parse(_answers(spark, sf))
    h = fragments.hyperedges(p, fragments.concepts(p))
    return h.select("chunk_no", "he_key", "label", F.size("members").alias("n_members"))


# Imports and re-exports at the start of a line, in either quotes, and calls of require.
_FROM = r"""(?m)^(?:import|export)\b(?:[^'"\n;]*\bfrom)?[ \t]*(['"])([^'"\n]+)['"]"""
_REQUIRE = r"""\brequire\([ \t]*(['"])([^'"\n]+)['"][ \t]*\)"""


def _imports(spark, sf):
    """Module names that scripts import, re-export or require."""
    f = table(spark, sf, "source_files").filter(F.col("path").rlike(r"\.(js|mjs|cjs)$") & F.col("content").isNotNull()).dropDuplicates(["file_id"])
    found = F.array_union(F.regexp_extract_all("content", F.lit(_FROM), F.lit(2)), F.regexp_extract_all("content", F.lit(_REQUIRE), F.lit(2)))
    return f.select("repo", "path", F.explode(found).alias("spec")).filter(F.col("spec") != "").distinct()


def resolve_module_path(spark, sf):
    i = _imports(spark, sf)
    return i.select("repo", "path", "spec", P.resolve_module_path(P.dirname(F.col("path")), F.col("spec")).alias("target"))


def import_edges(spark, sf):
    """Import edges to modules that exist, and the rest by kind."""
    i = resolve_module_path(spark, sf)
    known = table(spark, sf, "source_files").select("repo", F.col("path").alias("target")).distinct().withColumn("known", F.lit(1))
    j = i.join(known, ["repo", "target"], "left")
    kind = F.when(F.col("known").isNotNull(), "edge").when(F.startswith(F.col("spec"), F.lit(".")), "missing").otherwise("external")
    return j.groupBy("repo", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("target").alias("n_targets"))


def prompts(spark, sf):
    """Prompts of all chunks of files: number of files and length."""
    f = table(spark, sf, "source_files").filter(F.col("content").isNotNull()).dropDuplicates(["file_id"])
    packed = pack_chunks(spark, sf).select("repo", "path", "chunk_no")
    return render_prompts(f.select("repo", "path", "content").join(packed, ["repo", "path"])).select("repo", "chunk_no", "n_chunks", "n_files", S.sha256(F.col("prompt")).alias("prompt_sha"))


def metric_counters(spark, sf):
    r = table(spark, sf, "analyzer_results").dropDuplicates(["result_id"])
    files = metrics.counters(r, ["analyzer"], "n_files").withColumnRenamed("n", "files")
    errors = metrics.counters(r, ["analyzer"], "parse_errors").withColumnRenamed("n", "errors")
    return files.join(errors, "analyzer").join(metrics.counters(r, ["analyzer"]).withColumnRenamed("n", "results"), "analyzer")


def metric_histogram(spark, sf):
    """Cumulative histogram of rows per file."""
    rows = _owned(spark, sf).groupBy("repo", "path").agg(F.sum("n_rows").alias("n_rows"))
    return metrics.histogram(rows, ["repo"], "n_rows", HISTOGRAM_ROWS)


def flatten_props(spark, sf):
    """Leaves of JSON properties of events: type and how many, by key."""
    e = table(spark, sf, "events").select("event_type", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return e.groupBy("event_type", "key").agg(F.count("value").alias("n"), F.sum(F.expr("try_cast(value as bigint)")).alias("total"))


QUERIES = {
    f.__name__: f
    for f in (chunk_items, item_dedup_last_wins, items_sent, pack_graph_batches, batch_totals, pack_chunks, slug_concept_ids, hyperedge_ids, hyperedges_capped, fragment_parse, fragment_hyperedges, resolve_module_path, import_edges, prompts, metric_counters, metric_histogram, flatten_props)
}

_SLUG = "regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"
_ITEMS = """
WITH c AS (SELECT DISTINCT chunk_id, repo, entity_id, file_path, lang, coalesce(header, '') || chr(10) || '---' || chr(10) || coalesce(body, '') AS text FROM chunks),
k AS (SELECT *, repo || ':' || entity_id || ':' || sha256(text) AS idempotency_key FROM c)
"""
_OWNED = """
WITH rows_ AS (
  SELECT repo, strftime(pushed_at AT TIME ZONE 'UTC', '%Y-%m') AS month, coalesce(file_path, '') AS path FROM (SELECT DISTINCT repo, file_path, entity_id, pushed_at FROM entities)
  UNION ALL SELECT repo, strftime(pushed_at AT TIME ZONE 'UTC', '%Y-%m'), coalesce(src_file, '') FROM (SELECT DISTINCT edge_id, repo, src_file, pushed_at FROM edges)
  UNION ALL SELECT repo, strftime(pushed_at AT TIME ZONE 'UTC', '%Y-%m'), coalesce(src_file, '') FROM (SELECT DISTINCT hyper_id, repo, src_file, pushed_at FROM hyperedges)
), owned AS (SELECT repo, month, path, count(*) AS n_rows FROM rows_ GROUP BY ALL)
"""
_PACKED = (
    _OWNED.replace("WITH rows_", "WITH RECURSIVE rows_")
    + """, unfiled AS (SELECT repo, month, sum(n_rows) AS u FROM owned WHERE path = '' GROUP BY ALL),
f AS (SELECT o.repo, o.month, o.path, o.n_rows, coalesce(u.u, 0) AS u, row_number() OVER (PARTITION BY o.repo, o.month ORDER BY o.path) AS i FROM owned o LEFT JOIN unfiled u USING (repo, month) WHERE o.path <> ''),
p AS (
  SELECT repo, month, path, n_rows, i, 0 AS batch_no, u + n_rows AS load, 1 AS files FROM f WHERE i = 1
  UNION ALL
  SELECT f.repo, f.month, f.path, f.n_rows, f.i, CASE WHEN p.load + f.n_rows > 40 OR p.files >= 12 THEN p.batch_no + 1 ELSE p.batch_no END,
    CASE WHEN p.load + f.n_rows > 40 OR p.files >= 12 THEN f.n_rows ELSE p.load + f.n_rows END, CASE WHEN p.load + f.n_rows > 40 OR p.files >= 12 THEN 1 ELSE p.files + 1 END
  FROM p JOIN f ON f.repo = p.repo AND f.month = p.month AND f.i = p.i + 1
)
"""
)
_HE = "(SELECT DISTINCT hyper_id, repo, he_key, label, relation, confidence_score, src_file, members FROM hyperedges)"
_HEID = "'he:' || repo || ':' || "
_IMPORTS = r"""
WITH i AS (SELECT DISTINCT repo, path, unnest(regexp_extract_all(content, '(?m)^(?:import|export)\b(?:[^''"\n;]*\bfrom)?[ \t]*([''"])([^''"\n]+)[''"]', 2) || regexp_extract_all(content, '\brequire\([ \t]*([''"])([^''"\n]+)[''"][ \t]*\)', 2)) AS spec FROM source_files WHERE regexp_matches(path, '\.(js|mjs|cjs)$')),
d AS (SELECT *, CASE WHEN instr(path, '/') = 0 THEN '' ELSE regexp_replace(path, '/[^/]*$', '') || '/' END AS dir FROM i),
j AS (SELECT repo, path, spec, CASE WHEN NOT starts_with(spec, '.') THEN spec WHEN starts_with(spec, './') THEN dir || substr(spec, 3)
  WHEN starts_with(spec, '../') AND length(dir) - length(replace(dir, '/', '')) >= 1 THEN regexp_replace(dir, '[^/]*/$', '') || substr(spec, 4) ELSE spec END AS t FROM d),
r AS (SELECT repo, path, spec, CASE WHEN NOT starts_with(spec, '.') THEN t WHEN instr(regexp_extract(t, '([^/]*)$', 1), '.') = 0 THEN t || '.js' ELSE t END AS target FROM j)
"""
_FILES_PACKED = """WITH RECURSIVE s AS (SELECT DISTINCT file_id, repo, path, content, strlen(content) AS n_bytes FROM source_files WHERE content IS NOT NULL),
      f AS (SELECT repo, path, n_bytes, row_number() OVER (PARTITION BY repo ORDER BY path) AS i FROM s),
      p AS (SELECT repo, path, n_bytes, i, 0 AS chunk_no, n_bytes AS load, 1 AS files FROM f WHERE i = 1 UNION ALL
        SELECT f.repo, f.path, f.n_bytes, f.i, CASE WHEN p.load + f.n_bytes > 49152 OR p.files >= 8 THEN p.chunk_no + 1 ELSE p.chunk_no END,
        CASE WHEN p.load + f.n_bytes > 49152 OR p.files >= 8 THEN f.n_bytes ELSE p.load + f.n_bytes END, CASE WHEN p.load + f.n_bytes > 49152 OR p.files >= 8 THEN 1 ELSE p.files + 1 END
        FROM p JOIN f ON f.repo = p.repo AND f.i = p.i + 1)
"""


def _prompt_sql() -> str:
    """The prompt's template as a concatenation."""
    import re

    columns = {"number": "CAST(chunk_no + 1 AS VARCHAR)", "total": "CAST(n_chunks AS VARCHAR)", "repo": "repo", "files": "names", "contents": "bodies"}
    parts = re.split(r"\{(\w+)\}", TEMPLATE)
    text = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return " || ".join(columns[x] if i % 2 else text(x) for i, x in enumerate(parts))


_PROMPTS = (
    _FILES_PACKED
    + """, g AS (SELECT p.repo, p.chunk_no, count(*) AS n_files, string_agg('- ' || p.path, chr(10) ORDER BY p.path) AS names,
        string_agg('### ' || p.path || chr(10) || '```' || chr(10) || s.content || chr(10) || '```', chr(10) || chr(10) ORDER BY p.path) AS bodies
        FROM p JOIN s ON s.repo = p.repo AND s.path = p.path GROUP BY p.repo, p.chunk_no),
      n AS (SELECT *, max(chunk_no) OVER (PARTITION BY repo) + 1 AS n_chunks FROM g)
      SELECT repo, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(n_chunks AS INTEGER) AS n_chunks, CAST(n_files AS INTEGER) AS n_files, sha256("""
    + _prompt_sql()
    + ") AS prompt_sha FROM n"
)
SQL = {
    "chunk_items": _ITEMS + """SELECT idempotency_key, min(chunk_id) AS first_chunk, CAST(strlen(arg_max(text, chunk_id)) AS BIGINT) AS n_bytes, arg_max(file_path, chunk_id) AS file_path, arg_max(coalesce(lang, ''), chunk_id) AS language FROM k GROUP BY repo, idempotency_key""",
    "item_dedup_last_wins": "WITH i AS (SELECT DISTINCT item_no, repo, idempotency_key, text FROM ingest_items) SELECT repo, idempotency_key, min(item_no) AS first_no, count(*) AS n_sent, sha256(arg_max(text, item_no)) AS text_sha FROM i GROUP BY repo, idempotency_key",
    "items_sent": _ITEMS + ", d AS (SELECT DISTINCT repo, idempotency_key FROM k) SELECT repo, count(*) AS n_items, count(*) FILTER (WHERE idempotency_key IN (SELECT idempotency_key FROM ingest_items)) AS n_sent FROM d GROUP BY repo",
    "pack_graph_batches": _PACKED + "SELECT repo, month, path, n_rows, CAST(batch_no AS INTEGER) AS batch_no FROM p",
    "batch_totals": _PACKED + "SELECT repo, month, CAST(max(batch_no) + 1 AS INTEGER) AS n_batches, count(*) AS n_files, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM p GROUP BY repo, month",
    "pack_chunks": _FILES_PACKED + "SELECT repo, path, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(chunk_no AS INTEGER) AS chunk_no FROM p",
    "prompts": _PROMPTS,
    "slug_concept_ids": f"SELECT DISTINCT repo, label, {_SLUG.format(x='label')} AS slug, 'concept:' || repo || ':' || CASE WHEN {_SLUG.format(x='label')} = '' THEN substr(sha256(label), 1, 16) ELSE {_SLUG.format(x='label')} END AS concept_id FROM hyperedges",
    "hyperedge_ids": f"""WITH h AS (SELECT *, list_filter(members, lambda m: m IS NOT NULL) AS ms, string_split(he_key, ':')[-1] AS m FROM {_HE}), s AS (SELECT *, {_SLUG.format(x='src_file')} AS f, {_SLUG.format(x='m')} AS g, substr(sha256(label || array_to_string(ms, '')), 1, 16) AS x FROM h)
      SELECT hyper_id, {_HEID} CASE WHEN f = '' OR g = '' THEN x ELSE f || ':' || g END AS by_file, {_HEID} x AS by_hash FROM s""",
    "hyperedges_capped": f"WITH h AS (SELECT hyper_id, len(members) AS n_members, row_number() OVER (PARTITION BY repo, src_file ORDER BY hyper_id) AS n FROM {_HE} WHERE len(members) >= 3) SELECT hyper_id, CAST(n AS INTEGER) AS n, CAST(n_members AS INTEGER) AS n_members FROM h WHERE n <= 3",
    "fragment_parse": f"""WITH h AS (SELECT *, 'concept:' || repo || ':' || {_SLUG.format(x='label')} AS c FROM {_HE}), e AS (SELECT hyper_id, c, unnest(members) AS m, src_file, confidence_score AS s FROM h)
      SELECT DISTINCT hyper_id AS chunk_no, c AS src_id, m AS dst_id, 'cites' AS relation, src_file, s AS confidence_score, {"CASE WHEN s >= 1.0 THEN 'EXTRACTED' WHEN s > 0.3 THEN 'INFERRED' ELSE 'AMBIGUOUS' END"} AS confidence_tier FROM e WHERE m <> '' AND m <> c""",
    "fragment_hyperedges": f"WITH s AS (SELECT *, {_SLUG.format(x='src_file')} AS f, {_SLUG.format(x='he_key')} AS g FROM {_HE} WHERE len(members) >= 3) SELECT hyper_id AS chunk_no, {_HEID} f || ':' || g AS he_key, label, CAST(len(members) AS INTEGER) AS n_members FROM s",
    "resolve_module_path": _IMPORTS + "SELECT repo, path, spec, target FROM r",
    "import_edges": _IMPORTS + ", k AS (SELECT DISTINCT repo, path FROM source_files), j2 AS (SELECT r.*, CASE WHEN k.path IS NOT NULL THEN 'edge' WHEN starts_with(spec, '.') THEN 'missing' ELSE 'external' END AS kind FROM r LEFT JOIN k ON k.repo = r.repo AND k.path = r.target) SELECT repo, kind, count(*) AS n, count(DISTINCT target) AS n_targets FROM j2 GROUP BY repo, kind",
    "metric_counters": "WITH r AS (SELECT DISTINCT result_id, analyzer, n_files, parse_errors FROM analyzer_results) SELECT analyzer, CAST(sum(n_files) AS BIGINT) AS files, CAST(sum(parse_errors) AS BIGINT) AS errors, count(*) AS results FROM r GROUP BY analyzer",
    "metric_histogram": _OWNED + ", t AS (SELECT repo, path, sum(n_rows) AS n FROM owned GROUP BY ALL), b AS (SELECT unnest([10, 50, 100, 250, 500, 1000, 2000, 5000, 10000]) AS le) SELECT repo, CAST(le AS VARCHAR) AS le, CAST(sum(CASE WHEN n <= le THEN 1 ELSE 0 END) AS BIGINT) AS n FROM t, b GROUP BY ALL UNION ALL SELECT repo, '+Inf', count(*) FROM t GROUP BY repo",
    "flatten_props": "WITH e AS (SELECT event_type, unnest(json_keys(props)) AS key, props FROM events) SELECT event_type, key, count(json_extract_string(props, '$.' || key)) AS n, CAST(sum(TRY_CAST(json_extract_string(props, '$.' || key) AS BIGINT)) AS BIGINT) AS total FROM e GROUP BY event_type, key",
}
