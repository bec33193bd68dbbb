"""Queries of the extractors and of whole ingest runs over the source files."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.plans import pipeline
from loomgraph.sources.tables import table


def _files(spark, sf):
    return table(spark, sf, "source_files").select("repo", "path", "content").distinct()


def _graph(spark, sf, prefix: str):
    keep = {"python": r"\.py$", "javascript": r"\.(js|mjs|cjs)$", "go": r"\.go$", "terraform": r"\.tf$", "helm": r"\.ya?ml$", "docs": r"\.(md|markdown|txt|rst)$"}
    return pipeline.ingest(_files(spark, sf).filter(F.col("path").rlike(keep[prefix])))


def _edges(g):
    return g.edges.groupBy("relation", F.coalesce("confidence_tier", F.lit("")).alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("repo", "src_id").alias("n_src"))


def extract_python(spark, sf):
    return _edges(_graph(spark, sf, "python"))


def extract_javascript(spark, sf):
    return _edges(_graph(spark, sf, "javascript"))


def extract_go(spark, sf):
    return _edges(_graph(spark, sf, "go"))


def extract_terraform(spark, sf):
    return _edges(_graph(spark, sf, "terraform"))


def extract_helm(spark, sf):
    """Charts of this data have no manifest: one is made of each root's name."""
    files = _files(spark, sf).filter(F.col("path").rlike(r"\.ya?ml$"))
    roots = files.select("repo", pipeline.P.chart_root(F.col("path")).alias("root")).distinct()
    manifests = roots.select("repo", F.concat("root", F.lit("/Chart.yaml")).alias("path"), F.concat(F.lit("name: "), F.element_at(F.split("root", "/"), -1), F.lit("\ndependencies: []\n")).alias("content"))
    return _edges(pipeline.ingest(files.unionByName(manifests)))


def ingest_entities(spark, sf):
    """Entities of a full run over all source files, by type."""
    g = pipeline.ingest(_files(spark, sf))
    return g.entities.groupBy("repo", "ent_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity_id").alias("n_ids"))


def ingest_symbols(spark, sf):
    g = pipeline.ingest(_files(spark, sf))
    return g.symbols.groupBy("lang", "kind", "role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("repo", "symbol").alias("n_symbols"))


def ingest_incremental(spark, sf):
    """Rows a run over every change of the log emits, and the paths it replaces."""
    changes = table(spark, sf, "change_log").select("repo", "path", "old_path", "status", "content_sha").distinct()
    g = pipeline.ingest(_files(spark, sf), changes)
    count = lambda df, what: df.groupBy("repo").agg(F.count(F.lit(1)).alias("n")).select("repo", F.lit(what).alias("what"), "n")
    return count(g.entities, "entities").unionByName(count(g.edges, "edges")).unionByName(count(g.chunks, "chunks")).unionByName(count(g.reconcile, "reconcile")).unionByName(count(g.graph_files, "graph_files"))


def go_definitions(spark, sf):
    """Functions and methods of Go files, with their first lines."""
    e = _graph(spark, sf, "go").entities.filter(F.col("ent_type").isin("go_func", "go_method"))
    return e.select("repo", "entity_id", "ent_type", "file_path", F.col("line_start").cast("bigint").alias("line_start")).distinct()


def terraform_blocks(spark, sf):
    """Resources, modules, variables and outputs of Terraform files."""
    return _graph(spark, sf, "terraform").entities.filter(F.startswith("ent_type", F.lit("tf_"))).select("repo", "entity_id", "ent_type", "file_path").distinct()


QUERIES = {f.__name__: f for f in (extract_python, extract_javascript, extract_go, extract_terraform, extract_helm, ingest_entities, ingest_symbols, ingest_incremental, go_definitions, terraform_blocks)}

_LINES = """WITH f AS (SELECT DISTINCT repo, path, content FROM source_files WHERE content IS NOT NULL AND NOT list_has_any(string_split(path, '/')[1:-2], ['.git', 'node_modules', 'vendor', '.venv', 'venv', '__pycache__', '.tox', '.mypy_cache', '.pytest_cache'])),
l AS (SELECT repo, path, unnest(string_split(content, chr(10))) AS line, CAST(generate_subscripts(string_split(content, chr(10)), 1) AS BIGINT) AS no FROM f)
"""
_FUNC = r"^func +(?:\( *(?:\w+ +)?\*?(\w+)[^)]*\) *)?(\w+)"
_BLOCK = r"^(resource|module|variable|output|data) +\"([^\"]+)\"(?: +\"([^\"]+)\")? *\{"
SQL: dict[str, str] = {
    "go_definitions": _LINES + f"""SELECT DISTINCT repo, CASE WHEN r <> '' THEN 'go:method:' ELSE 'go:func:' END || '/' || regexp_replace(path, '/?[^/]*$', '') || CASE WHEN r <> '' THEN '.(' || r || ').' ELSE '.' END || n AS entity_id,
      CASE WHEN r <> '' THEN 'go_method' ELSE 'go_func' END AS ent_type, path AS file_path, no AS line_start
      FROM (SELECT repo, path, no, regexp_extract(line, '{_FUNC}', 1) AS r, regexp_extract(line, '{_FUNC}', 2) AS n FROM l WHERE path LIKE '%.go') WHERE n <> ''""",
    "terraform_blocks": _LINES + f"""SELECT DISTINCT repo, 'tf:' || CASE WHEN k = 'data' THEN 'resource' ELSE k END || ':' || regexp_replace(path, '/?[^/]*$', '') || ':' || CASE WHEN k = 'data' THEN 'data.' ELSE '' END || a || CASE WHEN b <> '' THEN '.' || b ELSE '' END AS entity_id,
      'tf_' || CASE WHEN k = 'data' THEN 'resource' ELSE k END AS ent_type, path AS file_path
      FROM (SELECT repo, path, regexp_extract(line, '{_BLOCK}', 1) AS k, regexp_extract(line, '{_BLOCK}', 2) AS a, regexp_extract(line, '{_BLOCK}', 3) AS b FROM l WHERE path LIKE '%.tf') WHERE k <> ''""",
}
