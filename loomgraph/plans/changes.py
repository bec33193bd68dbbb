"""Queries over change logs and files: status, touched and reconcile sets, routing, hashes, documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import paths as P
from loomgraph.functions import scalars as S
from loomgraph.operators import changes as C
from loomgraph.schema import JOB_TERMINAL
from loomgraph.sources.tables import table


def _changes(spark, sf):
    cols = ["repo", "path", "old_path", "status", "content_sha", "commit_no"]
    return table(spark, sf, "change_log").select(*cols).distinct()


def _failed(spark, sf):
    return table(spark, sf, "analyzer_results").select("repo", F.explode("failed_files").alias("path")).distinct()


def _files(spark, sf):
    return table(spark, sf, "source_files").dropDuplicates(["file_id"])


def content_sha(spark, sf):
    f = _files(spark, sf).filter(F.col("content").isNotNull())
    return f.select("file_id", S.sha256(F.col("content")).alias("sha"), F.octet_length("content").cast("bigint").alias("n_bytes"))


def change_status(spark, sf):
    n = C.normalise(_changes(spark, sf))
    return n.groupBy("repo", "status").agg(F.count(F.lit(1)).alias("n"), F.count("content_sha").alias("n_sha"), F.count("old_path").alias("n_old"))


def touched_set(spark, sf):
    return C.touched(C.normalise(_changes(spark, sf)), ["repo"])


def scope_set(spark, sf):
    return C.scope(C.normalise(_changes(spark, sf)), ["repo"])


def graph_files(spark, sf):
    """Touched paths without those that an analyzer quarantined."""
    return C.without(C.touched(C.normalise(_changes(spark, sf)), ["repo"]), _failed(spark, sf), ["repo"])


def reconcile_set(spark, sf):
    """Touched paths per repo whose old rows are replaced; repos whose first run was full only insert."""
    runs = table(spark, sf, "ingest_runs")
    partial = runs.filter(F.col("since_no").isNotNull()).select("repo").distinct()
    paths = C.touched(C.normalise(_changes(spark, sf)), ["repo"]).join(partial, "repo", "left_semi")
    return C.reconcile_set(paths, _failed(spark, sf), ["repo"])


def sha_cache_miss(spark, sf):
    """Files whose content no succeeded run has seen: the log's shas up to the head of the repo's last one are the cache."""
    files = _files(spark, sf).select("repo", "path", F.lower("content_sha").alias("content_sha"))
    heads = table(spark, sf, "ingest_runs").filter("status = 'succeeded'").groupBy("repo").agg(F.max("head_no").alias("head_no"))
    log = table(spark, sf, "change_log").join(heads, "repo").filter(F.col("commit_no") <= F.col("head_no")).select("repo", "path", "old_path", "status", "content_sha")
    cache = C.normalise(log.distinct()).filter(F.col("content_sha").isNotNull())
    return C.cache_misses(files, cache, ["repo"])


def route_files(spark, sf):
    """Files per analyzer, by path alone."""
    f = _files(spark, sf).select("path", C.route_alone(F.col("path")).alias("analyzer"))
    return f.filter(F.col("analyzer").isNotNull()).groupBy("analyzer").agg(F.count(F.lit(1)).alias("n_files"), F.min("path").alias("first_path"))


def chart_roots(spark, sf):
    """Roots of charts with their files and templates: of every file that is part of one, by path alone."""
    f = _files(spark, sf).filter(C.route_alone(F.col("path")) == "helm").select("repo", "path", P.chart_root(F.col("path")).alias("chart_root"), P.is_template(F.col("path")).cast("bigint").alias("t"))
    return f.groupBy("repo", "chart_root").agg(F.count(F.lit(1)).alias("n_files"), F.sum("t").alias("n_templates"))


def scan_prune(spark, sf):
    """Files a walk finds, and those in directories it never enters."""
    f = table(spark, sf, "entities").select("repo", "file_path").filter(F.col("file_path").isNotNull()).distinct()
    return f.groupBy(P.pruned(F.col("file_path")).alias("pruned")).agg(F.count(F.lit(1)).alias("n_files"), F.min("file_path").alias("first_path"))


def walk_first(spark, sf):
    """First file of every repo in the order of a walk, component by component."""
    f = _files(spark, sf)
    return f.groupBy("repo").agg(F.min_by("path", P.walk_order(F.col("path"))).alias("first_path"), F.max_by("path", P.walk_order(F.col("path"))).alias("last_path"))


def doc_language(spark, sf):
    f = _files(spark, sf).filter(P.is_doc(F.col("path")))
    return f.groupBy(P.extension(F.col("path")).alias("extension"), P.doc_language(F.col("path")).alias("language")).agg(F.count(F.lit(1)).alias("n"))


def frontmatter_split(spark, sf):
    """Provenance of documents from their header block, and the length of what remains."""
    d = table(spark, sf, "documents").filter(F.col("text").isNotNull())
    block = S.frontmatter_block(F.col("text"))
    return d.select("doc_id", *[S.frontmatter_field(block, f).alias(f) for f in ("source_url", "author")], F.length(S.frontmatter_body(F.col("text"))).cast("bigint").alias("n_body"))


def docs_entities(spark, sf):
    """Entity and chunk of every document file."""
    f = _files(spark, sf).filter(P.is_doc(F.col("path")) & F.col("content").isNotNull())
    block, path = S.frontmatter_block(F.col("content")), F.col("path")
    return f.select(
        "repo", F.concat(F.lit("doc:file:"), path).alias("entity_id"), path.alias("ent_name"), *[S.frontmatter_field(block, x).alias(x) for x in ("source_url", "author", "captured_at")],
        P.doc_language(path).alias("language"), F.concat(F.lit("[doc] "), path).alias("header"), S.sha256(S.frontmatter_body(F.col("content"))).alias("body_sha"),
    )


def python_modules(spark, sf):
    f = _files(spark, sf).filter(F.col("path").endswith(".py"))
    m = P.python_module(F.col("path"))
    return f.select("repo", m.alias("module"), P.top_level(m).alias("top")).distinct()


def run_modes(spark, sf):
    """Runs per repo: full and incremental, and how many reached a terminal state."""
    r = table(spark, sf, "ingest_runs")
    return r.groupBy("repo").agg(F.sum(F.col("since").isNull().cast("bigint")).alias("n_full"), F.count("since").alias("n_incremental"), F.sum(F.coalesce(F.col("status").isin(*JOB_TERMINAL), F.lit(False)).cast("bigint")).alias("n_terminal"))


QUERIES = {
    f.__name__: f
    for f in (content_sha, change_status, touched_set, scope_set, graph_files, reconcile_set, sha_cache_miss, route_files, chart_roots, scan_prune, walk_first, doc_language, frontmatter_split, docs_entities, python_modules, run_modes)
}

_NORMAL = """
WITH raw AS (SELECT DISTINCT repo, path, old_path, upper(substr(trim(status), 1, 1)) AS c, content_sha, commit_no FROM change_log
), changes AS (
  SELECT repo, path, commit_no, CASE WHEN c = 'R' THEN old_path END AS old_path,
    CASE WHEN c IN ('A', 'M', 'D', 'R') THEN c WHEN c = 'C' THEN 'A' WHEN c = 'T' THEN 'M' END AS status,
    CASE WHEN c <> 'D' THEN nullif(lower(content_sha), '') END AS content_sha
  FROM raw WHERE c IN ('A', 'M', 'D', 'R', 'C', 'T')
), touched AS (SELECT repo, path FROM changes UNION SELECT repo, old_path FROM changes WHERE old_path <> ''
), failed AS (SELECT DISTINCT repo, unnest(failed_files) AS path FROM analyzer_results
), files AS (SELECT DISTINCT * FROM source_files)
"""
_BLOCK = r"""
  CASE WHEN starts_with({t}, '---' || chr(10)) AND instr(substr({t}, 5), chr(10) || '---' || chr(10)) > 0 THEN substr({t}, 5, instr(substr({t}, 5), chr(10) || '---' || chr(10)) - 1) END"""
_BODY = r"""
  CASE WHEN starts_with({t}, '---' || chr(10)) AND instr(substr({t}, 5), chr(10) || '---' || chr(10)) > 0 THEN substr({t}, 5 + instr(substr({t}, 5), chr(10) || '---' || chr(10)) + 4) ELSE {t} END"""
_FIELD = r"nullif(regexp_replace(regexp_extract(block, '(?m)^{f}:[ \t]*(.*?)[ \t]*$', 1), '^[\"''](.*)[\"'']$', '\1'), '')"


def _field(f: str) -> str:
    return _FIELD.replace("{f}", f) + f" AS {f}"


_SUFFIX = "regexp_extract(path, '(\\.[^./]*)$', 1)"
SQL = {
    "content_sha": "SELECT DISTINCT file_id, sha256(content) AS sha, CAST(strlen(content) AS BIGINT) AS n_bytes FROM source_files WHERE content IS NOT NULL",
    "change_status": _NORMAL + "SELECT repo, status, count(*) AS n, count(content_sha) AS n_sha, count(old_path) AS n_old FROM changes GROUP BY repo, status",
    "touched_set": _NORMAL + "SELECT repo, path FROM touched",
    "scope_set": _NORMAL + "SELECT DISTINCT repo, path FROM changes WHERE status IN ('A', 'M', 'R')",
    "graph_files": _NORMAL + "SELECT repo, path FROM touched EXCEPT SELECT repo, path FROM failed",
    "reconcile_set": _NORMAL + "SELECT t.repo, t.path FROM touched t WHERE t.repo IN (SELECT repo FROM ingest_runs WHERE since_no IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM failed f WHERE f.repo = t.repo AND f.path = t.path)",
    "sha_cache_miss": _NORMAL + "SELECT repo, path, lower(content_sha) AS content_sha FROM files f WHERE content_sha <> '' AND NOT EXISTS (SELECT 1 FROM changes c WHERE c.repo = f.repo AND c.path = f.path AND c.content_sha = lower(f.content_sha) AND c.commit_no <= (SELECT max(head_no) FROM ingest_runs r WHERE r.repo = c.repo AND r.status = 'succeeded'))",
    "route_files": f"""WITH f AS (SELECT DISTINCT file_id, path, {_SUFFIX} AS e, string_split(path, '/') AS p FROM source_files), r AS (
      SELECT path, CASE WHEN e = '.go' THEN 'go' WHEN e = '.py' THEN 'python' WHEN e IN ('.js', '.mjs', '.cjs') THEN 'javascript' WHEN e = '.tf' THEN 'terraform'
        WHEN p[-1] IN ('Chart.yaml', 'values.yaml') OR list_contains(p, 'templates') THEN 'helm' WHEN lower(e) IN ('.md', '.markdown', '.txt', '.rst') THEN 'docs' END AS analyzer FROM f)
      SELECT analyzer, count(*) AS n_files, min(path) AS first_path FROM r WHERE analyzer IS NOT NULL GROUP BY analyzer""",
    "chart_roots": """WITH f AS (SELECT DISTINCT file_id, repo, path, string_split(path, '/') AS p FROM source_files), r AS (
      SELECT repo, CASE WHEN list_contains(p, 'templates') THEN coalesce(nullif(array_to_string(p[1:list_position(p, 'templates') - 1], '/'), ''), '.') ELSE coalesce(nullif(array_to_string(p[1:len(p) - 1], '/'), ''), '.') END AS chart_root,
        CASE WHEN list_contains(p, 'templates') THEN 1 ELSE 0 END AS t FROM f
        WHERE regexp_extract(path, '(\\.[^./]*)$', 1) NOT IN ('.go', '.py', '.js', '.mjs', '.cjs', '.tf') AND (p[-1] IN ('Chart.yaml', 'values.yaml') OR list_contains(p, 'templates')))
      SELECT repo, chart_root, count(*) AS n_files, CAST(sum(t) AS BIGINT) AS n_templates FROM r GROUP BY repo, chart_root""",
    "scan_prune": """WITH f AS (SELECT DISTINCT repo, file_path, string_split(file_path, '/') AS p FROM entities WHERE file_path IS NOT NULL)
      SELECT list_has_any(p[1:len(p) - 1], ['.git', 'node_modules', 'vendor', '.venv', 'venv', '__pycache__', '.tox', '.mypy_cache', '.pytest_cache']) AS pruned, count(*) AS n_files, min(file_path) AS first_path FROM f GROUP BY 1""",
    "walk_first": "SELECT repo, arg_min(path, string_split(path, '/')) AS first_path, arg_max(path, string_split(path, '/')) AS last_path FROM source_files GROUP BY repo",
    "doc_language": f"SELECT {_SUFFIX} AS extension, CASE WHEN lower({_SUFFIX}) = '.txt' THEN 'text' ELSE 'markdown' END AS language, count(DISTINCT file_id) AS n FROM source_files WHERE lower({_SUFFIX}) IN ('.md', '.markdown', '.txt', '.rst') GROUP BY 1, 2",
    "frontmatter_split": "WITH d AS (SELECT doc_id, replace(text, chr(13) || chr(10), chr(10)) AS t FROM documents WHERE text IS NOT NULL), s AS (SELECT doc_id, "
    + _BLOCK.replace("{t}", "t") + " AS block, " + _BODY.replace("{t}", "t") + f" AS body FROM d) SELECT doc_id, {_field('source_url')}, {_field('author')}, CAST(length(body) AS BIGINT) AS n_body FROM s",
    "docs_entities": f"WITH d AS (SELECT DISTINCT file_id, repo, path, replace(content, chr(13) || chr(10), chr(10)) AS t FROM source_files WHERE content IS NOT NULL AND lower({_SUFFIX}) IN ('.md', '.markdown', '.txt', '.rst')), s AS (SELECT repo, path, "
    + _BLOCK.replace("{t}", "t") + " AS block, " + _BODY.replace("{t}", "t") + f""" AS body FROM d) SELECT repo, 'doc:file:' || path AS entity_id, path AS ent_name, {_field('source_url')}, {_field('author')}, {_field('captured_at')},
      CASE WHEN lower({_SUFFIX}) = '.txt' THEN 'text' ELSE 'markdown' END AS language, '[doc] ' || path AS header, sha256(body) AS body_sha FROM s""",
    "python_modules": "SELECT DISTINCT repo, replace(regexp_replace(path, '\\.py$', ''), '/', '.') AS module, split_part(replace(regexp_replace(path, '\\.py$', ''), '/', '.'), '.', 1) AS top FROM source_files WHERE path LIKE '%.py'",
    "run_modes": "SELECT repo, count(*) FILTER (WHERE since IS NULL) AS n_full, count(since) AS n_incremental, count(*) FILTER (WHERE status IN ('succeeded', 'failed', 'partial')) AS n_terminal FROM ingest_runs GROUP BY repo",
}
