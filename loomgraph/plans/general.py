"""Queries of the general data-pipeline operators (problems 3 and 5), with their SQL."""

from __future__ import annotations

from loomgraph.operators import incremental, references
from loomgraph.sources.tables import table


def p3_found(spark, sf):
    return incremental.pending_paths(table(spark, sf, "change_log"), table(spark, sf, "ingest_runs"))


def p3_repo_backlog(spark, sf):
    """Paths per repo, those pending and those up to date."""
    from pyspark.sql import functions as F

    states = incremental.path_states(incremental.block_digest(incremental.change_events(table(spark, sf, "change_log"), table(spark, sf, "ingest_runs"))))
    pending = (F.col("held") != F.col("wanted")).cast("long")
    return states.groupBy("repo").agg(F.count(F.lit(1)).alias("n_paths"), F.sum(pending).alias("n_pending"))


def p5_found(spark, sf):
    return references.find_orphans(*(table(spark, sf, t) for t in ("edges", "hyperedges", "entities")))


def p5_counts(spark, sf):
    return references.orphan_counts(*(table(spark, sf, t) for t in ("edges", "hyperedges", "entities")))


QUERIES = {f.__name__: f for f in (p3_found, p3_repo_backlog, p5_found, p5_counts)}

_STATES = """
WITH rows_ AS (
  SELECT *, upper(substr(trim(status), 1, 1)) AS letter, lower(trim(content_sha)) AS sha,
    EXISTS (SELECT 1 FROM ingest_runs r WHERE r.repo = c.repo AND r.status = 'succeeded'
      AND coalesce(r.since_no, 0) < c.commit_no AND c.commit_no <= r.head_no AND r.started_at >= c.recorded_at) AS processed
  FROM change_log c
), events AS (
  SELECT repo, path, commit_no, 1 AS own, processed,
    CASE WHEN letter = 'D' THEN 'absent' WHEN sha IS NULL OR sha = '' THEN 'unknown' ELSE sha END AS state
  FROM rows_
  UNION ALL
  SELECT repo, old_path, commit_no, 0, processed, 'absent' FROM rows_ WHERE letter = 'R' AND old_path IS NOT NULL
), merged AS (
  SELECT repo, path, commit_no, bool_or(processed) AS processed,
    arg_max(state, own * 2 + CASE WHEN state <> 'unknown' THEN 1 ELSE 0 END) AS state
  FROM events GROUP BY repo, path, commit_no
), states AS (
  SELECT repo, path, arg_max(processed, commit_no) AS done_last, arg_max(state, commit_no) AS wanted,
    coalesce(arg_max(state, commit_no) FILTER (WHERE processed), 'absent') AS held
  FROM merged GROUP BY repo, path
)
"""
_PENDING = "NOT done_last AND (wanted = 'unknown' OR wanted <> held)"

_REFS = """
WITH refs AS (
  SELECT DISTINCT 'edges' AS ref_table, edge_id AS row_id, 'src_id' AS field, src_id AS entity_id, repo, pushed_at FROM edges
  UNION SELECT DISTINCT 'edges', edge_id, 'dst_id', dst_id, repo, pushed_at FROM edges
  UNION SELECT DISTINCT 'hyperedges', hyper_id, 'members', unnest(members), repo, pushed_at FROM hyperedges
), real_refs AS (SELECT * FROM refs WHERE entity_id IS NOT NULL AND entity_id <> ''
), orphans AS (
  SELECT * FROM real_refs f
  WHERE NOT EXISTS (SELECT 1 FROM entities e WHERE e.repo = f.repo AND e.entity_id = f.entity_id AND e.pushed_at <= f.pushed_at)
     OR NOT EXISTS (SELECT 1 FROM entities e WHERE e.repo = f.repo AND e.entity_id = f.entity_id AND e.deleted_at IS NULL)
)
"""

SQL = {
    "p3_found": _STATES + f"SELECT repo, path FROM states WHERE {_PENDING}",
    "p3_repo_backlog": _STATES + f"SELECT repo, count(*) AS n_paths, CAST(sum(CASE WHEN {_PENDING} THEN 1 ELSE 0 END) AS BIGINT) AS n_pending FROM states GROUP BY repo",
    "p5_found": _REFS + "SELECT DISTINCT ref_table, row_id, field, entity_id FROM orphans",
    "p5_counts": _REFS
    + """, t AS (SELECT ref_table, field, strftime(pushed_at AT TIME ZONE 'UTC', '%Y-%m') AS period, count(*) AS n_refs FROM real_refs GROUP BY ALL),
    b AS (SELECT ref_table, field, strftime(pushed_at AT TIME ZONE 'UTC', '%Y-%m') AS period, count(*) AS n FROM orphans GROUP BY ALL)
    SELECT t.ref_table, t.field, t.period, n_refs, coalesce(n, 0) AS n_orphans, round(coalesce(n, 0) / n_refs, 6) AS share
    FROM t LEFT JOIN b ON t.ref_table = b.ref_table AND t.field = b.field AND t.period IS NOT DISTINCT FROM b.period""",
}
