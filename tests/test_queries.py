import os

import pytest

from loomgraph.plans import batches, changes, extracts, general, graph
from tests.oracle import FOLDER, connect, same

MODULES = (general, changes, graph, batches, extracts)
SQL = {n: (m.QUERIES[n], s) for m in MODULES for n, s in m.SQL.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    same(spark, duck, *SQL[name])


@pytest.mark.parametrize("name", sorted(n for m in MODULES for n in m.QUERIES if n not in m.SQL))
def test_runs(spark, name):
    """Queries without SQL: rows are there, none twice, and counts are counts."""
    query = next(m.QUERIES[name] for m in MODULES if name in m.QUERIES)
    rows = query(spark, FOLDER).collect()
    keys = [tuple(v for c, v in r.asDict().items() if not c.startswith("n")) for r in rows]
    assert rows and len(set(keys)) == len(keys)
    assert all(v is not None and v > 0 for r in rows for c, v in r.asDict().items() if c.startswith("n"))


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["repo", "path"]


def test_every_provider_of_a_name(spark, tmp_path):
    """Two repos export a name that a third calls: one provider must not hide the other."""
    defs = [("a", "py:func:m.load", "py_func", "m.py", 1), ("b", "py:func:n.load", "py_func", "n.py", 1), ("a", "py:func:m.only", "py_func", "m.py", 9)]
    spark.createDataFrame(defs, "repo string, entity_id string, ent_type string, file_path string, line_start int").write.parquet(f"{tmp_path}/entities.parquet")
    calls = [(1, "c", "py:func:x.run", "py:func:load", "calls", "x.py"), (2, "c", "py:func:x.run", "py:func:only", "calls", "x.py")]
    spark.createDataFrame(calls, "edge_id bigint, repo string, src_id string, dst_id string, relation string, src_file string").write.parquet(f"{tmp_path}/edges.parquet")
    got = {(r.symbol, r.from_repo, r.to_repo, r.to_id) for r in graph.QUERIES["provides_requires"](spark, str(tmp_path)).collect()}
    assert got == {("load", "c", "a", "py:func:m.load"), ("load", "c", "b", "py:func:n.load"), ("only", "c", "a", "py:func:m.only")}


def test_incremental_run_covers_the_whole_log(spark):
    """Every path the log touches is replaced, however old its last change."""
    got = {r.repo: r.n for r in extracts.QUERIES["ingest_incremental"](spark, FOLDER).collect() if r.what == "graph_files"}
    log = spark.read.parquet(f"{FOLDER}/change_log.parquet").filter("path is not null and upper(left(trim(status), 1)) in ('A', 'M', 'D', 'R', 'C', 'T')")
    paths = {(r.repo, r.path) for r in log.collect()} | {(r.repo, r.old_path) for r in log.collect() if r.status.strip().upper().startswith("R") and r.old_path}
    assert sum(got.values()) == len(paths)
    assert got == {repo: sum(r == repo for r, _ in paths) for repo, _ in paths}


def test_python_definitions_against_the_parser(spark):
    """Top-level functions and classes of every file that parses are those of Python's own parser."""
    import ast

    from loomgraph.schema import PRUNED_DIRS

    files = {(r.repo, r.path): r.content for r in spark.read.parquet(f"{FOLDER}/source_files.parquet").filter("content is not null and path like '%.py'").collect()}
    g = extracts._graph(spark, FOLDER, "python")
    got: dict = {}
    for e in g.entities.filter("ent_type in ('py_func', 'py_class')").collect():
        module = e.file_path.removesuffix(".py").replace("/", ".")
        name = e.entity_id.split(":", 2)[2].removeprefix(module + ".")
        if "." not in name:
            got.setdefault((e.repo, e.file_path), set()).add(name)
    n = 0
    for key, content in files.items():
        if set(key[1].split("/")[:-1]) & set(PRUNED_DIRS):
            continue
        try:
            tree = ast.parse(content)
        except (SyntaxError, ValueError):
            continue
        want = {x.name for x in tree.body if isinstance(x, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef))}
        assert got.get(key, set()) == want, key
        n += 1
    assert n > 10
