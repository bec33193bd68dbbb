"""Operators on small tables, against hand-made or brute-force results."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import paths as P
from loomgraph.functions import scalars as S
from loomgraph.functions.sizing import collect_bounded
from loomgraph.operators import changes as C
from loomgraph.operators import fragments, incremental, metrics, packing, references, store
from loomgraph.operators import resolve as R
from loomgraph.plans.semantic import semantic_stage

T0 = dt.datetime(2024, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def column_of(spark, values, f, kind="string"):
    return [r.x for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v")).alias("x")).collect()]


# scalars and paths


def test_confidence(spark):
    levels = ["type_resolved", "scoped_name_match", "imported_name_match", "global_name_match", "ambiguous_multi_def", "unresolved", None]
    assert column_of(spark, levels, S.confidence_score) == [0.98, 0.85, 0.7, 0.45, 0.2, 0.0, 0.0]
    assert column_of(spark, levels, S.confidence_text)[-2:] == ["0", "0"]
    assert column_of(spark, [1.0, 0.98, 0.3, 0.31, 0.0, None], S.tier_of, "double") == ["EXTRACTED", "INFERRED", "AMBIGUOUS", "INFERRED", "AMBIGUOUS", "AMBIGUOUS"]


def test_degrade(spark):
    p = one(spark, S.degrade(S.edge_props(F.lit("scoped_name_match")), "a"))
    assert p == {"resolution": "scoped_name_match", "confidence": "0.45", "degraded_by": "a"}
    low = one(spark, S.degrade(S.degrade(S.edge_props(F.lit("ambiguous_multi_def")), "a"), "b"))
    assert low["confidence"] == "0.2" and low["degraded_by"] == "a,b"
    assert one(spark, S.degrade(F.lit(None).cast("map<string,string>"), "a")) == {"degraded_by": "a"}


def test_slugs_and_ids(spark):
    assert column_of(spark, ["Hello,  World!", "--", "", None, "A1"], S.slug) == ["hello-world", "", "", None, "a1"]
    assert one(spark, S.concept_id(F.lit("r"), F.lit("!!"))).startswith("concept:r:") and len(one(spark, S.concept_id(F.lit("r"), F.lit("!!")))) == 26
    members = F.array(F.lit("a"), F.lit("b"))
    assert one(spark, S.hyperedge_id(F.lit("r"), F.lit("x/y.py"), F.lit("H 1"), F.lit("l"), members)) == "he:r:x-y-py:h-1"
    assert one(spark, S.hyperedge_id(F.lit("r"), F.lit(""), F.lit("H"), F.lit("l"), members)) != one(spark, S.hyperedge_id(F.lit("r"), F.lit(""), F.lit("H"), F.lit("m"), members))


def test_frontmatter(spark):
    docs = ["---\na: 1\n---\nbody", "---\r\na: 1\r\n---\r\nb\r\n", "no", "---\na: 1\n", "x\r\ny", "", None]
    assert column_of(spark, docs, S.frontmatter_body) == ["body", "b\n", "no", "---\na: 1\n", "x\ny", "", None]
    assert column_of(spark, docs, S.frontmatter_block) == ["a: 1", "a: 1", None, None, None, None, None]


def test_paths(spark):
    assert column_of(spark, ["a/b/templates/x/y.yaml", "templates/z", "a/b.yaml", "c.yaml"], P.chart_root) == ["a/b", ".", "a", "."]
    assert column_of(spark, ["a/vendor/b.go", "vendor.go", "a/Vendor/b", ".git/x"], P.pruned) == [True, False, False, True]
    specs = [("src", "./a", "src/a.js"), ("src/x", "../b.mjs", "src/b.mjs"), ("src", "../../c", "../c.js"), (".", "./d", "d.js"), ("a/b", "./../c/./e", "a/c/e.js"), ("a", "react", "react")]
    got = spark.createDataFrame(specs, "d string, s string, want string").select(P.resolve_module_path(F.col("d"), F.col("s")).alias("x"), "want").collect()
    assert [r.x for r in got] == [r.want for r in got]
    assert column_of(spark, ["a/../../b", "a/../b", "/x", "../x", "a/b"], P.escapes) == [True, False, False, True, False]
    walk = spark.createDataFrame([("a.py",), ("a/b.py",)], "p string").orderBy(P.walk_order(F.col("p"))).collect()
    assert [r.p for r in walk] == ["a/b.py", "a.py"]
    assert column_of(spark, ["a/b.py", "c.py"], P.python_module) == ["a.b", "c"]


# changes


CHANGE = "repo string, path string, old_path string, status string, content_sha string"


def test_change_sets(spark):
    rows = [("r", "a", None, "A", "1"), ("r", "b", "c", "R090", "2"), ("r", "d", None, "D", "x"), ("r", "e", "f", "C100", "3"), ("r", "g", None, "T", "4"), ("r", "h", None, "X", "5"), ("r", "a", None, "M", "6"), ("r", None, None, "M", "6"), (None, "i", None, None, None)]
    n = C.normalise(spark.createDataFrame(rows, CHANGE))
    got = {r.path: (r.status, r.old_path, r.content_sha) for r in n.filter("path is not null and status <> 'M'").collect()}
    assert got == {"a": ("A", None, "1"), "b": ("R", "c", "2"), "d": ("D", None, None), "e": ("A", None, "3")}
    touched = C.touched(n, ["repo"])
    assert {r.path for r in touched.collect()} == {"a", "b", "c", "d", "e", "g"}
    assert {r.path for r in C.scope(n.filter("path is not null"), ["repo"]).collect()} == {"a", "b", "e", "g"}
    failed = spark.createDataFrame([("r", "b"), ("q", "a")], "repo string, path string")
    assert {r.path for r in C.reconcile_set(touched, failed, ["repo"]).collect()} == {"a", "c", "d", "e", "g"}
    assert C.reconcile_set(touched, failed, ["repo"], full_set=True).count() == 0


def test_routing_first_match(spark):
    files = ["x.go", "c/Chart.yaml", "c/templates/a.txt", "c/README.md", "README.md", "w/templates/i.html", "values.yaml", "a.MD", "b.py"]
    got = {r.path: r.analyzer for r in C.route(spark.createDataFrame([("r", f) for f in files], "repo string, path string"), ["repo"]).collect()}
    assert got == {"x.go": "go", "c/Chart.yaml": "helm", "c/templates/a.txt": "helm", "c/README.md": "helm", "README.md": "docs", "a.MD": "docs", "b.py": "python"}


def test_cache_misses(spark):
    files = spark.createDataFrame([("r", "a", "1"), ("r", "b", "2"), ("r", "c", None), ("r", "d", "")], "repo string, path string, content_sha string")
    cache = spark.createDataFrame([("r", "a", "1"), ("r", "b", "9"), ("q", "b", "2")], "repo string, path string, content_sha string")
    assert [r.path for r in C.cache_misses(files, cache, ["repo"]).collect()] == ["b"]


# new and changed records


LOG = CHANGE + ", commit_no int, recorded_at timestamp, extra string"
RUNS = "repo string, since_no int, head_no int, status string, started_at timestamp, extra int"


def log(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], LOG)


def pending(spark, changes, runs):
    return {tuple(r) for r in incremental.pending_paths(changes, runs).collect()}


def test_pending_paths(spark):
    runs = spark.createDataFrame([("r", None, 5, "succeeded", day(10), 1), ("r", 5, 9, "failed", day(11), 1), ("q", None, 9, None, day(11), 1)], RUNS)
    rows = [
        ("r", "done", None, "A", "1", 1, day(1)),
        ("r", "late", None, "A", "1", 1, day(20)),
        ("r", "next", None, "M", "2", 6, day(1)),
        ("r", "same", None, "A", "AB", 2, day(1)), ("r", "same", None, "M", "ab", 7, day(1)),
        ("r", "gone", None, "D", None, 8, day(1)),
        ("r", "unknown", None, "A", None, 7, day(1)),
        ("r", "seen", None, "A", None, 3, day(1)),
        ("r", "new", "old", "R100", "3", 7, day(1)), ("r", "old", None, "A", "3", 1, day(1)),
        ("r", "copy", "done", "C075", "1", 2, day(1)),
        ("r", "twice", None, "M", "5", 4, day(1)), ("r", "twice", None, "M", "5", 4, day(30)),
        ("q", "x", None, "A", "1", 1, day(1)),
        ("r", None, None, "A", "1", 9, day(1)), (None, "n", None, "A", "1", 9, day(1)), ("r", "nocommit", None, "A", "1", None, day(1)), ("r", "norecord", None, "A", "1", 1, None),
    ]
    want = {("r", "late"), ("r", "next"), ("r", "unknown"), ("r", "new"), ("r", "old"), ("q", "x"), ("r", "norecord")}
    changes = log(spark, *rows)
    assert pending(spark, changes.unionByName(changes), runs) == want
    assert pending(spark, changes.limit(0), runs) == set()
    assert pending(spark, changes, runs.limit(0)) >= want - {("r", "old")}


def test_incremental_table(spark, tmp_path):
    calls = []

    def build(df):
        calls.append({r.part for r in df.select("part").distinct().collect()})
        return df.groupBy("part").agg(F.sum("v").alias("total"))

    def source(*rows):
        return spark.createDataFrame(list(rows), "part string, v int, note map<string,string>")

    t = incremental.IncrementalTable(spark, str(tmp_path / "t"), "part", build)
    assert t.refresh(source(("a", 1, {}), ("b", 2, None), ("c", 3, None))) == {"partitions": 3, "recomputed": 3, "rows": 3, "rows_read": 3}
    assert t.refresh(source(("b", 2, None), ("a", 1, {}), ("c", 3, None)))["recomputed"] == 0
    assert t.refresh(source(("a", 1, {}), ("b", 5, None), ("b", None, {"x": "y"})))["recomputed"] == 1
    assert calls[-1] == {"b"} and {(r.part, r.total) for r in t.read().collect()} == {("a", 1), ("b", 5)}

    def fails(df):
        raise RuntimeError("lost")

    broken = incremental.IncrementalTable(spark, str(tmp_path / "t"), "part", fails)
    with pytest.raises(RuntimeError):
        broken.refresh(source(("a", 9, {}), ("b", 5, None)))
    assert {(r.part, r.total) for r in t.read().collect()} == {("a", 1), ("b", 5)}
    assert t.refresh(source(("a", 9, {}), ("b", 5, None), ("b", None, {"x": "y"})))["recomputed"] == 1
    assert {(r.part, r.total) for r in t.read().collect()} == {("a", 9), ("b", 5)}


# references


def test_orphans(spark):
    e = spark.createDataFrame([("r", "a", day(1), None), ("r", "b", day(1), day(2)), ("r", "c", day(5), None), ("r", "d", day(1), day(2)), ("r", "d", day(3), None), ("q", "x", day(1), None)], "repo string, entity_id string, pushed_at timestamp, deleted_at timestamp")
    edges = spark.createDataFrame([(1, "r", "a", "b", day(2)), (1, "r", "a", "b", day(2)), (2, "r", "c", "", day(3)), (3, "r", None, "x", day(3)), (4, "r", "d", "c", day(6)), (5, "r", "a", "a", None), (6, None, "a", None, day(3))], "edge_id bigint, repo string, src_id string, dst_id string, pushed_at timestamp")
    hyper = spark.createDataFrame([(9, "r", ["a", "zz", None, "zz"], day(4)), (8, "r", None, day(4))], "hyper_id bigint, repo string, members array<string>, pushed_at timestamp")
    got = {tuple(r) for r in references.find_orphans(edges, hyper, e).collect()}
    assert got == {("edges", 1, "dst_id", "b"), ("edges", 2, "src_id", "c"), ("edges", 3, "dst_id", "x"), ("edges", 5, "src_id", "a"), ("edges", 5, "dst_id", "a"), ("edges", 6, "src_id", "a"), ("hyperedges", 9, "members", "zz")}
    assert references.find_orphans(edges.limit(0), hyper.limit(0), e).count() == 0
    assert references.find_orphans(edges, hyper, e.limit(0)).count() == 11
    counts = {(r.ref_table, r.field, r.period): (r.n_refs, r.n_orphans) for r in references.orphan_counts(edges, hyper, e).collect()}
    assert counts["hyperedges", "members", "2024-01"] == (2, 1) and counts["edges", "src_id", None] == (1, 1)


# resolution


def test_ladder_against_brute_force(spark):
    r = random.Random(2)
    names, files = list("abcdef"), ["x/1", "x/2", "y"]
    defs = [("r", r.choice(files), r.choice(names), f"id{i}", i) for i in range(12)]
    imports = [("r", r.choice(files), n, f"imp{n}") for n in "ab"]
    calls = [("r", r.choice(files), f"c{r.randint(0, 3)}", r.choice(names + ["zz"]), i) for i in range(40)]
    table = {}
    for _, p, n, i, o in sorted(defs, key=lambda d: d[4]):
        table[p, n] = i
    want = set()
    for _, p, c, n, _o in calls:
        imported = [i for _, q, m, i in imports if (q, m) == (p, n)]
        ids = [table[q, n] for q in sorted(files, key=lambda x: x.split("/")) if (q, n) in table]
        if (p, n) in table:
            want.add((c, table[p, n], "scoped_name_match"))
        elif imported:
            want.add((c, max(imported), "imported_name_match"))
        elif len(ids) == 1:
            want.add((c, ids[0], "global_name_match"))
        else:
            want |= {(c, i, "ambiguous_multi_def") for i in ids} or {(c, None, "unresolved")}
    got = R.call_ladder(spark.createDataFrame(calls, "repo string, path string, caller string, callee string, ord int"), spark.createDataFrame(defs, "repo string, path string, name string, entity_id string, ord int"), spark.createDataFrame(imports, "repo string, path string, name string, entity_id string"))
    assert {(x.src, x.dst, x.resolution) for x in got.collect()} == want
    lost = {x.src: x.dangling_call for x in R.dangling_calls(got).collect()}
    assert all("zz" in v for k, v in lost.items() if any(c == k and n == "zz" for _, _, c, n, _ in calls))


def test_innermost_against_brute_force(spark):
    r = random.Random(3)
    defs = [("r", "p", f"d{i}", a, a + r.randint(0, 900), i) for i in range(60) for a in [r.randint(0, 1500)]]
    refs = [("r", "p", f"x{i}", r.randint(0, 2400), f"d{i}") for i in range(60)]
    want = {}
    for _, _, x, line, own in refs:
        inside = [(z - a, o, d) for _, _, d, a, z, o in defs if a <= line < z and d != own]
        if inside:
            want[x] = min(inside)[2]
    got = R.innermost_enclosing(spark.createDataFrame(defs, "repo string, path string, def_id string, start int, end int, ord int"), spark.createDataFrame(refs, "repo string, path string, ref_id string, line int, self_id string"))
    assert {x.ref_id: x.def_id for x in got.collect()} == want


# packing, items, store


def test_packing_invariants(spark):
    r = random.Random(4)
    files = [("k%d" % (i % 3), i, f"f{i:03}", r.choice([0, 1, 5, 40])) for i in range(90)]
    got = packing.pack(spark.createDataFrame(files, "k string, ord int, path string, n int"), ["k"], "n", 12, 5).collect()
    assert len(got) == 90
    for k in ("k0", "k1", "k2"):
        mine = sorted((x for x in got if x.k == k), key=lambda x: x.ord)
        assert [x.batch_no for x in mine] == packing.next_fit([x.n for x in mine], 12, 5)
        for _, b in itertools.groupby(mine, key=lambda x: x.batch_no):
            b = list(b)
            assert len(b) <= 5 and (sum(x.n for x in b) <= 12 or len(b) == 1)
    assert packing.next_fit([5, 5], 8, 9, seed=100) == [0, 1] and packing.next_fit([], 1, 1) == []
    assert packing.next_fit([1] * 20, 10**9, 8) == [0] * 8 + [1] * 8 + [2] * 4


def test_unfiled_rows_count_in_the_first_batch(spark):
    owned = spark.createDataFrame([("r", "", 9), ("r", "a", 1), ("r", "b", 3), ("r", "stray", 2)], "repo string, path string, n_rows bigint")
    files = spark.createDataFrame([("r", "a"), ("r", "b"), ("r", "c")], "repo string, path string")
    got = {x.path: (x.n_rows, x.batch_no) for x in packing.pack_graph(files, owned, ["repo"], 12, 9).collect()}
    assert got == {"a": (1, 0), "b": (3, 1), "c": (0, 1)}


def test_items_last_wins(spark):
    chunks = spark.createDataFrame([(1, "r", "e", "t", "f1", None, "h", "b"), (2, "r", "e", "t", "f2", "py", "h", "b"), (3, "r", "e", "t", "f", "py", None, None)], "chunk_id bigint, repo string, entity_id string, ent_type string, file_path string, lang string, header string, body string")
    got = sorted(packing.chunk_items(chunks, ["chunk_id"]).collect(), key=lambda x: x.first.chunk_id)
    assert [(x.first.chunk_id, x.metadata["file_path"], x.text) for x in got] == [(1, "f2", "h\n---\nb"), (3, "f", "\n---\n")]
    assert got[0].idempotency_key.startswith("r:e:") and len(got[0].idempotency_key) == 68


def test_store_versions(spark, tmp_path):
    s = store.ParquetStore(spark, str(tmp_path / "s"), ["f"])
    rows = lambda *x: spark.createDataFrame(list(x), "f string, v int")
    s.apply(rows(("a", 1), ("b", 2)), None)
    s.apply(rows(("a", 9)), spark.createDataFrame([("a",), ("gone",)], "f string"))
    s.apply(rows(("a", 9)), spark.createDataFrame([("a",)], "f string"))
    assert {tuple(r) for r in s.read().collect()} == {("a", 9), ("b", 2)} and s.version() == 3
    assert spark.read.parquet(str(tmp_path / "s" / "data" / "v3")).count() == 1  # b was not written again
    (tmp_path / "s" / "manifest" / "v4").mkdir()
    assert s.version() == 3
    s.apply(rows(("c", 3)), None)
    assert {tuple(r) for r in s.read().collect()} == {("a", 9), ("b", 2), ("c", 3)} and s._versions("data") == [1, 3, 4]
    s.MOST_VERSIONS = 2
    s.apply(rows(), spark.createDataFrame([("c",), (None,)], "f string"))
    assert {tuple(r) for r in s.read().collect()} == {("a", 9), ("b", 2)} and s._used(s.version()) == [5]


def test_bounded_collect(spark):
    assert len(collect_bounded(spark.range(3), 3)) == 3
    with pytest.raises(ValueError):
        collect_bounded(spark.range(4), 3)


# fragments


def test_fragments(spark):
    body = """Sure:\n```json\n{"nodes": [{"id": "n1", "label": "Big Idea", "file_type": "concept", "source_file": "a.py"}, {"id": "n2", "label": "!!", "file_type": "rationale", "source_file": "zz"}, {"id": "n3", "label": "x", "file_type": "code"}],
     "edges": [{"source": "n1", "target": "py:func:f", "relation": "cites", "confidence_score": 1.0, "source_file": "a.py"}, {"source": "n1", "target": "n1", "source_file": "a.py"}, {"source": "n1", "target": "", "source_file": "a.py"}, {"source": "n1", "target": "n2", "source_file": "zz"}, {"source": "n2", "target": "n3", "confidence_score": 0.3, "source_file": "a.py"}],
     "hyperedges": [{"id": "h0", "label": "l", "nodes": ["a", "b"], "source_file": "a.py"}, {"id": "h1", "label": "l", "nodes": ["n1", "b", "c"], "source_file": "a.py"}, {"id": "h2", "nodes": ["a", "b", "c"], "source_file": "zz"}, {"id": "h3", "nodes": ["a", "b", "c"], "source_file": "a.py"}, {"id": "h4", "nodes": ["a", "b", "c"], "source_file": "a.py"}, {"id": "h5", "nodes": ["a", "b", "c"], "source_file": "a.py"}]}\n``` trailing } prose"""
    rows = [("r", 0, ["a.py"], body), ("r", 1, ["a.py"], "no json"), ("r", 2, ["a.py"], '{"nodes": [}'), ("r", 3, None, None)]
    p = fragments.parse(spark.createDataFrame(rows, "repo string, chunk_no int, valid_files array<string>, body string"))
    nodes = fragments.concepts(p)
    assert {(n.entity_id[:14], n.ent_type, n.file_path) for n in nodes.collect()} == {("concept:r:big-", "concept", "a.py"), (nodes.filter("model_id = 'n2'").first().entity_id[:14], "rationale", "")}
    e = {(x.src_id[:13], x.dst_id, x.confidence_tier) for x in fragments.edges(p, nodes).collect()}
    assert e == {("concept:r:big", "py:func:f", "EXTRACTED"), (nodes.filter("model_id = 'n2'").first().entity_id[:13], "n3", "AMBIGUOUS")}
    h = fragments.hyperedges(p, nodes).orderBy("ord").collect()
    assert [x.he_key for x in h] == ["he:r:a-py:h1", "he:r:a-py:h3", "he:r:a-py:h4"] and h[0].members[0] == "concept:r:big-idea"


def test_semantic_stage(spark):
    files = spark.createDataFrame([("r", "a.py", "text a"), ("r", "b.py", "text b"), ("r", "c.py", "fail")], "repo string, path string, content string")
    changes = spark.createDataFrame([("r", "a.py", None, "M", "1"), ("r", "b.py", None, "A", "2"), ("r", "d.py", None, "D", None), ("r", "../x", None, "A", "3")], CHANGE)
    cache = spark.createDataFrame([("r", "b.py", "2")], "repo string, path string, content_sha string")

    def model(prompt):
        assert "text a" in prompt and "text b" not in prompt
        return '{"nodes": [{"id": "n", "label": "A thing", "file_type": "concept", "source_file": "a.py"}], "edges": [], "hyperedges": []}'

    out = semantic_stage(files, changes, cache, model)
    assert [n.entity_id for n in out["entities"].collect()] == ["concept:r:a-thing"]
    assert {(r.path) for r in out["file_shas"].collect()} == {"a.py"} and [r.ok for r in out["outcomes"].collect()] == [True]

    def broken(prompt):
        raise OSError("down")

    out = semantic_stage(files, changes, cache, broken)
    assert out["entities"].count() == 0 and [r.ok for r in out["outcomes"].collect()] == [False]


def test_histogram(spark):
    df = spark.createDataFrame([("a", 1), ("a", 10), ("a", 11), ("a", None)], "k string, v int")
    got = {r.le: r.n for r in metrics.histogram(df, ["k"], "v", (10, 50)).collect()}
    assert got == {"10": 2, "50": 3, "+Inf": 3}


def test_payloads(spark):
    from loomgraph.operators import wire
    from loomgraph.schema import EDGE, ENTITY, SYMBOL
    from pyspark.sql import types as T

    with_repo = lambda s: T.StructType([T.StructField("repo", T.StringType()), *s.fields])
    ent = spark.createDataFrame([("r\"1", "e1", "n", "t", None, "a \"q\".py", 3, 0, None, "", None, {}), ("r\"1", "pkg", "p", "t", None, None, None, None, None, None, None, {"k": "v"})], with_repo(ENTITY))
    edg = spark.createDataFrame([("r\"1", "e1", "e2", "calls", "b.py", 0.85, "INFERRED", {"resolution": "x"})], with_repo(EDGE))
    sym = spark.createDataFrame([], with_repo(SYMBOL))
    packed = spark.createDataFrame([("r\"1", "a \"q\".py", 0), ("r\"1", "b.py", 1)], "repo string, path string, batch_no int")
    got = list(wire.in_order(wire.payloads(packed, ent, edg, sym, "c1", "ast")))
    assert [p["files"] for p in got] == [['a "q".py'], ["b.py"]] and got[0]["repo"] == 'r"1' and got[0]["commit"] == "c1"
    by_id = {e["id"]: e for e in got[0]["entities"]}
    assert by_id["e1"] == {"id": "e1", "name": "n", "type": "t", "file_path": 'a "q".py', "line_start": 3}
    assert by_id["pkg"]["properties"] == {"k": "v"} and by_id["pkg"]["file_path"] == ""
    assert got[1]["edges"][0]["from"] == "e1" and got[1]["entities"] == [] and "symbols" not in got[1]


def test_exposition_and_slices(spark):
    rows = [{"a": 'x"y\n', "n": 2}]
    assert metrics.exposition("m_total", rows, ["a"]) == '# TYPE m_total counter\nm_total{a="x\\"y\\n"} 2\n'
    assert metrics.push(lambda *a: (_ for _ in ()).throw(OSError()), "x") is False
    assert one(spark, S.byte_slice(F.lit("aüb"), F.lit(1), F.lit(3))) == "ü"


def test_changed_partition_without_output_loses_its_rows(spark, tmp_path):
    t = incremental.IncrementalTable(spark, f"{tmp_path}/t", "part", lambda d: d.filter("v > 0"))
    rows = lambda *r: spark.createDataFrame(list(r), "part string, v int")
    read = lambda: {(r.part, r.v) for r in t.read().collect()}
    t.refresh(rows(("a", 1), ("b", 2), (None, 3)))
    assert read() == {("a", 1), ("b", 2), (None, 3)}
    assert t.refresh(rows(("a", -1), ("b", 2), (None, -3)))["recomputed"] == 2
    assert read() == {("b", 2)}
    t.refresh(rows(("a", -1), ("b", -2)))
    assert read() == set()
    t.refresh(rows(("a", 4), ("b", -2)))
    assert read() == {("a", 4)}


def test_partition_values_keep_their_type(spark, tmp_path):
    t = incremental.IncrementalTable(spark, f"{tmp_path}/t", "part", lambda d: d)
    t.refresh(spark.createDataFrame([("007", 1), ("7", 2)], "part string, v int"))
    assert {tuple(r) for r in t.read().select("part", "v").collect()} == {("007", 1), ("7", 2)}
    empty = incremental.IncrementalTable(spark, f"{tmp_path}/e", "part", lambda d: d)
    assert empty.refresh(spark.createDataFrame([], "part string, v int"))["partitions"] == 0 and empty.read().count() == 0


def test_backlog_reads_changed_blocks_only(spark, tmp_path):
    """A late row in an old block changes that block alone; the result is that of the whole log."""
    log = "repo string, path string, old_path string, commit_no int, status string, content_sha string, recorded_at timestamp"
    rows = [("r", f"p{k % 5}", None, k, "M", f"{k:x}", day(1)) for k in range(1, 65)]
    runs = spark.createDataFrame([("r", None, 64, "succeeded", day(2)), ("r", 60, 64, "succeeded", day(3)), ("r", 0, 999, "failed", day(9))], "repo string, since_no int, head_no int, status string, started_at timestamp")
    backlog = incremental.ChangeBacklog(spark, f"{tmp_path}/b", block=8)
    assert backlog.update(spark.createDataFrame(rows, log), runs)["rows_read"] == 0 and backlog.pending().count() == 0
    late = rows + [("r", "p9", None, 20, "A", "ff", day(8)), ("r", "p1", None, 66, "D", None, day(8))]
    said = backlog.update(spark.createDataFrame(late, log), runs)
    assert said["recomputed"] == 2 and said["rows_read"] == 8 + 1 + 1 + 1  # the block of commits 16 to 23, and the last
    assert {tuple(r) for r in backlog.pending().collect()} == {("r", "p9"), ("r", "p1")}
    assert {tuple(r) for r in incremental.pending_paths(spark.createDataFrame(late, log), runs).collect()} == {("r", "p9"), ("r", "p1")}


def test_disjoint_windows_against_brute_force():
    import pandas as pd

    r = random.Random(4)
    for _ in range(50):
        w = [(lo, lo + r.randint(1, 9), pd.Timestamp("2024-01-01", tz="UTC") + pd.Timedelta(days=r.randint(0, 5))) for lo in (r.randint(0, 20) for _ in range(r.randint(0, 8)))]
        got = incremental.disjoint_windows(w)
        for c in range(1, 32):
            want = [at for lo, hi, at in w if lo < c <= hi]
            assert [at for lo, hi, at in got if lo < c <= hi] == ([max(want)] if want else [])


def test_payloads_of_the_model_stage(spark):
    from loomgraph.operators import wire
    from loomgraph.schema import EDGE, ENTITY, SYMBOL
    from pyspark.sql import types as T

    none = lambda s: spark.createDataFrame([], T.StructType([T.StructField("repo", T.StringType()), *s.fields]))
    packed = spark.createDataFrame([("r", "a.md", 0), ("r", "b.md", 1)], "repo string, path string, batch_no int")
    he = spark.createDataFrame([("r", "he:1", "L", "form", 0.0, "b.md", ["x", None, "y"])], "repo string, he_key string, label string, relation string, confidence_score double, src_file string, members array<string>")
    shas = spark.createDataFrame([("r", "a.md", "aa"), ("r", "a.md", "aa"), ("r", "b.md", ""), ("r", "zz", "bb")], "repo string, path string, content_sha string")
    a, b = wire.in_order(wire.payloads(packed, none(ENTITY), none(EDGE), none(SYMBOL), "c", "model", he, shas))
    assert a["file_shas"] == {"a.md": "aa"} and "hyperedges" not in a
    assert b["hyperedges"] == [{"id": "he:1", "label": "L", "relation": "form", "src_file": "b.md", "members": ["x", "y"]}] and "file_shas" not in b


def test_registry_of_metrics(spark):
    m = metrics.Registry()
    m.inc("ingest_runs_total")
    m.inc("push_retries_total", 2, path="/graph", reason="shed_429")
    for n in (10, 11, 99999):
        m.observe("code_graph_batch_rows", n)
    m.absorb("analyzer_edges_total", spark.createDataFrame([("go", 3), ("go", 4)], "language string, n int"))
    lines = m.text().split("\n")
    assert "ingest_runs_total 1" in lines and 'push_retries_total{path="/graph",reason="shed_429"} 2' in lines and 'analyzer_edges_total{language="go"} 7' in lines
    assert 'code_graph_batch_rows_bucket{le="10"} 1' in lines and 'code_graph_batch_rows_bucket{le="50"} 2' in lines and 'code_graph_batch_rows_bucket{le="+Inf"} 3' in lines and "code_graph_batch_rows_count 3" in lines
    assert len(metrics.METRICS) == 18
    with pytest.raises(ValueError):
        m.inc("llm_calls_total", path="x")


def test_cancelled_jobs_end(spark):
    import threading
    import time

    from loomgraph.session import cancel, cancellable

    ended: list = []

    def slow():
        with cancellable(spark, "run-1"):
            try:
                spark.range(8, numPartitions=8).mapInPandas(lambda b: (time.sleep(60), next(b))[1:], "id bigint").count()
                ended.append("whole")
            except Exception:  # noqa: BLE001
                ended.append("cancelled")

    t = threading.Thread(target=slow)
    t.start()
    for _ in range(40):
        time.sleep(0.5)
        cancel(spark, "run-1")
        if ended:
            break
    t.join(5)
    assert ended == ["cancelled"]
