"""Small trees through the whole pipeline: ids, edges and their scores."""

import pytest

from loomgraph.extract import helm, terraform
from loomgraph.plans import pipeline

SCHEMA = "repo string, path string, content string"


def run(spark, tree, **options):
    return pipeline.ingest(spark.createDataFrame([("r", p, c) for p, c in tree.items()], SCHEMA), **options)


def edges(g):
    return {(e.src_id, e.dst_id, e.relation): e for e in g.edges.collect()}


def entities(g):
    return {e.entity_id: e for e in g.entities.collect()}


PY = {
    "pkg/mod.py": "import requests\nfrom flask import Flask as Fl\nfrom pkg.helper import helped as h2\nfrom . import near\ndef g():\n    pass\ndef f():\n    g(); g(); len([]); h2(); once(); twice(); obj.method(); Made()\n\nclass C:\n    def run(self):\n        g()\n    @property\n    def gone(self): pass\n",
    "pkg/helper.py": "def helped(): pass\n",
    "other/a.py": "def once(): pass\ndef twice(): pass\n",
    "other/b.py": "def twice(): pass\n@deco\ndef wrapped():\n    local()\ndef local(): pass\nclass Made: pass\n",
    ".venv/x.py": "def len(): pass\n",
    "bad.py": "def ok():\n    pass\ndef broken(:\n",
}


def test_python(spark):
    g = run(spark, PY)
    e, ent = edges(g), entities(g)
    f = "py:func:pkg.mod.f"
    assert e[f, "py:func:pkg.mod.g", "calls"].confidence_score == 0.85
    assert e[f, "py:func:pkg.helper.helped", "calls"].confidence_score == 0.7
    assert e[f, "py:func:other.a.once", "calls"].confidence_score == 0.45
    assert {d for s, d, r in e if s == f and "twice" in d} == {"py:func:other.a.twice", "py:func:other.b.twice"}
    assert e[f, "py:func:other.a.twice", "calls"].confidence_tier == "AMBIGUOUS"
    assert e[f, "py:class:other.b.Made", "calls"].confidence_score == 0.45
    w = e["py:func:other.b.wrapped", "py:func:other.b.local", "calls"]
    assert w.confidence_score == 0.45 and w.props["degraded_by"] == "decorator" and w.props["confidence"] == "0.45"
    assert ent[f].props["dangling_call"] == "len,obj.method"
    assert ("py:class:pkg.mod.C", "py:func:pkg.mod.C.run", "defines") in e and "py:func:pkg.mod.C.gone" not in ent
    assert not [x for x in ent if ".venv" in x or x.endswith("broken")] and "py:func:bad.ok" in ent
    needed = {(s.symbol, s.role) for s in g.symbols.collect() if s.src_file == "pkg/mod.py"}
    assert {("requests", "requires"), ("flask", "requires"), ("pkg", "requires"), ("pkg.mod.C", "provides")} - {("pkg", "requires")} <= needed
    assert not [s for s, _ in needed if not s]


JS = {
    "src/main.js": "import { h } from './lib/util';\nimport React from 'react';\nimport React2 from 'react';\nconst u = require('./lib/util');\nconst f = (a) => { g(); h(a); obj.call(1); table[key](); none(); new Service(); };\nfunction g() { return `x${h(1)}`; }\nimport { Service } from './service.js';\nif (x) { hidden(); }\n",
    "src/lib/util.js": "export function h(x) { return /a(b)/.test(x); }\nexport const arrow = async () => 1;\nexport default class Klass { m() { g(); } }\n",
    "src/service.js": "export class Service {}\n",
    "src/broken.js": "import x from './missing';\nfunction half( {",
}


def test_javascript(spark):
    g = run(spark, JS)
    e, ent = edges(g), entities(g)
    f = "js:func:src/main.js::f"
    assert e[f, "js:func:src/main.js::g", "calls"].confidence_score == 0.85
    assert e[f, "js:func:src/lib/util.js::h", "calls"].confidence_score == 0.7
    assert e[f, "js:class:src/service.js::Service", "calls"].confidence_score == 0.7
    assert ent[f].props == {"dangling_call": "obj.call,table[key],none", "degraded_by": "dynamic"}
    assert ("js:func:src/main.js::g", "js:func:src/lib/util.js::h", "calls") in e
    assert ("js:module:src/main.js", "js:module:src/lib/util.js", "imports") in e
    assert not [x for x in e if "missing" in x[1]]
    symbols = {(s.symbol, s.role) for s in g.symbols.collect()}
    assert {("react", "requires"), ("src/lib/util.js::h", "provides"), ("src/lib/util.js::arrow", "provides"), ("src/service.js::Service", "provides")} <= symbols
    assert len([s for s in g.symbols.collect() if s.symbol == "react"]) == 1


def test_go(spark):
    tree = {
        "go.mod": "module example.org/m\n\ngo 1.22\n",
        "pkg/a.go": "package pkg\n\n// F calls.\nfunc F() { g(); g(); x.G(); H() }\n\nfunc (r *T[K]) M(a func() int) (int, error) {\n\tg()\n\treturn 0, nil\n}\n\ntype T struct{}\n",
        "pkg/b.go": "package pkg\nfunc g() {}\n",
        "empty/c.go": "package empty\ntype X int\n",
    }
    g = run(spark, tree)
    e, ent = edges(g), entities(g)
    call = e["go:func:example.org/m/pkg.F", "go:func:example.org/m/pkg.g", "calls"]
    assert call.confidence_score is None and call.props == {"resolution": "scoped_name_match", "confidence": "0.45", "degraded_by": "no_typecheck"}
    assert ("go:method:example.org/m/pkg.(T).M", "go:func:example.org/m/pkg.g", "calls") in e
    assert ent["go:package:example.org/m/pkg"].ent_name == "pkg" and "go:package:example.org/m/empty" not in ent
    assert ent["go:func:example.org/m/pkg.F"].props["exported"] == "true"
    assert {s.symbol for s in g.symbols.collect()} == {"example.org/m/pkg.F", "example.org/m/pkg.T.M"}
    assert not [x for x in e if x[1].endswith(".H")]


def test_go_requires(spark):
    tree = {"go.mod": "module example.org/m\n", "a.go": 'package m\n\nimport (\n\t"fmt"\n\tk "example.org/kit/v2"\n\t"example.org/m/own"\n)\n\nvar x = k.New()\n\nfunc F() { k.Do(); k.Do(); own.Y(); fmt.Println(); s.k.No() }\n'}
    g = run(spark, tree, cross_repo_prefix="example.org/")
    got = {(s.symbol, s.entity_id) for s in g.symbols.collect() if s.role == "requires"}
    assert got == {("example.org/kit/v2.New", "go:package:example.org/m"), ("example.org/kit/v2.Do", "go:func:example.org/m.F")}


def test_terraform(spark):
    tree = {
        "net/main.tf": 'variable "v" {}\nresource "aws_vpc" "a" {\n  name = "${var.v}-x"\n  tags = { n = var.v, l = local.z, c = count.index }\n  nested {\n    id = aws_subnet.b[0].id\n  }\n  depends_on = [module.m, var.v]\n}\ndata "aws_ami" "i" {\n  x = data.aws_ami.other.id\n}\nmodule "m" {\n  source = "./sub"\n  in = module.k.out\n}\noutput "o" {\n  value = aws_vpc.a.id # aws_no.no.id\n}\nlocals {\n  q = var.q\n}\n',
        "app/main.tf": 'variable "v" {}\n',
    }
    g = run(spark, tree)
    e, ent = set(edges(g)), entities(g)
    a = "tf:resource:net:aws_vpc.a"
    assert (a, "tf:variable:net:v", "var_ref") in e and (a, "tf:resource:net:aws_subnet.b", "references") in e and (a, "tf:module:net:m", "depends_on") in e
    assert ("tf:data:net:aws_ami.i", "tf:data:net:aws_ami.other", "references") in e
    assert ("tf:module:net:m", "./sub", "module_source") in e and ("tf:module:net:m", "tf:module:net:k", "references") in e
    assert ("tf:output:net:o", a, "references") in e
    assert {x.split(":")[1] for x in ent} == {"variable", "resource", "data", "module", "output"} and {"tf:variable:net:v", "tf:variable:app:v"} <= set(ent)
    assert not [x for x in e if "local" in x[1] or "count" in x[1] or "no.no" in x[1]] and len([x for x in e if x[2] == "var_ref"]) == 1
    assert len({c.body for c in g.chunks.collect() if c.entity_id.endswith(":v")}) == 2


def test_helm(spark):
    tree = {
        "c/Chart.yaml": "name: app\ndependencies:\n- name: redis\n  alias: cache\n- name: db\n",
        "c/values.yaml": "image:\n  repo: x\n  tags: [a]\nempty: {}\n",
        "c/templates/d.yaml": '{{- if .Values.image.repo }}\nx: {{ .Values.image.repo | quote }} {{ include "app.name" . }} {{ $.Values.no }}\n{{ end }}{{/* .Values.c */}}{{ template "t" (.Values.z) }}',
        "c/templates/bad.yaml": "{{ if .Values.a }}",
        "c/README.md": "# in the chart\n",
        "web/templates/index.html": "{{ .Values.x }}",
    }
    g = run(spark, tree)
    e, ent = edges(g), entities(g)
    t = "helm:template:c/templates/d.yaml"
    assert {"helm:chart:app", "helm:value:app.image.repo", "helm:value:app.image.tags", "helm:value:app.empty", t} <= set(ent)
    assert {(d, r) for s, d, r in e if s == t} == {("helm:value:app.image.repo", "value_ref"), ("helm:value:app.z", "value_ref"), ("helm:include:app.name", "includes"), ("helm:include:t", "includes")}
    assert {d for s, d, r in e if r == "subchart"} == {"helm:chart:cache", "helm:chart:db"}
    assert [r.path for r in g.failed.collect()] == ["c/templates/bad.yaml"] and not [x for x in ent if "web/" in x or "README" in x]
    assert helm.plain_mapping(tree["c/Chart.yaml"])["dependencies"] == [{"name": "redis", "alias": "cache"}, {"name": "db"}]
    assert sorted(helm.flatten(helm.plain_mapping("a:\n  b: 1\n  c: |\n    x: 1\nd: {}\n"))) == ["a.b", "a.c", "d"]


def test_docs(spark):
    g = run(spark, {"a.md": "---\r\nauthor: me\r\nsource_url: \"http://x\"\r\n---\r\nbody\r\n", "b.txt": "x\r\ny", "c.rst": None})
    ent = entities(g)
    assert (ent["doc:file:a.md"].author, ent["doc:file:a.md"].source_url) == ("me", "http://x")
    bodies = {c.file_path: (c.body, c.lang) for c in g.chunks.collect()}
    assert bodies == {"a.md": ("body\n", "markdown"), "b.txt": ("x\ny", "text")}


def test_incremental_run(spark):
    changes = spark.createDataFrame([("r", "pkg/mod.py", None, "M", "s"), ("r", "gone.py", None, "D", None), ("r", "other/a.py", "old.py", "R100", "s"), ("r", "bad2.py", None, "M", "s")], "repo string, path string, old_path string, status string, content_sha string")
    g = run(spark, PY | {"bad2.py": None}, changes=changes)
    assert {x.file_path for x in g.entities.collect()} == {"pkg/mod.py", "other/a.py"}
    assert ("py:func:pkg.mod.f", "py:func:pkg.helper.helped", "calls") in edges(g)
    assert {r.path for r in g.graph_files.collect()} == {"pkg/mod.py", "gone.py", "other/a.py", "old.py", "bad2.py"}
    assert {r.path for r in g.reconcile.collect()} == {"pkg/mod.py", "gone.py", "other/a.py", "old.py"}
    held = run(spark, PY, changes=changes, failing=["python"])
    assert {r.path for r in held.graph_files.collect()} == {"gone.py", "old.py"} and held.entities.count() == 0


def test_registry_takes_other_analyzers(spark):
    from loomgraph.extract.facts import extract_facts, fact

    files = spark.createDataFrame([("r", "a.x", "mine", "text"), ("r", "b.x", "mine", None)], "repo string, path string, analyzer string, content string")
    table = {"mine": lambda p, c: iter([fact("entity", entity_id=f"x:{p}", name=c)])}
    got = {(r.path, r.kind, r.entity_id) for r in extract_facts(files, table).collect()}
    assert got == {("a.x", "entity", "x:a.x"), ("b.x", "failed", None)}
    assert [r.note for r in extract_facts(files.limit(1), {"mine": lambda p, c: 1 / 0}).collect()] == ["ZeroDivisionError"]


def test_mask_keeps_places():
    s = 'a = "x ${var.y} z" # var.c\nb = <<EOT\n${var.d} var.e\nEOT\n'
    m = terraform.mask(s)
    assert len(m) == len(s) and "var.y" in m and "var.d" in m and "var.c" not in m and "var.e" not in m


@pytest.mark.parametrize("text,good", [("{{ if .a }}x{{ else }}y{{ end }}", True), ("{{ end }}", False), ("{{ .a", False), ("{{/* {{ */}}", True), ("{{ if }}{{ end }}", False),
    ('{{- $x := .a | default "}}" -}}{{ range $i, $v := .b }}{{ $x }}{{ $i }}{{ break }}{{ else }}-{{ end }}', True), ("{{ $y }}", False), ("{{ with $y := .a }}{{ $y.b.c }}{{ else with .d }}{{ end }}", True), ("{{ with $y := .a }}{{ end }}{{ $y }}", False),
    ("{{ if a }}{{ else }}{{ else }}{{ end }}", False), ("{{ else }}", False), ("{{ (index .a 0).b }}", True), ("{{ (index .a 0 }}", False), ("{{ .a | }}", False), ("{{ }}", False), ('{{ define "t" }}{{ $.x }}{{ end }}', True), ("{{ define t }}{{ end }}", False), ("{{ break }}", False), ('{{ "a }}', False), ("{{ template `t` (dict \"a\" .b) }}", True), ("{{ .a := 1 }}", False), ("a } } b { {", True), ("{{ if a }}{{ else with .b }}{{ end }}", False), ("{{ $a, $b := .x }}", False)])
def test_template_balance(text, good):
    assert helm.balanced(text) is good


def changed(spark, *paths):
    return spark.createDataFrame([("r", p, None, "M", "aa") for p in paths], "repo string, path string, old_path string, status string, content_sha string")


def test_packages_of_functions_in_scope_only(spark):
    tree = {"go.mod": "module m\n", "x/a.go": "package x\nfunc A() { B() }\nfunc B() {}\n", "y/b.go": "package y\nfunc C() {}\n", "z/c.go": "package z\nvar V = 1\n"}
    g = run(spark, tree, changes=changed(spark, "x/a.go", "z/c.go"))
    assert {e for e in entities(g) if e.startswith("go:package")} == {"go:package:m/x"}
    assert {"go:package:m/x", "go:package:m/y"} <= set(entities(run(spark, tree)))


def test_chart_without_its_manifest_in_scope(spark):
    tree = {"c/Chart.yaml": "name: c\ndependencies:\n  - name: common\n", "c/values.yaml": "a: 1\n", "c/templates/a.yaml": "x: {{ .Values.a }}\n", "d/Chart.yaml": "name: d\n", "d/values.yaml": "b: 2\n"}
    g = run(spark, tree, changes=changed(spark, "c/templates/a.yaml"))
    ent = entities(g)
    assert ent["helm:chart:c"].file_path == "" and "helm:chart:d" not in ent and not any(e.relation == "subchart" for e in g.edges.collect())
    whole = run(spark, tree, changes=changed(spark, "c/Chart.yaml", "c/values.yaml"))
    assert [e.file_path for e in whole.entities.collect() if e.entity_id == "helm:chart:c"] == ["c/Chart.yaml"]
    assert ("helm:chart:c", "helm:chart:common", "subchart") in edges(whole)


def test_rows_without_a_file_are_upserted(spark, tmp_path):
    from loomgraph.operators.store import ParquetStore

    tree = {"go.mod": "module m\n", "x/a.go": "package x\nfunc A() {}\n", "c/Chart.yaml": "name: c\n", "c/values.yaml": "a: 1\n"}
    s = ParquetStore(spark, f"{tmp_path}/s", ["repo", "file_path"], ["repo", "entity_id"])
    s.apply(run(spark, tree).entities, None)
    for _ in range(2):
        g = run(spark, tree, changes=changed(spark, "x/a.go", "c/values.yaml"))
        s.apply(g.entities, g.graph_files.withColumnRenamed("path", "file_path"))
    rows = sorted((r.entity_id, r.file_path or "") for r in s.read().collect())
    assert rows == [("go:func:m/x.A", "x/a.go"), ("go:package:m/x", ""), ("helm:chart:c", "c/Chart.yaml"), ("helm:value:c.a", "c/values.yaml")]
    assert s._versions("manifest") == [2, 3] and s._versions("data") == [2, 3]


def test_facts_are_kept_by_content(spark, tmp_path):
    from loomgraph.operators.store import FactStore

    store = FactStore(spark, f"{tmp_path}/facts")
    tree = {"a.py": "def f():\n    g()\n", "b.py": "def g(): pass\n", "c.py": None}
    plain = lambda g: (sorted(map(str, g.entities.collect())), sorted(map(str, g.edges.collect())), sorted(map(str, g.failed.collect())))
    n_facts = lambda k: spark.read.parquet(f"{tmp_path}/facts/keys/run-{k:06}").count()
    assert plain(run(spark, tree, known_facts=store)) == plain(run(spark, tree)) and n_facts(1) == 3
    tree |= {"b.py": "def g(): pass\ndef h(): pass\n", "d.py": ""}
    assert plain(run(spark, tree, known_facts=store)) == plain(run(spark, tree)) and n_facts(2) == 2
    assert plain(run(spark, tree, known_facts=store)) == plain(run(spark, tree)) and store._runs() == ["run-000001", "run-000002"]


def test_go_calls_of_imported_packages(spark):
    tree = {
        "go.mod": "module example.org/m\n",
        "a/a.go": 'package a\nimport (\n\t"fmt"\n\tu "example.org/m/lib/util"\n\t"example.org/m"\n)\nfunc A() { u.Run(fmt.Sprint(1)); u.Run(2); m.Root(); x.u.Run(); u.Missing() }\n',
        "lib/util/u.go": "package util\nfunc Run(int) {}\n",
        "root.go": "package m\nfunc Root() {}\n",
    }
    e = edges(run(spark, tree))
    calls = {k[:2]: v for k, v in e.items() if k[2] == "calls"}
    assert set(calls) == {("go:func:example.org/m/a.A", "go:func:example.org/m/lib/util.Run"), ("go:func:example.org/m/a.A", "go:func:example.org/m.Root")}
    assert all(v.props == {"resolution": "imported_name_match", "confidence": "0.45", "degraded_by": "no_typecheck"} and v.confidence_score is None for v in calls.values())
