import ast
import random
import warnings

import pytest

from loomgraph.llm import syntax
from loomgraph.llm.parse.gll import Grammar

GOOD = {
    "python": ["", "x = 1\n", "def f(a, *, b=2, **k):\n    return a\n", "f'{x!r:>{w}} {y[\"a\"]}'\n", "match = 3\nmatch x:\n    case [1, *r] if r: pass\n", "with (a as b, c):\n    pass\n", "x: int = 1; y = (z := 3)\n", "async def f():\n    async for x in y: await z\n", '"""\n<<<<<<< HEAD\n"""\n', "if 1:\n\tx\n", "lambda *a, **k: (a, k)\n", "[x for x in y if x for z in x]", "a = b = yield_ = {**c, 1: 2}\n"],
    "javascript": ["", "let a = 1\nlet b = 2", "const f = async (x, {y = 2}, ...z) => { return x?.y ?? z }", "a = b / c / d; r = /[/]x/g.test(s)", "class A extends B { #p = 1; static async *m() {} get x() { return 1 } static { y() } }", "for (const x of y) z(); for (;;) break\nfor (a in b) ;", "x = `a${ `b${c}` }d`", "import a, {b as c} from 'x'; export default class {}", "label: while (1) continue label", "if (a) b\nelse c", "do x(); while (y) z()", "({a, b} = c)", "return_ = function* () { yield* x }", "with (a) b", "x = a ? (b, c) : d => e", "`<<<<<<< HEAD`"],
    "golang": ["package a\n", "package a\n\nimport (\n\t\"x\"\n\ty \"z\"\n)\n\nfunc (s *T) M(a, b int, c ...string) (x int, err error) {\n\tif v := f(); v > 1 {\n\t\treturn\n\t}\n\tfor i := range xs {\n\t\tgo g(i)\n\t}\n\treturn T{1, 2}.x, nil\n}\n", "package a\nvar m = map[string][]int{\"a\": {1}, }\n", "package a\nfunc F[T any, U ~int | string](x T) { switch y := x.(type) { case int: default: } }\n", "package a\ntype I interface { M(int) string; ~int | string }\ntype S struct { A, B int `j:\"x\"`; *T }\n", "package a\nfunc f() { select { case x := <-c: case c <- 1: } ; defer func() {}() }\n", "package a\nfunc f() { L: for ; ; { break L } }\n"],
    "terraform": ["", 'a = 1\nb "c" "d" {\n  e = "${f.g[0]}-${h("i")}"\n  j { k = true }\n}\n', "x = {\n  a = 1, b = 2\n  c : 3\n}\n", "x = [for a, b in c : a => b]\n".replace(" => b", ""), "x = {for k, v in m : k => v... if v != null}\n", 'x = <<-EOT\n  <<<<<<< a ${b}\n  EOT\ny = 1\n', "x = a ? b : c\n# z\n", "x = a.*.b\ny = -1 + 2 * (3 -\n 4)\n"],
    "yaml": ["", "a: 1\nb:\n- x\n- y: 2\n  z: |\n    t\n", "--- a\n--- {b: [c, d: e]}\n...\n", "'a': \"b\\n\"\n? c\n: d\n", "a: &x !!str b\nc: *x\n", '{"a": [1, null]}', "a: b\n  c\nd: e\n"],
    "gotemplate": ["", "a: {{ .Values.x | quote }}\n", "{{- if and .a (eq .b \"c\") }}x{{ else if .d }}y{{ else }}z{{ end -}}", "{{ range $i, $e := .l }}{{ $e.x }}{{ end }}{{/* c */}}", '{{ define "t" }}{{ template "u" . }}{{ end }}', "<<<<<<< HEAD\n"],
}
BAD = {
    "python": ["def f(:\n", "x = (1\n", "if x:\ny\n", "print 'a'\n", "x = 'a\n", "<<<<<<< HEAD\n", "  x\n", "f() = 1\n", "1 + 2 = 3\n", "x = 1__0\n", "f(a=1, b)\n", "else:\n  x\n", "f'{a'\n", "\tif x:\n        y\n", "a b\n", "for x y in z: pass\n"],
    "javascript": ["let = = 1", "function f( {", "a = `x${`", "if (a", '{"a": 1, "b": 2}', "interface A { b: string }", "x = 'a\n'", "<<<<<<< HEAD\na\n=======\n", "const x: string = 'a'", "return 1 2", "}", "var 1a", "a b", "class { x() }"],
    "golang": ["", "package", "package a\nfunc f() {", "package a\nfunc f() { x := }\n", "package a\nvar x = 'ab'\n", "package a\n=======\n", "import json\n", "package a\nfunc f() { if x { } }}\n", "package a\nfunc f()\n{\n}\n", "package a\nfunc f() { for i in x { } }\n"],
    "terraform": ['{"a": 1}', "a = \n", "a = 1 b = 2\n", 'a "b {\n}\n', "a {\n", "x = <<EOT\na\n", "a = 1\n=======\n", "}\n", "resource x = {\n"],
    "yaml": ["a: b: c\n", "a: [1\n", "a:\n\tb: 1\n", "<<<<<<< x\na: 1\n", "a: 1\nb\n", "a: 'x\n", "- a\nb: c\n", "a: @x\n", "a:\n  b: 1\n c: 2\n"],
    "gotemplate": ["{{ if }}x{{ end }}", "{{ if .a }}", "{{ end }}", "{{ .a }", "{{ .a", "{{ }}", '{{ "a }}', "{{ .a | }}", "{{ (a }}", "{{ else }}"],
}


@pytest.mark.parametrize("language", sorted(GOOD))
def test_grammars(language):
    assert [t for t in GOOD[language] if not syntax.dialects(language, t)] == []
    assert [t for t in BAD[language] if syntax.dialects(language, t)] == []


def test_dialects_run_together():
    assert syntax.dialects("javascript", "a()") == {"module", "script"}
    assert syntax.dialects("javascript", "import a from 'b'") == {"module"}


def test_python_agrees_with_the_standard_library():
    """Damaged copies of this very file: the recogniser and ast.parse agree."""
    source, r, differ = open(__file__, encoding="utf-8").read()[:6000], random.Random(4), []
    for _ in range(300):
        at = r.randrange(len(source))
        text = source[:at] + r.choice(["", "(", ")", "\n", " ", ":", "'", "x y", "= ="]) + source[at + r.randint(0, 3) :]
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(text)
            fine = True
        except (SyntaxError, ValueError):
            fine = False
        if fine != bool(syntax.dialects("python", text)):
            differ.append(text[max(0, at - 40) : at + 40])
    assert len(differ) <= 3, differ


def test_ambiguous_grammar_shares_its_stack():
    """An exponentially ambiguous grammar stays polynomial, against a brute-force count of what it derives."""
    g = Grammar('s : e "EOF" ; e : "a" e? e? | "(" e ")" ;', {"d": "s"})
    a, op, cl, end = (g.kind(k) for k in ("a", "(", ")", "EOF"))
    assert g.recognise([a] * 300 + [end], ("d",)) == {"d"}
    assert g.recognise([op] + [a] * 50 + [cl, end], ("d",)) == {"d"}
    assert g.recognise([op] + [a] * 50 + [end], ("d",)) == set()


def test_grammar_checks():
    with pytest.raises(ValueError, match="left-recursive"):
        Grammar('s : s "a" | "b" ;', {"d": "s"})
    with pytest.raises(ValueError, match="nothing"):
        Grammar('s : "a"* ;', {"d": "s"})


def test_table_edges(spark):
    rows = [(1, "r", "a.py", "x = ", "q"), (1, "r", "a.py", "x = ", "q"), (2, "r", "b.py", None, "q"), (3, "r", "c.md", "(((", "q"), (4, None, "d/templates/e.yaml", "{{ if }}", "q"), (5, "r", None, "x", "q"), (6, "r", "f.yaml", "a: [", "q"), (7, "r", "templates.yaml", "{{ if }}: [", "q"), (8, "r", "g.py", "x = 1\n" * 50_000, "q"), (9, "r", "noext", "x", "q")]
    df = spark.createDataFrame(rows, "file_id bigint, repo string, path string, content string, language string")
    assert sorted(r.file_id for r in syntax.find_unparsable(df).collect()) == [1, 4, 6, 7]
    assert syntax.find_unparsable(df.limit(0)).count() == 0
    results = spark.createDataFrame([("r", ["a.py", "g.py", None]), ("r", None), (None, ["x"])], "repo string, failed_files array<string>")
    got = {(r.repo, r.language): r for r in syntax.failure_rates(df, results).collect()}
    assert (got["r", "python"].n_files, got["r", "python"].n_failed, got["r", "python"].n_reported, got["r", "python"].n_reported_right) == (2, 1, 2, 1)
