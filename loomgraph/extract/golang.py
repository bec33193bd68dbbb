"""Facts of Go files, by syntax alone: there is no type checker, so calls never exceed the capped score.

Calls name a function of the own package, or one of an imported package by that package's name; calls of
methods on values need types and are not resolved.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator

from loomgraph.extract.facts import fact, register
from loomgraph.extract.tokens import Token, closing, go_tokens, line_at

_NO_CALLEE = frozenset("if for switch select func return go defer case var const type struct interface map chan range".split())


def _imports(tokens: list[Token]) -> Iterator[tuple[str, str]]:
    """(local name, path) of imports; without an alias the name is the path's last part that is no version."""
    i = 0
    while i < len(tokens):
        if tokens[i].text == "import" and tokens[i].kind == "name" and i + 1 < len(tokens):
            end = closing(tokens, i + 1) if tokens[i + 1].text == "(" else min(i + 3, len(tokens))
            for k in range(i + 1, end):
                if tokens[k].kind == "text" and tokens[k].text[:1] in '"`':
                    path = tokens[k].text.strip('"`')
                    parts = [x for x in path.split("/") if not re.fullmatch(r"v\d+", x)] or [path]
                    alias = tokens[k - 1].text if tokens[k - 1].kind == "name" and tokens[k - 1].text != "import" else parts[-1]
                    yield alias, path
            i = end
        i += 1


def _references(tokens: list[Token], a: int, b: int, packages: dict[str, str], owner: str) -> Iterator[dict]:
    """Exported names of imported packages between two tokens."""
    for j in range(a, min(b, len(tokens)) - 2):
        t = tokens[j]
        if t.kind == "name" and t.text in packages and tokens[j + 1].text == "." and tokens[j + 2].kind == "name" and tokens[j + 2].text[:1].isupper() and (j == 0 or tokens[j - 1].text != "."):
            yield fact("reference", entity_id=owner, name=f"{packages[t.text]}.{tokens[j + 2].text}", target=packages[t.text], form="func")


def extract(path: str, source: str) -> Iterator[dict]:
    """The package's path is the file's directory here; the module's path is put before it by a join."""
    tokens = go_tokens(source)
    directory = posixpath.dirname(path)
    package = f"<module>/{directory}" if directory else "<module>"
    package_id, n, order = f"go:package:{package}", len(tokens), 0
    clause = next((tokens[k + 1].text for k in range(n - 1) if tokens[k].text == "package"), "")
    yield fact("package", entity_id=package_id, name=clause, form="go_package")
    packages = dict(_imports(tokens))
    i = 0
    while i < n:
        t = tokens[i]
        if t.kind == "name" and t.text in packages:
            yield from _references(tokens, i, min(i + 3, n), packages, package_id)
        if t.kind == "op" and t.text in "([{":
            yield from _references(tokens, i, closing(tokens, i), packages, package_id)
            i = closing(tokens, i) + 1
            continue
        if t.text != "func" or t.kind != "name":
            i += 1
            continue
        k, receiver = i + 1, None
        if k < n and tokens[k].text == "(":
            end = closing(tokens, k)
            words = [x for x in tokens[k + 1 : end]]
            cut = next((q for q, x in enumerate(words) if x.text == "["), len(words))
            names = [x.text for x in words[:cut] if x.kind == "name"]
            receiver = names[-1] if names else "unknown"
            k = end + 1
        if k >= n or tokens[k].kind != "name":
            i = k
            continue
        name = tokens[k].text
        opened = next((q for q in range(k, n) if tokens[q].text == "("), n - 1)
        q = closing(tokens, opened) + 1
        while q < n and not (tokens[q].text == "{" and tokens[q - 1].text not in ("interface", "struct")):
            if tokens[q].text == "func" and tokens[q - 1].text not in ("(", ",", ")", "]") or "\n" in source[tokens[q - 1].end : tokens[q].start]:
                break
            q = closing(tokens, q) + 1 if tokens[q].text in "([{" else q + 1
        has_body = q < n and tokens[q].text == "{"
        end = closing(tokens, q) if has_body else q - 1
        kind = "go_method" if receiver else "go_func"
        fid = f"go:method:{package}.({receiver}).{name}" if receiver else f"go:func:{package}.{name}"
        exported = name[:1].isupper()
        shown = f"{package}.({receiver}).{name}" if receiver else f"{package}.{name}"
        yield fact(
            "entity", entity_id=fid, parent_id=package_id, name=name, form=kind, line_start=line_at(source, t.start), line_end=line_at(source, tokens[end].end), note="true" if exported else "false",
            header=f"[{kind}] {shown}\nfile: {path}\npackage: {package}", body=source[t.start : tokens[end].end],
        )
        if not receiver:
            order += 1
            yield fact("def", entity_id=fid, name=name, target=package, ord=order)
        if exported:
            yield fact("symbol", entity_id=fid, name=f"{package}.{receiver}.{name}" if receiver else f"{package}.{name}", form="method" if receiver else "func", note="provides")
        yield from _references(tokens, i, end + 1, packages, fid)
        if has_body:
            for j in range(q + 1, end):
                if tokens[j].text == "(" and tokens[j - 1].kind == "name" and tokens[j - 1].text not in _NO_CALLEE and tokens[j - 2].text not in (".", "func"):
                    order += 1
                    yield fact("call", entity_id=fid, name=tokens[j - 1].text, target=package, form="package", ord=order)
                elif tokens[j].text == "(" and tokens[j - 1].kind == "name" and tokens[j - 2].text == "." and tokens[j - 3].text in packages and tokens[j - 4].text != "." and tokens[j - 1].text[:1].isupper():
                    order += 1
                    yield fact("call", entity_id=fid, name=tokens[j - 1].text, target=packages[tokens[j - 3].text], form="imported", ord=order)
        i = end + 1


register("go", extract)
