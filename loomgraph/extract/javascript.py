"""Facts of JavaScript files."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

from loomgraph.extract.facts import fact, register
from loomgraph.extract.tokens import Token, closing, js_tokens, line_at

_NO_CALLEE = frozenset("if for while switch catch function return typeof with super import await yield void delete in of new do else case throw instanceof".split())


def resolve(directory: str, spec: str) -> str:
    """Path a relative specifier means; bare ones stay as they are."""
    if not spec.startswith("."):
        return spec
    path = posixpath.normpath(posixpath.join(directory, spec))
    return path if "." in posixpath.basename(path) else path + ".js"


def _calls(tokens: list[Token], a: int, b: int, source: str) -> Iterator[tuple[str, str]]:
    """(callee, form) of calls between two tokens, in order of their opening."""
    for i in range(a, b):
        if tokens[i].text != "(" or tokens[i].kind != "op" or i == a:
            continue
        k = i - 1
        t = tokens[k]
        if t.text == "]":  # obj[expr](..)
            depth, k2 = 0, k
            while k2 >= a:
                depth += {"]": 1, "[": -1}.get(tokens[k2].text, 0) if tokens[k2].kind == "op" else 0
                if depth == 0:
                    break
                k2 -= 1
            if k2 > a and (tokens[k2 - 1].kind == "name" or tokens[k2 - 1].text in ")]") and tokens[k2 - 1].text not in _NO_CALLEE:
                start = k2 - 1
                while start - 2 >= a and tokens[start - 1].text in (".", "?.") and tokens[start - 2].kind == "name":
                    start -= 2
                yield source[tokens[start].start : t.end], "computed"
            continue
        if t.kind != "name" or t.text in _NO_CALLEE:
            continue
        start = k
        while start - 2 >= a and tokens[start - 1].text in (".", "?.") and (tokens[start - 2].kind == "name" or tokens[start - 2].text in ")]"):
            start -= 2
            if tokens[start].text in ")]":
                depth = 0
                while start >= a:
                    depth += 1 if tokens[start].text in ")]}" else -1 if tokens[start].text in "([{" else 0
                    if depth == 0:
                        break
                    start -= 1
                start -= 1 if start > a and tokens[start - 1].kind == "name" else 0
        before = tokens[start - 1] if start > a else None
        if before is not None and before.kind == "name" and before.text in ("function", "get", "set", "static", "async"):
            continue
        after = closing(tokens, i)
        if start == k and after + 1 < len(tokens) and tokens[after + 1].text == "{" and (before is None or before.text in "{};"):
            continue  # a method of a class or object
        yield source[tokens[start].start : t.end], "member" if start != k else "name"


def extract(path: str, source: str) -> Iterator[dict]:
    tokens = js_tokens(source)
    module_id, directory = f"js:module:{path}", posixpath.dirname(path)
    yield fact("entity", entity_id=module_id, name=path, form="js_module", header=f"[js_module] {path}\nfile: {path}", body=source)
    n, i, order = len(tokens), 0, 0

    def function(name: str, a: int, b: int, exported: bool, named: bool):
        """A function between two tokens; ``named`` ones are in the file's table of names."""
        nonlocal order
        fid = f"js:func:{path}::{name}"
        yield fact("entity", entity_id=fid, parent_id=module_id, name=name, form="js_func", line_start=line_at(source, tokens[a].start), line_end=line_at(source, tokens[b].end), header=f"[js_func] {path}::{name}\nfile: {path}", body=source[tokens[a].start : tokens[b].end])
        if named:
            order += 1
            yield fact("def", entity_id=fid, name=name, ord=order)
        if exported:
            yield fact("symbol", entity_id=fid, name=f"{path}::{name}", form="func", note="provides")
        body = next((k for k in range(a, b) if tokens[k].text in ("{", "=>") and (tokens[k].text == "=>" or tokens[k - 1].text == ")")), a)
        for callee, form in _calls(tokens, body, b + 1, source):
            order += 1
            yield fact("call", entity_id=fid, name=callee, form=form, ord=order, note="dynamic" if form == "computed" else None)

    def end_of_statement(k: int) -> int:
        depth = 0
        while k < n:
            t = tokens[k]
            if t.kind == "op" and t.text in "([{":
                k = closing(tokens, k)
            elif t.kind == "op" and (t.text == ";" or t.text == "," and depth == 0):
                return k - 1
            elif k + 1 < n and "\n" in source[t.end : tokens[k + 1].start] and tokens[k + 1].kind == "name" and t.text not in ("=>", "=", "(", ",") and t.kind != "op":
                return k
            elif k + 1 < n and t.text in ")}" and "\n" in source[t.end : tokens[k + 1].start] and tokens[k + 1].text not in (".", "?.", "(", "+"):
                return k
            k += 1
        return n - 1

    while i < n:
        start, exported = i, False
        if tokens[i].text == "export":
            exported = True
            i += 1
            if i < n and tokens[i].text == "default":
                i += 1
        word = tokens[i].text if i < n else ""
        k = i + 1 if word == "async" else i
        if k < n and tokens[k].text == "function":
            name_at = k + 2 if k + 1 < n and tokens[k + 1].text == "*" else k + 1
            opened = next((j for j in range(name_at, n) if tokens[j].text == "("), n - 1)
            brace = closing(tokens, opened) + 1
            end = closing(tokens, brace) if brace < n and tokens[brace].text == "{" else min(brace, n - 1)
            if name_at < n and tokens[name_at].kind == "name" and word != "async" or name_at < n and tokens[name_at].kind == "name":
                yield from function(tokens[name_at].text, i, end, exported, True)
            i = end + 1
        elif word == "class":
            brace = next((j for j in range(i, n) if tokens[j].text == "{"), n - 1)
            end = closing(tokens, brace)
            if i + 1 < n and tokens[i + 1].kind == "name" and tokens[i + 1].text != "extends":
                name = tokens[i + 1].text
                cid = f"js:class:{path}::{name}"
                yield fact("entity", entity_id=cid, parent_id=module_id, name=name, form="js_class", line_start=line_at(source, tokens[i].start), line_end=line_at(source, tokens[end].end), header=f"[js_class] {path}::{name}\nfile: {path}", body=source[tokens[i].start : tokens[end].end])
                order += 1
                yield fact("def", entity_id=cid, name=name, ord=order)
                if exported:
                    yield fact("symbol", entity_id=cid, name=f"{path}::{name}", form="class", note="provides")
            i = end + 1
        elif word in ("const", "let", "var"):
            j = i + 1
            while True:
                end = end_of_statement(j)
                if j + 2 < n and tokens[j].kind == "name" and tokens[j + 1].text == "=":
                    v = j + 2
                    f = v + 1 if tokens[v].text == "async" else v
                    arrow = f < n and (tokens[f].kind == "name" and f + 1 < n and tokens[f + 1].text == "=>" or tokens[f].text == "(" and closing(tokens, f) + 1 < n and tokens[closing(tokens, f) + 1].text == "=>")
                    if arrow or f < n and tokens[f].text == "function":
                        yield from function(tokens[j].text, v, end, exported, word != "var" or exported)
                # require bindings: const x = require('..')
                call = next((q for q in range(j, min(end, n - 2)) if tokens[q].text == "require" and tokens[q + 1].text == "(" and tokens[q + 2].kind == "text"), None)
                if call is not None:
                    spec = tokens[call + 2].text.strip("'\"`")
                    if spec.startswith("."):
                        order += 1
                        yield fact("import", name=None, target=resolve(directory, spec), form="require", ord=order)
                if end + 1 < n and tokens[end + 1].text == "," and end + 2 < n:
                    j = end + 2
                    continue
                break
            i = end + 1
        elif word == "import" and i + 1 < n and tokens[i + 1].text not in ("(", "."):
            end = next((j for j in range(i, n) if tokens[j].kind == "text" and tokens[j].text[:1] in "'\""), n - 1)
            spec = tokens[end].text.strip("'\"")
            order += 1
            if spec.startswith("."):
                target = resolve(directory, spec)
                yield fact("import", name=None, target=target, form="module", ord=order)
            else:
                target = spec
                yield fact("external", entity_id=module_id, name=spec, form="bare", ord=order)
            clause = tokens[i + 1 : end]
            for q, t in enumerate(clause):
                if t.kind == "name" and t.text not in ("from", "as", "type") and not (q and clause[q - 1].text == "as") and (q == 0 or clause[q - 1].text in "{,"):
                    order += 1
                    yield fact("import", name=t.text, target=target, form="named", ord=order)
            i = end + 1
        elif i < n and tokens[i].kind == "op" and tokens[i].text in "([{":
            i = closing(tokens, i) + 1
        else:
            i += 1
        i = max(i, start + 1)


register("javascript", extract)
