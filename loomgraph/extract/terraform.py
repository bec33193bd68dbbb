"""Facts of Terraform files."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator

from loomgraph.extract.facts import fact, register

_LABELS = {"variable": 1, "output": 1, "resource": 2, "data": 2, "module": 1}
_SKIPPED = frozenset("local each count path self terraform".split())
_BLOCK = re.compile(r"(?m)^[ \t]*([A-Za-z_][\w-]*)((?:[ \t]+(?:\"[^\"\n]*\"|[A-Za-z_][\w-]*))*)[ \t]*\{")
_TRAVERSAL = re.compile(r"(?<![\w.\"-])([A-Za-z_][\w-]*)((?:\.[A-Za-z_*\d][\w-]*|\[[^\]\n]*\])+)")
_ATTRIBUTE = re.compile(r"(?m)^[ \t]*([A-Za-z_][\w-]*)[ \t]*=(?!=)")


def mask(source: str) -> str:
    """Text of the same length without comments and literal text; what stands in ``${..}`` stays."""
    out = list(source)
    i, n, stack = 0, len(source), []

    def blank(a: int, b: int) -> None:
        for k in range(a, min(b, n)):
            if out[k] != "\n":
                out[k] = " "

    while i < n:
        c = source[i]
        if stack and stack[-1] == '"':
            if source.startswith("${", i) and not source.startswith("$${", i - 1):
                stack.append("{")
                blank(i, i + 2)
                i += 2
            elif c == "\\":
                blank(i, i + 2)
                i += 2
            elif c == '"':
                stack.pop()
                i += 1
            else:
                blank(i, i + 1)
                i += 1
            continue
        if c == '"':
            stack.append('"')
            i += 1
        elif c == "#" or source.startswith("//", i):
            e = source.find("\n", i)
            e = n if e < 0 else e
            blank(i, e)
            i = e
        elif source.startswith("/*", i):
            e = source.find("*/", i)
            e = n if e < 0 else e + 2
            blank(i, e)
            i = e
        elif (m := re.compile(r"<<-?([A-Za-z_]\w*)\r?\n").match(source, i)) is not None:
            e = re.compile(rf"(?m)^[ \t]*{m[1]}[ \t]*\r?$").search(source, m.end())
            stop = e.end() if e else n
            text = source[m.end() : stop]
            blank(i, stop)
            for x in re.finditer(r"(?<!\$)\$\{([^{}]*)\}", text):
                a = m.end() + x.start(1)
                out[a : a + len(x[1])] = list(x[1])
            i = stop
        else:
            if c == "{" and stack:
                stack.append("{")
            elif c == "}" and stack and stack[-1] == "{":
                stack.pop()
                if stack and stack[-1] == '"':
                    blank(i, i + 1)
            i += 1
    return "".join(out)


def _body_end(masked: str, at: int) -> int:
    depth = 0
    for m in re.compile(r"[{}]").finditer(masked, at):
        depth += 1 if m[0] == "{" else -1
        if depth == 0:
            return m.start()
    return -1


def extract(path: str, source: str) -> Iterator[dict]:
    masked, directory = mask(source), posixpath.dirname(path) or "."
    at, order = 0, 0
    while m := _BLOCK.search(masked, at):
        opened = m.end() - 1
        end = _body_end(masked, opened)
        if end < 0:
            yield fact("failed", note="unclosed block")
            return
        at = end + 1
        block = m[1]
        labels = [x.strip('"') for x in re.findall(r"\"[^\"\n]*\"|[A-Za-z_][\w-]*", source[m.start(2) : m.end(2)])]
        if block not in _LABELS or len(labels) < _LABELS[block]:
            continue
        name = labels[1] if block in ("resource", "data") else labels[0]
        full = f"{labels[0]}.{labels[1]}" if block in ("resource", "data") else name
        bid = f"tf:{block}:{directory}:{full}"
        shown = " ".join(f'"{x}"' for x in labels[: _LABELS[block]])
        yield fact("entity", entity_id=bid, name=name, form=f"tf_{block}", header=f"[tf_{block}] {full}", body=f"# {path}\n{block} {shown} {{ ... }}")
        if block == "variable":
            continue
        body, raw = masked[opened + 1 : end], source[opened + 1 : end]
        if block == "module" and (s := re.search(r"(?m)^[ \t]*source[ \t]*=[ \t]*\"([^\"\n$]*)\"", raw)):
            order += 1
            yield fact("edge", entity_id=bid, target=s[1], form="module_source", ord=order)
        # each traversal belongs to the attribute that begins last before it
        starts = [(a.start(), a[1]) for a in _ATTRIBUTE.finditer(body)]
        for t in _TRAVERSAL.finditer(body):
            owner = next((w for p, w in reversed(starts) if p <= t.start()), "")
            parts = re.findall(r"\.([A-Za-z_*\d][\w-]*)|(\[)", t[2])
            steps = [a for a, b in parts]
            root = t[1]
            if not steps or not steps[0] or steps[0] == "*" or steps[0].isdigit() or root in _SKIPPED:
                continue
            relation = "depends_on" if owner == "depends_on" else "references"
            if root == "var":
                if relation == "depends_on":
                    continue
                target, relation = f"tf:variable:{directory}:{steps[0]}", "var_ref"
            elif root == "module":
                target = f"tf:module:{directory}:{steps[0]}"
            elif root == "data":
                if len(steps) < 2 or not steps[1]:
                    continue
                target = f"tf:data:{directory}:{steps[0]}.{steps[1]}"
            else:
                target = f"tf:resource:{directory}:{root}.{steps[0]}"
            order += 1
            yield fact("edge", entity_id=bid, target=target, form=relation, ord=order)


register("terraform", extract)
