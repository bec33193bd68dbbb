"""Facts of Python files."""

from __future__ import annotations

import ast
import re
import warnings
from collections.abc import Iterator

from loomgraph.extract.facts import fact, register

_FUNC = (ast.FunctionDef, ast.AsyncFunctionDef)


def _segment(lines: list[str], node: ast.AST) -> str:
    """Source of a node by lines and UTF-8 columns."""
    a, b = node.lineno - 1, node.end_lineno - 1
    first, last = lines[a].encode(), lines[b].encode()
    if a == b:
        return first[node.col_offset : node.end_col_offset].decode("utf-8", "replace")
    return "\n".join([first[node.col_offset :].decode("utf-8", "replace"), *lines[a + 1 : b], last[: node.end_col_offset].decode("utf-8", "replace")])


def _parse(source: str) -> tuple[ast.Module, str, bool]:
    """Tree and text; of a broken file, the tree of the longest run of whole top-level blocks."""
    text = source.replace("\r\n", "\n").replace("\r", "\n").removeprefix(chr(0xFEFF))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            return ast.parse(text), text, False
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            pass
        kept = []
        for block in re.split(r"(?m)^(?=\S)", text):
            try:
                ast.parse(block)
                kept.append(block)
            except (SyntaxError, ValueError, RecursionError, MemoryError):
                kept.append("\n" * block.count("\n"))
        whole = "".join(kept)
        try:
            return ast.parse(whole), whole, True
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return ast.parse(""), "", True


def extract(path: str, source: str) -> Iterator[dict]:
    tree, text, _ = _parse(source)
    lines = text.split("\n")
    module = path.removesuffix(".py").replace("/", ".")
    module_id = f"py:module:{module}"
    yield fact("entity", entity_id=module_id, name=module, form="py_module", header=f"[py_module] {module}\nfile: {path}", body=source)
    order = 0

    def function(node, parent: str, owner: str, decorated: bool):
        nonlocal order
        name = f"{module}.{owner}.{node.name}" if owner else f"{module}.{node.name}"
        fid = f"py:func:{name}"
        yield fact("entity", entity_id=fid, parent_id=parent, name=node.name, form="py_func", line_start=node.lineno, line_end=node.end_lineno, header=f"[py_func] {name}\nfile: {path}", body=_segment(lines, node))
        order += 1
        yield fact("def", entity_id=fid, name=node.name, ord=order)
        stack = [*reversed(node.body)]
        while stack:
            x = stack.pop()
            if isinstance(x, ast.Call):
                order += 1
                form = "attribute" if isinstance(x.func, ast.Attribute) else "name" if isinstance(x.func, ast.Name) else "other"
                yield fact("call", entity_id=fid, name=x.func.id if form == "name" else _segment(lines, x.func), form=form, ord=order, note="decorator" if decorated else None)
            stack += reversed([*ast.iter_child_nodes(x)])

    for node in tree.body:
        if isinstance(node, _FUNC):
            yield from function(node, module_id, "", bool(node.decorator_list))
            yield fact("symbol", entity_id=f"py:func:{module}.{node.name}", name=f"{module}.{node.name}", form="func", note="provides")
        elif isinstance(node, ast.ClassDef) and not node.decorator_list:
            cid = f"py:class:{module}.{node.name}"
            yield fact("entity", entity_id=cid, parent_id=module_id, name=node.name, form="py_class", line_start=node.lineno, line_end=node.end_lineno, header=f"[py_class] {module}.{node.name}\nfile: {path}", body=_segment(lines, node))
            order += 1
            yield fact("def", entity_id=cid, name=node.name, ord=order)
            yield fact("symbol", entity_id=cid, name=f"{module}.{node.name}", form="class", note="provides")
            for child in node.body:
                if isinstance(child, _FUNC) and not child.decorator_list:
                    yield from function(child, cid, node.name, False)
        elif isinstance(node, ast.Import):
            for a in node.names:
                order += 1
                yield fact("external", entity_id=module_id, name=a.name.split(".")[0], form="import", ord=order)
        elif isinstance(node, ast.ImportFrom) and not node.level and node.module:
            order += 1
            named = [a.name for a in node.names]
            yield fact("external", entity_id=module_id, name=node.module.split(".")[0], target=",".join(named), form="from", ord=order)
            for a in node.names:
                if a.name != "*":
                    order += 1
                    yield fact("import", name=a.asname or a.name, target=f"{node.module}.{a.name}", form="suffix", note=a.name, ord=order)


register("python", extract)
