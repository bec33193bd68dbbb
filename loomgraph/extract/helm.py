"""Facts of Helm charts: charts, values and templates. The chart's name is joined in by its root."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator

from loomgraph.extract import template
from loomgraph.extract.facts import fact, register

_ACTION = re.compile(r"\{\{-?(?!-?\s*/\*)([\s\S]*?)-?\}\}")
_COMMENT = re.compile(r"\{\{-?\s*/\*[\s\S]*?\*/\s*-?\}\}")
_VALUE = re.compile(r"(?<![\w.$)])\.Values((?:\.[A-Za-z_]\w*)+)")
_INCLUDE = re.compile(r"\b(?:include|template)\s+\"([^\"]+)\"")
_KEY = re.compile(r"[\"']?([^\"':]+)[\"']?:(?:\s+(.*))?$")
_STRINGS = re.compile(r"\"(?:[^\"\\]|\\.)*\"|`[^`]*`")


def chart_root(path: str) -> str:
    """What stands before the first ``templates`` directory, else the parent directory."""
    parts = path.split("/")
    if "templates" in parts:
        return "/".join(parts[: parts.index("templates")]) or "."
    return posixpath.dirname(path) or "."


def flatten(value, prefix: str = "") -> Iterator[str]:
    """Dotted keys of a tree; lists and empty maps are leaves."""
    for key, child in value.items():
        name = f"{prefix}.{key}" if prefix else str(key)
        if isinstance(child, dict) and child:
            yield from flatten(child, name)
        else:
            yield name


def read_yaml(text: str):
    """A YAML document, by PyYAML where it is installed, else by a reader of plain block mappings."""
    try:
        import yaml
    except ImportError:
        return plain_mapping(text)
    return yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))


def plain_mapping(text: str) -> dict:
    """Nested block mappings and lists, with every leaf as text; for where no YAML reader is installed."""
    rows = []
    for line in text.replace("\r\n", "\n").split("\n"):
        bare = line.strip()
        if bare and not bare.startswith("#") and bare not in ("---", "..."):
            rows.append((len(line) - len(line.lstrip(" ")), bare))

    def block(i: int, depth: int):
        """The mapping or list whose lines begin at ``depth``, and the first line after it."""
        out = [] if rows[i][1].startswith("- ") else {}
        while i < len(rows) and rows[i][0] == depth and (rows[i][1].startswith("- ") == isinstance(out, list)):
            bare = rows[i][1]
            if isinstance(out, list):
                rows[i] = (depth + 2, bare[2:].strip())
                if _KEY.match(rows[i][1]):
                    value, i = block(i, depth + 2)
                    out.append(value)
                else:
                    out.append(rows[i][1].strip("\"'"))
                    i += 1
                continue
            m = _KEY.match(bare)
            if not m:
                raise ValueError(f"no mapping: {bare[:40]}")
            value, i = re.split(r"(?:^|\s)#", m[2] or "")[0].strip(), i + 1
            below = i < len(rows) and (rows[i][0] > depth or rows[i][0] == depth and rows[i][1].startswith("- "))
            if value[:1] in ("|", ">"):
                while i < len(rows) and rows[i][0] > depth:
                    i += 1
            elif not value and below:
                value, i = block(i, rows[i][0])
            out[m[1].strip()] = {} if value in ("", "{}") else value.strip("\"'") if isinstance(value, str) else value
        return out, i

    if not rows:
        return {}
    tree, end = block(0, rows[0][0])
    if end < len(rows) or not isinstance(tree, dict):
        raise ValueError("no block mapping")
    return tree


def balanced(content: str) -> bool:
    """Whether a template parses."""
    try:
        template.check(content)
    except template.TemplateError:
        return False
    return True


def extract(path: str, source: str) -> Iterator[dict]:
    root, name = chart_root(path), posixpath.basename(path)
    order = 0
    if name == "Chart.yaml" and "templates" not in path.split("/"):
        try:
            manifest = read_yaml(source) or {}
        except Exception:  # noqa: BLE001 - any fault of the document is the same fault
            yield fact("failed", note="Chart.yaml")
            return
        if manifest.get("name"):
            yield fact("chart", entity_id=f"helm:chart:{manifest['name']}", name=str(manifest["name"]), target=root, form="helm_chart")
            for d in manifest.get("dependencies") or []:
                order += 1
                yield fact("edge", entity_id=f"helm:chart:{manifest['name']}", target=f"helm:chart:{d.get('alias') or d.get('name')}", form="subchart", ord=order)
        return
    if "templates" in path.split("/"):
        tid = f"helm:template:{path}"
        if not balanced(source):
            yield fact("entity", entity_id=tid, name=name, form="helm_template", target=root)
            yield fact("failed", note="template")
            return
        yield fact("entity", entity_id=tid, name=name, form="helm_template", target=root, header=f"[helm_template] {path}", body=source)
        for a in _ACTION.findall(_COMMENT.sub("", source)):
            for inc in _INCLUDE.findall(a):
                order += 1
                yield fact("edge", entity_id=tid, target=f"helm:include:{inc}", form="includes", ord=order)
            for v in _VALUE.findall(_STRINGS.sub('""', a)):
                order += 1
                yield fact("value_ref", entity_id=tid, name=v[1:], target=root, form="value_ref", ord=order)
        return
    if name == "values.yaml":
        try:
            tree = read_yaml(source) or {}
            keys = sorted(flatten(tree)) if isinstance(tree, dict) else []
        except Exception:  # noqa: BLE001
            yield fact("failed", note="values.yaml")
            return
        for key in keys:
            yield fact("value", name=key, target=root, form="helm_value")


register("helm", extract)
