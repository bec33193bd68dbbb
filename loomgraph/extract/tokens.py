"""A tolerant scanner for languages with braces: names, punctuation and literals, with their places."""

from __future__ import annotations

import re
from typing import NamedTuple


class Token(NamedTuple):
    kind: str  # name, text, op
    text: str
    start: int
    end: int


_GO = re.compile(r"(?P<skip>\s+|//[^\n]*|/\*[\s\S]*?(?:\*/|\Z))|(?P<text>`[^`]*(?:`|\Z)|\"(?:[^\"\\\n]|\\.)*\"?|'(?:[^'\\\n]|\\.)*'?)|(?P<name>[^\W\d]\w*)|(?P<op>:=|[^\s\w])|(?P<num>\w+)")
_JS = re.compile(
    r"(?P<skip>\s+|//[^\n]*|/\*[\s\S]*?(?:\*/|\Z))|(?P<text>\"(?:[^\"\\\n]|\\[\s\S])*\"?|'(?:[^'\\\n]|\\[\s\S])*'?)|(?P<tpl>`)|(?P<name>[A-Za-z_$][\w$]*)|(?P<op>=>|\?\.|\.\.\.|[^\s\w])|(?P<num>\w+)"
)
_REGEX = re.compile(r"/(?![*/])(?:[^\\/\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*")
_VALUE = frozenset(")]}")
_KEYWORDS_BEFORE_REGEX = frozenset("return typeof case in of new delete void throw do else instanceof".split())


def go_tokens(source: str) -> list[Token]:
    return [Token("op" if m.lastgroup == "op" else "text" if m.lastgroup in ("text", "num") else "name", m[0], m.start(), m.end()) for m in _GO.finditer(source) if m.lastgroup != "skip"]


def js_tokens(source: str) -> list[Token]:
    """Tokens of a script; the code inside template literals is scanned like any other."""
    out: list[Token] = []
    at, n, depth, templates = 0, len(source), 0, []
    while at < n:
        m = _JS.match(source, at)
        if m is None:
            at += 1
            continue
        kind, start, end = m.lastgroup, at, m.end()
        if kind == "skip":
            at = end
            continue
        if kind == "op" and m[0] == "/" and (not out or out[-1].kind == "op" and out[-1].text not in _VALUE or out[-1].text in _KEYWORDS_BEFORE_REGEX):
            r = _REGEX.match(source, at)
            if r:
                kind, end = "text", r.end()
        if kind == "op" and m[0] == "{":
            depth += 1
        closes = kind == "op" and m[0] == "}" and templates and templates[-1] == depth
        if kind == "op" and m[0] == "}":
            depth -= 1
        if kind == "tpl" or closes:
            if closes:
                templates.pop()
                depth += 1
            while end < n and source[end] != "`" and not source.startswith("${", end):
                end += 2 if source[end] == "\\" else 1
            if source.startswith("${", end):
                end += 2
                templates.append(depth)
                out.append(Token("text", source[start:end], start, end))
                at = end
                continue
            end += 1
            if closes:
                depth -= 0
            kind = "text"
        out.append(Token("op" if kind == "op" else "text" if kind in ("text", "num", "tpl") else "name", source[start:end], start, end))
        at = end
    return out


_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, frozenset(")]}")


def closing(tokens: list[Token], i: int) -> int:
    """Index of the bracket that closes the one at ``i``, or the last token where none does."""
    depth = 0
    for k in range(i, len(tokens)):
        if tokens[k].kind == "op":
            if tokens[k].text in _OPEN:
                depth += 1
            elif tokens[k].text in _CLOSE:
                depth -= 1
                if depth <= 0:
                    return k
    return len(tokens) - 1


def line_at(source: str, place: int) -> int:
    return source.count("\n", 0, place) + 1
