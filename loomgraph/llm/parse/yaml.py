"""YAML: a scanner that marks block structure by indentation, and a grammar of the marked stream."""

from __future__ import annotations

import re

from loomgraph.llm.parse.gll import Grammar

GRAMMAR = r"""
stream : ( block )? ( DOCEND | DIRECTIVE* DOCSTART block? )* "EOF" ;
block : ALIAS | PROP+ ( content )? | content ;
content : SCALAR | flow | BSEQ ( ENTRY block? )* BEND | BMAP ( KEY inner? ( VALUE inner? )? | VALUE inner? )* BEND ;
inner : ALIAS | PROP+ ( content | entries )? | content | entries ;
entries : ( ENTRY block? )+ ;
flow : "[" ( seq_item ( "," seq_item )* ","? )? "]" | "{" ( map_item ( "," map_item )* ","? )? "}" ;
node : ALIAS | PROP+ ( SCALAR | flow )? | SCALAR | flow ;
seq_item : node | KEY node? ( VALUE node? )? | VALUE node? ;
map_item : KEY node? ( VALUE node? )? | node | VALUE node? ;
"""

G = Grammar(GRAMMAR, {"yaml": "stream"})
DIALECTS = ("yaml",)
_K = G.kind
_DOCEND, _DOCSTART, _DIRECTIVE, _ALIAS, _PROP, _SCALAR, _BSEQ, _BMAP, _BEND, _ENTRY, _KEY, _VALUE, _EOF = map(_K, ("DOCEND", "DOCSTART", "DIRECTIVE", "ALIAS", "PROP", "SCALAR", "BSEQ", "BMAP", "BEND", "ENTRY", "KEY", "VALUE", "EOF"))
_OPEN = {"[": _K("["), "{": _K("{")}
_SHUT = {"]": _K("]"), "}": _K("}")}
_COMMA = _K(",")

_SKIP = re.compile(r"[ ]*(?:\t[ \t]*)?(?:#[^\r\n]*)?")
_BREAK = re.compile(r"\r\n|\n|\r|\x85| | ")
_DOC = re.compile(r"(?:---|\.\.\.)(?=[ \t\r\n]|$)")
_DOUBLE = re.compile(r"\"(?:[^\\\"]|\\(?:[0abtnvfre \"/\\N_LP\t]|\r?\n|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}))*\"")
_SINGLE = re.compile(r"'(?:[^']|'')*'")
_HEADER = re.compile(r"[|>](?:[+-]?[1-9]?|[1-9][+-])[ \t]*(?:(?<=[ \t])#[^\r\n]*)?(?=[\r\n]|$)")
_WORD = re.compile(r"[^\s,\[\]{}]+")
_TAG = re.compile(r"!(?:<[^>\s]+>|[^\s,\[\]{}]*)")
_PLAIN_BLOCK = re.compile(r"(?:[^\s:#]|:(?=\S)|(?<=\S)#|[ \t]+(?=[^\s#])(?!:(?:\s|$)))+")
_PLAIN_FLOW = re.compile(r"(?:[^\s:#,\[\]{}?]|\?(?=[^\s,\[\]{}])|:(?=[^\s,\[\]{}])|(?<=\S)#|[ \t]+(?=[^\s#,\[\]{}])(?!:(?:[\s,\[\]{}]|$)))+")
_BAD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def lex(text: str) -> list[int] | None:
    """Token kinds with the beginnings and ends of block collections; None where the text cannot be scanned."""
    if text.startswith("\ufeff"):
        text = text[1:]
    if _BAD.search(text):
        return None
    out: list[int] = []
    indents: list[int] = [-1]
    flow: list[str] = []
    keys: dict[int, tuple[int, int, int]] = {}  # flow depth: (place in out, line, column) of what may be a key
    line, start, at, n = 0, 0, 0, len(text)
    allowed = True  # a block key or entry may begin here
    adjacent = False  # a quoted scalar or flow collection just ended: a colon may follow at once

    def unwind(column: int) -> None:
        while indents[-1] > column:
            indents.pop()
            out.append(_BEND)

    while True:
        # blanks, comments and line ends
        while True:
            m = _SKIP.match(text, at)
            if m[0].lstrip(" \t").startswith("#") and at > start and text[at - 1] not in " \t" and m[0][0] == "#":
                return None
            at_line_start = at == start
            at = m.end()
            b = _BREAK.match(text, at)
            if b:
                line, at = line + 1, b.end()
                start = at
                adjacent = False
                keys.clear()  # a key stands on one line
                if not flow:
                    allowed = True
                continue
            if at < n and at_line_start and "\t" in m[0] and not flow:
                return None  # tabs do not indent
            if m[0]:
                adjacent = False
            break
        column = at - start
        if at >= n:
            break
        if column == 0 and (m := _DOC.match(text, at)):
            if flow:
                return None
            unwind(-1)
            keys.clear()
            out.append(_DOCSTART if m[0] == "---" else _DOCEND)
            at += 3
            allowed = True
            if m[0] == "---":
                allowed = False
            continue
        if not flow:
            unwind(column)
        c = text[at]
        follow = text[at + 1 : at + 2]
        blank = not follow or follow in " \t\r\n"
        if c == "%" and column == 0 and not flow and (not out or out[-1] == _DOCEND or out[-1] == _DIRECTIVE):
            e = _BREAK.search(text, at)
            at = e.start() if e else n
            out.append(_DIRECTIVE)
            continue
        if c in "[{":
            if (flow or allowed) and len(flow) not in keys:
                keys[len(flow)] = (len(out), line, column)
            out.append(_OPEN[c])
            flow.append(c)
            at += 1
            allowed = True
            continue
        if c in "]}":
            if not flow or {"]": "[", "}": "{"}[c] != flow.pop():
                return None
            keys.pop(len(flow) + 1, None)
            out.append(_SHUT[c])
            at += 1
            allowed, adjacent = False, True
            continue
        if c == "," and flow:
            keys.pop(len(flow), None)
            out.append(_COMMA)
            at += 1
            allowed = True
            continue
        if c == "-" and blank and not flow:
            if not allowed:
                return None
            if column > indents[-1]:
                indents.append(column)
                out.append(_BSEQ)
            keys.pop(0, None)
            out.append(_ENTRY)
            at += 1
            continue
        if c == "?" and blank:
            if not flow:
                if not allowed:
                    return None
                if column > indents[-1]:
                    indents.append(column)
                    out.append(_BMAP)
            keys.pop(len(flow), None)
            out.append(_KEY)
            at += 1
            continue
        if c == ":" and (blank or flow and (follow in ",[]{}" or adjacent)):
            key = keys.pop(len(flow), None)
            if key and key[1] == line and at - start - key[2] <= 1024:
                out.insert(key[0], _KEY)
                if not flow and key[2] > indents[-1]:
                    indents.append(key[2])
                    out.insert(key[0], _BMAP)
                allowed = False
            else:
                if not flow:
                    if not allowed:
                        return None
                    if column > indents[-1]:
                        indents.append(column)
                        out.append(_BMAP)
                allowed = not flow
            out.append(_VALUE)
            at += 1
            adjacent = False
            continue
        # what follows may be a key
        may = flow or allowed
        if c in "&*":
            m = _WORD.match(text, at + 1)
            if not m:
                return None
            if may and len(flow) not in keys:
                keys[len(flow)] = (len(out), line, column)
            out.append(_PROP if c == "&" else _ALIAS)
            at = m.end()
            allowed = False
            continue
        if c == "!":
            if may and len(flow) not in keys:
                keys[len(flow)] = (len(out), line, column)
            out.append(_PROP)
            at = _TAG.match(text, at).end()
            allowed = False
            continue
        if c in "|>" and not flow:
            m = _HEADER.match(text, at)
            if not m:
                return None
            keys.pop(0, None)
            out.append(_SCALAR)
            digit = re.search(r"[1-9]", m[0].split("#")[0])
            parent = max(indents[-1], -1)
            need = max(parent, 0) + int(digit[0]) if digit else None
            at = m.end()
            while True:  # lines that are blank or deeper than the parent
                b = _BREAK.match(text, at)
                if not b:
                    break
                s = b.end()
                e = _BREAK.search(text, s)
                stop = e.start() if e else n
                body = text[s:stop]
                depth = len(body) - len(body.lstrip(" "))
                if body.strip(" ") == "":
                    line, start, at = line + 1, s, stop
                    continue
                if need is None:
                    if depth <= parent:
                        break
                    need = depth
                if depth < need or depth == 0 and _DOC.match(text, s):
                    break
                line, start, at = line + 1, s, stop
            allowed = True
            continue
        placed = keys.get(len(flow), (-1, -1, -1))
        fresh = placed[1] != line or placed[0] < len(out) - 2 or out[placed[0] : placed[0] + 1] not in ([_PROP],)
        if may and fresh and not (placed[1] == line and out[placed[0] : len(out)] == [_PROP] * (len(out) - placed[0])):
            keys[len(flow)] = (len(out), line, column)
        if c in "\"'":
            m = (_DOUBLE if c == '"' else _SINGLE).match(text, at)
            if not m:
                return None
            body = m[0]
            if any(_DOC.match(body, b.end()) for b in _BREAK.finditer(body)):
                return None
            breaks = list(_BREAK.finditer(body))
            if breaks:
                line += len(breaks)
                start = at + breaks[-1].end()
                keys.clear()
            out.append(_SCALAR)
            at = m.end()
            allowed, adjacent = False, True
            continue
        if c in "#,[]{}%@`" or c in "&*!|>" or c in "-?:" and (blank or flow and follow in ",[]{}"):
            return None
        # a plain scalar, perhaps over several lines
        pattern = _PLAIN_FLOW if flow else _PLAIN_BLOCK
        first = True
        while True:
            m = pattern.match(text, at)
            if not m or (not first and m.end() == at):
                break
            at = m.end()
            first = False
            # a further line belongs to the scalar if it is deeper than the collection and no comment or mark
            s = at
            while s < n and text[s] in " \t":
                s += 1
            if text.startswith("#", s) and s > at:
                break
            b = _BREAK.match(text, s)
            if not b:
                break
            lines, p = 0, s
            while (b := _BREAK.match(text, p)) is not None:
                lines, q = lines + 1, b.end()
                p = q
                while p < n and text[p] in " \t":
                    p += 1
            if p >= n or text[p] == "#" or not flow and p - q <= indents[-1] or p == q and _DOC.match(text, q) or not flow and "\t" in text[q:p][: indents[-1] + 1]:
                break
            nxt = pattern.match(text, p)
            if not nxt or text[p] in ":" and (p + 1 >= n or text[p + 1] in " \t\r\n") or flow and text[p] in ",[]{}":
                break
            line, start, at = line + lines, q, p
            keys.clear()
        if first:
            return None
        out.append(_SCALAR)
        allowed = False
    if flow:
        return None
    unwind(-1)
    out.append(_EOF)
    return out


def accepts(text: str) -> set[str]:
    tokens = lex(text)
    return set() if tokens is None else G.recognise(tokens, DIALECTS)
