"""Go templates: actions, blocks and pipelines, parsed as far as syntax goes; functions are not looked up."""

from __future__ import annotations

import re

_COMMENT = re.compile(r"\{\{(?:- )?/\*.*?\*/(?: -)?\}\}", re.S)
_TOKEN = re.compile(
    r"""\s+|(?P<text>"(?:[^"\\\n]|\\.)*"|`[^`]*`)|(?P<char>'(?:[^'\\\n]|\\.)+')|(?P<number>[+-]?\d[\w.]*(?:[eEpP][+-]\w+)?)|(?P<var>\$\w*)|(?P<field>\.[^\W\d]\w*)|(?P<word>[^\W\d]\w*)|(?P<op>:=|[.|()=,])"""
)


class TemplateError(ValueError):
    """What does not parse, and where."""


def actions(source: str) -> list[tuple[int, str]]:
    """(offset, inside) of every action in order; comments are none. An action ends at the first ``}}`` outside its texts."""
    out, at = [], 0
    while (start := source.find("{{", at)) >= 0:
        if m := _COMMENT.match(source, start):
            at = m.end()
            continue
        k = start + 2
        if source[k : k + 1] == "-" and source[k + 1 : k + 2].isspace():
            k += 1
        begin = k
        while True:
            if k >= len(source):
                raise TemplateError(f"unclosed action at {start}")
            if source.startswith("}}", k):
                break
            c = source[k]
            if c in "\"'`":
                m = re.compile(r"`[^`]*`" if c == "`" else rf"{c}(?:[^{c}\\\n]|\\.)*{c}").match(source, k)
                if not m:
                    raise TemplateError(f"unterminated text at {k}")
                k = m.end()
            else:
                k += 1
        inside = source[begin:k]
        out.append((start, inside[:-1] if inside[-1:] == "-" and inside[-2:-1].isspace() else inside))
        at = k + 2
    return out


def tokens(inside: str) -> list[tuple[str, str, bool]]:
    """(kind, text, whether blank space stands before it) of an action."""
    out, at, spaced = [], 0, True
    while at < len(inside):
        m = _TOKEN.match(inside, at)
        if not m:
            raise TemplateError(f"unexpected {inside[at]!r}")
        if m.lastgroup:
            out.append((m.lastgroup, m[0], spaced))
        spaced, at = not m.lastgroup, m.end()
    return out


class _Pipeline:
    """Recursive descent over the tokens of one pipeline."""

    def __init__(self, parts: list[tuple[str, str, bool]], known: list[str], ranged: bool = False):
        self.parts, self.at, self.known, self.ranged = parts, 0, known, ranged
        self.made: list[str] = []

    def _peek(self, k: int = 0) -> tuple[str, str, bool]:
        return self.parts[self.at + k] if self.at + k < len(self.parts) else ("end", "", True)

    def whole(self) -> list[str]:
        """Parses everything; gives the variables it declares."""
        self._declaration()
        self._commands()
        if self.at < len(self.parts):
            raise TemplateError(f"unexpected {self._peek()[1]!r}")
        return self.made

    def _declaration(self) -> None:
        names, k = [], 0
        while self._peek(k)[0] == "var":
            names.append(self._peek(k)[1])
            k += 1
            if self._peek(k)[1] != ",":
                break
            k += 1
        sign = self._peek(k)[1]
        if not names or sign not in (":=", "="):
            return
        if len(names) > (2 if self.ranged else 1):
            raise TemplateError("too many declarations")
        if sign == "=" and (lost := [n for n in names if n not in self.known]):
            raise TemplateError(f"undefined variable {lost[0]}")
        self.made, self.at = names if sign == ":=" else [], self.at + k + 1

    def _commands(self) -> None:
        self._command()
        while self._peek()[1] == "|" and self._peek()[0] == "op":
            self.at += 1
            self._command()

    def _command(self) -> None:
        n = 0
        while True:
            kind, text, spaced = self._peek()
            if kind == "end" or kind == "op" and text in ("|", ")"):
                break
            if n and not spaced and kind != "op" and self.parts[self.at - 1][0] != "op":
                raise TemplateError(f"no space before {text!r}")
            self._operand()
            n += 1
        if not n:
            raise TemplateError("missing value")

    def _operand(self) -> None:
        kind, text, _ = self._peek()
        self.at += 1
        if kind == "op" and text == "(":
            self._commands()
            if self._peek()[1] != ")":
                raise TemplateError("unclosed parenthesis")
            self.at += 1
        elif kind == "op" and text != ".":
            raise TemplateError(f"unexpected {text!r}")
        elif kind == "var" and text not in self.known:
            raise TemplateError(f"undefined variable {text}")
        chained = kind in ("var", "field") or text == ")" or self.parts[self.at - 1][1] in (")", ".")
        while self._peek()[0] == "field" and not self._peek()[2]:
            if not chained and kind != "word":
                raise TemplateError(f"unexpected {self._peek()[1]!r}")
            self.at += 1


def check(source: str) -> None:
    """Raises ``TemplateError`` where a template does not parse."""
    # A block: its word, whether it had its last else, and the variables before it.
    blocks: list[list] = []
    known = ["$"]
    for _, inside in actions(source):
        parts = tokens(inside)
        if not parts:
            raise TemplateError("empty action")
        kind, word, _ = parts[0]
        rest = parts[1:]
        if kind != "word" or word not in ("if", "with", "range", "else", "end", "define", "block", "template", "break", "continue"):
            known += _Pipeline(parts, known).whole()
        elif word in ("if", "with", "range"):
            blocks.append([word, False, list(known)])
            known += _Pipeline(rest, known, word == "range").whole()
        elif word in ("define", "block"):
            if not rest or rest[0][0] != "text" or (word == "define") != (len(rest) == 1):
                raise TemplateError(f"{word} without its name")
            if word == "define" and blocks:
                raise TemplateError("define within a block")
            if word == "block":
                _Pipeline(rest[1:], known).whole()
            blocks.append([word, True, list(known)])
            known = ["$"]
        elif word == "template":
            if not rest or rest[0][0] != "text":
                raise TemplateError("template without its name")
            if len(rest) > 1:
                _Pipeline(rest[1:], known).whole()
        elif word in ("break", "continue"):
            if rest or not any(b[0] == "range" for b in blocks):
                raise TemplateError(f"{word} outside a range")
        elif word == "else":
            if not blocks or blocks[-1][1]:
                raise TemplateError("unexpected else")
            known = list(blocks[-1][2])
            if not rest:
                blocks[-1][1] = True
            elif rest[0][1] == blocks[-1][0] and rest[0][1] in ("if", "with"):
                known += _Pipeline(rest[1:], known).whole()
            else:
                raise TemplateError("unexpected words after else")
        else:
            if rest or not blocks:
                raise TemplateError("unexpected end")
            known = blocks.pop()[2]
    if blocks:
        raise TemplateError(f"{blocks[-1][0]} without its end")
