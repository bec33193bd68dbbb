"""Go templates: the actions of a template; the text between them is free."""

from __future__ import annotations

import re

from loomgraph.llm.parse.gll import Grammar

GRAMMAR = r"""
file : node* "EOF" ;
node : TEXT | OPEN pipeline CLOSE | IF pipeline CLOSE node* ( ELSEIF pipeline CLOSE node* )* ( ELSE CLOSE node* )? END CLOSE | WITH pipeline CLOSE node* ( ELSEWITH pipeline CLOSE node* )* ( ELSE CLOSE node* )? END CLOSE
  | RANGE pipeline CLOSE node* ( ELSE CLOSE node* )? END CLOSE | DEFINE STR CLOSE node* END CLOSE | BLOCK STR pipeline CLOSE node* END CLOSE | TEMPLATE STR pipeline? CLOSE | BREAK CLOSE | CONTINUE CLOSE ;
pipeline : ( VAR ( "," VAR )? ( ":=" | "=" ) )? operand+ ( "|" stage )* ;
stage : ( IDENT | FIELD | "." | VAR | "(" pipeline ")" FIELD* ) operand* ;
operand : IDENT | FIELD | "." | VAR | NUM | STR | CHAR | "nil" | "(" pipeline ")" ;
"""

G = Grammar(GRAMMAR, {"template": "file"})
DIALECTS = ("template",)
_K = G.kind
_TEXT, _OPEN, _CLOSE, _EOF = map(_K, ("TEXT", "OPEN", "CLOSE", "EOF"))
_CONTROL = {w: _K(w.upper()) for w in ("if", "with", "range", "define", "block", "template", "break", "continue", "else", "end")}
_ELSE_OF = {"if": _K("ELSEIF"), "with": _K("ELSEWITH")}
_KIND = {x: _K(x.upper()) for x in ("ident", "field", "var", "num", "str", "char")}
_FIXED = {x: _K(x) for x in (".", ",", ":=", "=", "|", "(", ")", "nil")}

_COMMENT = re.compile(r"\{\{(?:- ?)?\s*/\*[\s\S]*?\*/\s*(?: -|-)?\}\}")
_HEAD = re.compile(r"\{\{(?:-(?=[ \t\r\n]))?[ \t\r\n]*(?:(?P<word>if|with|range|define|block|template|break|continue|else|end)\b(?![\w.]))?(?:(?<=else)[ \t\r\n]+(?P<more>if|with)\b)?")
_ACTION = re.compile(
    r"(?P<ws>[ \t\r\n]+(?=-\}\})|[ \t\r\n]+)|(?P<close>-?\}\})|(?P<field>\.[^\W\d]\w*)|(?P<var>\$\w*(?:\.[^\W\d]\w*)*)|(?P<num>[+-]?(?:0[xX][0-9a-fA-F_]+|0[bB][01_]+|0[oO][0-7_]+|\d[\d_]*(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+)i?)(?!\w)|(?P<ident>[^\W\d]\w*)"
    r"|(?P<str>\"(?:[^\\\"\n]|\\[^\n])*\"|`[^`]*`)|(?P<char>'(?:[^\\'\n]|\\[^\n])+')|(?P<op>:=|[.,=|()])"
)


def lex(text: str) -> list[int] | None:
    """Token kinds; a control word is one token with the opening braces."""
    out: list[int] = []
    at, n = 0, len(text)
    while at < n:
        k = text.find("{{", at)
        if k != at:
            out.append(_TEXT)
            if k < 0:
                break
            at = k
        m = _COMMENT.match(text, at)
        if m:
            at = m.end()
            continue
        m = _HEAD.match(text, at)
        at = m.end()
        if text.startswith("/*", at):
            return None
        word, more = m["word"], m["more"]
        out.append(_ELSE_OF[more] if more else _CONTROL[word] if word else _OPEN)
        depth = 0
        while True:
            m = _ACTION.match(text, at)
            if m is None:
                return None
            what, blank_before, at = m.lastgroup, at > 0 and text[at - 1] in " \t\r\n", m.end()
            if what == "ws":
                continue
            if what == "close":
                if depth or m[0][0] == "-" and not blank_before:
                    return None
                out.append(_CLOSE)
                break
            if what == "op":
                depth += {"(": 1, ")": -1}.get(m[0], 0)
                if depth < 0:
                    return None
                out.append(_FIXED[m[0]])
            elif m[0] == "nil":
                out.append(_FIXED["nil"])
            else:
                out.append(_KIND[what])
    out.append(_EOF)
    return out


def accepts(text: str) -> set[str]:
    tokens = lex(text)
    return set() if tokens is None else G.recognise(tokens, DIALECTS)
