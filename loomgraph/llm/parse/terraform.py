"""Terraform configuration (HCL native syntax): lexer with string templates and heredocs, and grammar."""

from __future__ import annotations

import re

from loomgraph.llm.parse.gll import Grammar

_WORDS = ("for", "in", "if", "else", "endif", "endfor", "true", "false", "null")
_PUNCT = ("...", "==", "!=", "<=", ">=", "&&", "||", "=>", "::", *"+-*/%!<>=?:()[]{},.")
_BINARY = ("==", "!=", "<=", ">=", "<", ">", "&&", "||", "+", "-", "*", "/", "%")

GRAMMAR = r"""
file : NL* ( item ( NL+ item )* NL* )? "EOF" ;
item : %name ( "=" expr | ( STR | %name )* "{" ( NL+ ( item ( NL+ item )* NL* )? | %name "=" expr )? "}" ) ;
expr : binary ( "?" expr ":" expr )? ;
binary : unary ( %binary unary )* ;
unary : ( "-" | "!" )* term ;
term : primary ( "." ( %name | NUM | "*" ) | "[" ( expr | "*" ) "]" )* ;
primary : NUM | STR | template | %name | %name ( "::" %name )* "(" ( expr ( "," expr )* ( "," | "..." )? )? ")" | "(" expr ")" | tuple | object ;
tuple : "[" ( for_head expr ( "if" expr )? | expr ( "," expr )* ","? )? "]" ;
object : "{" NL* ( for_head NL* expr NL* "=>" NL* expr "..."? NL* ( "if" expr )? NL* | pair ( ( NL+ | "," NL* ) pair )* ","? NL* )? "}" ;
pair : expr ( "=" | ":" ) expr ;
for_head : "for" %name ( "," %name )? "in" expr ":" ;
template : TSTART ( TEXT | "${" expr "}" | directive )* TEND ;
directive : "%{" ( "if" expr | "else" | "endif" | "for" %name ( "," %name )? "in" expr | "endfor" ) "}" ;
"""

G = Grammar(GRAMMAR, {"hcl": "file"}, {"name": {"NAME", *_WORDS}, "binary": set(_BINARY)})
DIALECTS = ("hcl",)
_K = G.kind
_FIXED = {x: _K(x) for x in (*_PUNCT, *_WORDS, "${", "%{")}
_NAME, _NUM, _STR, _NL, _EOF, _TSTART, _TEXT, _TEND = map(_K, ("NAME", "NUM", "STR", "NL", "EOF", "TSTART", "TEXT", "TEND"))

_TOKEN = re.compile(
    r"(?P<ws>[ \t]+|/\*[\s\S]*?\*/)|(?P<nl>\r?\n|(?:#|//)[^\n]*(?:\n|$))|(?P<name>[^\W\d][\w-]*)|(?P<num>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)"
    r"|(?P<heredoc><<(?P<strip>-?)(?P<mark>[^\W\d][\w-]*)\r?\n)|(?P<quote>\")"
    r"|(?P<op>\.\.\.|==|!=|<=|>=|&&|\|\||=>|::|[+\-*/%!<>=?:()\[\]{},.])"
)
_QUOTED = re.compile(r"(?:[^\\\"$%\r\n]|\\(?:[nrt\"\\]|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8})|\$\$\{|%%\{|\$(?!\{)|%(?!\{))+")
_HERE = re.compile(r"(?:[^$%\n]|\$\$\{|%%\{|\$(?!\{)|%(?!\{))+")


def lex(text: str) -> list[int] | None:
    """Token kinds; line ends count outside of round and square brackets."""
    if text.startswith("\ufeff"):
        text = text[1:]
    out: list[int] = []
    stack: list = []  # brackets, "${" in templates, '"' and heredoc marks
    at, n = 0, len(text)
    while True:
        top = stack[-1] if stack else ""
        if top == '"':
            m = _QUOTED.match(text, at)
            if m:
                out.append(_TEXT)
                at = m.end()
            if text.startswith('"', at):
                stack.pop()
                at += 1
                # a string without templates is one token
                k = len(out) - 1
                if out[k] == _TSTART or out[k] == _TEXT and out[k - 1] == _TSTART:
                    del out[k if out[k] == _TSTART else k - 1 :]
                    out.append(_STR)
                else:
                    out.append(_TEND)
                continue
            if text.startswith(("${", "%{"), at):
                stack.append(text[at : at + 2])
                out.append(_FIXED[text[at : at + 2]])
                at += 2
                if text.startswith("~", at):
                    at += 1
                continue
            return None
        if isinstance(top, tuple):  # a heredoc: its mark stands alone on the last line
            mark = top[0]
            while True:
                if at == 0 or text[at - 1] == "\n":
                    e = text.find("\n", at)
                    line = text[at : e if e >= 0 else n]
                    if line.strip() == mark:
                        at += len(line.rstrip("\r"))
                        stack.pop()
                        out.append(_TEND)
                        break
                if at >= n:
                    return None
                m = _HERE.match(text, at)
                if m:
                    at = m.end()
                    if out[-1] != _TEXT:
                        out.append(_TEXT)
                if text.startswith("\n", at):
                    at += 1
                elif text.startswith(("${", "%{"), at):
                    stack.append(text[at : at + 2])
                    out.append(_FIXED[text[at : at + 2]])
                    at += 2
                    if text.startswith("~", at):
                        at += 1
                    break
                elif not m:
                    return None
            continue
        if at >= n:
            break
        if top and top in "${%{" and text.startswith("~}", at):
            at += 1
        m = _TOKEN.match(text, at)
        if m is None:
            return None
        what, at = m.lastgroup, m.end()
        if what == "ws":
            continue
        if what == "nl":
            if not top or top == "{":
                out.append(_NL)
        elif what == "name":
            out.append(_FIXED.get(m[0], _NAME))
        elif what == "num":
            out.append(_NUM)
        elif what == "quote":
            out.append(_TSTART)
            stack.append('"')
        elif what == "mark" or what == "heredoc":
            out.append(_TSTART)
            stack.append((m["mark"],))
        else:
            op = m[0]
            if op in "([{":
                stack.append(op)
            elif op in ")]}":
                if not stack:
                    return None
                opened = stack.pop()
                if opened != {")": "(", "]": "[", "}": "{"}[op] and not (op == "}" and opened in ("${", "%{")):
                    return None
            out.append(_FIXED[op])
    if stack:
        return None
    out.append(_EOF)
    return out


def accepts(text: str) -> set[str]:
    tokens = lex(text)
    return set() if tokens is None else G.recognise(tokens, DIALECTS)
