"""Python 3: lexer and grammar."""

from __future__ import annotations

import re

from loomgraph.llm.parse.gll import Grammar

KEYWORDS = frozenset(
    "False None True and as assert async await break class continue def del elif else except finally for from global if import in is lambda nonlocal not or pass raise return try while with yield".split()
)
SOFT = frozenset(["match", "case", "type"])
_OPS = ("**=", "//=", ">>=", "<<=", "...", "!=", "%=", "&=", "**", "*=", "+=", "-=", "->", "//", "/=", ":=", "<<", "<=", "==", ">=", ">>", "@=", "^=", "|=", *"%&()*+,-./:;<=>@[]^{|}~!")
_AUG = ("+=", "-=", "*=", "/=", "//=", "%=", "@=", "&=", "|=", "^=", ">>=", "<<=", "**=")
_BIN = ("+", "-", "*", "/", "//", "%", "@", "&", "|", "^", ">>", "<<", "**", "<", ">", "<=", ">=", "==", "!=", "in", "is")

GRAMMAR = r"""
file : ( NEWLINE | stmt )* "EOF" ;
stmt : simple_line | compound ;
simple_line : LINE | simple ( ";" simple )* ";"? NEWLINE ;
simple : "pass" | "break" | "continue" | "del" targets | "return" star_list? | "raise" ( expr ( "from" expr )? )? | ( "global" | "nonlocal" ) %name ( "," %name )*
  | "import" dotted ( "as" %name )? ( "," dotted ( "as" %name )? )* | "from" ( ( "." | "..." )* dotted | ( "." | "..." )+ ) "import" ( "*" | "(" from_names ","? ")" | from_names )
  | "assert" expr ( "," expr )? | TYPE %name type_params? "=" expr | expr_stmt ;
dotted : %name ( "." %attr )* ;
from_names : %name ( "as" %name )? ( "," %name ( "as" %name )? )* ;
expr_stmt : yield | star_list | ( targets "=" )+ ( yield | star_list ) | target %aug ( yield | star_list ) | target ":" expr ( "=" ( yield | star_list ) )? ;
yield : "yield" ( star_list | "from" expr )? ;
targets : star_target ( "," star_target )* ","? ;
star_target : "*"? target ;
target : %name ( call* access )* | other ( call* access )+ | "(" ( star_target ( "," star_target )* ","? )? ")" | "[" ( star_target ( "," star_target )* ","? )? "]" ;
primary : atom trailer* ;
star_list : star_expr ( "," star_expr )* ","? ;
star_expr : "*" binary | expr ;
named : WNAME ":=" expr | expr ;
star_named : "*" binary | named ;
expr : lambda | disjunction ( "if" disjunction "else" expr )? ;
lambda : "lambda" params? ":" expr ;
disjunction : negation ( ( "and" | "or" ) negation )* ;
negation : "not" negation | binary ;
binary : unary ( ( %bin | "not" "in" | "is" "not" ) unary )* ;
unary : ( "-" | "+" | "~" )* "await"? primary ;
trailer : access | call ;
access : "." %attr | "[" subscript ( "," subscript )* ","? "]" ;
call : "(" args? ")" ;
subscript : star_named | expr? ":" expr? ( ":" expr? )? ;
args : arg ( "," arg )* ( "," kwarg ( "," ( kwarg | "*" expr ) )* )? ","? | kwarg ( "," ( kwarg | "*" expr ) )* ","? ;
arg : named comp? | "*" expr ;
kwarg : KWNAME "=" expr | "**" expr ;
comp : "async"? "for" targets "in" disjunction ( "if" comp_if )* comp? ;
comp_if : WNAME ":=" disjunction | disjunction | lambda ;
atom : %name | KWNAME | WNAME | other ;
other : NUM | ( STR | fstring )+ | BSTR+ | "..." | "None" | "True" | "False" | paren | list | brace ;
fstring : FSTART ( FTEXT | field )* FEND ;
field : "{" ( yield | star_list ) "="? ( "!" %name )? ( ":" ( FTEXT | field )* )? "}" ;
paren : "(" ( yield | star_named ( comp | ( "," star_named )* ","? ) )? ")" ;
list : "[" ( star_named ( comp | ( "," star_named )* ","? ) )? "]" ;
brace : "{" ( dict_item ( "," dict_item )* ","? | expr ":" expr comp | star_named ( comp | ( "," star_named )* ","? ) )? "}" ;
dict_item : expr ":" expr | "**" binary ;
params : param ( "," param )* ","? ;
param : ( %name | KWNAME ) ( ":" expr )? ( "=" expr )? | "*" ( %name ( ":" star_expr )? )? | "**" %name ( ":" expr )? | "/" ;
type_params : "[" type_param ( "," type_param )* ","? "]" ;
type_param : ( "*" | "**" )? ( %name | KWNAME ) ( ":" expr )? ( "=" star_expr )? ;
block : simple_line | NEWLINE INDENT stmt+ DEDENT ;
compound : "if" named ":" block ( "elif" named ":" block )* ( "else" ":" block )? | "while" named ":" block ( "else" ":" block )? | "async"? for_stmt | try_stmt | "async"? with_stmt | decorated | match_stmt ;
for_stmt : "for" targets "in" star_list ":" block ( "else" ":" block )? ;
try_stmt : "try" ":" block ( ( except )+ ( "else" ":" block )? ( "finally" ":" block )? | "finally" ":" block ) ;
except : "except" "*"? ( expr ( "," expr )* ( "as" %name )? )? ":" block ;
with_stmt : "with" ( with_item ( "," with_item )* | "(" with_item ( "," with_item )* ","? ")" ) ":" block ;
with_item : expr ( "as" star_target )? ;
decorated : ( "@" named NEWLINE )* ( "async"? func | class ) ;
func : "def" %name type_params? "(" params? ")" ( "->" expr )? ":" block ;
class : "class" %name type_params? ( "(" args? ")" )? ":" block ;
match_stmt : MATCH star_list_named ":" NEWLINE INDENT ( case )+ DEDENT ;
star_list_named : star_named ( "," star_named )* ","? ;
case : CASE patterns ( "if" named )? ":" block ;
patterns : pattern ( "," pattern )* ","? ;
pattern : "*" %name | closed ( "|" closed )* ( "as" %name )? ;
closed : "-"? NUM ( ( "+" | "-" ) NUM )? | ( STR | fstring )+ | BSTR+ | "None" | "True" | "False" | dotted ( "(" ( pat_arg ( "," pat_arg )* ","? )? ")" )? | "(" ( patterns )? ")" | "[" ( patterns )? "]" | "{" ( pat_item ( "," pat_item )* ","? )? "}" ;
pat_arg : KWNAME "=" pattern | pattern ;
pat_item : "**" %name | ( "-"? NUM | ( STR | fstring )+ | BSTR+ | dotted | "None" | "True" | "False" ) ":" pattern ;
"""

G = Grammar(GRAMMAR + 'one_line : simple_line "EOF" ;', {"python3": "file", "line": "one_line"}, {"name": {"NAME", "MATCH", "CASE", "TYPE"}, "attr": {"NAME", "MATCH", "CASE", "TYPE", "KWNAME", "WNAME"}, "aug": set(_AUG), "bin": set(_BIN)})
DIALECTS = ("python3",)

_K = G.kind
_FIXED = {x: _K(x) for x in (*_OPS, *KEYWORDS)}
_NAME, _NUM, _STR, _BSTR, _KW, _W = map(_K, ("NAME", "NUM", "STR", "BSTR", "KWNAME", "WNAME"))
_NEWLINE, _INDENT, _DEDENT, _EOF = map(_K, ("NEWLINE", "INDENT", "DEDENT", "EOF"))
_FSTART, _FTEXT, _FEND = map(_K, ("FSTART", "FTEXT", "FEND"))
_SOFT = {"match": _K("MATCH"), "case": _K("CASE"), "type": _K("TYPE")}

# A line end takes blank lines, comment lines and the next line's indentation with it.
_TOKEN = re.compile(
    r"[ \t\f]*(?:(?P<name>(?![rRbBuUfFtT]{1,2}[\"'])[^\W\d]\w*)(?P<eq>(?=\s*=(?!=)))?"
    r"|(?P<op>:=|[(),:\[\]{};~]|\.(?:\.\.)?(?!\d)|==?|\*\*?=?|//?=?|>>=|<<=|!=|%=?|&=?|\+=?|->|-=?|:=|<<|<=|>=|>>|@=?|\^=?|\|=?|[<>!])"
    r"|(?P<nl>(?:\r?\n|\r)(?:[ \t\f]*(?:#[^\r\n]*)?(?:\r?\n|\r))*(?P<in>[ \t\f]*)(?:#[^\r\n]*(?![\s\S]))?)"
    r"|(?P<f>[fF][rR]?|[rR][fF]|[tT][rR]?|[rR][tT])(?P<fq>\"\"\"|'''|\"|')"
    r"|(?P<b>[bB][rR]?|[rR][bB])?(?P<p>[rRuU])?(?P<s>\"\"\"(?:[^\\\"]|\\[\s\S]|\"(?!\"\"))*\"\"\"|'''(?:[^\\']|\\[\s\S]|'(?!''))*'''|\"(?:[^\\\"\r\n]|\\\r\n|\\[\s\S])*\"|'(?:[^\\'\r\n]|\\\r\n|\\[\s\S])*')"
    r"|(?P<num>(?:0[xX](?:_?[0-9a-fA-F])+|0[oO](?:_?[0-7])+|0[bB](?:_?[01])+|(?:(?:[1-9](?:_?\d)*|0(?:_?0)*)(?![\d.eEjJ_])|(?:\d(?:_?\d)*)?\.\d(?:_?\d)*(?:[eE][+-]?\d(?:_?\d)*)?[jJ]?|\d(?:_?\d)*\.?(?:[eE][+-]?\d(?:_?\d)*)[jJ]?|\d(?:_?\d)*\.[jJ]?|\d(?:_?\d)*[jJ])))"
    r"|(?P<ws>\\\r?\n|#[^\r\n]*|[ \t\f]+(?![\s\S])))"
)
_WALRUS = re.compile(r"\s*:=")
_FIRST = re.compile(r"(?:[ \t\f]*(?:#[^\r\n]*)?(?:\r?\n|\r))*([ \t\f]*)(?:#[^\r\n]*(?![\s\S]))?")
_AFTER_NUM = re.compile(r"[^\W\d]\w*")
_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, {")": "(", "]": "[", "}": "{"}
_FSTOP = {q: re.compile(r"(?:[^{}\\" + q[0] + ("" if len(q) == 3 else r"\r\n") + r"]|\\(?!N\{)(?:\r\n|[^{}]|(?=[{}]))|\\N\{[^{}\r\n]*\}|\{\{|\}\}" + (rf"|{q[0]}(?!{q[0] * 2})" if len(q) == 3 else "") + ")+") for q in ('"', "'", '"""', "'''")}
_SPEC = {q: re.compile(r"(?:[^{}\\" + q[0] + ("" if len(q) == 3 else r"\r\n") + r"]|\\[^{}]" + (rf"|{q[0]}(?!{q[0] * 2})" if len(q) == 3 else "") + ")+") for q in ('"', "'", '"""', "'''")}


def _indent(blanks: str, indents: list[int], alt: list[int], out: list[int]) -> bool:
    """Indents and dedents of a line; False where tabs and blanks do not agree."""
    if "\t" in blanks or "\f" in blanks:
        col = other = 0
        for c in blanks:
            if c == "\t":
                col, other = (col // 8 + 1) * 8, other + 1
            elif c == "\f":
                col = other = 0
            else:
                col, other = col + 1, other + 1
    else:
        col = other = len(blanks)
    if col > indents[-1]:
        if other <= alt[-1]:
            return False
        indents.append(col)
        alt.append(other)
        out.append(_INDENT)
        return True
    while col < indents[-1]:
        indents.pop()
        alt.pop()
        out.append(_DEDENT)
    return col == indents[-1] and other == alt[-1]


def lex(text: str) -> list[int] | None:
    """Token kinds, or None where the characters form no tokens."""
    if text[:1] == chr(0xFEFF):
        text = text[1:]
    if "\0" in text:
        return None
    out: list[int] = []
    indents, alt = [0], [0]
    stack: list = []  # open brackets, and f-strings as (quote, in a format)
    n = len(text)
    m = _FIRST.match(text)
    at = m.end()
    if at < n and not text.startswith(("\\\n", "\\\r"), at) and not _indent(m[1], indents, alt, out):
        return None
    fresh = True  # nothing on this line yet
    while at < n:
        if stack and isinstance(stack[-1], tuple):  # inside the text of an f-string
            quote, spec = stack[-1]
            m = (_SPEC if spec else _FSTOP)[quote].match(text, at)
            if m:
                out.append(_FTEXT)
                at = m.end()
            if text.startswith("{", at):
                out.append(_FIXED["{"])
                stack.append("{f")
                at += 1
            elif spec and text.startswith("}", at):
                stack.pop()
                stack.pop()
                out.append(_FIXED["}"])
                at += 1
            elif not spec and text.startswith(quote, at):
                stack.pop()
                out.append(_FEND)
                at += len(quote)
            else:
                return None
            continue
        for m in _TOKEN.finditer(text, at):
            if m.start() != at:
                return None
            what, at = m.lastgroup, m.end()
            if what == "name" or what == "eq":
                word = m["name"]
                k = _FIXED.get(word)
                if k is None:
                    if not word.isascii() and not word.isidentifier():
                        return None
                    k = _NAME
                    if what == "eq":
                        if stack and stack[-1] == "(":
                            k = _KW
                    elif text.startswith((":", " :"), at) and _WALRUS.match(text, at) and not (stack and stack[-1] == "{f"):
                        k = _W
                    if word in _SOFT and k == _NAME and not stack and (fresh or out[-1] == _FIXED[";"]):
                        k = _SOFT[word]
                out.append(k)
                fresh = False
            elif what == "op":
                op = m["op"]
                fresh = False
                if op in _OPEN:
                    stack.append(op)
                elif op in _CLOSE:
                    if not stack or stack.pop()[0] != _CLOSE[op]:
                        return None
                    out.append(_FIXED[op])
                    if stack and isinstance(stack[-1], tuple):
                        break
                    continue
                elif stack and stack[-1] == "{f":
                    if op[0] == ":":
                        stack.append((next(x[0] for x in reversed(stack) if isinstance(x, tuple)), True))
                        at = m.start("op") + 1
                        out.append(_FIXED[":"])
                        break
                elif op == "!":
                    return None
                out.append(_FIXED[op])
            elif what == "in" or what == "nl":
                if not stack:
                    if not fresh:
                        out.append(_NEWLINE)
                        fresh = True
                    if at < n and not text.startswith(("\\\n", "\\\r"), at) and not _indent(m["in"], indents, alt, out):
                        return None
            elif what == "s":
                if m["b"] and not m["s"].isascii():
                    return None
                out.append(_BSTR if m["b"] else _STR)
                fresh = False
            elif what == "num":
                follow = _AFTER_NUM.match(text, at)
                if follow and follow[0] not in KEYWORDS:
                    return None
                out.append(_NUM)
                fresh = False
            elif what == "fq":
                out.append(_FSTART)
                stack.append((m["fq"], False))
                fresh = False
                break
            elif m["ws"][0] == "\\" and at >= n:
                return None
        else:
            if at < n:
                return None
    if stack:
        return None
    if not fresh:
        out.append(_NEWLINE)
    out += [_DEDENT] * (len(indents) - 1)
    out.append(_EOF)
    return out


_LINE = _K("LINE")
_KNOWN: dict[tuple, bool] = {}


def fold(tokens: list[int]) -> list[int]:
    """Each line that is a simple statement by itself as one token.

    A line's kinds recur from line to line and from file to file, so what they derive is remembered;
    only headers of compound statements are recognised anew in every file.
    """
    out: list[int] = []
    start = 0
    try:
        while True:
            end = tokens.index(_NEWLINE, start) + 1
            while tokens[start] == _INDENT or tokens[start] == _DEDENT:
                out.append(tokens[start])
                start += 1
            line = tuple(tokens[start:end])
            simple = _KNOWN.get(line)
            if simple is None:
                if len(_KNOWN) > 200_000:
                    _KNOWN.clear()
                simple = _KNOWN[line] = len(line) < 400 and bool(G.recognise([*line, _EOF], ("line",)))
            if simple:
                out.append(_LINE)
            else:
                out += line
            start = end
    except ValueError:
        return out + tokens[start:]


def accepts(text: str) -> set[str]:
    tokens = lex(text)
    return set() if tokens is None else G.recognise(fold(tokens), DIALECTS)
