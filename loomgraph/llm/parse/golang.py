"""Go: lexer with automatic semicolons, and grammar."""

from __future__ import annotations

import re

from loomgraph.llm.parse.gll import Grammar

KEYWORDS = frozenset("break case chan const continue default defer else fallthrough for func go goto if import interface map package range return select struct switch type var".split())
_PUNCT = ("<<=", ">>=", "&^=", "...", "&&", "||", "<-", "++", "--", "==", "!=", "<=", ">=", ":=", "+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "<<", ">>", "&^", *"+-*/%&|^<>=!()[]{},;.:~")
_ASSIGN = ("=", "+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "<<=", ">>=", "&^=")
_BINARY = ("||", "&&", "==", "!=", "<", "<=", ">", ">=", "+", "-", "|", "^", "*", "/", "%", "<<", ">>", "&", "&^")

_BASE = r"""
file : "package" NAME ";" ( import ";" )* ( topdecl ";" )* ( topdecl )? "EOF" ;
import : "import" ( import_spec | "(" ( import_spec ";" )* import_spec? ")" ) ;
import_spec : ( NAME | "." )? STR ;
topdecl : func_decl | decl ;
decl : "const" ( const_spec | "(" ( const_spec ";" )* const_spec? ")" ) | "var" ( var_spec | "(" ( var_spec ";" )* var_spec? ")" ) | "type" ( type_spec | "(" ( type_spec ";" )* type_spec? ")" ) ;
const_spec : names ( type? "=" exprs )? ;
var_spec : names ( type ( "=" exprs )? | "=" exprs ) ;
type_spec : NAME type_params? "="? type ;
names : NAME ( "," NAME )* ;
type_params : "[" type_param ( "," type_param )* ","? "]" ;
type_param : names constraint ;
constraint : "~"? type ( "|" "~"? type )* ;
func_decl : "func" params? NAME type_params? signature block? ;
signature : params ( params | type )? ;
params : "(" ( param ( "," param )* ","? )? ")" ;
param : NAME "..." type | NAME type | "..."? type ;
type : type_name | "*" type | "(" type ")" | "[" ( expr | "..." )? "]" type | "map" "[" type "]" type | "chan" "<-"? type | "<-" "chan" type | "func" signature | struct | interface ;
type_name : NAME ( "." NAME )? type_args? ;
type_args : "[" type ( "," type )* ","? "]" ;
struct : "struct" "{" ( field ";" )* field? "}" ;
field : ( names type | "*"? type_name ) STR? ;
interface : "interface" "{" ( element ";" )* element? "}" ;
element : NAME signature | constraint ;
block : "{" stmts? "}" ;
stmts : stmt | stmt? ( ";" stmt? )+ ;
stmt : decl | simple | block | LABEL ":" stmt? | "go" expr | "defer" expr | "return" exprs? | "break" NAME? | "continue" NAME? | "goto" NAME | "fallthrough" | if | for | switch | select ;
simple : exprs ( ( %assign | ":=" ) exprs | "++" | "--" | "<-" expr )? ;
hsimple : hexprs ( ( %assign | ":=" ) hexprs | "++" | "--" | "<-" hexpr )? ;
if : "if" ( hsimple? ";" )? hexpr block ( "else" ( if | block ) )? ;
for : "for" ( block | hexpr block | hsimple? ";" hexpr? ";" hsimple? block | ( hexprs ( "=" | ":=" ) )? "range" hexpr block ) ;
switch : "switch" ( hsimple? ";" )? ( hsimple )? "{" clause* "}" ;
clause : ( "case" case_exprs | "default" ) ":" stmts? ;
case_exprs : exprs ;
select : "select" "{" ( ( "case" simple | "default" ) ":" stmts? )* "}" ;
exprs : expr ( "," expr )* ;
hexprs : hexpr ( "," hexpr )* ;
args : "(" ( arg ( "," arg )* "..."? ","? )? ")" ;
arg : expr ;
index : "[" ( expr ( "," expr )* ","? | expr? ":" expr? ( ":" expr )? ) "]" ;
func_lit : "func" signature block? ;
literal : "{" ( element_value ( "," element_value )* ","? )? "}" ;
element_value : value ( ":" value )? ;
value : expr | literal ;
array_type : "[" ( expr | "..." )? "]" type ;
map_type : "map" "[" type "]" type ;
"""

_EXPR = r"""
{e} : {e}_unary ( %binary {e}_unary )* ;
{e}_unary : ( "+" | "-" | "!" | "^" | "*" | "&" | "<-" )* {e}_primary ;
{e}_primary : {e}_operand {suffix} ;
{e}_operand : NAME | LABEL | NUM | STR | CHAR | "(" expr_or_type ")" | func_lit | array_type literal? | map_type literal? | struct literal? | interface | "chan" "<-"? type ;
"""

def _grammar() -> str:
    # Composite literals of a named type may not stand open in the header of a statement.
    suffix = '( "." ( NAME | "(" ( type | "type" ) ")" ) | index | args{})*'
    normal = _EXPR.replace("{e}", "expr").replace("{suffix}", suffix.format(" | literal "))
    header = _EXPR.replace("{e}", "hexpr").replace("{suffix}", suffix.format(""))
    return _BASE + normal + header + "expr_or_type : expr ;\n"


G = Grammar(_grammar(), {"go": "file"}, {"assign": set(_ASSIGN), "binary": set(_BINARY)})
DIALECTS = ("go",)

_K = G.kind
_FIXED = {x: _K(x) for x in (*_PUNCT, *KEYWORDS)}
_NAME, _NUM, _STR, _CHAR, _EOF = map(_K, ("NAME", "NUM", "STR", "CHAR", "EOF"))
_SEMI = _FIXED[";"]
#: A name before ``:`` where a statement or an element may begin.
_LABEL = _K("LABEL")
_BEFORE_COLON = re.compile(r"[ \t]*:(?!=)")
_MAY_BEGIN = frozenset(_FIXED[x] for x in (";", "{", "}", ":"))
_ENDS = frozenset([_NAME, _NUM, _STR, _CHAR, *(_FIXED[x] for x in ("break", "continue", "fallthrough", "return", "++", "--", ")", "]", "}"))])

_ESC = r"\\(?:[abfnrtv\\'\"]|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{3})"
_TOKEN = re.compile(
    r"[ \t\r]*(?:(?P<name>[^\W\d]\w*)|(?P<op>[()\[\]{},;~]|:=?|\.(?:\.\.)?(?!\d)|<<=?|>>=?|&\^=?|&&|\|\||<-|\+\+|--|[=!<>+*%&|^]=?|-=?|/(?![/*])=?)|(?P<nl>\n\s*)"
    r"|(?P<str>`[^`]*`|\"(?:[^\\\"\n]|" + _ESC + r")*\")"
    r"|(?P<num>(?:0[xX](?:_?[0-9a-fA-F])*(?:\.(?:[0-9a-fA-F](?:_?[0-9a-fA-F])*)?)?(?:[pP][+-]?\d+)?|0[bB](?:_?[01])+|0[oO](?:_?[0-7])+|(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?)i?)(?!\w)"
    r"|(?P<ws>//[^\n]*|[ \t\r]+(?![\s\S]))|(?P<com>/\*[\s\S]*?\*/)|(?P<char>'(?:[^\\'\n]|" + _ESC + r")'))"
)


def lex(text: str) -> list[int] | None:
    """Token kinds with the semicolons that line ends stand for; None where there are no tokens."""
    if text.startswith("\ufeff"):
        text = text[1:]
    if "\0" in text:
        return None
    out: list[int] = []
    last = -1
    at, n = 0, len(text)
    for m in _TOKEN.finditer(text):
        if m.start() != at:
            return None
        what, at = m.lastgroup, m.end()
        if what == "name":
            kind = _FIXED.get(m["name"], _NAME)
            last = _LABEL if kind == _NAME and last in _MAY_BEGIN and _BEFORE_COLON.match(text, at) else kind
        elif what == "op":
            last = _FIXED[m["op"]]
        elif what == "nl":
            if last not in _ENDS:
                continue
            last = _SEMI
        elif what == "str":
            last = _STR
        elif what == "num":
            last = _NUM
        elif what == "ws":
            continue
        elif what == "com":
            if "\n" not in m["com"] or last not in _ENDS:
                continue
            last = _SEMI
        else:
            last = _CHAR
        out.append(last)
    if at < n:
        return None
    if last in _ENDS:
        out.append(_SEMI)
    out.append(_EOF)
    return out


def accepts(text: str) -> set[str]:
    tokens = lex(text)
    return set() if tokens is None else G.recognise(tokens, DIALECTS)
