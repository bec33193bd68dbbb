"""JavaScript, as a module and as a script: lexer and grammar."""

from __future__ import annotations

import re

from loomgraph.llm.parse.gll import Grammar

RESERVED = frozenset(
    "break case catch class const continue debugger default delete do else export extends false finally for function if import in instanceof new null return super switch this throw true try typeof var void while with enum".split()
)
#: Words that are names except in their own places.
SOFT = frozenset("as async await from get let of set static yield meta target".split())
_PUNCT = (
    ">>>=", "...", "===", "!==", "**=", "<<=", ">>=", ">>>", "&&=", "||=", "??=", "=>", "==", "!=", "<=", ">=", "&&", "||", "??", "?.", "++", "--", "+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "<<", ">>", "**",
    *"{}()[];,<>+-*/%&|^!~?:=.",
)
_ASSIGN = ("=", "+=", "-=", "*=", "/=", "%=", "**=", "<<=", ">>=", ">>>=", "&=", "|=", "^=", "&&=", "||=", "??=")
_BINARY = ("+", "-", "*", "/", "%", "**", "<<", ">>", ">>>", "&", "|", "^", "&&", "||", "??", "==", "!=", "===", "!==", "<", ">", "<=", ">=", "in", "instanceof")

GRAMMAR = r"""
module : item* "EOF" ;
script : stmt* "EOF" ;
item : import_decl | export_decl | stmt ;
semi : ";" | ASI ;
import_decl : "import" ( STR | clause "from" STR ) ( ( "with" | %name ) object )? semi ;
clause : %name ( "," ( star_as | named_imports ) )? | star_as | named_imports ;
star_as : "*" "as" %name ;
named_imports : "{" ( import_spec ( "," import_spec )* ","? )? "}" ;
import_spec : ( %word | STR ) ( "as" %name )? ;
export_decl : "export" ( "*" ( "as" ( %word | STR ) )? "from" STR semi | "{" ( export_spec ( "," export_spec )* ","? )? "}" ( "from" STR )? semi | "default" ( func | class | "async" func | !not_decl assign semi ) | declaration ) ;
export_spec : ( %word | STR ) ( "as" ( %word | STR ) )? ;
declaration : ( "var" | "const" | "let" ) bindings semi | func | "async" func | class ;
bindings : binding ( "," binding )* ;
binding : pattern ( "=" assign )? ;
pattern : %name | array | object ;
block : "{" stmt* "}" ;
stmt : block | declaration | ";" | "if" "(" expr ")" stmt ( "else" stmt )? | "for" for_rest | "while" "(" expr ")" stmt | "do" stmt "while" "(" expr ")" ";"?
  | "continue" %name? semi | "break" %name? semi | "return" expr? semi | "throw" expr semi | "with" "(" expr ")" stmt | "switch" "(" expr ")" "{" ( ( "case" expr | "default" ) ":" stmt* )* "}"
  | "try" block ( "catch" ( "(" pattern ")" )? block ( "finally" block )? | "finally" block ) | "debugger" semi | LABEL ":" stmt | %soft ":" stmt | !not_expr expr semi ;
for_rest : "await"? "(" for_head ")" stmt ;
for_head : ( "var" | "const" | "let" ) ( bindings ";" expr? ";" expr? | pattern ( "of" assign | "in" expr ) ) | !not_let expr ";" expr? ";" expr? | ";" expr? ";" expr? | !not_let left ( "of" assign | "in" expr ) ;
expr : assign ( "," assign )* ;
cover : cover_item ( "," cover_item )* ","? ;
cover_item : "..."? assign ;
assign : ARROW "=>" arrow_body | %soft "=>" arrow_body | "(" cover? ")" "=>" arrow_body | "async" ( ARROW | %soft ) "=>" arrow_body | "async" "(" cover? ")" "=>" arrow_body | "yield" ( "*"? assign )? | left ( %assign assign | "++" tail? | "--" tail? | tail )? | PRIVATE "in" unary tail? | prefixed tail? ;
tail : ( %binary unary )+ ( "?" assign ":" assign )? | "?" assign ":" assign ;
arrow_body : func_body | !brace assign ;
unary : left ( "++" | "--" )? | prefixed ;
prefixed : ( %prefix | "await" ) unary ;
left : "new" new_rest ( suffix )* | ( primary | "super" super_suffix | "import" import_suffix ) suffix* ;
super_suffix : args | "." ( %word | PRIVATE ) | "[" expr "]" ;
import_suffix : "(" assign ( "," assign )? ","? ")" | "." "meta" ;
new_rest : "new" new_rest | "." "target" | primary member_suffix* args? | "super" super_suffix member_suffix* args? | "import" "." "meta" member_suffix* args? ;
member_suffix : "." ( %word | PRIVATE ) | "[" expr "]" | template ;
suffix : "." ( %word | PRIVATE ) | "?." ( %word | PRIVATE | args | "[" expr "]" ) | "[" expr "]" | args | template ;
args : "(" ( "..."? assign ( "," "..."? assign )* ","? )? ")" ;
primary : %name | NUM | STR | REGEX | template | "this" | "null" | "true" | "false" | "(" expr ")" | array | object | func | "async" func | class ;
template : TPL | TPLHEAD expr ( TPLMID expr )* TPLTAIL ;
array : "[" ( "," | "..."? assign "," )* ( "..."? assign )? "]" ;
object : "{" ( property ( "," property )* ","? )? "}" ;
property : "..." assign | LABEL ":" assign | %name ( "=" assign )? | prop_name ":" assign | "async"? "*"? prop_name method | ( "get" | "set" ) prop_name method ;
prop_name : %plain_word | STR | NUM | "[" assign "]" | PRIVATE ;
method : params func_body ;
params : "(" ( param ( "," param )* ","? )? ")" ;
param : "..."? pattern ( "=" assign )? ;
func_body : "{" stmt* "}" ;
func : "function" "*"? %name? params func_body ;
class : "class" %name? ( "extends" left )? "{" ( member | ";" )* "}" ;
member : "static"? ( "async"? "*"? prop_name method | ( "get" | "set" ) prop_name method | prop_name ( "=" assign )? semi ) | "static" block ;
"""

_SETS = {
    "name": {"NAME", *SOFT},
    "soft": set(SOFT),
    "word": {"NAME", "LABEL", *SOFT, *RESERVED},
    "plain_word": {"NAME", *SOFT, *RESERVED},
    "assign": set(_ASSIGN),
    "binary": set(_BINARY),
    "prefix": {"+", "-", "!", "~", "typeof", "void", "delete", "++", "--"},
    "not_expr": {"{", "function", "class"},
    "not_decl": {"function", "class"},
    "not_let": {"let"},
    "brace": {"{"},
}
G = Grammar(GRAMMAR, {"module": "module", "script": "script"}, _SETS)
DIALECTS = ("module", "script")

_K = G.kind
_FIXED = {x: _K(x) for x in (*_PUNCT, *RESERVED, *SOFT)}
_NAME, _NUM, _STR, _REGEX, _PRIVATE, _ASI, _EOF = map(_K, ("NAME", "NUM", "STR", "REGEX", "PRIVATE", "ASI", "EOF"))
#: A name before ``=>``, and one before ``:`` where a statement or a property may begin.
_ARROW, _LABEL = map(_K, ("ARROW", "LABEL"))
_BEFORE_ARROW, _BEFORE_COLON = re.compile(r"[ \t]*=>"), re.compile(r"[ \t]*:")
_MAY_BEGIN = frozenset([-1, *(_FIXED[x] for x in (";", "{", "}", ")", ":", "else", "do"))])
_TPL, _HEAD, _MID, _TAIL = map(_K, ("TPL", "TPLHEAD", "TPLMID", "TPLTAIL"))

_TOKEN = re.compile(
    r"[ \t\v\f\xa0﻿]*(?:(?P<name>(?:[A-Za-z_$\u0080-\U0010ffff]|\\u[0-9a-fA-F]{4}|\\u\{[0-9a-fA-F]+\})(?:[\w$‌‍\u0080-\U0010ffff]|\\u[0-9a-fA-F]{4}|\\u\{[0-9a-fA-F]+\})*)"
    r"|(?P<op>[()\[\]{},;~:]|\.(?:\.\.)?(?!\d)|===?|=>?|!==?|!|\?\?=?|\?\.(?!\d)|\?|\*\*?=?|<<?=?|>{1,3}=?|&&?=?|\|\|?=?|\+\+|--|[+\-%^]=?|/(?![/*])=?)"
    r"|(?P<nl>[\n\r  ]+)"
    r"|(?P<str>\"(?:[^\\\"\n\r]|\\(?:\r\n|[^xu]|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|u\{[0-9a-fA-F]+\}))*\"|'(?:[^\\'\n\r]|\\(?:\r\n|[^xu]|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|u\{[0-9a-fA-F]+\}))*')"
    r"|(?P<num>(?:0[xX](?:_?[0-9a-fA-F])+n?|0[oO](?:_?[0-7])+n?|0[bB](?:_?[01])+n?|(?:\d(?:_?\d)*)n|(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?))"
    r"|(?P<tpl>`)"
    r"|(?P<priv>#[A-Za-z_$\u0080-\U0010ffff][\w$\u0080-\U0010ffff]*)"
    r"|(?P<com>/\*[\s\S]*?\*/)|(?P<ws>[ \t\v\f\xa0﻿]+(?![\s\S])|//[^\n\r  ]*))"
)
_REGEX_BODY = re.compile(r"/(?![*/])(?:[^\\/\[\n\r  ]|\\[^\n\r]|\[(?:[^\]\\\n\r]|\\[^\n\r])*\])+/[A-Za-z]*")
_TPL_TEXT = re.compile(r"(?:[^\\`$]|\\[\s\S]|\$(?!\{))*")
_ID_NEXT = re.compile(r"[A-Za-z0-9_$\\]")
#: After these a slash divides; after anything else it begins a regular expression.
_VALUE_END = frozenset([_NAME, _ARROW, _LABEL, _NUM, _STR, _REGEX, _PRIVATE, _TPL, _TAIL, _FIXED[")"], _FIXED["]"], _FIXED["}"], _FIXED["this"], _FIXED["super"], _FIXED["null"], _FIXED["true"], _FIXED["false"], _FIXED["++"], _FIXED["--"], *(_FIXED[x] for x in SOFT)])
_RESTRICTED = frozenset(_FIXED[x] for x in ("return", "break", "continue"))
_HEADS = frozenset(_FIXED[x] for x in ("if", "while", "for", "with"))


def lex(text: str) -> tuple[list[int], bytearray] | None:
    """Token kinds, and for each whether a semicolon may be inserted before it; None where there are no tokens."""
    out: list[int] = []
    may = bytearray()
    stack: list[tuple[int, bool]] = []  # open brackets: kind, and for "(" whether it follows if, while, for or with
    last, newline, closed_head, block_end = -1, False, False, True
    at, n = 0, len(text)
    if text.startswith("#!"):
        at = text.find("\n")
        at = n if at < 0 else at
    match = _TOKEN.match
    while at < n:
        m = match(text, at)
        if m is None:
            return None
        what, end = m.lastgroup, m.end()
        if what == "ws":
            at = end
            continue
        if what == "nl":
            newline, at = True, end
            continue
        if what == "com":
            newline, at = newline or "\n" in m["com"] or "\r" in m["com"], end
            continue
        kind = -1
        if what == "name":
            word = m["name"]
            kind = _FIXED.get(word, _NAME)
            if kind == _NAME:
                if text.startswith((" =>", "=>"), end) and _BEFORE_ARROW.match(text, end):
                    kind = _ARROW
                elif last in _MAY_BEGIN and _BEFORE_COLON.match(text, end):
                    kind = _LABEL
            if not word.isascii() and not word.replace("$", "_").replace("‌", "").replace("‍", "").isidentifier():
                return None
        elif what == "op":
            op = m["op"]
            if op[0] == "/" and (last not in _VALUE_END or last == _FIXED[")"] and closed_head or last == _FIXED["}"] and block_end):
                r = _REGEX_BODY.match(text, m.start("op"))
                if not r:
                    return None
                kind, end = _REGEX, r.end()
            elif op == "{":
                kind = _FIXED[op]
                # an object where a value is expected; a block elsewhere
                value = last in _OBJECT_AFTER
                stack.append((kind, not value))
            elif op == "(":
                kind = _FIXED[op]
                stack.append((kind, last in _HEADS))
            elif op == "[":
                kind = _FIXED[op]
                stack.append((kind, False))
            elif op in ")]}":
                kind = _FIXED[op]
                if not stack:
                    return None
                opened, flag = stack.pop()
                if op == "}" and opened == _HEAD:
                    t = _TPL_TEXT.match(text, end)
                    if text.startswith("`", t.end()):
                        kind, end = _TAIL, t.end() + 1
                    elif text.startswith("${", t.end()):
                        kind, end = _MID, t.end() + 2
                        stack.append((_HEAD, False))
                    else:
                        return None
                elif opened != _FIXED[{")": "(", "]": "[", "}": "{"}[op]]:
                    return None
                elif op == ")":
                    closed_head = flag
                elif op == "}":
                    block_end = flag
            else:
                kind = _FIXED[op]
        elif what == "num":
            if _ID_NEXT.match(text, end):
                return None
            kind = _NUM
        elif what == "str":
            kind = _STR
        elif what == "tpl":
            t = _TPL_TEXT.match(text, end)
            if text.startswith("`", t.end()):
                kind, end = _TPL, t.end() + 1
            elif text.startswith("${", t.end()):
                kind, end = _HEAD, t.end() + 2
                stack.append((_HEAD, False))
            else:
                return None
        elif what == "priv":
            kind = _PRIVATE
        if newline:
            if last in _RESTRICTED and kind != _FIXED[";"]:
                out.append(_ASI)
                may.append(0)
            elif last == _FIXED["throw"]:
                return None
            elif kind in (_FIXED["++"], _FIXED["--"]) and last in _VALUE_END:
                out.append(_ASI)
                may.append(0)
        out.append(kind)
        may.append(newline or kind == _FIXED["}"])
        last, newline, at = kind, False, end
    if stack:
        return None
    out.append(_EOF)
    may.append(1)
    return out, may


_OBJECT_AFTER = frozenset(_FIXED[x] for x in ("(", "[", ",", "=", ":", "?", "return", "typeof", "in", "of", "instanceof", "new", "void", "delete", "throw", "yield", "await", "case", "default", "...", *_ASSIGN, *(b for b in _BINARY), "!", "~"))


def accepts(text: str) -> set[str]:
    lexed = lex(text)
    return set() if lexed is None else G.recognise(lexed[0], DIALECTS, _ASI, lexed[1])
