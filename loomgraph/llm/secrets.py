"""Credentials embedded in source code and prose: found by line, and redacted in place.

Lines with an assignment context (a credential's name, a login call, an authorization header, a login
in a URL or command, a remark that gives a login, the prefix of an issuer or a key block) yield
literals. Each literal is segmented into dictionary words by Viterbi; what no word explains is its
residual, in which a digit weighs more than a letter and a symbol most, as names of things have few of
them. A long residual in such a context is a credential. Two exceptions are decided otherwise. Known
hash formats (hex digests, commit and request ids) are excluded before anything is segmented, unless
the name says credential, since keys are hex too. A literal of words alone is a credential only where
the context is one of a password: three words and more, or any in a login.

Null and empty texts give nothing. Lines are split at ``\\n`` only; a ``\\r`` before it belongs to no
value. Texts are scanned whole, whatever their length. Repeated rows give one row per line.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_left
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import local_copy, ship_file

#: A public vocabulary whose whole words are the dictionary.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
MARK = "[REDACTED]"
#: Residual from which a literal is unexplained, and that at which one in a weak context is.
LONG, LONG_WEAK = 4, 8
#: What a digit and a symbol weigh in a residual where the context names a credential; a letter is one.
DIGIT, SYMBOL = 3, 4

# Words that name a credential, alone or in the last place of a name.
_STRONG = frozenset(
    "password passwd passphrase passcode pwd pw pass secret psk cred creds credential credentials bearer kennwort passwort clave contrasena contraseña motdepasse apikey "
    "secretkey accesskey signingkey privatekey clientsecret authtoken accesstoken".split()
)
_WEAK = frozenset(["token", "auth", "authorization", "key", "jwt", "login", "pin"])
_PAIRS = frozenset(f"{a}{b}" for a in ("api", "access", "signing", "private", "secret", "client", "auth", "master", "encryption", "account", "shared") for b in ("key", "secret", "token"))
#: Last words that turn a credential's name into the name of something else, and first words that do.
_NOT_LAST = frozenset(
    "name names ref refs reference arn policy header headers env file files path paths dir id ids length len limit size count type types hint prefix suffix regex expiry ttl url uri "
    "hash sum checksum etag fingerprint algorithm algo mode enabled required strict store vault manager provider service kind placeholder image".split()
)
_NOT_FIRST = frozenset("existing public".split())
#: Last words that leave some doubt: only an unexplained literal counts there.
_DOUBT_LAST = frozenset("digest label rule rules index field fields rotation pattern record".split())
_HASHED = frozenset("hash sum checksum etag digest fingerprint rev revision commit sha sha1 sha256 md5 id ids".split())
_PLACEHOLDER = re.compile(
    r"^(?:x{3,}|\*+|\.{2,}|-+|_+|todo|tbd|none|null|nil|true|false|yes|no|empty|dummy|fake|test|example|changeme|change[-_ ]?me|redacted|masked|secret|password|placeholder|string|required|optional|strict|default|unset|n/?a|"
    r".*(?:your[-_ ].*|example[-_ ]?only|not[-_ ]a[-_ ]real|replace[-_ ]?me|fill[-_ ]?in|insert[-_ ]).*|<.*>|\[.*\]|\{.*\}|\$.*|%\w+%|\$?\$\{.*\}|\{\{.*|@\w+@|#\{.*)$",
    re.I,
)
_REFERENCE = re.compile(r"^<<|^[|>][-+]?$|^(?:vault|ref|secret|ssm|arn|res|env|file|op|kms|sm|azurekv|gcpsm|keychain|https?|urn|config)(?::|://)[^@]*$|^(?:var|local|module|data|process\.env|os\.environ|env|config|settings|self|this|values|secrets)[.\[(]|^/[\w./-]+$|^\.{1,2}/|\$\{|\{\{|^[\w.]+\(|^sha(?:256|512|1|384)[:-]", re.I)
_HASH = re.compile(r"^(?:[0-9a-f]{7,12}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})$", re.I)

_BEGIN = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
# Prefixes of issued tokens.
_ISSUED = re.compile(
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{40,}|glpat-[\w-]{20,}|xox[abprs]-[A-Za-z0-9-]{16,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[\w-]{30,}|npm_[A-Za-z0-9]{30,}|pypi-[\w-]{40,}"
    r"|[a-z]{2,5}_(?:pat|tok|key|live|sec|sk)_[A-Za-z0-9]{16,}|eyJ[\w-]{8,}\.(?:eyJ)?[\w-]{8,}\.[\w-]{8,})(?![A-Za-z0-9_])"
)
_ISSUED_START = re.compile(r"^(?:AKIA|ASIA|gh[pousr]_|xox[abprs]-|[sr]k_live_|eyJ[\w-]{4}|[a-z]{2,5}_(?:pat|tok|key|live)_)")

# What any pattern below needs somewhere on its line, in lower case; an ``@`` counts after a colon.
_WORDS = (
    r"pass|pwd|pw|pin|-[pu]\s|secret|token|key|bearer|basic\s|auth|cred|psk|clave|kenn[\W_]?wort|contra[\W_]?se|log(?:ged)?[ _-]?in|sign_?in|connect|dial|jwt"
    r"|eyj|akia|asia|aiza|npm_|pypi-|[sr]k_|gh[pousr]_|glpat|xox[abprs]-|_(?:pat|tok|live|sec|sk)_|try\s|use\s|worked with|[?&][\w-]*(?:code|sig|signature)="
)
_TRIGGER = re.compile(_WORDS + r"|@|(?:open|client|session)\w{0,30}\(")
_CONTEXT = re.compile(_WORDS)
_Q = r"""(?P<q>["'`])(?P<v>(?:(?!(?P=q))[^\\\r]|\\.)+)"""
_ASSIGN = re.compile(r"""(?<![\w.\-])(?P<n>[A-Za-z_][\w.\-]*)["'`]?\]?(?:\s*:\s*[A-Za-z_]\w*)?\s*(?::=|=>|->|[:=|])\s*\(?\s*(?:[rbuf]{1,2}(?=["']))?""" + _Q)
_DEFAULT = re.compile(r"""(?:getenv|envOr|env_or|environ\.get|getOrDefault|lookup|get|env|fetch)\w{0,30}\(\s*["'](?P<n>\w+)["']\s*,\s*""" + _Q + r"(?P=q)")
_OR = re.compile(r"""(?<![\w.])(?P<n>[A-Za-z_][\w.]*)(?:["']\])?\s*(?:\|\||\?\?|\bor\b)\s*""" + _Q + r"(?P=q)")
_BARE = re.compile(r"""^[\s#/*>+!-]*(?:export\s+|set\s+|setx\s+|ENV\s+|ARG\s+)?(?P<n>[A-Za-z_][\w.\-]*)\s*(?:=|:|->)\s*(?P<v>[^\s"'`,;(){}\[\]]+)[,;]?\s*$""")
_TABLE = re.compile(r"\|\s*`?(?P<n>[A-Za-z_][\w.\- ]*+)`?\s*\|\s*`?(?P<v>[^\s|`]+)`?\s*(?=\|)")
_CALL = re.compile(r"""\b(?:connect|login|log_in|signin|sign_in|dial|open|authenticate|auth|Client|session)\w{0,30}\(\s*["'`][^"'`]{0,300}["'`]\s*,\s*["'`][\w.@-]{1,200}["'`]\s*,\s*""" + _Q + r"(?P=q)", re.I)
_HEADER = re.compile(r"""["'](?=[\w-]*?(?:auth|key|token|secret))(?P<n>[\w-]++)["']\s*[,:]\s*""" + _Q + r"(?P=q)", re.I)
_SCHEME = re.compile(r"(?:Authorization\W{1,6}|[\"'\s])(?P<s>Basic|Bearer|Token)\s+(?P<v>[A-Za-z0-9+/=_.~\-]{6,})", re.I)
_USERINFO = re.compile(r"[^\s:@/\"'`]+(?:/[^\s:@/\"'`]+)*")
_HOST = re.compile(r"[\w-]+(?:\.[\w-]+)+|localhost")
_PARAM = re.compile(r"[?&](?P<n>[\w-]*(?:key|code|sig|signature|token|secret|auth|password|pwd))=(?P<v>[^&\s\"'`<>#)]+)", re.I)
_FLAG = re.compile(r"(?<![\w-])(?:--(?P<n>[\w-]*(?:password|passwd|passphrase|pw|pass|pwd|secret|token|key|auth|psk|cred|bearer|clave|kennwort))(?:=|\s+)|-(?P<p>p)\s+|-(?P<up>u)\s+[\w.-]+:)(?P<v>[^\s\"'`]+)")
_SAYS = re.compile(r"(?<![\w-])(?P<n>[A-Za-z][\w-]*)`?\s*(?:(?:is|was|ist|es)(?:\s+(?:still|now|currently))?\s*:?|=|:|->)\s+[`\"']?(?P<v>[^\s`\"']+)", re.I)
_AS = re.compile(r"\bwith\s+[`\"']?(?P<v>[^\s`\"']+)[`\"']?\s+as\s+(?:the\s+)?(?P<n>[A-Za-z_][\w-]*)", re.I)
_LOGIN = (
    re.compile(r"\blog(?:ged)?[ -]?in(?:to)?\s+(?:as|with)\s+[`\"']?[\w.@-]+[`\"']?\s*(?:with|and|/|using)\s*[`\"']?(?P<v>[^\s`\"']+)", re.I),
    re.compile(r"\b(?:use|try)\s+[`\"']?[\w.@-]+[`\"']?\s*/\s*[`\"']?(?P<v>[^\s`\"']+)", re.I),
    re.compile(r"\blogin\b[^\n]{0,200}?,?\s*then\s+(?:type|enter|use)\s+[`\"']?(?P<v>[^\s`\"']+)", re.I),
)
_NEXT_LITERAL = re.compile(r"""\s*[+.&]?\s*(?P<q>["'`])(?P<v>(?:(?!(?P=q))[^\\\r]|\\.)*)(?P=q)""")
_JOINED = re.compile(r"""^["'`]\s*(?:\+|\.|&|\\)?\s*\\?\r?$""")
_TRAIL = ".,;:)]}>\"'`\r"

_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*|\d+")


@lru_cache(maxsize=4)
def dictionary(path: str) -> frozenset:
    """Whole words of at least three letters of a public vocabulary."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return frozenset(w for k in vocabulary if k.endswith("</w>") and len(w := k[:-4]) >= 3 and w.isalpha() and w.isascii())


class Segmenter:
    """Viterbi segmentation of a literal: words cost least, numbers more, single characters most."""

    def __init__(self, words: frozenset, longest: int = 16):
        self.words, self.longest = words, longest
        self._known = lru_cache(maxsize=200_000)(self._parse)

    def parse(self, literal: str) -> tuple[int, int, int]:
        """(residual characters, dictionary words, digits in numbers) of the cheapest segmentation; long literals are not remembered."""
        return self._known(literal) if len(literal) <= 1000 else self._parse(literal)

    def _parse(self, literal: str) -> tuple[int, int, int]:
        s = literal.lower()
        n = len(s)
        best = [(0.0, 0, 0, 0)] + [(1e9, 0, 0, 0)] * n
        for i in range(n):
            (cost, residual, words, digits), best[i] = best[i], None
            c = s[i]
            if not c.isalnum():
                step = (cost + 0.2, residual, words, digits)
            else:
                step = (cost + 2.0, residual + 1, words, digits)
            if step[0] < best[i + 1][0]:
                best[i + 1] = step
            if c.isdigit() and (i == 0 or not s[i - 1].isdigit()):
                j = i + 1
                while j < n and s[j].isdigit():
                    j += 1
                if j - i <= 4 and (j == n or not s[j].isalnum()):
                    step = (cost + 1.2 + 0.1 * (j - i), residual, words, digits + j - i)
                    if step[0] < best[j][0]:
                        best[j] = step
            elif c.isalpha():
                for j in range(i + 3, min(n, i + self.longest) + 1):
                    if s[i:j] in self.words:
                        # short words occur inside random strings by chance
                        step = (cost + max(1.5, 5.5 - (j - i)), residual, words + 1, digits)
                        if step[0] < best[j][0]:
                            best[j] = step
        return best[n][1:]


def name_rank(name: str) -> int:
    """2 when a name means a credential, 1 when it may, 0 when it does not."""
    parts = [p.lower() for p in _PART.findall(name)]
    words = [p for p in parts if not p.isdigit()]
    if not words:
        return 0
    joined = {"".join(words[i : i + 2]) for i in range(len(words) - 1)} | {"".join(words[i : i + 3]) for i in range(len(words) - 2)}
    strong = bool(_STRONG & {*words, *joined} or _PAIRS & joined)
    weak = bool(_WEAK & set(words))
    if not (strong or weak):
        return 0
    if words[-1] in _NOT_LAST or words[0] in _NOT_FIRST:
        return -1
    return 2 if strong and words[-1] not in _DOUBT_LAST else 1


def userinfo(line: str):
    """Places of the passwords of user:password@host in a line, each between an @ and the last colon before it."""
    at, done = line.find("@"), 0
    while at >= 0:
        c = line.rfind(":", done, at)
        if c >= 0 and _USERINFO.fullmatch(line, c + 1, at) and _HOST.match(line, at + 1):
            s = c
            while s > done and (line[s - 1].isalnum() or line[s - 1] in "_.+-"):
                s -= 1
            if s == 0 or line[s - 1] not in "/:@" or line[max(0, s - 3) : s] == "://" or "+" in line[s:c]:
                yield c + 1, at
        done, at = at + 1, line.find("@", at + 1)


class Finder:
    """Finds the credentials of a text as (line number from 1, first, last) character spans."""

    def __init__(self, words: frozenset):
        self.segment = Segmenter(words)

    def residual(self, value: str) -> int:
        """Weight of what no word explains in a literal of a credential's context."""
        letters, _, digits = self.segment.parse(value)
        alone = sum(c.isdigit() for c in value) - digits  # digits outside numbers are among the single characters
        return letters + (DIGIT - 1) * alone + DIGIT * digits + SYMBOL * sum(not c.isalnum() and c not in "._-" for c in value)

    def accepts(self, value: str, rank: int, quoted: bool, hashed: bool = False) -> bool:
        return self.reason(value, rank, quoted, hashed) is not None

    def reason(self, value: str, rank: int, quoted: bool, hashed: bool = False) -> str | None:
        """Why a literal is a credential (residual, words or hash), or None. rank: 3 login or header, 2 credential name, 1 weak, -1 another name."""
        if len(value) < 4 or _PLACEHOLDER.match(value) or _PLACEHOLDER.match(value.strip("[](){}<>")) or _REFERENCE.search(value) or " " in value.strip():
            return None
        if _HASH.match(value):
            return "hash" if rank >= 1 and not hashed and len(value) >= 16 else None
        if _ISSUED.fullmatch(value):
            rank = max(rank, 2)
        if rank < 0:
            return None
        if value.isdigit() or re.fullmatch(r"[\d.,:xv-]+", value):
            return "residual" if rank >= 3 and len(value) >= 6 else None
        letters, words, digits = self.segment.parse(value)
        if rank >= 2:
            if self.residual(value) >= LONG:
                return "residual"
            return "words" if words >= 3 or rank >= 3 and words >= 1 and len(value) >= 5 else None
        symbols = any(not c.isalnum() and c not in "._-" for c in value)
        if letters >= LONG_WEAK or quoted and (symbols and (letters >= 2 or digits >= 2) or letters >= LONG and any(c.isdigit() for c in value)):
            return "residual"
        return "words" if words >= 4 or digits >= 4 and words >= 1 else None

    def spans(self, text: str):
        """Spans of credentials, in order. The first span of one credential is flagged True."""
        found: list[tuple[int, int, bool]] = []  # sorted, and none overlaps another

        def free(x: int, y: int) -> int | None:
            k = bisect_left(found, (x, y))
            return None if k < len(found) and found[k][0] < y or k and found[k - 1][1] > x else k

        for m in _BEGIN.finditer(text):
            end = _END.search(text, m.end())
            body = end.start() if end else len(text)
            stop = end.end() if end else len(text)
            if not end:  # a key cut off: up to the first line that is no key material
                k = re.compile(r"\n(?!\s*[A-Za-z0-9+/=]{8,}\s*(?:\n|$))").search(text, m.end())
                body = stop = k.start() if k else len(text)
            if (k := free(m.start(), stop)) is not None and self.residual("".join(text[m.end() : body].split())) >= LONG:
                found.insert(k, (m.start(), stop, True))
        blocks = list(found)
        low = text.lower()
        if len(low) != len(text):  # a few letters change length: compare them as they are
            low = text
        at, a, n = 0, 0, len(text)
        while True:
            m = _TRIGGER.search(low, at)
            if not m:
                break
            a = text.rfind("\n", at, m.start()) + 1 or a
            if low[m.start()] == "@" and text.find(":", max(a, at), m.start()) < 0:
                at = m.end()
                continue
            b = text.find("\n", m.start())
            b = n if b < 0 else b
            at = b
            if blocks:
                k = bisect_left(blocks, (a, a)) - 1
                if k >= 0 and blocks[k][1] > a or k + 1 < len(blocks) and blocks[k + 1][0] == a:
                    continue  # the line begins in a key block
            for x, y, first in self._line(text, a, b):
                if (k := free(x, y)) is not None:
                    found.insert(k, (x, y, first))
            if at >= n:
                break
        return found

    def _line(self, text: str, a: int, b: int):
        line = text[a:b]
        out: list[tuple[int, int, bool]] = []

        def take(x: int, y: int, rank: int, quoted: bool, hashed: bool = False, value: str | None = None) -> None:
            while not quoted and y > x and line[y - 1] in _TRAIL:
                y -= 1
            if y > x and self.accepts(line[x:y] if value is None else value, rank, quoted, hashed):
                out.append((a + x, a + y, True))

        for m in _ISSUED.finditer(line):
            take(m.start(), m.end(), 2, True)
        for m in _SCHEME.finditer(line):
            v = m["v"]
            if m["s"].lower() == "basic":
                try:
                    plain = base64.b64decode(v + "=" * (-len(v) % 4), validate=True).decode("utf-8")
                except ValueError:
                    continue
                _, colon, word = plain.partition(":")
                if colon:
                    take(m.start("v"), m.end("v"), 3, True, value=word)
            else:
                take(m.start("v"), m.end("v"), 2, False)
        if "@" in line:
            for x, y in userinfo(line):
                take(x, y, 3, True)
        for m in _PARAM.finditer(line):
            take(m.start("v"), m.end("v"), 1, False)
        for m in _FLAG.finditer(line):
            take(m.start("v"), m.end("v"), name_rank(m["n"]) if m["n"] else 2, False)
        if calls := list(_CALL.finditer(line)):
            # Files and sessions are opened with modes and encodings too: without another word only an odd literal counts.
            rank = 3 if _CONTEXT.search(line.lower()) else 1
            for m in calls:
                take(m.start("v"), m.end("v"), rank, True)
        for m in _HEADER.finditer(line):
            if name_rank(m["n"]) >= 0 or m["n"].lower().startswith("x-"):
                take(m.start("v"), m.end("v"), 2 if m["n"].lower().startswith("x-") else name_rank(m["n"]), True)
        for pattern in (_DEFAULT, _OR):
            for m in pattern.finditer(line):
                take(m.start("v"), m.end("v"), name_rank(m["n"]), True)
        for m in _ASSIGN.finditer(line):
            rank, x, y = name_rank(m["n"]), m.start("v"), m.end("v")
            parts = {p.lower() for p in _PART.findall(m["n"])}
            rest = line[y:]
            value, more = m["v"], []
            if rank or _ISSUED_START.match(value):
                if _JOINED.match(rest) and (rest.rstrip()[-1:] in "+.&\\" or line[: m.start("q")].rstrip().endswith("(")):
                    c, parts_of = b, [value]
                    while k := _NEXT_LITERAL.match(text, c + 1):
                        more.append((k.start("v"), k.end("v")))
                        parts_of.append(k["v"])
                        c = (text.find("\n", k.end()) + 1 or len(text) + 1) - 1
                        tail = text[k.end() : c]
                        if not _JOINED.match("'" + tail) or not tail.strip().endswith(("+", ".", "&", "\\")):
                            break
                    value = "".join(parts_of)
                if not more and not rest.startswith(m["q"]):
                    continue  # the literal does not end on this line
                before = len(out)
                take(x, y, rank, True, bool(parts & _HASHED), value)
                if len(out) > before:
                    out.extend((p, q, False) for p, q in more if q > p)
        if m := _BARE.match(line):
            rank = name_rank(m["n"])
            parts = {p.lower() for p in _PART.findall(m["n"])}
            if rank:
                v = m["v"]
                code = re.match(r"^[A-Za-z_][\w]*(?:[.\[(]|$)", v) and not any(c.isdigit() for c in v) and "-" not in v
                if not code:
                    take(m.start("v"), m.end("v"), rank, False, bool(parts & _HASHED))
        for m in _TABLE.finditer(line):
            if rank := name_rank(m["n"]):
                take(m.start("v"), m.end("v"), rank, False)
        for pattern in (_SAYS, _AS):
            for m in pattern.finditer(line):
                if (rank := name_rank(m["n"])) > 0:
                    v = m["v"].rstrip(_TRAIL)
                    if any(c.isdigit() for c in v) or v.count("-") >= 2 or self.segment.parse(v)[0] >= LONG:
                        if not re.match(r"^[\w.]+[(\[]", v) and not re.match(r"^[a-z_]+\.[a-z_]+", v):
                            take(m.start("v"), m.end("v"), rank, False)
        for pattern in _LOGIN:
            for m in pattern.finditer(line):
                take(m.start("v"), m.end("v"), 2, False)
        out.sort(key=lambda s: (s[0], -s[1]))
        return out

    def lines(self, text: str | None) -> list[int]:
        """Line numbers on which a credential starts."""
        if not text:
            return []
        out, at, line = [], 0, 1
        for x, _, first in self.spans(text):
            if first:
                line += text.count("\n", at, x)
                at = x
                if not out or out[-1] != line:
                    out.append(line)
        return out

    def redact(self, text: str, mark: str = MARK) -> str:
        """The text with only the credentials replaced; further parts of a joined literal become empty."""
        out, at = [], 0
        for x, y, first in self.spans(text):
            if x >= at:
                out += [text[at:x], mark if first else ""]
                at = y
        return "".join([*out, text[at:]])


_FINDERS: dict[str, Finder] = {}


def finder(vocabulary: str) -> Finder:
    """One finder a worker process and vocabulary."""
    if vocabulary not in _FINDERS:
        _FINDERS[vocabulary] = Finder(dictionary(local_copy(vocabulary)))
    return _FINDERS[vocabulary]


def texts_of(chunks: DataFrame, items: DataFrame) -> DataFrame:
    """Chunk bodies and item texts as (item_kind, row_id, text)."""
    a = chunks.select(F.lit("chunk").alias("item_kind"), F.col("chunk_id").alias("row_id"), F.col("body").alias("text"))
    b = items.select(F.lit("item").alias("item_kind"), F.col("item_no").alias("row_id"), F.col("text").alias("text"))
    return a.unionByName(b)


def find_credentials(texts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Distinct (item_kind, row_id, line_no) of credentials in (item_kind, row_id, text)."""

    ship_file(texts.sparkSession, vocabulary)

    def scan(batches):
        find = finder(vocabulary)
        for batch in batches:
            rows = [(k, i, n) for k, i, t in zip(batch["item_kind"], batch["row_id"], batch["text"]) for n in find.lines(t)]
            yield pd.DataFrame(rows, columns=["item_kind", "row_id", "line_no"])

    return texts.mapInPandas(scan, "item_kind string, row_id bigint, line_no int").distinct()


def redact_credentials(texts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(item_kind, row_id, n_credentials, redacted) of the texts that hold credentials; repeated rows count once."""

    ship_file(texts.sparkSession, vocabulary)

    def scan(batches):
        find = finder(vocabulary)
        for batch in batches:
            rows = []
            for k, i, t in zip(batch["item_kind"], batch["row_id"], batch["text"]):
                if t and (n := sum(first for *_, first in find.spans(t))):
                    rows.append((k, i, n, find.redact(t)))
            yield pd.DataFrame(rows, columns=["item_kind", "row_id", "n_credentials", "redacted"])

    return texts.mapInPandas(scan, "item_kind string, row_id bigint, n_credentials int, redacted string").distinct()
