"""A generalised LL recogniser over a graph-structured stack.

A grammar is given in EBNF and compiled to one small automaton a rule, a recursive transition network.
Recognition keeps a set of descriptors (automaton state, stack node). A stack node belongs to a rule
and a position and is shared by all callers at that position, each an edge with the state to return
to; so any number of parses, and of dialects with their own start rules, run side by side over one
stack graph. One token of lookahead prunes calls and returns. While a single descriptor is alive and
has a single move, it runs in a tight loop; that is the usual case.

Rules never derive nothing, and are not left-recursive; the compiler checks both. Hence a node gets all
its edges at the position where it is made, before anything can return through it.

EBNF: ``name : a "tok" ( b | c )* d? ;``. Lower-case words are rules; quoted words and upper-case words
are token kinds; ``%set`` is a set of kinds; ``!set rule`` calls a rule only if the next token is not
in the set.
"""

from __future__ import annotations

import re

_EBNF = re.compile(r'\s*(?:(?P<rule>[a-z_]\w*)|"(?P<tok>[^"]+)"|(?P<kind>[A-Z]\w*)|%(?P<set>\w+)|!(?P<not>\w+)|(?P<op>[()|*+?:;]))')


class Grammar:
    """Compiled rules; ``moves[state]`` maps a token kind to (shift target, calls, may return)."""

    def __init__(self, text: str, starts: dict[str, str], sets: dict[str, set[str]] | None = None):
        self.sets = {k: frozenset(v) for k, v in (sets or {}).items()}
        self.kinds: dict[str, int] = {}
        self._nfa: list[list[tuple]] = []
        rules = self._parse(text)
        self._compile(rules, starts)

    #: Number of the token that the last rejected input failed at.
    rejected_at = -1

    def kind(self, name: str) -> int:
        return self.kinds.setdefault(name, len(self.kinds))

    # EBNF to automata

    def _parse(self, text: str) -> dict[str, tuple[int, int]]:
        tokens, at = [], 0
        text = re.sub(r"(?m)^\s*#.*$", "", text).rstrip()
        while at < len(text):
            m = _EBNF.match(text, at)
            if not m:
                raise ValueError(f"grammar: {text[at : at + 40]!r}")
            tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        rules, k = {}, 0
        while k < len(tokens):
            name = tokens[k][1]
            assert tokens[k][0] == "rule" and tokens[k + 1][1] == ":", (name, tokens[k : k + 3])
            self._tokens, self._at = tokens, k + 2
            a, b = self._alternatives()
            assert self._tokens[self._at][1] == ";", (name, self._tokens[self._at])
            assert name not in rules, name
            k = self._at + 1
            rules[name] = (a, b)
        return rules

    def _new(self) -> int:
        self._nfa.append([])
        return len(self._nfa) - 1

    def _edge(self, a: int, label: tuple | None, b: int) -> None:
        self._nfa[a].append((label, b))

    def _alternatives(self) -> tuple[int, int]:
        a, b = self._new(), self._new()
        while True:
            x, y = self._sequence()
            self._edge(a, None, x)
            self._edge(y, None, b)
            if self._tokens[self._at][1] != "|" or self._tokens[self._at][0] != "op":
                return a, b
            self._at += 1

    def _sequence(self) -> tuple[int, int]:
        a = b = self._new()
        banned: frozenset = frozenset()
        while True:
            what, value = self._tokens[self._at]
            if what == "op" and value in "|);":
                return a, b
            self._at += 1
            if what == "not":
                banned = self.sets[value]
                continue
            if what == "op":
                assert value == "(", value
                x, y = self._alternatives()
                assert self._tokens[self._at][1] == ")"
                self._at += 1
            else:
                x, y = self._new(), self._new()
                if what == "rule":
                    self._edge(x, ("call", value, banned), y)
                elif what == "set":
                    for kind in self.sets[value]:
                        self._edge(x, ("kind", kind), y)
                else:
                    self._edge(x, ("kind", value), y)
            banned = frozenset()
            what, value = self._tokens[self._at]
            if what == "op" and value in "*+?":
                self._at += 1
                p, q = self._new(), self._new()
                self._edge(p, None, x)
                self._edge(y, None, q)
                if value in "*?":
                    self._edge(p, None, q)
                if value in "*+":
                    self._edge(y, None, x)
                x, y = p, q
            self._edge(b, None, x)
            b = y

    def _closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for label, b in self._nfa[todo.pop()]:
                if label is None and b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(seen)

    def _compile(self, rules: dict, starts: dict[str, str]) -> None:
        self.rule_names = list(rules)
        number = {n: i for i, n in enumerate(self.rule_names)}
        self.start_of: list[int] = []
        edges: list[dict] = []
        final: list[bool] = []
        self.rule_of: list[int] = []
        for name, (a, b) in rules.items():
            first = self._closure([a])
            ids = {first: len(edges)}
            self.start_of.append(len(edges))
            edges.append({})
            todo = [first]
            self.rule_of.append(number[name])
            final.append(b in first)
            if b in first:
                raise ValueError(f"rule {name} derives nothing")
            while todo:
                s = todo.pop()
                out: dict[tuple, set] = {}
                for x in s:
                    for label, y in self._nfa[x]:
                        if label is not None:
                            out.setdefault(label, set()).add(y)
                for label, ys in out.items():
                    t = self._closure(ys)
                    if t not in ids:
                        ids[t] = len(edges)
                        edges.append({})
                        self.rule_of.append(number[name])
                        final.append(b in t)
                        todo.append(t)
                    if label[0] == "call" and label[1] not in number:
                        raise ValueError(f"rule {name} calls {label[1]}")
                    edges[ids[s]][label] = ids[t]
        del self._nfa
        n = len(self.rule_names)
        first_of: list[set] = [set() for _ in range(n)]
        changed = True
        while changed:
            changed = False
            for r in range(n):
                size = len(first_of[r])
                for label in edges[self.start_of[r]]:
                    first_of[r] |= {label[1]} if label[0] == "kind" else first_of[number[label[1]]] - label[2]
                changed |= len(first_of[r]) > size
        follow: list[set] = [set() for _ in range(n)]
        changed = True
        while changed:
            changed = False
            for s, out in enumerate(edges):
                for label, t in out.items():
                    if label[0] == "call":
                        callee = number[label[1]]
                        size = len(follow[callee])
                        for after in edges[t]:
                            follow[callee] |= {after[1]} if after[0] == "kind" else first_of[number[after[1]]] - after[2]
                        if final[t]:
                            follow[callee] |= follow[self.rule_of[s]]
                        changed |= len(follow[callee]) > size
        self._check_left_recursion(edges, number)
        self.moves: list[dict[int, tuple]] = []
        for s, out in enumerate(edges):
            table: dict[str, list] = {}
            for label, t in out.items():
                if label[0] == "kind":
                    table.setdefault(label[1], [-1, [], False])[0] = t
                else:
                    for kind in first_of[number[label[1]]] - label[2]:
                        table.setdefault(kind, [-1, [], False])[1].append((number[label[1]], self.start_of[number[label[1]]], t))
            if final[s]:
                for kind in follow[self.rule_of[s]]:
                    table.setdefault(kind, [-1, [], False])[2] = True
            self.moves.append({self.kind(k): (a, tuple(b), c) for k, (a, b, c) in table.items()})
        self._chains()
        self.final = final
        self.starts = {d: self.start_of[number[r]] for d, r in starts.items()}
        self.kind("EOF")

    def _check_left_recursion(self, edges: list[dict], number: dict) -> None:
        calls = {r: {number[x[1]] for x in edges[s] if x[0] == "call"} for r, s in enumerate(self.start_of)}
        for r in calls:
            seen, todo = set(), list(calls[r])
            while todo:
                x = todo.pop()
                if x == r:
                    raise ValueError(f"rule {self.rule_names[r]} is left-recursive")
                if x not in seen:
                    seen.add(x)
                    todo += calls[x]

    def _chains(self) -> None:
        """Where a token leads through calls only and without a choice, ``direct`` holds the pushes and the shift."""
        self.direct: list[dict[int, tuple]] = []
        for s in range(len(self.moves)):
            out = {}
            for kind in self.moves[s]:
                pushes, at, sure = [], s, True
                while True:
                    shift, calls, back = self.moves[at].get(kind, (-1, (), False))
                    if back or (shift >= 0) + len(calls) != 1:
                        sure = False
                        break
                    if shift >= 0:
                        break
                    _, start, ret = calls[0]
                    pushes.append(ret)
                    at = start
                if sure:
                    out[kind] = (shift, tuple(pushes))
                elif self.moves[s][kind][2] and self.moves[s][kind][0] < 0 and not self.moves[s][kind][1]:
                    out[kind] = (-1, ())
            self.direct.append(out)

    # recognition

    def recognise(self, tokens: list[int], starts: tuple[str, ...], virtual: int = -1, may_insert: bytes | None = None) -> set[str]:
        """Dialects that accept the tokens, which end with EOF.

        ``virtual`` is a kind inserted before a token that nothing accepts, where ``may_insert`` allows it.
        """
        direct = self.direct
        roots = {d: [] for d in starts}
        live: list[tuple[int, list]] = [(self.starts[d], roots[d]) for d in starts]
        i, n = 0, len(tokens)
        while i < n:
            if len(live) == 1:
                state, node = live[0]
                while i < n:
                    move = direct[state].get(tokens[i])
                    if move is None:
                        break
                    shift, pushes = move
                    if shift >= 0:
                        for ret in pushes:
                            node = [(ret, node)]
                        state = shift
                        i += 1
                    elif len(node) == 1:
                        state, node = node[0]
                    else:
                        break
                live = [(state, node)]
                if i >= n:
                    break
            t = tokens[i]
            after = self._step(live, t)
            if not after and virtual >= 0 and may_insert is not None and may_insert[i]:
                middle = self._step(live, virtual)
                after = self._step(middle, t) if middle else middle
            if not after:
                self.rejected_at = i
                return set()
            live = after
            i += 1
        ids = {id(root): d for d, root in roots.items()}
        return {ids[id(node)] for state, node in live if self.final[state] and id(node) in ids}

    def _step(self, live: list[tuple[int, list]], t: int) -> list[tuple[int, list]]:
        """All descriptors after one token."""
        moves = self.moves
        todo, seen, made, out = list(live), {(s, id(x)) for s, x in live}, {}, {}
        while todo:
            state, node = todo.pop()
            move = moves[state].get(t)
            if move is None:
                continue
            shift, calls, back = move
            if shift >= 0:
                out[shift, id(node)] = node
            for rule, start, ret in calls:
                callee = made.get(rule)
                if callee is None:
                    callee = made[rule] = [(ret, node)]
                    todo.append((start, callee))
                elif not any(r == ret and x is node for r, x in callee):
                    callee.append((ret, node))
            if back:
                for ret, parent in node:
                    if (ret, id(parent)) not in seen:
                        seen.add((ret, id(parent)))
                        todo.append((ret, parent))
        return [(s, node) for (s, _), node in out.items()]
