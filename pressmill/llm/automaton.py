"""Regular expressions over bytes as one minimal deterministic automaton.

The dialect: literals, ``\\xHH`` and escaped signs, classes, groups, ``|``, ``?``, ``*``,
``+``, ``{m}``, ``{m,}`` and ``{m,n}``. Patterns become position sets (NFA), all rules at once
become a deterministic automaton by subset construction, equivalent states are merged, and the
result is one flat transition array, indexed by state and byte.
"""

from __future__ import annotations

from typing import NamedTuple

ALL = frozenset(range(256))


class Nfa:
    """Nodes with silent moves and byte moves; ``accepts`` names the rule that ends at a node."""

    def __init__(self):
        self.silent: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.accepts: dict[int, int] = {}

    def node(self) -> int:
        self.silent.append([])
        self.moves.append([])
        return len(self.silent) - 1

    def closure(self, nodes) -> frozenset[int]:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for to in self.silent[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


def parse(pattern: str, ignore_case: bool = False):
    """A tree of ("set", bytes), ("seq", parts), ("alt", parts), ("rep", part, least, most)."""
    text, at = pattern.encode(), 0

    def folded(values: set[int]) -> frozenset[int]:
        if ignore_case:
            values |= {v ^ 32 for v in values if 65 <= v & ~32 <= 90}
        return frozenset(values)

    def escaped() -> int:
        nonlocal at
        at += 2
        if text[at - 1 : at] == b"x":
            at += 2
            return int(text[at - 2 : at], 16)
        return text[at - 1]

    def one() -> int:
        nonlocal at
        if text[at : at + 1] == b"\\":
            return escaped()
        at += 1
        return text[at - 1]

    def members() -> frozenset[int]:
        nonlocal at
        at += 1
        negated = text[at : at + 1] == b"^"
        at += negated
        found: set[int] = set()
        while text[at : at + 1] != b"]":
            low = high = one()
            if text[at : at + 1] == b"-" and text[at + 1 : at + 2] != b"]":
                at += 1
                high = one()
            found |= set(range(low, high + 1))
        at += 1
        return ALL - folded(found) if negated else folded(found)

    def atom():
        nonlocal at
        sign = text[at : at + 1]
        if sign == b"(":
            at += 1
            inner = choice()
            at += 1
            return inner
        if sign == b"[":
            return ("set", members())
        return ("set", folded({one()}))

    def repeated():
        nonlocal at
        part = atom()
        while (sign := text[at : at + 1]) and sign in b"?*+{":
            at += 1
            if sign == b"{":
                end = text.index(b"}", at)
                low, _, high = text[at:end].partition(b",")
                least = int(low)
                most = least if b"," not in text[at:end] else int(high) if high else None
                at = end + 1
            else:
                least, most = {b"?": (0, 1), b"*": (0, None), b"+": (1, None)}[sign]
            part = ("rep", part, least, most)
        return part

    def choice():
        nonlocal at
        options = [[]]
        while at < len(text) and text[at : at + 1] != b")":
            if text[at : at + 1] == b"|":
                at += 1
                options.append([])
            else:
                options[-1].append(repeated())
        parts = [("seq", o) for o in options]
        return parts[0] if len(parts) == 1 else ("alt", parts)

    tree = choice()
    if at != len(text):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return tree


def add(nfa: Nfa, tree, begin: int, backward: bool = False) -> int:
    """Adds a tree from node ``begin`` on and returns the node where it ends."""
    kind = tree[0]
    if kind == "set":
        end = nfa.node()
        nfa.moves[begin].append((tree[1], end))
        return end
    if kind == "seq":
        for part in reversed(tree[1]) if backward else tree[1]:
            begin = add(nfa, part, begin, backward)
        return begin
    if kind == "alt":
        end = nfa.node()
        for part in tree[1]:
            first = nfa.node()
            nfa.silent[begin].append(first)
            nfa.silent[add(nfa, part, first, backward)].append(end)
        return end
    _, part, least, most = tree
    for _ in range(least):
        begin = add(nfa, part, begin, backward)
    end = nfa.node()
    nfa.silent[begin].append(end)
    if most is None:
        first = nfa.node()
        nfa.silent[begin].append(first)
        last = add(nfa, part, first, backward)
        nfa.silent[last] += [first, end]
    for _ in range((most or least) - least):
        begin = add(nfa, part, begin, backward)
        nfa.silent[begin].append(end)
    return end


class Dfa(NamedTuple):
    """``moves[state + byte]`` is the next state; states are multiples of 256, 0 is the first.

    States from ``accepting`` on accept; ``rules[state >> 8]`` lists the rules that end there.
    ``dead`` is the state without a way to accept, or -1.
    """

    moves: list[int]
    accepting: int
    rules: list[tuple[int, ...]]
    dead: int


def determinise(nfa: Nfa, begin: int, everywhere: bool) -> Dfa:
    """Subset construction, then merging of equivalent states.

    ``everywhere`` lets a match begin at every byte.
    """
    sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
    kind_of: dict[tuple[bool, ...], int] = {}
    kinds = [kind_of.setdefault(tuple(b in s for s in sets), len(kind_of)) for b in range(256)]
    sample = [kinds.index(k) for k in range(len(kind_of))]
    home = nfa.closure([begin])
    number, todo, table = {home: 0}, [home], []
    for state in todo:
        row = []
        for byte in sample:
            to = {t for node in state for s, t in nfa.moves[node] if byte in s}
            to = nfa.closure(to) | home if everywhere else nfa.closure(to)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    rules = [tuple(sorted({nfa.accepts[n] for n in state if n in nfa.accepts})) for state in todo]
    # Merge: start from what a state accepts, split by where its moves lead, until stable.
    names: dict = {}
    block = [names.setdefault(r, len(names)) for r in rules]
    while True:
        names = {}
        finer = [names.setdefault((block[i], *(block[t] for t in row)), len(names)) for i, row in enumerate(table)]
        if len(names) == len(set(block)):
            break
        block = finer
    first = {b: i for i, b in reversed(list(enumerate(block)))}
    order = sorted(first, key=lambda b: (b != block[0], bool(rules[first[b]]), first[b]))
    if rules[0]:
        raise ValueError("a rule matches the empty string")
    place = {b: i * 256 for i, b in enumerate(order)}
    moves = [place[block[table[first[b]][kinds[byte]]]] for b in order for byte in range(256)]
    accepted = [rules[first[b]] for b in order]
    accepting = sum(not r for r in accepted) * 256
    dead = next((s for s in range(0, accepting, 256) if all(m == s for m in moves[s : s + 256])), -1)
    return Dfa(moves, accepting, accepted, -1 if everywhere else dead)


def compile_rules(trees: list, everywhere: bool = True, backward: bool = False) -> Dfa:
    """One automaton for several trees; rules are numbered by their place."""
    nfa = Nfa()
    begin = nfa.node()
    for number, tree in enumerate(trees):
        first = nfa.node()
        nfa.silent[begin].append(first)
        nfa.accepts[add(nfa, tree, first, backward)] = number
    return determinise(nfa, begin, everywhere)


def ends(dfa: Dfa, data: bytes) -> list[tuple[int, int]]:
    """``(end, state)`` wherever something matches, in one pass over the bytes."""
    moves, accepting, state, out = dfa.moves, dfa.accepting, 0, []
    for at, byte in enumerate(data, 1):
        state = moves[state + byte]
        if state >= accepting:
            out.append((at, state))
    return out


def longest(dfa: Dfa, data: bytes, begin: int, step: int = 1, bound: int | None = None) -> int:
    """Where the longest match from ``begin`` stops, going on or (``step=-1``) back; -1 if none."""
    at, state, found = begin, 0, -1
    stop = bound if bound is not None else len(data) if step > 0 else 0
    while at != stop:
        state = dfa.moves[state + data[at if step > 0 else at - 1]]
        if state == dfa.dead:
            break
        at += step
        if state >= dfa.accepting:
            found = at
    return found
