"""Regular expressions compiled together into one minimal deterministic automaton over bytes.

Subset construction over the rules' Thompson automata, then refinement to the fewest states; transitions are one flat
list, 256 entries per state, in which a state is the offset of its row. Supported syntax is what Python's own
expression parser gives for literals, classes, groups, alternatives and greedy repeats; alternatives must be such that
the longest match is the greedy one, as no order of preference survives in an automaton.
"""

from __future__ import annotations

from re import _constants as C, _parser


class _Nfa:
    """States with byte moves (a set of bytes and one target) and free moves."""

    def __init__(self):
        self.moves: list[tuple[frozenset[int], int] | None] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append(None)
        self.free.append([])
        return len(self.moves) - 1

    def step(self, codes: frozenset[int], then: int) -> int:
        s = self.state()
        self.moves[s] = (codes, then)
        return s

    def fork(self, *targets: int) -> int:
        s = self.state()
        self.free[s].extend(targets)
        return s

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _class(items) -> frozenset[int]:
    """The bytes of a character class; classes hold ASCII only, a negated one any byte outside it."""
    codes: set[int] = set()
    for op, value in items:
        if op is C.LITERAL:
            codes.add(value)
        elif op is C.RANGE:
            codes.update(range(value[0], value[1] + 1))
        elif op is not C.NEGATE:
            raise ValueError(f"unsupported in a class: {op}")
    if max(codes, default=0) > 127:
        raise ValueError("classes must be ASCII")
    return frozenset(set(range(256)) - codes) if items[0][0] is C.NEGATE else frozenset(codes)


def _build(nfa: _Nfa, parts, then: int, backwards: bool, fold: bool) -> int:
    """Adds `parts` in front of state `then` and returns where they begin."""

    def one(op, value, then: int) -> int:
        if op is C.LITERAL:
            raw = chr(value).encode()
            if fold and len(raw) == 1:
                return nfa.step(frozenset({ord(chr(value).lower()), ord(chr(value).upper())}), then)
            for byte in raw if backwards else reversed(raw):
                then = nfa.step(frozenset({byte}), then)
            return then
        if op is C.IN:
            return nfa.step(_class(value), then)
        if op is C.ANY:
            return nfa.step(frozenset(range(256)) - {10}, then)
        if op is C.SUBPATTERN:
            return _build(nfa, value[3], then, backwards, fold or bool(value[1] & 2))
        if op is C.BRANCH:
            return nfa.fork(*[_build(nfa, branch, then, backwards, fold) for branch in value[1]])
        if op is C.MAX_REPEAT:
            low, high, inner = value
            if high is C.MAXREPEAT:
                loop = nfa.fork()
                nfa.free[loop].extend([_build(nfa, inner, loop, backwards, fold), then])
                then = loop
            else:
                end = then
                for _ in range(high - low):
                    then = nfa.fork(_build(nfa, inner, then, backwards, fold), end)
            for _ in range(low):
                then = _build(nfa, inner, then, backwards, fold)
            return then
        raise ValueError(f"unsupported: {op}")

    for op, value in parts if backwards else reversed(list(parts)):
        then = one(op, value, then)
    return then


class Automaton:
    """`rules` in one automaton.

    `next` holds 256 entries per state, a state being the offset of its row; states from `accepting` upwards end a
    match, of the rules in bit set `rules[state // 256]`. `anywhere`: a match may begin at any byte. `dead` is the
    offset of the state that nothing leaves, or -1.
    """

    def __init__(self, rules: list[str], backwards: bool = False, anywhere: bool = False):
        nfa, ends, starts = _Nfa(), {}, []
        for i, rule in enumerate(rules):
            end = nfa.state()
            ends[end] = 1 << i
            starts.append(_build(nfa, _parser.parse(rule), end, backwards, False))
        start = nfa.fork(*starts)
        table, accepts = self._subsets(nfa, nfa.closure([start]), ends, anywhere)
        self._pack(*self._fewest(table, accepts))

    @staticmethod
    def _subsets(nfa: _Nfa, start: frozenset[int], ends: dict[int, int], anywhere: bool):
        # bytes that no rule tells apart are moved together
        kinds: dict[tuple, list[int]] = {}
        classes = list({m[0] for m in nfa.moves if m})
        for byte in range(256):
            kinds.setdefault(tuple(byte in c for c in classes), []).append(byte)
        number, table, todo = {start: 0}, [], [start]
        for subset in todo:
            row = [0] * 256
            moves = [nfa.moves[s] for s in subset if nfa.moves[s]]
            for group in kinds.values():
                target = nfa.closure({t for codes, t in moves if group[0] in codes})
                target = target | start if anywhere else target
                if target not in number:
                    number[target] = len(todo)
                    todo.append(target)
                for byte in group:
                    row[byte] = number[target]
            table.append(row)
        accepts = []
        for subset in todo:
            bits = 0
            for s in subset:
                bits |= ends.get(s, 0)
            accepts.append(bits)
        return table, accepts

    @staticmethod
    def _fewest(table: list[list[int]], accepts: list[int]):
        """Merges states until two in one block agree in what they accept and in the blocks they lead to."""
        block = [sorted(set(accepts)).index(a) for a in accepts]
        while True:
            names: dict[tuple, int] = {}
            finer = [names.setdefault((block[s], tuple(block[t] for t in table[s])), len(names)) for s in range(len(table))]
            if len(names) == len(set(block)):
                break
            block = finer
        first = {b: s for s, b in reversed(list(enumerate(block)))}
        merged = [[block[t] for t in table[first[b]]] for b in sorted(first)]
        return merged, [accepts[first[b]] for b in sorted(first)], block[0]

    def _pack(self, table, accepts, start) -> None:
        order = sorted(range(len(table)), key=lambda b: accepts[b] != 0)
        place = {b: i * 256 for i, b in enumerate(order)}
        self.next = [place[t] for b in order for t in table[b]]
        self.rules = [accepts[b] for b in order]
        self.accepting = 256 * sum(not accepts[b] for b in order)
        self.start = place[start]
        self.dead = next((place[b] for b in order if not accepts[b] and set(table[b]) == {b}), -1)

    def __len__(self) -> int:
        return len(self.rules)


class Scanner:
    """Leftmost longest matches of every rule, each rule on its own, not overlapping.

    One pass from the end of the text to its front over all rules together finds every byte at which some match
    begins; from the first such byte after the last match, the rule's own automaton runs to the match's end.
    """

    def __init__(self, rules: list[str]):
        self.begins = Automaton(rules, backwards=True, anywhere=True)
        self.single = [Automaton([rule]) for rule in rules]

    def starts(self, data: bytes) -> list[list[int]]:
        """Per rule, ascending, the bytes at which a match begins."""
        move, s, accepting, rules = self.begins.next, self.begins.start, self.begins.accepting, self.begins.rules
        found: list[list[int]] = [[] for _ in self.single]
        at = len(data)
        for byte in reversed(data):
            at -= 1
            s = move[s + byte]
            if s >= accepting:
                bits = rules[s >> 8]
                while bits:
                    low = bits & -bits
                    found[low.bit_length() - 1].append(at)
                    bits ^= low
        for places in found:
            places.reverse()
        return found

    def end(self, rule: int, data: bytes, start: int) -> int:
        dfa, s, last = self.single[rule], self.single[rule].start, start
        move, accepting, dead = dfa.next, dfa.accepting, dfa.dead
        for at in range(start, len(data)):
            s = move[s + data[at]]
            if s == dead:
                break
            if s >= accepting:
                last = at + 1
        return last

    def spans(self, data: bytes) -> list[list[tuple[int, int]]]:
        """Per rule, its (start, end) in bytes."""
        out = []
        for rule, places in enumerate(self.starts(data)):
            spans, last = [], 0
            for start in places:
                if start >= last:
                    last = self.end(rule, data, start)
                    spans.append((start, last))
            out.append(spans)
        return out
