"""Several byte patterns in one deterministic automaton.

Patterns are written in the usual notation: literals, ``\\x20`` and ``\\.``
escapes, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{m}``, ``{m,}``,
``{m,n}``. They are joined in one automaton over bytes by subset construction,
which is then minimised and laid out as a transition array over byte classes.
``Automaton(..., anywhere=True)`` lets a match begin at every byte and ends it as
early as it can, so one pass marks every place where some pattern matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ALL = (1 << 256) - 1
MOST_STATES = 60_000


def _mask(values) -> int:
    out = 0
    for v in values:
        out |= 1 << v
    return out


def _either_case(mask: int) -> int:
    for lower in range(0x61, 0x7B):
        pair = 1 << lower | 1 << (lower - 32)
        if mask & pair:
            mask |= pair
    return mask


class _Reader:
    """Reads a pattern into a tree: ("set", mask), ("cat", parts), ("or", parts), ("many", part, least, most)."""

    def __init__(self, pattern: str, any_case: bool):
        self.text, self.at, self.any_case = pattern, 0, any_case

    def read(self):
        tree = self.choice()
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} of {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise ValueError(f"{self.text!r} ends too early")
        self.at += 1
        return c

    def choice(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            part = self.one()
            while self.peek() and self.peek() in "?*+{":
                part = ("many", part, *self.times())
            parts.append(part)
        return ("cat", parts)

    def times(self) -> tuple[int, int | None]:
        c = self.take()
        if c != "{":
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        body = ""
        while (c := self.take()) != "}":
            body += c
        least, comma, most = body.partition(",")
        return int(least), (int(most) if most else None) if comma else int(least)

    def one(self):
        c = self.take()
        if c == "(":
            tree = self.choice()
            if self.take() != ")":
                raise ValueError(f"a group of {self.text!r} does not end")
            return tree
        if c == "[":
            return ("set", self.members())
        if c in "?*+{":
            raise ValueError(f"nothing to repeat at {self.at} of {self.text!r}")
        value = self.escaped() if c == "\\" else ord(c)
        mask = 1 << value
        return ("set", _either_case(mask) if self.any_case else mask)

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            return int(self.take() + self.take(), 16)
        if c.isalnum():
            raise ValueError(f"unknown escape \\{c} in {self.text!r}")
        return ord(c)

    def members(self) -> int:
        negated = self.peek() == "^"
        self.at += negated
        mask, first = 0, True
        while first or self.peek() != "]":
            first = False
            c = self.take()
            low = high = self.escaped() if c == "\\" else ord(c)
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", ""):
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
            mask |= _mask(range(low, high + 1))
        self.take()
        mask = _either_case(mask) if self.any_case else mask
        return ALL ^ mask if negated else mask


def _shortest(tree):
    """``tree`` without what only makes a match longer at its end: it matches
    wherever ``tree`` does, and needs no loop there."""
    kind = tree[0]
    if kind == "cat" and tree[1]:
        last = _shortest(tree[1][-1])
        rest = ("cat", tree[1][:-1])
        return _shortest(rest) if last == ("cat", []) else ("cat", [*tree[1][:-1], last])
    if kind == "or":
        return ("or", [_shortest(t) for t in tree[1]])
    if kind == "many":
        _, part, least, _ = tree
        return ("cat", [part] * (least - 1) + [_shortest(part)]) if least else ("cat", [])
    return tree


class _Steps:
    """The nondeterministic automaton: free steps and steps on byte sets."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.on: list[list[tuple[int, int]]] = []

    def new(self) -> int:
        self.free.append([])
        self.on.append([])
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """Lay ``tree`` out from ``start``; the state where it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.new()
            self.on[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "or":
            end = self.new()
            for part in tree[1]:
                begin = self.new()
                self.free[start].append(begin)
                self.free[self.add(part, begin)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        end = self.new()
        self.free[start].append(end)
        if most is None:
            loop = self.new()
            self.free[start].append(loop)
            back = self.add(part, loop)
            self.free[back] += [loop, end]
        else:
            for _ in range(most - least):
                start = self.add(part, start)
                self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, left = set(states), list(states)
        while left:
            for s in self.free[left.pop()]:
                if s not in seen:
                    seen.add(s)
                    left.append(s)
        return frozenset(seen)


class Automaton:
    """The minimal automaton of ``patterns``, pairs of (pattern, any_case).

    ``table[state, class]`` is the next state, ``classes[byte]`` the class of a
    byte, ``accept[state]`` a bit for each pattern that matches there. State 0
    is the start. ``dead``: the state that nothing leaves and that accepts
    nothing, or -1. ``resets``: bytes after which every state is the start.
    """

    def __init__(self, patterns: list[tuple[str, bool]], anywhere: bool = False):
        steps = _Steps()
        begin = steps.new()
        trees = [_Reader(p, any_case).read() for p, any_case in patterns]
        ends = [steps.add(_shortest(t) if anywhere else t, begin) for t in trees]
        masks = sorted({m for on in steps.on for m, _ in on})
        kinds: dict[tuple, int] = {}
        self.classes = np.zeros(256, np.uint8)
        for b in range(256):
            self.classes[b] = kinds.setdefault(tuple(m >> b & 1 for m in masks), len(kinds))
        bits = dict(zip(masks, zip(*kinds))) if masks else {}
        n = len(kinds)
        first = steps.closure([begin])
        number, order, rows = {first: 0}, [first], []
        for own in order:  # grows while it is read
            to: list[set[int]] = [set() for _ in range(n)]
            for s in own:
                for mask, target in steps.on[s]:
                    for c, bit in enumerate(bits[mask]):
                        if bit:
                            to[c].add(target)
            row = []
            for targets in to:
                nxt = steps.closure(targets | ({begin} if anywhere else set()))
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                    if len(order) > MOST_STATES:
                        raise ValueError("the patterns need too many states together; count lengths after the match instead")
                row.append(number[nxt])
            rows.append(row)
        table = np.array(rows, np.int64)
        accept = np.array([sum(1 << k for k, end in enumerate(ends) if end in own) for own in order], np.int64)
        self.table, self.accept = self._least(table, accept)
        same = (self.table == np.arange(len(self.table))[:, None]).all(axis=1) & (self.accept == 0)
        self.dead = int(np.flatnonzero(same)[0]) if same.any() else -1
        self.resets = (self.table == 0).all(axis=0)[self.classes]

    @staticmethod
    def _least(table: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge states that no input tells apart: blocks are split by the
        blocks of their successors until none splits any more."""
        _, block = np.unique(accept, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack((block, block[table])), axis=0, return_inverse=True)
            finer = finer.reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        # Number the blocks so that the start is 0.
        _, first = np.unique(block, return_index=True)
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(first, kind="stable")] = np.arange(len(first))
        block = rank[block]
        chosen = np.sort(first)
        return block[table[chosen]], accept[chosen]

    def ends(self, data: np.ndarray, lanes: int = 8192) -> tuple[np.ndarray, np.ndarray]:
        """Positions after which some pattern has just matched, ascending, and
        the bits of the patterns. One pass over the bytes: the data are cut behind
        reset bytes into lanes, which all start afresh and advance together."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = self.table.shape[1]
        table = (self.table * width).astype(np.int32).ravel()
        marks = np.flatnonzero(self.resets[data]) + 1
        goals = np.arange(0, n, max(64, n // lanes))
        at = np.searchsorted(marks, goals[1:])
        starts = np.unique(np.concatenate(([0], marks[at[at < len(marks)]])))
        starts = starts[starts < n]
        sizes = np.diff(np.append(starts, n))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        live = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left").tolist()
        column = self.classes[data]
        state = np.zeros(len(starts), np.int32)
        flags = np.zeros(len(table), bool)
        flags[::width] = self.accept != 0
        where, what = [], []
        for i, k in enumerate(live):
            if k != len(state):
                state, starts = state[:k], starts[:k]
            state = table.take(state + column.take(starts + i))
            hit = flags.take(state)
            if hit.any():
                where.append(starts[hit] + i + 1)
                what.append(self.accept[state[hit] // width])
        if not where:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where, what = np.concatenate(where), np.concatenate(what)
        order = np.argsort(where, kind="stable")
        return where[order], what[order]

    def longest(self, data: bytes, start: int, stop: int) -> int:
        """End of the longest match that begins at ``start``, or -1."""
        table, classes, accept = self._lists()
        state, end = 0, start if accept[0] else -1
        for i in range(start, stop):
            state = table[state][classes[data[i]]]
            if state == self.dead:
                break
            if accept[state]:
                end = i + 1
        return end

    def _lists(self):
        if not hasattr(self, "_plain"):
            self._plain = self.table.tolist(), self.classes.tolist(), self.accept.tolist()
        return self._plain

    def first_bytes(self) -> np.ndarray:
        """Bytes that a match can begin with."""
        return (self.table[0] != self.dead)[self.classes]

    def matches(self, data: bytes, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """Leftmost longest matches in a stretch, none overlapping another."""
        begins = np.flatnonzero(self.first_bytes()[np.frombuffer(data, np.uint8, stop - start, start)]) + start
        free = start
        for s in begins.tolist():
            if s >= free:
                end = self.longest(data, s, stop)
                if end > s:
                    yield s, end
                    free = end
