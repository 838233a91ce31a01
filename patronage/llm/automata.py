"""Probabilistic automata learnt from example strings by state merging.

The examples form a prefix tree with counts.  From the root outwards a state is
merged with the first settled state that it agrees with: the shares of strings
that end and of each next character, there and below, differ by no more than
Hoeffding's bound allows at level ``alpha``.  States that agree with none are
settled themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log, sqrt

import numpy as np

_FLOOR = -9.0  # log probability of a character that a state has not seen


class _State:
    __slots__ = ("n", "ends", "to")

    def __init__(self) -> None:
        self.n, self.ends, self.to = 0, 0, {}


def _prefix_tree(examples: Sequence[bytes]) -> _State:
    root = _State()
    for word in examples:
        state = root
        state.n += 1
        for c in word:
            state = state.to.setdefault(c, _State())
            state.n += 1
        state.ends += 1
    return root


def _agree(a: _State, b: _State, bound: float) -> bool:
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        most = bound * (1 / sqrt(x.n) + 1 / sqrt(y.n))
        if abs(x.ends / x.n - y.ends / y.n) > most:
            return False
        for c in x.to.keys() | y.to.keys():
            u, v = x.to.get(c), y.to.get(c)
            if abs((u.n if u else 0) / x.n - (v.n if v else 0) / y.n) > most:
                return False
            if u and v and u is not v and min(u.n, v.n) > 1:
                todo.append((u, v))
    return True


def _fold(into: _State, tree: _State) -> None:
    todo = [(into, tree)]
    while todo:
        x, y = todo.pop()
        x.n += y.n
        x.ends += y.ends
        for c, v in y.to.items():
            u = x.to.get(c)
            if u is None:
                x.to[c] = v
            else:
                todo.append((u, v))


class Automaton:
    """States with log probabilities of each next byte and of the end."""

    def __init__(self, examples: Sequence[bytes], alpha: float = 0.05):
        bound = sqrt(0.5 * log(2 / alpha))
        root = _prefix_tree(examples)
        settled, is_settled = [root], {id(root)}
        while True:
            open_ = [(s.to[c].n, -k, -c, s, c) for k, s in enumerate(settled) for c in s.to
                     if id(s.to[c]) not in is_settled]
            if not open_:
                break
            *_, parent, c = max(open_, key=lambda x: x[:3])
            state = parent.to[c]
            match = next((s for s in settled if _agree(s, state, bound)), None)
            if match is None:
                settled.append(state)
                is_settled.add(id(state))
            else:
                parent.to[c] = match
                _fold(match, state)
        number = {id(s): k for k, s in enumerate(settled)}
        self.next = np.tile(np.arange(len(settled))[:, None], (1, 256))  # an unseen byte stays
        for k, s in enumerate(settled):
            for c, to in s.to.items():
                self.next[k, c] = number[id(to)]
        self._count(examples)

    def _count(self, examples: Sequence[bytes]) -> None:
        """Probabilities from the paths of the examples through the merged states."""
        seen, ends = np.zeros(self.next.shape), np.zeros(len(self.next))
        for word in examples:
            state = 0
            for c in word:
                seen[state, c] += 1
                state = self.next[state, c]
            ends[state] += 1
        whole = np.maximum(1, seen.sum(axis=1) + ends)
        with np.errstate(divide="ignore"):
            self.log = np.maximum(_FLOOR, np.log(seen / whole[:, None]))
            self.stop = np.maximum(_FLOOR, np.log(ends / whole))

    def __len__(self) -> int:
        return len(self.next)

    def score(self, words: Sequence[bytes]) -> np.ndarray:
        """Log probability of each word, many at a time, one byte of each per step."""
        n = len(words)
        total = np.zeros(n)
        if not n:
            return total
        size = np.fromiter(map(len, words), np.int64, n)
        text, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")  # the words that go on are a prefix
        state, longest = np.zeros(n, np.int64), size[order]
        for step in range(int(size.max())):
            live = int(np.searchsorted(-longest, -step, "left"))
            c, s = text[start[order[:live]] + step], state[:live]
            total[order[:live]] += self.log[s, c]
            state[:live] = self.next[s, c]
        total[order] += self.stop[state]
        return total
