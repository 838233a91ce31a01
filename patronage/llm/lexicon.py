"""Minimal acyclic transducer over frequent words, with id outputs.

Words in byte order are added one after another; states that no later word can
change are merged with equal ones, so common suffixes are stored once.  An edge
carries the number of words before it: the sum along a word's path is its
place among all words, which finds its ids.  The arrays lie in one file that
every process maps into memory; many words are looked up at once, one byte of
each per step.
"""

from __future__ import annotations

import mmap
from collections.abc import Sequence

import numpy as np

_MAGIC = b"LEXICON1"
_KINDS = (np.int64, np.int32, np.int32, np.uint8, np.int32, np.int32)


def compile_lexicon(entries: dict[bytes, Sequence[int]]) -> bytes:
    """File content for a map of words to ids."""
    words = sorted(entries)
    edges: list[list[tuple[int, int]]] = [[]]  # state -> (byte, state), in byte order
    final = bytearray(1)
    known: dict[tuple, int] = {}
    path = [0]  # states of the last word

    def settle(depth: int) -> None:
        """Merge the states of the last word that lie deeper than ``depth``."""
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], *edges[state])
            same = known.setdefault(key, state)
            if same != state:
                label, _ = edges[path[-1]][-1]
                edges[path[-1]][-1] = (label, same)

    last = b""
    for word in words:
        shared = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        settle(shared)
        for label in word[shared:]:
            edges.append([])
            final.append(0)
            edges[path[-1]].append((label, len(edges) - 1))
            path.append(len(edges) - 1)
        final[path[-1]] = 1
        last = word
    settle(0)

    number, order, stack = {0: 0}, [0], [0]  # states in use, renumbered
    while stack:
        for _, to in edges[stack.pop()]:
            if to not in number:
                number[to] = len(order)
                order.append(to)
                stack.append(to)
    below: dict[int, int] = {}  # words that end at a state or below it

    def count(root: int) -> None:
        todo = [root]
        while todo:
            state = todo[-1]
            missing = [to for _, to in edges[state] if to not in below]
            if missing:
                todo += missing
            else:
                below[state] = final[state] + sum(below[to] for _, to in edges[state])
                todo.pop()

    count(0)
    keys, targets, outputs = [], [], []
    for state in order:
        before = final[state]
        for label, to in edges[state]:
            keys.append(number[state] << 8 | label)
            targets.append(number[to])
            outputs.append(before)
            before += below[to]
    ids = [entries[w] for w in words]
    arrays = [keys, targets, outputs, [final[s] for s in order], np.cumsum([0, *map(len, ids)]),
              [i for part in ids for i in part]]
    parts = [np.asarray(a, kind) for a, kind in zip(arrays, _KINDS)]
    head = _MAGIC + np.array([len(p) for p in parts], np.int64).tobytes()
    return head + b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)


class Lexicon:
    """A compiled lexicon, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self._map[:8] != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        sizes, at, parts = np.frombuffer(self._map, np.int64, len(_KINDS), 8), 8 + 8 * len(_KINDS), []
        for n, kind in zip(sizes.tolist(), _KINDS):
            parts.append(np.frombuffer(self._map, kind, n, at))
            at += -(-parts[-1].nbytes // 8) * 8
        self.keys, self.targets, self.outputs, self.final, self.starts, self.ids = parts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def places(self, words: Sequence[bytes]) -> np.ndarray:
        """The place of each word among the lexicon's words, or -1."""
        n = len(words)
        place = np.full(n, -1, np.int64)
        if not n or not len(self):
            return place
        length = np.fromiter(map(len, words), np.int64, n)
        text = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(length) - length
        at, state, total, step = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        while len(at):
            ended = length[at] == step
            if ended.any():
                hit = ended & (self.final[state] == 1)
                place[at[hit]] = total[hit]
                at, state, total = at[~ended], state[~ended], total[~ended]
            if not len(at) or not len(self.keys):
                break
            key = state << 8 | text[start[at] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            live = self.keys[edge] == key
            at, edge = at[live], edge[live]
            state, total = self.targets[edge].astype(np.int64), total[live] + self.outputs[edge]
            step += 1
        return place

    def at(self, place: int) -> list[int]:
        return self.ids[self.starts[place]:self.starts[place + 1]].tolist()
