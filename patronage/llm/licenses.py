"""License scans by patience alignment.

Every word of the text that a template has may start a copy, so a window as long
as a match may be starts at each, as far as its words hold a common subsequence
with the template that is long enough (its length comes from bit rows).  In a
window the words that occur once in the window and once in the template are
anchors; the longest increasing subsequence of their places keeps those in
order, and the gaps between them are aligned in the same way, equal words next
to an anchor first.  Where this aligns fewer words than the longest common
subsequence has (repeated words), that subsequence is taken.  Coverage is the
share of the template's words that are aligned; a window that reaches
``coverage`` is a match.  Its length is ``spread`` times the template's, so
aligned words are not spread over more than that, and any copy within it lies
whole in the window that starts with its first word.  The best match is taken out, and what
windows hold beside it is aligned again, so copies in a row are all found.

A template is looked for only in a document that holds one of its rarest words
(so many that a text without all of them can't reach the coverage) and, in any
order, as many of its words as the coverage needs.  That loses nothing.

Words are runs without white space, lower-cased, without punctuation at the ends.

Defined cases: null or empty text has no matches; repeated rows are rows of
their own; an empty table gives an empty result; of overlapping matches the
one of greater coverage stays, then the one that aligns more words, then the
one whose window starts first.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import column, slices, text_of
from .license_texts import NOTICES

# Notices as their licences word them.
TEMPLATES: dict[str, str] = NOTICES | {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied."),
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"),
}

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_PUNCTUATION = "\"'()[]{}<>,;:!?.*#/"

Pair = tuple[int, int]


def plain(word: str) -> str:
    return word.lower().strip(_PUNCTUATION)


def _increasing(pairs: list[Pair]) -> list[Pair]:
    """The longest subsequence of pairs, sorted by the second, whose first rises."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (t, _) in enumerate(pairs):
        at = bisect_left(tops, t)
        tops[at:at + 1] = [t]
        ends[at:at + 1] = [k]
        back.append(ends[at - 1] if at else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[Pair]:
    """Aligned (place in text, place in template) pairs, both rising."""
    out: list[Pair] = []
    todo = [(0, len(text), 0, len(template), False, False)]
    while todo:
        a, b, c, d, left, right = todo.pop()  # left, right: there is an anchor on that side
        while left and a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while right and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(text[a:b], a) if here[w] == 1}
        anchors = _increasing([(place[w], k) for k, w in enumerate(template[c:d], c) if there[w] == 1 and w in place])
        if anchors:
            out += anchors
            for k, ((t0, p0), (t1, p1)) in enumerate(zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)])):
                todo.append((t0 + 1, t1, p0 + 1, p1, left or k > 0, right or k < len(anchors)))
    return sorted(out)


def _rows(text: Sequence[str], template: Sequence[str]) -> Iterator[int]:
    """After each word of the text, a number whose zero bits are the places of the
    template at which the longest common subsequence grows."""
    places: dict[str, int] = {}
    for k, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << k
    row = full = (1 << len(template)) - 1
    for w in text:
        if hit := row & places.get(w, 0):
            row = (row + hit | row - hit) & full
        yield row


def common_length(text: Sequence[str], template: Sequence[str]) -> int:
    """The length of the longest common subsequence."""
    row = (1 << len(template)) - 1
    for row in _rows(text, template):
        pass
    return len(template) - row.bit_count()


def longest(text: Sequence[str], template: Sequence[str]) -> list[Pair]:
    """The pairs of a longest common subsequence, the one that ends first."""
    rows, out = list(_rows(text, template)), []
    t, p = len(text), len(template)
    while t and p:
        if rows[t - 1] >> p - 1 & 1:
            p -= 1
        elif t > 1 and not rows[t - 2] >> p - 1 & 1:
            t -= 1
        else:
            t, p = t - 1, p - 1
            out.append((t, p))
    return out[::-1]


def best(text: Sequence[str], template: Sequence[str], length: int) -> list[Pair]:
    """``align``, or the longest common subsequence, of ``length``, if that has more."""
    found = align(text, template)
    return found if len(found) >= length else longest(text, template)


@dataclass
class Template:
    name: str
    words: list[str]
    needed: int  # words that must be aligned
    rare: list[bytes]  # one of these is in any text that has them
    counts: dict[bytes, int]  # how often it has each word

    @classmethod
    def of(cls, name: str, text: str, coverage: float, common: Counter) -> Template:
        words = [w for w in map(plain, text.split()) if w]
        needed = max(1, -int(-coverage * len(words) // 1))
        by_rarity = sorted(words, key=lambda w: (common[w], -len(w), w))
        return cls(name, words, needed, [w.encode() for w in dict.fromkeys(by_rarity[:len(words) - needed + 1])],
                   Counter(w.encode() for w in words))


def templates(texts: dict[str, str], coverage: float) -> list[Template]:
    common = Counter(w for t in texts.values() for w in {plain(x) for x in t.split()})
    common.update({w: 1000 - 100 * len(w) for w in common if len(w) < 4})  # short words are common in any text
    return [Template.of(n, t, coverage, common) for n, t in sorted(texts.items())]


def by_rare_word(wanted: list[Template]) -> dict[bytes, list[int]]:
    out: dict[bytes, list[int]] = {}
    for k, t in enumerate(wanted):
        for w in t.rare:
            out.setdefault(w, []).append(k)
    return out


def possible(text: bytes, wanted: list[Template], rare: dict[bytes, list[int]]) -> list[Template]:
    """The templates that a text has words enough for."""
    low = text.lower() if text.isascii() else str(text, "utf-8").lower().encode()
    words = {w.strip(_PUNCTUATION.encode()) for w in set(low.split())}
    some = sorted({k for w in words & rare.keys() for k in rare[w]})
    return [t for t in (wanted[k] for k in some)
            if sum(t.counts[w] for w in t.counts.keys() & words) >= t.needed]


Match = tuple[str, int, int, float]  # name, start, end, coverage


def matches(text: str, wanted: list[Template], spread: float) -> list[Match]:
    """Matches in a text, by start."""
    spans = [m.span() for m in _WORD.finditer(text)]
    words = [plain(text[a:b]) for a, b in spans]
    # windows, best first: share and length of the common subsequence, start, end and template
    heap: list[tuple[float, int, int, int, int]] = []

    def offer(start: int, end: int, which: int) -> None:
        t = wanted[which]
        length = common_length(words[start:end], t.words)
        if length >= t.needed:
            heappush(heap, (-length / len(t.words), -length, start, end, which))

    for which, t in enumerate(wanted):
        own, reach = set(t.words), ceil(spread * len(t.words))
        hits = [k for k, w in enumerate(words) if w in own]
        for start, least in zip(hits, hits[t.needed - 1:]):  # where the needed words can be at the earliest
            if least - start < reach:
                offer(start, min(len(words), start + reach), which)
    taken: list[tuple[int, int]] = []
    out: list[Match] = []
    while heap:
        share, length, start, end, which = heappop(heap)
        k = bisect_left(taken, (start + 1,))
        if k and taken[k - 1][1] >= start:
            continue
        if k < len(taken) and taken[k][0] < end:
            offer(start, taken[k][0], which)
            continue
        t = wanted[which]
        pairs = best(words[start:end], t.words, -length)
        first, last = start + pairs[0][0], start + pairs[-1][0]
        taken.insert(k, (first, last))
        out.append((t.name, spans[first][0], spans[last][1], -share))
    return sorted(out, key=lambda m: m[1:])


MATCHES = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("coverage", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("coverage", pa.float64())]))


def scan(docs: DataFrame, texts: dict[str, str] = TEMPLATES, coverage: float = 0.8, spread: float = 1.5,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and matches (license, start, end, coverage), by start."""
    source = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("_text"))
    wanted = templates(texts, coverage)
    rare = by_rare_word(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in slices(batches, "_text"):
            out = []
            for t in raw:
                own = possible(t, wanted, rare)
                out.append(matches(str(t, "utf-8"), own, spread) if own else [])
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, _ARROW)], ["doc_id", "matches"])

    return source.mapInArrow(run, T.StructType([source.schema.fields[0], T.StructField("matches", MATCHES)]))
