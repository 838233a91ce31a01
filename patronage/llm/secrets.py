"""Secret scans by grammar inference.

1. Base: patterns of assignments, access keys and hexadecimal runs over whole
   texts.  Runs of credential characters outside base spans are candidates, and
   so are the values in them: what is left between '=', then '/', '.', '_' and
   '-', and what follows each of these, if ``shortest`` characters or longer.
2. Credentials that base spans hold are the labelled examples.  Of the distinct
   ones of each kind, and of the runs and the shortest values in them with and
   without a digit as backgrounds (words would crowd out numbers in one),
   ``examples`` at most (the least by hash) go to the driver, where prefix-tree states that agree are
   merged into one probabilistic automaton each (``automata``).
3. The text is read again and every candidate is scored: it is of the kind whose
   automaton finds it likeliest if it is as likely per character as all but a
   share ``miss`` of examples kept out of the learning, and its odds against
   either background automaton are over ``odds``.  Of overlapping ones that
   farthest over the least likelihood becomes a span, then the longest, then the
   first.

Defined cases: null text counts as empty and has no spans; a kind without
``fewest`` examples adds none (few are learnt from all, and held against
themselves); examples over 256 characters teach nothing; what follows a cut is
a candidate of its own up to 256 characters, what lies between cuts at any length;
repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .automata import Automaton
from .common import ARROW_SPANS, SPANS, packed, slices, text_of

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a shorter run fails, so only these need be found
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
_DIGIT = re.compile(b"[0-9]")
_CUT = re.compile(r"[=/._-]")
_CUTS = tuple(map(re.compile, ("=(?=[^=])", "/", r"\.", "_", "-")))  # "=" at the end of a value pads it
_LONGEST = 256  # characters of an example, and of a value that goes on behind further cuts


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, credential), by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(0, *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(1, *m.span(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(2, *m.span(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def values(run: str, shortest: int) -> dict[tuple[int, int], int]:
    """(start, end) of the run and of the values in it: -1 for the run and what lies
    between any cuts, which teach the background, -2 for the others: a value that
    taught in every form would count as ordinary."""
    whole = (len(run) - len(run.lstrip("=/._-")), len(run.rstrip("/._-")))
    out = {(0, len(run)), whole,
           *((m.end(), whole[1]) for m in _CUT.finditer(run, max(0, whole[1] - _LONGEST - 1), whole[1]))}
    parts = [whole]
    for cut in _CUTS:
        finer = []
        for a, b in parts:
            for m in cut.finditer(run, a, b):
                finer.append((a, m.start()))
                a = m.end()
            finer.append((a, b))
        parts = [p for p in finer if p[1] - p[0] >= shortest]
        out.update(parts)
    teach = {(0, len(run)), *parts}
    return {(a, b): -1 if (a, b) in teach else -2 for a, b in sorted(out) if b - a >= shortest}


def candidates(text: str, taken: list[tuple[int, int, int, str]], shortest: int) -> list[tuple[int, int, int, str]]:
    """(-1 or -2, start, end, value) of the runs outside base spans and of the values in them."""
    out, at = [], 0
    for start, end in [*sorted((s[1], s[2]) for s in taken), (len(text), len(text))]:
        for m in _RUN.finditer(text, at, max(at, start)):
            first, run = m.start(), m[0]
            if len(run) < shortest:
                continue
            if _CUT.search(run):
                out += [(k, first + a, first + b, run[a:b]) for (a, b), k in values(run, shortest).items()]
            else:
                out.append((-1, first, m.end(), run))
        at = max(at, end)
    return out


def findings(docs: DataFrame, text_col: str, shortest: int) -> DataFrame:
    """The kind (-1: background) and value of what may teach, a value once per slice of rows at least."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "_text"):
            seen = set()
            for t in texts:
                text = str(t, "utf-8")
                base = base_spans(text)
                seen.update((s[0], s[3]) for s in base + candidates(text, base, shortest)
                            if s[0] > -2 and len(s[3]) <= _LONGEST)
            kinds, own = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(own, pa.string())], ["kind", "value"])

    return docs.select(text_of(docs[text_col]).alias("_text")).mapInArrow(run, "kind int, value string")


_APART = 20  # examples of a kind from which on a fifth is kept out of the learning


class Grammars:
    """An automaton and a least likelihood per kind, and the backgrounds."""

    def __init__(self, examples: dict[int, list[bytes]], background: list[bytes], fewest: int, miss: float,
                 alpha: float, odds: float = 1000.0):
        self.kinds: dict[int, tuple[Automaton, float]] = {}
        for kind, words in sorted(examples.items()):
            if len(words) >= fewest:
                held, taught = words[::5], [w for k, w in enumerate(words) if k % 5]
                if len(words) < _APART:
                    held = taught = words
                automaton = Automaton(taught, alpha)
                per_byte = automaton.score(held) / [len(w) + 1 for w in held]
                self.kinds[kind] = automaton, float(np.quantile(per_byte, miss))
        while True:  # until no word of the background is a secret: what is found must not count as ordinary
            parts = [[w for w in background if bool(_DIGIT.search(w)) == digit] for digit in (True, False)]
            self.backgrounds = [Automaton(p, alpha) for p in parts if p] or [Automaton([b"0"], alpha)]
            ordinary = [w for w, k in zip(background, self.judge(background, odds).tolist()) if k < 0]
            if len(ordinary) in (0, len(background)):
                break
            background = ordinary

    def gains(self, words: list[bytes], odds: float) -> tuple[np.ndarray, np.ndarray]:
        """The kind of each word, or -1, and by how much it is likelier than that kind's least."""
        out, best, margin = np.full(len(words), -1), np.full(len(words), log(odds)), np.zeros(len(words))
        if words and self.kinds:
            size = np.array([len(w) + 1 for w in words])
            ordinary = np.max([b.score(words) for b in self.backgrounds], axis=0)
            for kind, (automaton, least) in self.kinds.items():
                own = automaton.score(words)
                better = (own / size >= least) & (own - ordinary > best)
                out[better], best[better] = kind, (own - ordinary)[better]
                margin[better] = (own - size * least)[better]
        return out, margin

    def judge(self, words: list[bytes], odds: float) -> np.ndarray:
        """The kind of each word, or -1."""
        return self.gains(words, odds)[0]


def _sample(values: DataFrame, most: int) -> list[bytes]:
    """At most ``most`` distinct values, the least by hash."""
    picked = values.distinct().orderBy(F.xxhash64("value"), "value").limit(most).collect()
    return [r[0].encode() for r in picked]


def learn(found: DataFrame, examples: int, fewest: int, miss: float, alpha: float, odds: float) -> Grammars:
    own = {k: _sample(found.where(F.col("kind") == k).select("value"), examples) for k in range(len(KINDS))}
    others, digit = found.where(F.col("kind") < 0).select("value"), F.col("value").rlike("[0-9]")
    ordinary = [w for part in (digit, ~digit) for w in _sample(others.where(part), examples)]
    return Grammars(own, ordinary, fewest, miss, alpha, odds)


def all_spans(base: list[list[tuple]], runs: list[list[tuple]], grammars: Grammars,
              odds: float) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, base) of each document, by start and kind."""
    words = list({r[3]: None for own in runs for r in own})
    kinds, gains = grammars.gains([w.encode() for w in words], odds)
    secret = {words[k]: (int(kinds[k]), float(gains[k])) for k in np.flatnonzero(kinds >= 0)}
    out = []
    for found, own in zip(base, runs):
        spans = [(k, a, b, True) for k, a, b, _ in found]
        taken: list[tuple[int, int]] = []
        for _, _, a, b, kind in sorted((-secret[w][1], a - b, a, b, secret[w][0]) for _, a, b, w in own if w in secret):
            k = bisect_left(taken, (a, b))
            if (not k or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b):
                taken.insert(k, (a, b))
                spans.append((kind, a, b, False))
        out.append(sorted(spans, key=lambda s: (s[1], s[0])))
    return out


def _spans_of(rows: DataFrame, grammars: Grammars, shortest: int, odds: float) -> DataFrame:
    """``rows`` with ``_spans`` for _text, its last column, in one step."""
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_spans", SPANS)])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            whole = [str(t, "utf-8") for t in texts]
            base = [base_spans(t) for t in whole]
            runs = [candidates(t, b, shortest) for t, b in zip(whole, base)]
            spans = pa.array(all_spans(base, runs, grammars, odds), ARROW_SPANS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], spans], names)

    return rows.mapInArrow(run, schema)


def _learnt(docs: DataFrame, text_col: str, shortest: int, examples: int, fewest: int, miss: float,
            alpha: float, odds: float) -> Grammars:
    return learn(materialize(findings(docs, text_col, shortest), "secrets-found"), examples, fewest, miss, alpha, odds)


def scan(docs: DataFrame, shortest: int = 8, examples: int = 1000, fewest: int = 1, miss: float = 0.02,
         alpha: float = 0.05, odds: float = 1000.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and _spans (kind, start, end, base), by start and kind."""
    learnt = _learnt(docs, text_col, shortest, examples, fewest, miss, alpha, odds)
    return _spans_of(docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("_text")),
                     learnt, shortest, odds)


def redacted(docs: DataFrame, shortest: int = 8, examples: int = 1000, fewest: int = 1, miss: float = 0.02,
             alpha: float = 0.05, odds: float = 1000.0, text_col: str = "text",
             length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with each span of the text replaced by [kind], and
    ``length_col`` set to the new length where a text changed."""
    learnt = _learnt(docs, text_col, shortest, examples, fewest, miss, alpha, odds)
    rows = _spans_of(docs.select(packed(docs), text_of(docs[text_col]).alias("_text")), learnt, shortest, odds)
    text, names = F.col("_row")[text_col], F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        cut = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        fresh = s["start"] >= done["at"]  # else it overlaps what is replaced already
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, F.concat(
            done["out"], cut, F.element_at(names, s["kind"] + 1))).otherwise(done["out"]).alias("out"))

    hit = F.size("_spans") > 0
    clean = F.when(hit, F.aggregate("_spans", start, step, lambda done: F.concat(
        done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))).otherwise(text)
    rows = rows.select("_row", hit.alias("_hit"), clean.alias("_clean"))

    def value(c: str) -> Column:
        old = F.col("_row")[c]
        if c == text_col:
            return F.col("_clean").alias(c)
        if c == length_col:
            return F.when(F.col("_hit"), F.length("_clean").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)

    return rows.select(*[value(c) for c in docs.columns])
