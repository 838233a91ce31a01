"""Periodic runs of words by a sparse diagonal dynamic programme.

A run is a stretch of words with smallest period q, of at least
``max(least, times * q)`` words (``times`` is 3 or more), that neither
neighbouring word extends.  On the diagonal of lag q a cell is a word that
equals the word q before it; a run of n words is n - q such cells in a row.

1. A word adds a cell to a diagonal through its earlier occurrences.  Of these
   a run needs one for each scale: a run whose lag lies in [g/2, g) has more
   than g cells, and of the g words from a cell on the nearest earlier
   occurrence lies just q before (g words of a stretch whose smallest period is
   q <= g recur in it at multiples of q only).  So a word touches one lag a
   scale at most, and a frequent word, or a text of one word, costs no more
   than any other.
2. The words from a place on are named scale by scale, two names of one scale
   making one of the next.  Places whose name occurs once leave: longer names
   that begin there occur once, too.
3. The match length of a lag grows while place after place has that lag; when
   it ends with enough cells its run is emitted.  Lengths are counted with
   vector operations over a slice of documents, each of them whole.  A diagonal
   of a multiple of the smallest period is never touched, since nearer
   occurrences hide it.

Work is n log n in a slice at worst; a slice is about ``common.text_slices``'s
size or one document.  Nothing is shuffled.

Defined cases: null or empty text, or text without words, has no run and an
empty collapsed text; null ids stay null; repeated rows are rows of their own;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, slices, text_of

RUNS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType())])
_ARROW_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names 0.. of equal keys, and for each place the nearest earlier place
    with its key (-1: none)."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    new = np.ones(len(held), bool)
    new[1:] = held[1:] != held[:-1]
    names, before = np.empty(len(keys), np.int64), np.full(len(keys), -1)
    names[order] = np.cumsum(new) - 1
    before[order[1:]] = np.where(new[1:], -1, order[:-1])
    return names, before


def find(words: np.ndarray, ends: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Runs of documents that lie one after another: ``words`` are numbers, equal
    for equal words, ``ends`` the documents' ends.  Rows (start, length, period),
    by start, then period; starts count from the first document."""
    if times < 3:
        raise ValueError("a run holds its period three times or more")
    n = len(words)
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    end = np.repeat(ends, sizes)
    # a name holds its document, so no name occurs in two
    names, _ = _named(doc * (int(words.max(initial=0)) + 1) + words)
    at, scale, out = np.arange(n), 1, []
    while len(at):
        # name the 2 * scale words from each place on
        whole = at + 2 * scale <= end[at]
        place = np.full(n, -1)
        place[at] = names
        at = at[whole]
        right = place[at + scale]
        at, left, right = at[right >= 0], place[at[right >= 0]], right[right >= 0]
        scale *= 2
        names, before = _named(left * (n + 1) + right)
        lag = np.where(before >= 0, at - at[before], 0)
        out.append(_ended(words, ends, doc, at, lag, scale, least, times))
        # places whose name occurs once can't begin a longer match
        again = np.bincount(names, minlength=1)[names] > 1 if len(names) else np.zeros(0, bool)
        at, names = at[again], names[again]
    runs = np.concatenate([np.zeros((0, 3), np.int64), *out])
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _ended(words: np.ndarray, ends: np.ndarray, doc: np.ndarray, at: np.ndarray, lag: np.ndarray, scale: int,
           least: int, times: int) -> np.ndarray:
    """The diagonals of a scale that ended with enough cells."""
    mine = (lag >= scale // 2) & (lag < scale)
    at, lag = at[mine], lag[mine]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    cells = np.diff(np.append(first, len(at))) + scale - 1
    at, lag = at[first], lag[first]
    enough = cells + lag >= np.maximum(least, times * lag)
    at, lag, cells = at[enough], lag[enough], cells[enough]
    # a diagonal that was left for a nearer occurrence and goes on is no run of this lag
    begin = np.where(doc > 0, ends[doc - 1], 0)[at] if len(at) else at
    stop = ends[doc[at]]
    after = np.minimum(at + cells, len(words) - 1)
    open_left = (at - lag > begin) & (words[at - 1] == words[at - 1 - lag])
    open_right = (at + cells < stop) & (words[after] == words[after - lag])
    own = ~(open_left | open_right)
    return np.stack([at - lag, cells + lag, lag], axis=1)[own]


def collapse(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) == 0


def detect(docs: DataFrame, least: int = 6, times: int = 4,
           edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period in words,
    by start, then period) and ``collapsed``, the words outside repeats joined by a
    space.  ``edit`` may change a document's words first; it gets the id and the words."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs[text_col]).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            ids = column(batch, "doc_id")
            held = [t.split() for t in texts]
            if edit is not None:
                held = [edit(i, w) for i, w in zip(ids.to_pylist(), held)]
            sizes = np.array([len(w) for w in held], np.int64)
            ends = np.cumsum(sizes)
            coded = pa.array([w for own in held for w in own], pa.large_binary()).dictionary_encode().indices
            found = find(coded.to_numpy(zero_copy_only=False).astype(np.int64), ends, least, times)
            begins = ends - sizes
            cuts = np.searchsorted(found[:, 0], np.append(begins, ends[-1]))
            found[:, 0] -= np.repeat(begins, np.diff(cuts))
            collapsed = []
            for k, own in enumerate(held):
                if cuts[k] < cuts[k + 1]:
                    own = compress(own, collapse(len(own), found[cuts[k]:cuts[k + 1]]).tolist())
                collapsed.append(str(b" ".join(own), "utf-8"))
            runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(found[:, c]) for c in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), runs.cast(_ARROW_RUNS), pa.array(collapsed)],
                                             ["doc_id", "n_words", "runs", "collapsed"])

    return source.mapInArrow(run, RUNS)


def longest(runs: str) -> Column:
    """The run of greatest length (ties: smallest start, then period), or null."""
    rank = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    best = F.array_min(rank)
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), (-best["less"]).alias("length"),
                                             best["period"].alias("period")))


def run_lines(runs: str) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
