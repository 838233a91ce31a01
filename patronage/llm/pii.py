"""Personal data by a skip-chain conditional random field.

1. Base: e-mail addresses, IP addresses, payment cards and phone numbers by
   pattern, over whole texts, in one pass.  Words with a digit or an @ are the
   field's variables; every other word is no entity for certain, so leaving it
   out loses nothing.  Their features and links are staged.
2. Links: neighbouring variables form a chain; variables with the same digits
   (``_LEAST_DIGITS`` or more) or the same letters are joined by skip links from each
   occurrence to the next and to the first, so a word that occurs n times adds
   fewer than 2 n links.
3. Weights: tasks count, over all documents, how often features and label occur
   together and which labels links hold; the driver gets a row per pattern and
   pair.  Training is piecewise: node weights come from multinomial logistic
   regression on the base labels alone, link potentials from smoothed log ratios
   of label pairs to chance.
4. Inference: words in base spans keep their label; sum-product messages run
   over chain and skip links of some documents at once (about 200,000 variables,
   each document whole) until they settle (at most ``rounds`` times, damped).  Words outside base spans whose
   label is an entity with probability ``sure`` or more are joined with
   neighbours of the same kind.  They become a span if a skip link ties one to
   a base span of that kind, or if together they have the parts of an entity
   (digits of a card or phone, four numbers, or an @ and a domain).

Defined cases: null text counts as empty and has no spans; repeated rows are
rows of their own; an empty table, or one without variables, gives base spans
alone; a word may be of any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import ARROW_SPANS, SPANS, column, slices, text_of

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: no entity
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit behind a digit starts nothing that the first digit of its run doesn't
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_VARIABLE = re.compile(r"[0-9@]")
_SPACE = frozenset(" \t\n\v\f\r")
_REST = re.compile(r"[^\x20\x09-\x0D]*")
_LEAST_DIGITS = 6
_EDGES = "\"'()[]{}<>,;:!?."

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    out = list(_emails(text))
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


FEATURES = 27
_BLOCK = 1 << 16  # links whose messages are computed at once


def _features(word: str) -> int:
    """Features of a word as bits."""
    digits, dots = _digits(word), word.count(".")
    core = word.strip(_EDGES)
    n = len(digits)
    letters = any(c.isalpha() for c in word)
    bits = [True, "@" in word, letters, core.isdigit(), word.startswith("+"), "(" in word or ")" in word,
            "-" in word, core.count(".") == 1, core.count(".") == 2, core.count(".") == 3, dots > 4]
    bits += [low <= n <= high for low, high in
             ((0, 0), (1, 2), (3, 4), (5, 6), (7, 8), (9, 12), (13, 16), (17, 19), (20, len(word)))]
    bits += [any(c.isupper() for c in word), any(c in word for c in "=:\"/"),
             "@" in word and "." in word.rpartition("@")[2], core.count(".") == 3 and n <= 12 and not letters,
             13 <= n <= 19 and not letters and luhn(digits), len(word) >= 24,
             letters and n > 3 and "@" not in word]
    return sum(1 << k for k, b in enumerate(bits) if b)


def variables(text: str, base: list[Span]) -> list[tuple[int, int, int, bool, int, int, int]]:
    """(start, end, label, follows, features, key, digits) of each word with a digit or @;
    ``follows``: the variable before is the word before."""
    label_of = sorted((s, e, k) for k, s, e in base)
    out, at, near, last = [], 0, 0, -1
    while m := _VARIABLE.search(text, at):
        start = m.start()
        while start > at and text[start - 1] not in _SPACE:
            start -= 1
        at = end = _REST.match(text, m.start()).end()
        word = text[start:end]
        while near < len(label_of) and label_of[near][1] <= start:
            near += 1
        label = next((k + 1 for s, e, k in label_of[near:near + LABELS] if s < end and e > start), 0)
        digits = _digits(word)
        key = digits if len(digits) >= _LEAST_DIGITS else word.strip(_EDGES).lower()
        follows = last >= 0 and start - last < 100 and not text[last:start].strip(" \t\n\v\f\r")
        out.append((start, end, label, follows, _features(word), xxhash.xxh64_intdigest(key.encode()) >> 1,
                    len(digits)))
        last = end
    return out


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_VAR = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32()), ("follows", pa.bool_()),
                  ("features", pa.int64()), ("key", pa.int64()), ("digits", pa.int64())])
_FOUND = [
    T.StructField("_base", T.ArrayType(T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())]))),
    T.StructField("_vars", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("label", T.IntegerType()), T.StructField("follows", T.BooleanType()),
        T.StructField("features", T.LongType()), T.StructField("key", T.LongType()),
        T.StructField("digits", T.LongType())]))),
]


def findings(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """The columns of ``keep``, _base and _vars."""
    source = docs.select(*keep, text_of(docs[text_col]).alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], *_FOUND])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            base, own = [], []
            for t in texts:
                text = str(t, "utf-8")
                base.append(base_spans(text))
                own.append(variables(text, base[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(base, pa.list_(_SPAN)),
                                              pa.array(own, pa.list_(_VAR))], names)

    return source.mapInArrow(run, schema)


@dataclass
class Graph:
    """The variables of many documents and the links between them."""

    label: np.ndarray
    features: np.ndarray  # bits
    chain: np.ndarray  # pairs of variables
    skip: np.ndarray

    @classmethod
    def of(cls, doc: np.ndarray, label: np.ndarray, follows: np.ndarray, features: np.ndarray,
           key: np.ndarray) -> Graph:
        n = len(doc)
        at = np.flatnonzero(follows)
        chain = np.stack([at - 1, at], 1)
        order = np.lexsort((np.arange(n), key, doc))
        new = np.ones(n, bool)
        new[1:] = (doc[order[1:]] != doc[order[:-1]]) | (key[order[1:]] != key[order[:-1]])
        first = order[np.maximum.accumulate(np.where(new, np.arange(n), 0))] if n else order
        more = np.flatnonzero(~new)
        before, own, head = order[more - 1], order[more], first[more]
        far = before != head
        skip = np.concatenate([np.stack([before, own], 1), np.stack([head[far], own[far]], 1)])
        return cls(label, features, chain, skip)


def _bits(features: np.ndarray) -> np.ndarray:
    return ((features[:, None] >> np.arange(FEATURES)) & 1).astype(float)


@dataclass
class Counts:
    """What the field learns from: how often features and label occur together, and
    the labels (first, second) that links hold.  A row per pattern of features
    and label, whatever number of documents."""

    features: np.ndarray
    label: np.ndarray
    n: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def of(cls, kind: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Counts:
        """From rows (kind, a, b, n): 0 features and label, 1 and 2 a chain's and a skip link's labels."""
        pairs = [np.zeros((LABELS, LABELS)) for _ in range(2)]
        for k in (1, 2):
            np.add.at(pairs[k - 1], (a[kind == k], b[kind == k]), n[kind == k])
        own = kind == 0
        return cls(a[own], b[own], n[own], *pairs)


def counted(graph: Graph) -> np.ndarray:
    """Rows (kind, a, b, n) of a graph, as ``Counts.of`` takes them."""
    parts = [np.stack([np.zeros_like(graph.features), graph.features, graph.label], 1)]
    parts += [np.column_stack([np.full(len(x), k), graph.label[x]]) for k, x in ((1, graph.chain), (2, graph.skip))]
    rows, n = np.unique(np.concatenate(parts), axis=0, return_counts=True)
    return np.column_stack([rows, n])


@dataclass
class Field:
    """Weights of a skip-chain field."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def learn(cls, counts: Counts, steps: int = 400, penalty: float = 1e-3) -> Field:
        """Fitted piece by piece: a logistic model of the labels by a word's own
        features, and log ratios to chance of the labels that links hold."""
        x = _bits(counts.features)
        y, weight = np.eye(LABELS)[counts.label], counts.n[:, None] / max(1, counts.n.sum())
        node, speed = np.zeros((FEATURES, LABELS)), np.zeros((FEATURES, LABELS))
        for _ in range(steps if len(x) else 0):
            p = _softmax(x @ node)
            speed = 0.9 * speed + x.T @ (weight * (y - p)) - penalty * node
            node += 0.3 * speed
        share = np.bincount(counts.label, counts.n, LABELS) + 1.0
        share /= share.sum()
        chance = np.outer(share, share)

        def ratio(pairs: np.ndarray, agreement: float, given: float = 20.0) -> np.ndarray:
            """Log ratios to chance; before any pair is seen, labels agree with the given probability."""
            held = given * (agreement * np.diag(share) + (1 - agreement) * chance) + pairs
            return np.clip(np.log(held / held.sum() / chance), -4, 4)

        skip = ratio(counts.skip, 0.9)
        return cls(node, ratio(counts.chain, 0.0), (skip + skip.T) / 2)

    def beliefs(self, graph: Graph, rounds: int) -> np.ndarray:
        """Probabilities of the labels of each variable, by loopy sum-product."""
        kinds, which = np.unique(graph.features, return_inverse=True)
        own = np.log(_softmax(_bits(kinds) @ self.node) + 1e-12)[which]
        fixed = graph.label > 0
        own[fixed] = -50.0
        own[fixed, graph.label[fixed]] = 0.0
        pairs, chains = np.concatenate([graph.chain, graph.skip]), len(graph.chain)
        n = len(pairs)
        if n:
            source, target = np.r_[pairs[:, 0], pairs[:, 1]], np.r_[pairs[:, 1], pairs[:, 0]]
            # links share a potential by kind and direction, so only its number is held for each
            potential = np.stack([self.chain, self.skip, self.chain.T, self.skip.T])
            which = (np.arange(2 * n) % n >= chains) + 2 * (np.arange(2 * n) >= n)
            sent = np.zeros((2 * n, LABELS))
            for _ in range(rounds):
                total = own.copy()
                np.add.at(total, target, sent)
                change, fresh = 0.0, np.empty_like(sent)
                for k in range(0, 2 * n, _BLOCK):  # memory for the sums of a block of links
                    at = np.arange(k, min(k + _BLOCK, 2 * n))
                    new = _log_sum((total[source[at]] - sent[(at + n) % (2 * n)])[:, :, None] + potential[which[at]])
                    fresh[at] = new - _log_sum(new[:, :, None])
                    change = max(change, np.abs(fresh[at] - sent[at]).max())
                sent = 0.5 * sent + 0.5 * fresh
                if change < 1e-3:
                    break
            np.add.at(own, target, sent)
        return _softmax(own)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over the second axis."""
    top = x.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0]


def _documents_in(batch: pa.RecordBatch, most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of documents of about ``most`` variables (one document
    at least): memory follows the document with most variables, not the batch."""
    ends = np.cumsum(np.diff(column(batch, "_vars").offsets.to_numpy()))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _graph(lists: pa.ListArray) -> tuple[Graph, np.ndarray]:
    """The graph of some documents' variables, and how many each document has."""
    flat = lists.flatten()
    sizes = np.diff(lists.offsets.to_numpy())
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return Graph.of(doc, *(flat.field(n).to_numpy(zero_copy_only=False).astype(kind) for n, kind in (
        ("label", np.int64), ("follows", bool), ("features", np.int64), ("key", np.int64)))), sizes


def learn(found: DataFrame) -> Field:
    """From all documents: tasks count, and the counts go to the driver, a row per
    pattern of features and label and per pair of labels."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _documents_in(batch):
                rows = counted(_graph(column(part, "_vars"))[0])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], ["kind", "a", "b", "n"])

    rows = found.where(F.size("_vars") > 0).select("_vars").mapInArrow(run, "kind long, a long, b long, n long")
    total = rows.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).orderBy("kind", "a", "b").toArrow()
    return Field.learn(Counts.of(*(total.column(c).to_numpy() for c in ("kind", "a", "b", "n"))))


_ADDRESS, _QUAD = 1 << 22, 1 << 23  # features of an e-mail address and of four numbers


def _whole(kind: int, parts: list[dict]) -> bool:
    """Whether the variables have the parts of an entity of the kind."""
    digits = sum(v["digits"] for v in parts)
    return (any(v["features"] & _ADDRESS for v in parts), any(v["features"] & _QUAD for v in parts),
            13 <= digits <= 19, 9 <= digits <= 15)[kind]


def _joined(vars_: list[dict], kinds: list[int]) -> list[Span]:
    """Spans of the variables with a kind; neighbours of one kind join."""
    tied = {(v["key"], v["label"] - 1) for v in vars_ if v["label"]}
    runs: list[tuple[int, list[dict]]] = []
    for k, (v, kind) in enumerate(zip(vars_, kinds)):
        if kind >= 0:
            if runs and v["follows"] and kinds[k - 1] == kind:
                runs[-1][1].append(v)
            else:
                runs.append((kind, [v]))
    return [(kind, parts[0]["start"], parts[-1]["end"]) for kind, parts in runs
            if any((v["key"], kind) in tied for v in parts) or _whole(kind, parts)]


def _judged(found: DataFrame, field: Field, sure: float, rounds: int) -> DataFrame:
    others = [c for c in found.columns if c not in ("_base", "_vars")]
    source = found.select(*others, "_base", "_vars")
    schema = T.StructType([*source.schema.fields[:-2], T.StructField("_spans", SPANS)])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _documents_in(whole)):
            lists = column(batch, "_vars")
            graph, sizes = _graph(lists)
            p = field.beliefs(graph, rounds)
            kind = p.argmax(axis=1) - 1 if len(p) else np.zeros(0, int)
            kind[(graph.label > 0) | (p.max(axis=1, initial=0) < sure)] = -1
            kinds, spans, at = kind.tolist(), [], 0
            for base, own, n in zip(column(batch, "_base").to_pylist(), lists.to_pylist(), sizes.tolist()):
                all_ = [(s["kind"], s["start"], s["end"], True) for s in base]
                all_ += [(*s, False) for s in _joined(own, kinds[at:at + n])]
                spans.append(sorted(all_, key=lambda s: s[:2]))
                at += n
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(spans, ARROW_SPANS)], names)

    return source.mapInArrow(run, schema)


def scan(docs: DataFrame, sure: float = 0.95, rounds: int = 30, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and _spans (kind, start, end, base), by kind and start."""
    found = materialize(findings(docs, text_col, [docs[id_col].alias("doc_id")]), "pii-found")
    return _judged(found, learn(found), sure, rounds)
