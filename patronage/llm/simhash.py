"""SimHash near-duplicates by bit-sliced comparison.

1. A document's fingerprint has a bit where over half of its shingles' 64-bit
   hashes have it.  Equal fingerprints are one node from here on, so groups of
   copies of any size cost one row.
2. Fingerprints at distance ``radius`` or less agree on at least two of
   ``radius + 2`` blocks of bits.  Each pair of blocks is a table; equal bits
   in both are a bucket.  A bucket of over ``split`` fingerprints is cut again
   by the same rule on its remaining bits, so no run of rows that is compared
   at once exceeds 2 ** (bits left) (65,536 for radius 2), whatever the data.
3. In a run, bit planes are stored vertically: word j of plane p holds bit p of
   64 fingerprints.  XOR of a plane with a query's bit gives 64 differences,
   which carry-save counters add for all 64 at once; the counters start so that
   they overflow just beyond the radius.  A block of 64 is abandoned when all
   of them have overflowed.
4. A run gives links from each fingerprint to the least one of its component
   in the run, not pairs; ``components`` joins the runs.

Defined cases: null or empty text, or text without words, has fingerprint 0,
linked like any other; a text of fewer words than a shingle is one shingle;
null ids count for no minimum (a component of null ids has a null id);
repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import packed, row_hashes, slices, text_of
from .components import components

BITS = 64
SEED = 42
PAIRS = 4_000_000  # comparisons of a task


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned fingerprint of one text in UTF-8; A-Z count as a-z."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [x - 1 for x in accumulate(len(w) + 1 for w in words)]
    begins = [0, *[e + 1 for e in ends[:-1]]]
    width = min(shingle, len(words))
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - width + 1
    for k in range(0, n, 1 << 16):
        m = min(n, k + (1 << 16))
        h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(begins[k:m], ends[k + width - 1:m + width - 1])),
                        np.uint64, m - k)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str, shingle: int, keep: list[Column]) -> DataFrame:
    """The columns of ``keep`` and ``_fp``, the fingerprint as a signed long."""
    source = docs.select(*keep, text_of(docs[text_col]).alias("_text"))
    fields = source.schema.fields[:-1]
    names = [*[f.name for f in fields], "_fp"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)], names)

    return source.mapInArrow(run, T.StructType([*fields, T.StructField("_fp", T.LongType())]))


def _masks(bits: list[int], radius: int) -> list[int]:
    """Masks of which at least one is equal in two numbers that differ in at
    most ``radius`` of ``bits``: each pair of radius + 2 blocks."""
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), radius + 2)]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near(fps: np.ndarray, planes: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i > j) of fingerprints that differ in at most ``radius`` of
    the bits ``planes``, by bit-sliced counting."""
    m = len(fps)
    lanes = -(-m // 64)
    bit = np.zeros((len(planes), lanes * 64), np.uint8)
    for p, b in enumerate(planes):
        bit[p, :m] = (fps >> np.uint64(b)) & np.uint64(1)
    word = np.packbits(bit, axis=1, bitorder="little").view(np.uint64)  # plane, block of 64
    ones = np.where(bit[:, :m] > 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))  # plane, query
    width = radius.bit_length()
    left, right = [], []
    step = max(64, (1 << 21) // lanes)
    for q0 in range(0, m, step):
        q = np.arange(q0, min(m, q0 + step))
        # a query meets the blocks up to its own: each pair once
        n_blocks = q // 64 + 1
        qi = np.repeat(q, n_blocks)
        wi = np.arange(len(qi)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        start = (1 << width) - 1 - radius
        count = [np.full(len(qi), 0xFFFFFFFFFFFFFFFF if start >> k & 1 else 0, np.uint64) for k in range(width)]
        over = np.zeros(len(qi), np.uint64)
        for p in range(len(planes)):
            carry = word[p][wi] ^ ones[p][qi]
            for k in range(width):
                count[k], carry = count[k] ^ carry, count[k] & carry
            over |= carry
            if p % 4 == 3:
                live = over != np.uint64(0xFFFFFFFFFFFFFFFF)
                if live.sum() < 0.7 * len(live):
                    qi, wi, over, count = qi[live], wi[live], over[live], [c[live] for c in count]
        hit = np.flatnonzero(over != np.uint64(0xFFFFFFFFFFFFFFFF))
        for h0 in range(0, len(hit), 1 << 16):
            h = hit[h0:h0 + (1 << 16)]
            alive = np.unpackbits((~over[h]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(alive)
            i, j = qi[h][at], wi[h][at] * 64 + lane
            ok = j < i
            left.append(i[ok])
            right.append(j[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _roots(m: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index of each index's component."""
    root = np.arange(m)
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != (up := root[root])).any():
            root = up


def _run_links(fps: np.ndarray, mask: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    fps = np.unique(fps)
    if len(fps) > 1:
        planes = [b for b in range(BITS) if not mask >> b & 1]
        root = _roots(len(fps), *near(fps, planes, radius))
        linked = root != np.arange(len(fps))
        if linked.any():
            yield fps[linked], fps[root[linked]]


def links(prints: DataFrame, radius: int, split: int) -> DataFrame:
    """(a, b) links between distinct fingerprints ``_fp`` that, with those they
    chain, join exactly the fingerprints at distance ``radius`` or less."""
    tables = _masks(list(range(BITS)), radius)
    masks = {t * 100: m for t, m in enumerate(tables)}
    deeper = {}
    for t, m in enumerate(tables):
        deeper[t] = [m | s for s in _masks([b for b in range(BITS) if not m >> b & 1], radius)]
        masks |= {t * 100 + 1 + k: s for k, s in enumerate(deeper[t])}

    def keyed(table: int, mask: int) -> Column:
        return F.struct(F.lit(table).alias("t"), F.col("_fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))

    keys = prints.select("_fp", F.explode(F.array(*[keyed(t * 100, m) for t, m in enumerate(tables)])).alias("k")
                         ).select("_fp", "k.t", "k.key")
    full = materialize(keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-runs")
    pairs = full.agg(F.sum(F.col("n") * F.least("n", F.lit(split)))).first()[0] or 0
    runs = keys.join(full, ["t", "key"])
    plain = F.array(F.struct("t", "key"))
    cut = plain
    for t, subs in deeper.items():
        cut = F.when(F.col("t") == t * 100, F.array(*[keyed(t * 100 + 1 + k, s) for k, s in enumerate(subs)])
                     ).otherwise(cut)
    runs = runs.select("_fp", F.explode(F.when(F.col("n") > split, cut).otherwise(plain)).alias("k")).select(
        "_fp", "k.t", "k.key")
    # by the comparisons to make: merged by size, the few rows would be one task
    runs = runs.repartition(max(1, -(-pairs // PAIRS)), "t", "key").sortWithinPartitions("t", "key")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = key = fp = np.zeros(0, np.int64)
        for batch in batches:
            t, key, fp = (np.concatenate([x, batch.column(n).to_numpy(zero_copy_only=False)])
                          for x, n in ((t, "t"), (key, "key"), (fp, "_fp")))
            ends = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            if len(ends):
                yield from found(t, fp, ends)
                t, key, fp = t[ends[-1]:], key[ends[-1]:], fp[ends[-1]:]
        yield from found(t, fp, np.array([len(fp)]))

    def found(t: np.ndarray, fp: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b, start = [], [], 0
        for end in ends:
            if end - start > 1:
                for x, y in _run_links(fp[start:end].view(np.uint64), masks[int(t[start])], radius):
                    a.append(x)
                    b.append(y)
            start = end
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    return runs.mapInArrow(compare, "a long, b long")


def classes(prints: DataFrame, radius: int = 2, split: int = 2048) -> DataFrame:
    """(_fp, first_id) of distinct fingerprints -> (_fp, _root, component_id)."""
    joined = components(links(prints, radius, split))
    named = joined.join(prints, joined["node"] == prints["_fp"]).select("node", "root", "first_id")
    least = named.groupBy("root").agg(F.min("first_id").alias("_least"))
    named = materialize(named.join(least, "root").select("node", "root", "_least"), "simhash-classes")
    return prints.join(named, prints["_fp"] == named["node"], "left").select(
        "_fp", F.coalesce("root", "_fp").alias("_root"),
        F.when(F.col("node").isNotNull(), F.col("_least")).otherwise(F.col("first_id")).alias("component_id"))


def _distinct(prints: DataFrame) -> DataFrame:
    return materialize(prints.groupBy("_fp").agg(F.min("doc_id").alias("first_id")), "simhash-prints")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, split: int = 2048, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    fps = materialize(fingerprints(docs, text_col, shingle, [docs[id_col].alias("doc_id")]), "simhash-docs")
    found = classes(_distinct(fps), radius, split)
    return fps.join(found, "_fp").select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
                                         "component_id")


def first_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2, split: int = 2048, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the row with
    the smallest id stays (null ids last; of rows that share it, one)."""
    fps = materialize(fingerprints(docs, text_col, shingle, [docs[id_col].alias("doc_id"), *row_hashes(docs)]),
                      "simhash-rows")
    found = classes(_distinct(fps), radius, split)
    stay = fps.join(found, "_fp").groupBy("_root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_h1", "_h2")).alias("m")).select("m._h1", "m._h2")
    rows = docs.select(packed(docs), *row_hashes(docs)).join(stay, ["_h1", "_h2"], "left_semi")
    return rows.dropDuplicates(["_h1", "_h2"]).select("_row.*")  # rows that agree in every column
