"""Vector code compression: integer product codes, nearest entries by an integer
Walsh-Hadamard transform.

1. Component x becomes floor(scale * x).  Vectors are cut into equal consecutive
   parts; each part position has a codebook, at first that part of the ``size``
   smallest ids.
2. A round assigns every part to its nearest entry and replaces each entry by
   the floor of its parts' mean; an entry without parts stays.  Tasks sum their
   own parts, Spark adds up one row per entry and component, and only these
   sums, parts x size x width numbers whatever the table holds, reach the driver.
3. Nearest entries: parts and entries are padded with zeros to a power of two and
   transformed.  The transform multiplies every squared distance by the padded
   width exactly, so integers decide.  Squared differences are added in sequency
   order (rows of the transform by their number of sign changes); the sum so far
   is a lower bound, and entries whose bound exceeds the whole distance of the
   best looking entry leave.  Ties go to the lower index.

64-bit integers hold every sum while components stay under a bound that
``_kind`` computes; beyond it Python's integers do the same steps.

Defined cases: vectors that are null or hold null or non-finite components take
no part; null ids are coded but start no entry, and of rows that share an id the
least vector does; with fewer ids than ``size`` the codebooks are smaller;
repeated rows are rows of their own; null labels are one label; vectors of
different lengths, or of one that ``parts`` doesn't divide, and distances beyond
64 bits are errors; without usable vectors (or without any id) the result is empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import column


def sequency_rows(width: int) -> np.ndarray:
    """Rows of the Hadamard matrix of a power of two, by sign changes."""
    rows = np.array([[1]])
    while len(rows) < width:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")]


def _kind(largest: int, width: int) -> type:
    """int64 where no scaled sum of squared differences can exceed 63 bits."""
    padded = 1 << max(0, width - 1).bit_length()
    return np.int64 if (2 * largest) ** 2 * width * padded < 1 << 62 else object


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def nearest(parts: np.ndarray, entries: np.ndarray, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, and its squared distance."""
    n, width = parts.shape
    rows = sequency_rows(1 << max(0, width - 1).bit_length())
    kind = _kind(max(_largest(parts), _largest(entries)), width)
    # only the columns that meet components: the others meet the padding's zeros
    turn = rows[:, :width].T.astype(kind)
    e = entries.astype(kind) @ turn
    index, distance = np.zeros(n, np.int64), np.zeros(n, kind)
    for k in range(0, n, block):
        x = parts[k:k + block].astype(kind) @ turn
        index[k:k + block], scaled = _eliminate(x, e)
        distance[k:k + block] = scaled // len(rows)
    return index, distance


def _eliminate(x: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest rows of ``e`` and their squared distance, coefficient by coefficient."""
    n, width = x.shape
    first = max(1, width // 4)
    sums = sum((x[:, c, None] - e[None, :, c]) ** 2 for c in range(first))
    likely = sums.argmin(axis=1) if sums.dtype != object else np.array([min(range(len(e)), key=s.__getitem__) for s in sums])
    bound = ((x - e[likely]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    held = sums[row, entry]
    for c in range(first, width):
        held = held + (x[row, c] - e[entry, c]) ** 2
        if c % 2 or c + 1 == width:
            stay = held <= bound[row]
            row, entry, held = row[stay], entry[stay], held[stay]
    # rows ascend, and within them entries
    order = np.lexsort((entry, held, row)) if held.dtype != object else np.array(
        sorted(range(len(row)), key=lambda j: (row[j], held[j], entry[j])))
    best = order[np.searchsorted(row[order], np.arange(n))]
    return entry[best], held[best]


def _vectors(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """The rows' components as integers."""
    x = column(batch, "v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
    if not x.size or np.abs(x).max() < (1 << 52) / scale:
        return np.floor(x * scale).astype(np.int64)
    flat = [math.floor(v * scale) if abs(v) < 2.0 ** 52 else int(v) * scale for v in x.ravel().tolist()]
    return np.array(flat, object).reshape(x.shape)


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = vectors[vector_col]
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].alias("label"),
                          v.alias("v") if vectors.schema[vector_col].dataType.simpleString() == "array<float>"
                          else v.cast("array<double>").alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _width(rows: DataFrame, parts: int) -> int | None:
    """Components of a part; None without a vector."""
    least, most = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if least != most or least is not None and (not least or least % parts):
        raise ValueError(f"vectors of one length that {parts} divides are needed, not of {least} to {most}")
    return None if least is None else least // parts


def _first_entries(rows: DataFrame, size: int, parts: int, scale: int) -> np.ndarray:
    """(part, entry, component): the vectors of the ``size`` smallest ids."""
    least = rows.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))
    held = least.orderBy("vec_id").limit(size).toArrow().combine_chunks().to_batches()
    if not held:
        return np.zeros((parts, 0, 0), np.int64)
    x = _vectors(held[0], scale)
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2)


def train(vectors: DataFrame, size: int = 256, parts: int = 4, rounds: int = 4, scale: int = 1024,
          id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> np.ndarray:
    """The codebooks: (part, entry, component) integers."""
    rows = _usable(vectors, id_col, vector_col, label_col).select("vec_id", "v")
    if _width(rows, parts) is None:
        return np.zeros((parts, 0, 0), np.int64)
    books = _first_entries(rows, size, parts, scale)
    for _ in range(rounds if books.shape[1] else 0):
        books = _improved(rows, books, scale)
    return books


def _improved(rows: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    parts, size, width = books.shape

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, size, width), object if books.dtype == object else np.int64)
        counts = np.zeros((parts, size), np.int64)
        for batch in batches:
            x = _vectors(batch, scale).reshape(batch.num_rows, parts, width)
            if x.dtype == object:
                sums = sums.astype(object)
            for p in range(parts):
                index, _ = nearest(x[:, p], books[p])
                np.add.at(sums[p], index, x[:, p])
                counts[p] += np.bincount(index, minlength=size)
        p, e = np.nonzero(counts)
        # sums as text: they may exceed 64 bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array([[str(s) for s in row] for row in sums[p, e]],
                                                                        pa.list_(pa.string()))], ["p", "e", "n", "s"])

    each = rows.select("v").mapInArrow(summed, "p long, e long, n long, s array<string>")
    total = each.select("p", "e", "n", F.posexplode("s").alias("c", "s")).groupBy("p", "e", "c").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    new = books.astype(object)
    for r in total.collect():  # parts x size x width rows at most
        new[r.p, r.e, r.c] = int(r.s) // r.n
    return new.astype(np.int64) if _largest(new) < 1 << 62 else new


def encode(vectors: DataFrame, books: np.ndarray, scale: int = 1024, id_col: str = "vec_id",
           vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: vec_id, label, codes (an index per part), error
    (squared distances summed over parts)."""
    rows = _usable(vectors, id_col, vector_col, label_col)
    label = rows.schema["label"]
    parts, size, width = books.shape
    if not size:
        rows = rows.where("false")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, scale).reshape(batch.num_rows, parts, width)
            found = [nearest(x[:, p], books[p]) for p in range(parts)]
            codes = np.stack([index for index, _ in found], axis=1)
            error = sum(distance.astype(object) for _, distance in found)
            if error.size and error.max() >= 1 << 63:
                raise OverflowError("a squared distance exceeds 64 bits")
            yield pa.RecordBatch.from_arrays(
                [column(batch, "vec_id"), column(batch, "label"), pa.array(list(codes), pa.list_(pa.int32())),
                 pa.array(error.astype(np.int64))], ["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(run, T.StructType([
        T.StructField("vec_id", T.LongType()), label, T.StructField("codes", T.ArrayType(T.IntegerType())),
        T.StructField("error", T.LongType())]))


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels."""
    coded = materialize(coded, "codes")
    total = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return coded.alias("c").join(total.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label"))).select(
        "c.*", "t.label_error")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and component, joined by commas."""
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()
