"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_table

# Words are runs of characters other than space and \t..\r.  ``bytes.split()``
# and ``re`` on bytes cut at exactly these six; ``str.split()`` does not.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_of(c: str | Column) -> Column:
    """The text as string, null as empty."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def packed(docs: DataFrame, name: str = "_row") -> Column:
    """All columns of a row as one struct: columns an operator adds beside it
    cannot clash with the caller's."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(name)


def row_hashes(docs: DataFrame) -> list[Column]:
    """``_h1`` and ``_h2``: 128 bits that name a row by all its columns, nulls
    included.  Two passes over a table find the same row by them, so no pass has
    to store its text; rows that agree in every column share them."""
    values = [x for c in docs.columns for x in (docs[f"`{c}`"], docs[f"`{c}`"].isNull())]
    return [F.xxhash64(F.lit(k), *values).alias(f"_h{k}") for k in (1, 2)]


def text_slices(batches: Iterable[pa.RecordBatch], text: str,
                most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut Arrow batches into runs of rows of about ``most`` bytes of text (one
    row at least), with the texts: memory per step follows the longest text,
    not the batch.  Texts without a value are empty."""
    for batch in batches:
        texts = pc.fill_null(column(batch, text).cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()  # workers stay for later tasks


def slices(batches: Iterable[pa.RecordBatch], text: str,
           most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """``text_slices`` with the texts as bytes."""
    for batch, texts in text_slices(batches, text, most):
        yield batch, texts.cast(pa.large_binary()).to_pylist()


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start + size] of each run, one after another."""
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return flat[shift + np.arange(len(shift))]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Memo[V]:
    """What a process remembers by key, in two generations: when the young one
    is full it becomes the old one, from which only keys in use come back."""

    def __init__(self, most: int = 60_000):
        self.young: dict[bytes, V] = {}
        self.old: dict[bytes, V] = {}
        self.most = most

    def missing(self, keys: Iterable[bytes]) -> list[bytes]:
        """Bring ``keys`` into the young generation; those that are new.
        ``keys`` are distinct."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old, out = self.young, self.old, []
        for key in keys:
            if key not in young:
                if key in old:
                    young[key] = old[key]
                else:
                    out.append(key)
        return out


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("base", pa.bool_())]))


def span_text(spans: str | Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each span, in the order of the array, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_columns(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """n_<kind> and base_sha256 of the base spans, and all spans as text."""
    base = F.filter(spans, lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return [*[count(k).alias(f"n_{name}") for k, name in enumerate(kinds)],
            F.sha2(span_text(base, kinds), 256).alias("base_sha256"), span_text(spans, kinds).alias("spans")]
