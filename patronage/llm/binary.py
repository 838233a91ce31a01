"""Token ids as flat binary files with 64-bit document offsets.

Layout of a folder, for each range of ids k in ascending order:

* ``part-k.ids``: unsigned little-endian token ids, document after document, of
  16 bits where the vocabulary and the end id fit, else of 32;
* ``part-k.off``: unsigned 64-bit little-endian offsets into it, one per document and the end;
* ``part-k.doc``: signed 64-bit document ids, and ``part-k.null``: a byte that is 1 where the id is null;
* ``manifest.parquet``: one row per part with its documents, tokens, bytes per id
  and the prefix sums of documents and tokens over the parts before.  The .ids files in order are one
  flat file; a document starts at its part's base plus its offset.

Spark range-partitions and sorts the documents; each task encodes and writes
its own part (under another name first, then renamed, so a task that runs again
leaves the same files).  Only one row per part reaches a window over one
partition.  Readers map the files into memory, so the folder must be a mounted
path that all executors share.

Encoding is the library's.  A text is cut where white space follows something
else and between ASCII letters or digits and punctuation, but not behind an
apostrophe; no match of the byte-level pattern crosses such a place, so the ids
of the pieces are the ids of the text.  Each distinct piece is encoded once while
a process remembers it (half a million short ones, most used first).  Texts that hold
an added token or white space beyond ASCII are not cut, nor is any text of a
tokenizer with another pattern.

Defined cases: null or empty text has only the end id; null ids come first;
rows that share an id lie next to each other, ordered by their text; an empty
table writes no part.
"""

from __future__ import annotations

import json
import os
import re
import string
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_root
from .common import column, gather, text_of, text_slices

# classes of bytes: letters and digits, punctuation, apostrophe, white space, all others
_CLASS = np.zeros(256, np.uint8)
_CLASS[list((string.ascii_letters + string.digits).encode())] = 1
_CLASS[list(string.punctuation.encode())] = 2
_CLASS[ord("'")] = 3
_CLASS[list(b" \t\n\r\v\f")] = 4
# by the classes of two neighbours: no match of the pattern holds both.  An
# apostrophe may begin a contraction, the others may be of any kind.
_EDGE = np.zeros((5, 5), bool)
_EDGE[:4, 4] = _EDGE[1, 2] = _EDGE[1, 3] = _EDGE[2, 1] = True
_EDGE = _EDGE.ravel()
# white space beyond ASCII, and separators that libraries class differently
_ODD = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# a line feed before or behind would change these
_ENDS = "^[\t\n\v\f\r ][\t\n\v\f\r ]|[\t\n\v\f\r ]$"
_TOGETHER = 128  # pieces in one text for the library: short texts stay in the processor's cache
_LONGEST = 64    # bytes of a remembered piece


def cut(texts: pa.Array, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All pieces of all texts as one array, and how many each text has; those in ``whole`` are not cut."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends, kinds = ends - ends[0], _CLASS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = _EDGE[kinds[:-1] * np.uint8(5) + kinds[1:]]
    for k in np.flatnonzero(whole).tolist():
        edge[ends[k]:ends[k + 1]] = False
    edge[ends] = True
    begins = np.flatnonzero(edge)  # and the end of the last
    found = pa.Array.from_buffers(pa.large_string(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(data)])
    return found, np.diff(np.searchsorted(begins, ends))


class PieceEncoder:
    """The library's ids of texts, by distinct pieces."""

    def __init__(self, tokenizer: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.largest = max(vocab.values())
        # a token has a letter per byte
        self.bytes_of = np.zeros(self.largest + 1, np.int64)
        self.bytes_of[list(vocab.values())] = list(map(len, vocab))
        # the texts and pieces that the library gets as they are
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD, *added]) if self._byte_level() else ""
        # remembered pieces, their places in ``flat`` and how often they were used
        self.most, self.known = most, pa.array([], pa.large_string())
        self.starts, self.many, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, "<u4")

    def _byte_level(self) -> bool:
        """Whether the pattern is the byte-level one and sees texts as they are."""
        kind = self.tokenizer.pre_tokenizer and json.loads(self.tokenizer.pre_tokenizer.__getstate__())
        return (self.tokenizer.normalizer is None and bool(kind) and kind["type"] == "ByteLevel"
                and kind["use_regex"] and not kind["add_prefix_space"])

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has."""
        # a line feed is a match of its own: pieces are encoded many at a time,
        # one before each, and told apart by the bytes of their tokens
        single = pc.match_substring_regex(words, f"{_ENDS}|{self.odd}").to_numpy(zero_copy_only=False)
        at, rest, many = np.flatnonzero(~single), np.flatnonzero(single), np.zeros(len(words), np.int64)
        joined, ids = words.take(pa.array(at)), []
        for k in range(0, len(at), _TOGETHER):
            ids += self._ids("\n".join([*joined.slice(k, _TOGETHER).to_pylist(), ""]))
        ids = np.array(ids, "<u4")
        feeds = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(pc.binary_length(joined).to_numpy() + 1))
        many[at] = np.diff(feeds, prepend=-1) - 1
        own = [np.array(self._ids(w), "<u4") for w in words.take(pa.array(rest)).to_pylist()]
        many[rest] = list(map(len, own))
        flat = np.concatenate([np.delete(ids, feeds), *own])
        # joined pieces come first, in their order, then the others
        given = np.concatenate([at, rest])
        starts = np.empty(len(words), np.int64)
        starts[given] = np.cumsum(many[given]) - many[given]
        return gather(flat, starts, many), many

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        words, sizes = cut(texts, pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        # known pieces keep their numbers, new ones follow
        coded, first = pa.concat_arrays([self.known, words]).dictionary_encode(), len(self.known)
        use = coded.indices.to_numpy()[first:]
        fresh, size = self._encoded(coded.dictionary.slice(first))
        starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(size) - size])
        many, flat = np.concatenate([self.many, size]), np.concatenate([self.flat, fresh])
        own = many[use]
        ids = gather(flat, starts[use], own)
        self._remember(coded.dictionary, starts, many, flat, use)
        total, ends = np.concatenate([[0], np.cumsum(own)]), np.cumsum(sizes)
        return ids, total[ends] - total[ends - sizes]

    def _remember(self, words: pa.Array, starts: np.ndarray, many: np.ndarray, flat: np.ndarray,
                  use: np.ndarray) -> None:
        """Keep all pieces but long ones; when there are too many, the half that was used most."""
        used = np.bincount(use, minlength=len(words))
        used[:len(self.used)] += self.used
        keep = np.flatnonzero(pc.binary_length(words).to_numpy() <= _LONGEST)
        if len(keep) > self.most:
            half = np.argpartition(-used[keep], self.most // 2)[:self.most // 2]
            keep, used = keep[np.sort(half)], used // 2
        if len(keep) < len(words):
            words, flat = words.take(pa.array(keep)), gather(flat, starts[keep], many[keep])
            many, used = many[keep], used[keep]
            starts = np.cumsum(many) - many
        self.known, self.starts, self.many, self.flat, self.used = words, starts, many, flat, used


_OPEN: dict[str, PieceEncoder] = {}


def _encoder(tokenizer: str) -> PieceEncoder:
    if tokenizer not in _OPEN:
        _OPEN.clear()
        _OPEN[tokenizer] = PieceEncoder(tokenizer)
    return _OPEN[tokenizer]


def mounted(path: str) -> str:
    """A file-system path for a folder given as path or file: URI."""
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: files that are mapped into memory need a mounted path, not {parts.scheme}:")
    return parts.path if parts.scheme else path


def id_type(largest: int) -> np.dtype:
    """The narrowest of the file's two id types."""
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def _put(folder: str, name: str, chunks: Iterable[bytes]) -> None:
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        for chunk in chunks:
            f.write(chunk)
    os.replace(own, f"{folder}/{name}")


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Write the files of ``docs`` to ``folder`` (made, and empty before) and return its manifest."""
    spark, to = docs.sparkSession, mounted(folder)
    os.makedirs(to, exist_ok=True)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs[text_col]).alias("_text"))
    # the hash spreads rows that share an id over several parts
    rows = (rows.withColumn("_h", F.xxhash64("_text")).repartitionByRange("doc_id", "_h")
            .sortWithinPartitions("doc_id", "_h", "_text").withColumn("_part", F.spark_partition_id())
            .select("_part", "doc_id", "_text"))

    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, own = _encoder(tokenizer), uuid.uuid4().hex
        kind = id_type(max(encoder.largest, end_id))
        ids, sizes, part = [], [], None
        name = f"{to}/.writing-{own}"
        try:
            with open(name, "wb") as flat:
                for batch, texts in text_slices(batches, "_text", 8 << 20):
                    part = column(batch, "_part")[0].as_py()
                    ids.append(column(batch, "doc_id"))
                    coded, many = encoder.encode(texts)
                    np.insert(coded.astype(kind), np.cumsum(many), end_id).tofile(flat)
                    sizes += (many + 1).tolist()
            if part is None:
                return
            os.replace(name, f"{to}/part-{part:08d}.ids")
        finally:
            if os.path.exists(name):  # nothing to write, or a task that failed
                os.remove(name)
        doc = pa.concat_arrays(ids)
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.uint64))]).astype("<u8")
        _put(to, f"part-{part:08d}.off", [offsets.tobytes()])
        _put(to, f"part-{part:08d}.doc", [doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()])
        _put(to, f"part-{part:08d}.null", [doc.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, len(sizes), int(offsets[-1]),
                                                                                   kind.itemsize)],
                                         ["part", "docs", "tokens", "id_bytes"])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    path = f"{folder.rstrip('/')}/manifest.parquet"
    (rows.mapInArrow(save, "part long, docs long, tokens long, id_bytes long")
     .select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("docs", "tokens")])
     .write.parquet(path))
    return spark.read.parquet(path)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a folder: doc_id, start (in the flat file), n_tokens,
    ids_crc32, from files mapped into memory, a part a task."""
    at = mounted(folder)
    parts = spark.read.parquet(f"{folder.rstrip('/')}/manifest.parquet")

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base, id_bytes in zip(*(column(batch, c).to_pylist() for c in (
                    "part", "tokens_before", "id_bytes"))):
                name = f"{at}/part-{part:08d}"
                offsets = np.memmap(f"{name}.off", "<u8", "r")
                flat = np.memmap(f"{name}.ids", f"<u{id_bytes}", "r")
                doc, null = np.memmap(f"{name}.doc", "<i8", "r"), np.memmap(f"{name}.null", "u1", "r")
                for k in range(0, len(doc), 10_000):
                    ends = offsets[k:k + 10_001].astype(np.int64)
                    crc = [zlib.crc32(flat[a:b].astype("<u4")) for a, b in zip(ends[:-1], ends[1:])]
                    n = len(crc)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[k:k + n], mask=null[k:k + n] == 1), pa.array(ends[:-1] + base),
                         pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a given count: merged by size, the few rows of a manifest would be one task
    parts = parts.select("part", "tokens_before", "id_bytes")
    return parts.repartitionByRange(max(1, parts.count()), "part").mapInArrow(
        load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fresh_folder(spark: SparkSession) -> str:
    """A new folder under the shared one."""
    return f"{stage_root(spark)}/token-files-{uuid.uuid4().hex}"
