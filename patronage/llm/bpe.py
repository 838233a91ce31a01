"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

1. Words of all documents are counted by Spark; of the most frequent, as many
   levels of count as hold ``max_words`` at most are merged to ids on the driver
   and compiled into a transducer, whose file goes to the shared checkpoint folder.
2. Spark hands that file to every executor; each process maps it into memory.
   The distinct words of a few MB of text walk the transducer together.
3. A word that the transducer does not hold is merged exactly: the pair of
   lowest rank first, the leftmost of equal ones.  So the lexicon decides the
   speed, never the ids.

Text is cut at the six ASCII spaces, which no word of the tokenizer crosses, and
each distinct piece as the tokenizer file says: special tokens, normalisation,
then the split pattern.  In pieces below U+0250 normalisation is lower-casing;
others go through the library's own normaliser and splitter.

Defined cases: null or empty text, and text of white space, has no tokens (an
empty id list and empty decoded text); repeated rows are rows of their own; an
empty table gives an empty result; words of any length are merged in
n log n steps.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha1, sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, stage_root
from .common import Memo, byte_letters, gather, text_of, text_slices
from .lexicon import Lexicon, compile_lexicon

_NONE = 1 << 60
_PLAIN = 0x250  # below: NFC changes nothing and lower-casing is one character's own
_TOGETHER = 48  # symbols of a word that is merged together with others
_LONGEST = 48  # bytes of a word in the lexicon


class PairTable:
    """Ranks of id pairs in an open-addressed table that is probed for many at once."""

    def __init__(self, rank: dict[tuple[int, int], int]):
        self.bits = max(8, (4 * len(rank)).bit_length())
        self.key, self.rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NONE)
        keys = np.array([a << 20 | b for a, b in rank], np.int64)
        ranks = np.array(list(rank.values()), np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.key[at] == -1
            self.key[at[free]] = keys[free]  # of several for a slot the last stays
            self.rank[at[free]] = ranks[free]
            left = self.key[at] != keys
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.key[at]
        out = np.where(found == keys, self.rank[at], _NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.key[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.rank[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class WordBPE:
    """A word-level BPE vocabulary from its file: words in, ids out."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path}: only lower-casing word BPE without a decoder is read here")
        self.path, vocab, suffix = path, model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inside = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.at_end = np.array([vocab.get(c + suffix, -1) for c in letters], np.int64)
        self.byte_of = {c: b for b, c in enumerate(letters)}
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in
                 (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        self.rank: dict[tuple[int, int], int] = {}
        for r, (a, b, _) in enumerate(pairs):
            self.rank.setdefault((a, b), r)
        self.made = np.array([c for *_, c in pairs], np.int64)
        self.pairs = PairTable(self.rank)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # \s of the pattern, spelled out for the range in which it is used
        self.split = regex.compile(self.pattern.replace(r"\s", r"\x09-\x0d\x20\x85\xa0")).findall
        self.odd = regex.compile(f"[^\\x00-\\u{_PLAIN - 1:04x}]").search
        self.cut = regex.compile("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))
                                 or r"(?!)")
        self._library = None

    def symbols(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words in a row, and how many each word has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        ids, ends = self.inside[text], np.cumsum(size) - 1
        ids[ends] = self.at_end[text[ends]]
        if (ids < 0).any():  # bytes without a token have no symbol
            size = np.add.reduceat((ids >= 0).astype(np.int64), ends + 1 - size)
            ids = ids[ids >= 0]
        return ids, size

    def merged(self, words: Sequence[bytes]) -> list[list[int]]:
        """Ids of each word (none is empty), by exact merging: many words advance
        together, each by the leftmost pair of its lowest rank per step."""
        if not words:
            return []
        ids, size = self.symbols(words)
        out: list[list[int]] = [[]] * len(words)
        each = np.repeat(np.arange(len(words)), size)
        for k in np.flatnonzero(size > _TOGETHER).tolist():
            out[k] = self._long(ids[each == k].tolist())
        word = np.flatnonzero((size > 0) & (size <= _TOGETHER))
        ids, size = ids[np.isin(each, word)] if len(word) < len(words) else ids, size[word]
        while len(word):
            start = np.cumsum(size) - size
            rank = np.full(len(ids), _NONE)
            rank[:-1] = self.pairs.find(ids[:-1] << 20 | ids[1:])
            rank[start + size - 1] = _NONE
            least = np.minimum.reduceat(rank, start)
            merging = least < _NONE
            each = np.repeat(np.arange(len(word)), size)
            stay, done = merging[each], ids.tolist()
            for k, i, n in zip(*(x[~merging].tolist() for x in (word, start, size))):
                out[k] = done[i:i + n]
            at = np.flatnonzero((rank == least[each]) & stay)
            at = at[np.r_[True, each[at[1:]] != each[at[:-1]]]] if len(at) else at
            ids[at] = self.made[rank[at]]
            stay[at + 1] = False
            ids, word, size = ids[stay], word[merging], size[merging] - 1
        return out

    def _long(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.rank.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := rank((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            to = after[k]
            if to < 0 or ids[k] != a or ids[to] != b:
                continue
            ids[k], ids[to], after[k] = int(self.made[r]), -1, after[to]
            if after[to] >= 0:
                before[after[to]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right >= 0 and (r := rank((ids[left], ids[right]))) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x in ids if x >= 0]

    def _library_words(self, chunk: str) -> list[bytes]:
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
        t = self._library
        return [bytes(map(self.byte_of.__getitem__, w))
                for w, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(chunk))]

    def words(self, chunk: str) -> list[bytes]:
        """Words of a text between white space, as UTF-8; special tokens as
        themselves behind a NUL, which no word of several characters starts with."""
        if (low := chunk.lower()).isalpha() and (chunk.isascii() or not self.odd(chunk)):
            return [low.encode()]
        out, at = [], 0
        for m in self.cut.finditer(chunk) if "<" in chunk else ():
            out += self._plain(chunk[at:m.start()])
            out.append(b"\0" + m[0].encode())
            at = m.end()
        return out + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii() and self.odd(text):
            return self._library_words(text)
        return list(map(str.encode, self.split(text.lower())))


Entry = tuple[str, str] | bytes  # ids and tokens as text; or ids as int32


class Encoder:
    """Cuts texts at white space, looks the words of each distinct piece up in
    the transducer and merges those that it does not hold."""

    def __init__(self, bpe: WordBPE, lexicon: Lexicon | None, as_text: bool):
        self.bpe, self.lexicon, self.as_text = bpe, lexicon, as_text
        self.known: Memo[Entry] = Memo()
        self.number = {i: str(i) for i in bpe.token}

    def _entry(self, ids: Sequence[int]) -> Entry:
        if not self.as_text:
            return array("i", ids).tobytes()
        return " ".join([self.number[i] for i in ids]), " ".join([self.bpe.token[i] for i in ids])

    def learn(self, chunks: Iterable[bytes]) -> None:
        new = self.known.missing(chunks)
        cut = [self.bpe.words(str(c, "utf-8")) for c in new]
        words = list(dict.fromkeys(chain.from_iterable(cut)))
        places = self.lexicon.places(words).tolist() if self.lexicon else [-1] * len(words)
        ids = {w: self.lexicon.at(p) for w, p in zip(words, places) if p >= 0}
        ids |= {b"\0" + t.encode(): [i] for t, i in self.bpe.special.items()}
        unseen = [w for w in words if w not in ids]
        ids |= zip(unseen, self.bpe.merged(unseen))
        for chunk, parts in zip(new, cut):
            self.known.young[chunk] = self._entry(ids[parts[0]] if len(parts) == 1 else [i for w in parts for i in ids[w]])

    def encode(self, texts: pa.Array) -> tuple[list[Entry], np.ndarray, np.ndarray]:
        """The entries of the distinct pieces (a piece may have no ids), the
        pieces of all texts as places among them, and where each text's end."""
        cut = pc.ascii_split_whitespace(texts)
        pieces = cut.flatten().cast(pa.large_binary()).dictionary_encode()
        chunks = pieces.dictionary.to_pylist()
        self.learn(chunks)
        ends = cut.offsets.to_numpy()
        return list(map(self.known.young.__getitem__, chunks)), pieces.indices.to_numpy(), ends - ends[0]


_OPEN: dict[tuple[str, str | None, bool], Encoder] = {}


def _encoder(tokenizer: str, lexicon: str | None, as_text: bool) -> Encoder:
    """One encoder a process; its memo of pieces is bounded."""
    key = (tokenizer, lexicon, as_text)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Encoder(WordBPE(tokenizer), Lexicon(SparkFiles.get(lexicon)) if lexicon else None, as_text)
    return _OPEN[key]


def word_counts(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents, words cut by the tokenizer's own pattern."""
    java = "(?U)" + pattern  # Unicode classes in Java's pattern language
    words = F.regexp_extract_all(F.lower(text_of(docs[text_col])), F.lit(java), F.lit(0))
    return docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def build_lexicon(docs: DataFrame, tokenizer: str, max_words: int = 50_000, text_col: str = "text") -> str:
    """Name of the lexicon file, added to the Spark context's files."""
    spark, bpe = docs.sparkSession, WordBPE(tokenizer)
    counts = materialize(word_counts(docs, bpe.pattern, text_col).where(
        (F.col("n") > 1) & (F.octet_length("word") <= _LONGEST)).withColumn(
        "level", F.floor(F.log2("n") * 64).cast("int")), "bpe-words")
    # words by level of count: a few thousand rows, whatever the corpus
    levels = sorted(counts.groupBy("level").count().collect(), reverse=True)
    total, least = 0, None
    for level, n in levels:
        total += n
        if total > max_words:
            break
        least = level
    frequent = counts.where(F.col("level") >= F.lit(least)).select("word").collect()  # at most max_words
    words = sorted(r[0].encode() for r in frequent)
    content = compile_lexicon(dict(zip(words, bpe.merged(words))))
    return share_file(spark, f"lexicon-{sha1(content).hexdigest()[:16]}.bin", content)


def share_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a small file to the shared folder and add it to the context's files."""
    path = f"{stage_root(spark)}/{name}"
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(to):
        out = fs.create(to, True)
        out.write(bytearray(content))
        out.close()
        spark.sparkContext.addFile(str(fs.makeQualified(to).toString()))
    return name


def _run(source: DataFrame, schema: T.StructType, columns: Callable[..., list[pa.Array]], as_text: bool,
         tokenizer: str, lexicon: str | None) -> DataFrame:
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, lexicon, as_text)
        for batch, texts in text_slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns(*encoder.encode(texts))], names)

    return source.mapInArrow(run, schema)


def _digest_columns(entries: list[Entry], places: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    places = places.tolist()
    lines, tokens = [e[0] for e in entries], [e[1] for e in entries]
    n, ids, decoded = [], [], []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        own = [k for k in places[a:b] if lines[k]]
        line = " ".join(map(lines.__getitem__, own))
        n.append(line.count(" ") + 1 if line else 0)
        ids.append(sha256(line.encode()).hexdigest())
        decoded.append(sha256(" ".join(map(tokens.__getitem__, own)).encode()).hexdigest())
    return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]


def _id_columns(entries: list[Entry], places: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    many = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
    ids = gather(np.frombuffer(b"".join(entries), np.int32), (np.cumsum(many) - many)[places], many[places])
    total = np.concatenate([[0], np.cumsum(many[places])])
    return [pa.ListArray.from_arrays(pa.array(total[ends], pa.int32()), pa.array(ids))]


def _encoded(docs: DataFrame, tokenizer: str, lexicon: str | None, extra: list[T.StructField], columns: Callable,
             as_text: bool, keep: Sequence[str], text_col: str) -> DataFrame:
    source = docs.select(*[docs[f"`{c}`"] for c in keep], text_of(docs[text_col]).alias("_text"))
    return _run(source, T.StructType([*source.schema.fields[:-1], *extra]), columns, as_text, tokenizer, lexicon)


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None = None, keep: Sequence[str] = ("doc_id",),
           text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` and ``ids`` (array of int) of each whole text."""
    return _encoded(docs, tokenizer, lexicon, [T.StructField("ids", T.ArrayType(T.IntegerType()))], _id_columns,
                    False, keep, text_col)


def digests(docs: DataFrame, tokenizer: str, lexicon: str | None = None, keep: Sequence[str] = ("doc_id",),
            text_col: str = "text") -> DataFrame:
    """The columns of ``keep``, n_tokens, ids_sha256 and decoded_sha256."""
    return _encoded(docs, tokenizer, lexicon, [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())], _digest_columns, True, keep, text_col)


def decode(encoded: DataFrame, tokenizer: str, keep: Sequence[str] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """The columns of ``keep`` and ``decoded``: the tokens of ``ids`` joined by spaces."""
    source = encoded.select(*[encoded[f"`{c}`"] for c in keep], encoded[ids_col].alias("_ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.StringType())])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _encoder(tokenizer, None, False).bpe.token
        for batch in batches:
            texts = [" ".join([token[i] for i in ids or []]) for ids in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names)

    return source.mapInArrow(run, schema)
