import itertools
import random
import tempfile
import zlib
from hashlib import sha256

import data
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

from patronage.llm import binary, bpe
from patronage.llm.lexicon import Lexicon, compile_lexicon

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
ODD = [chr(x) for x in range(0x250)] + list("ΑΣς İıſKÅ  　̧́한국어漢字Ⅳ²½🙂👍🏽​‍﻿ \x1c\x1f") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "'RE", " ", "  ", "\n", " \n", "<|", "|>"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def library(path, texts):
    t = Tokenizer.from_file(path)
    found = t.encode_batch([x or "" for x in texts], add_special_tokens=False)
    return [e.ids for e in found], [t.decode(e.ids, skip_special_tokens=False) for e in found]


def test_lexicon_holds_its_words_and_no_others():
    rng = random.Random(0)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))).encode() for _ in range(800)}
    entries = {w: [rng.randrange(50_000) for _ in range(rng.randint(1, 4))] for w in words}
    with tempfile.NamedTemporaryFile(suffix=".bin") as f:
        f.write(compile_lexicon(entries))
        f.flush()
        lexicon = Lexicon(f.name)
        asked = sorted(words) + [b"", b"d", b"abcabcabcabc"] + [w + b"d" for w in sorted(words)[:50]]
        for w, place in zip(asked, lexicon.places(asked).tolist()):
            assert (place >= 0) == (w in words)
            assert place < 0 or lexicon.at(place) == entries[w]
        assert len(lexicon.keys) < sum(map(len, words)) / 2  # prefixes and suffixes are shared
    with tempfile.NamedTemporaryFile(suffix=".bin") as f:
        f.write(compile_lexicon({}))
        f.flush()
        assert Lexicon(f.name).places([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("texts", [
    random_texts(1500, 1), ["ab" * 20_000 + "xyz", "", " ", "a" * 50_000, "!?" * 3000, "ΑΣ ΟΔΥΣΣΕΥΣ", "İaİ"]])
def test_merges_are_the_library_s(texts):
    ids, decoded = library(WORD, texts)
    encoder = bpe.Encoder(bpe.WordBPE(WORD), None, True)
    entries, places, ends = encoder.encode(pa.array(texts, pa.large_string()))
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        own = [entries[p] for p in places[a:b] if entries[p][0]]
        assert [int(i) for e in own for i in e[0].split()] == ids[k], texts[k][:80]
        assert " ".join(e[1] for e in own) == decoded[k]


def test_encode_decode_and_digests(spark):
    rows = data.ROWS + [(1000 + k, t, "en", "a", 1) for k, t in enumerate(random_texts(200, 2))]
    docs = data.documents(spark, rows)
    ids, decoded = library(WORD, [r[1] for r in rows])
    lexicon = bpe.build_lexicon(docs, WORD, max_words=500)
    got = bpe.digests(data.clashing(docs), WORD, lexicon).collect()
    want = sorted((str(r[0]), len(i), sha256(" ".join(map(str, i)).encode()).hexdigest(), sha256(d.encode()).hexdigest())
                  for r, i, d in zip(rows, ids, decoded))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    encoded = bpe.encode(docs, WORD, lexicon)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == sorted((str(r[0]), i) for r, i in zip(rows, ids))
    back = bpe.decode(encoded, WORD)
    assert sorted((str(r.doc_id), r.decoded) for r in back.collect()) == sorted(
        (str(r[0]), d) for r, d in zip(rows, decoded))
    none = data.empty(spark)
    assert bpe.digests(none, WORD, bpe.build_lexicon(none, WORD)).count() == 0


def test_pieces_give_the_library_s_ids():
    texts = random_texts(1500, 3) + ["", " ", "a  b", "x\n y", " lead", "trail ", "a  b", "w " * 5000]
    ids, _ = library(BYTE, texts)
    flat, many = binary.PieceEncoder(BYTE).encode(pa.array(texts, pa.large_string()))
    for t, want, got in zip(texts, ids, np.split(flat, np.cumsum(many)[:-1])):
        assert got.tolist() == want, t[:80]


def test_every_cut_gives_the_library_s_ids():
    letters = ["a", "1", "é", ".", "'", "s", " ", "\n", "\t", "\x01", "\x1c", "\xa0", "中", "<|endoftext|>"]
    texts = ["".join(x) for n in range(5) for x in itertools.product(letters, repeat=n)]
    ids, _ = library(BYTE, texts)
    encoder = binary.PieceEncoder(BYTE)
    for _ in range(2):  # new pieces, then known ones
        flat, many = encoder.encode(pa.array(texts, pa.large_string()))
        assert many.tolist() == list(map(len, ids)) and flat.tolist() == [i for x in ids for i in x]


class Counted:
    """A tokenizer that keeps count of the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **kw):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **kw)


def test_pieces_reach_the_library_once():
    rng = random.Random(5)
    words = ["".join(rng.choice("aeinrst") for _ in range(10)) for _ in range(500)]
    # each word once in a text, with other marks in the next
    texts = [" ".join(w + mark for w in words) for mark in ("", ".", ",", "!\nSo", '")')]
    encoder = binary.PieceEncoder(BYTE)
    encoder.tokenizer = Counted(encoder.tokenizer)
    found = [encoder.encode(pa.array([t], pa.large_string()))[0].tolist() for t in texts]
    assert found == library(BYTE, texts)[0]
    assert encoder.tokenizer.given < 1.2 * len(texts[0])


def test_remembered_pieces_are_bounded():
    texts = random_texts(600, 6) + ["often " * 50 + "w" * 1000] * 6
    random.Random(7).shuffle(texts)
    encoder = binary.PieceEncoder(BYTE, most=100)
    for k in range(0, len(texts), 60):
        part = texts[k:k + 60]
        flat, many = encoder.encode(pa.array(part, pa.large_string()))
        ids, _ = library(BYTE, part)
        assert many.tolist() == list(map(len, ids)) and flat.tolist() == [i for x in ids for i in x]
        assert len(encoder.known) == len(encoder.starts) == len(encoder.used) <= 100
        assert encoder.many.sum() == len(encoder.flat)
    assert " often" in encoder.known.to_pylist()


def test_other_patterns_are_not_cut():
    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    texts = ["one two,three", ",", "", " four"]
    with tempfile.TemporaryDirectory() as d:
        tokenizer.save(f"{d}/t.json")
        flat, many = binary.PieceEncoder(f"{d}/t.json").encode(pa.array(texts, pa.large_string()))
        ids, _ = library(f"{d}/t.json", texts)
    assert many.tolist() == list(map(len, ids)) and flat.tolist() == [i for x in ids for i in x]


def test_token_files_round_trip(spark):
    rows = data.ROWS + [(1000 + k, t, "en", "a", 1) for k, t in enumerate(random_texts(300, 4))]
    random.Random(0).shuffle(rows)
    folder = binary.fresh_folder(spark)
    manifest = binary.write(data.clashing(data.documents(spark, rows)), BYTE, folder, end_id=0)
    got = sorted(binary.read(spark, folder).collect(), key=lambda r: r.start)
    ids, _ = library(BYTE, [r[1] for r in rows])
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    crc = lambda i: zlib.crc32(np.array([*i, 0], "<u4"))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(r[0]), len(i) + 1, crc(i)) for r, i in zip(rows, ids))
    flat = b"".join(open(f"{binary.mounted(folder)}/part-{r.part:08d}.ids", "rb").read()
                    for r in sorted(manifest.collect(), key=lambda r: r.part))
    assert len(flat) == 2 * start == 2 * sum(len(i) + 1 for i in ids)
    nothing = binary.fresh_folder(spark)
    assert binary.write(data.empty(spark), BYTE, nothing).count() == 0 and binary.read(spark, nothing).count() == 0
    assert binary.id_type(70_000).itemsize == 4
    with pytest.raises(ValueError):
        binary.mounted("hdfs://x/y")
