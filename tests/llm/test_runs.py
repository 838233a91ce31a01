import hashlib
import random
import zlib

import data
import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import runs
from patronage.llm.queries import QUERIES, looped


def brute(words, least=6, times=4):
    """Every maximal stretch of every period, its smallest kept."""
    n, out = len(words), []
    for start in range(n):
        for q in range(1, n - start):
            if words[start + q] != words[start] or start and words[start - 1] == words[start - 1 + q]:
                continue
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            smaller = any(all(words[i] == words[i - p] for i in range(start + p, end)) for p in range(1, q))
            if end - start >= max(least, times * q) and not smaller:
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def loops(rng):
    words = []
    for _ in range(rng.randint(0, 4)):
        block = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 9))]
        words += block * rng.randint(1, 7) + block[:rng.randint(0, len(block))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(500):
        docs = [loops(rng) for _ in range(rng.randint(1, 4))]
        flat = np.array([w for d in docs for w in d], np.int64)
        want, before = [], 0
        for d in docs:
            want += [(s + before, n, q) for s, n, q in brute(d)]
            before += len(d)
        assert [tuple(r) for r in runs.find(flat, np.cumsum([len(d) for d in docs])).tolist()] == want


def test_other_limits():
    words = np.array([1, 2, 1, 2, 1, 2, 7, 7, 7])
    assert runs.find(words, np.array([9]), least=3, times=3).tolist() == [[0, 6, 2], [6, 3, 1]]
    with pytest.raises(ValueError):
        runs.find(words, np.array([9]), times=2)


def test_runs_do_not_cross_documents():
    assert len(runs.find(np.ones(10, np.int64), np.array([5, 10]))) == 0
    assert runs.find(np.ones(12, np.int64), np.array([6, 6, 12])).tolist() == [[0, 6, 1], [6, 6, 1]]


def test_a_text_of_one_word_is_no_slower():
    assert runs.find(np.ones(500_000, np.int64), np.array([500_000])).tolist() == [[0, 500_000, 1]]
    half = np.tile([1, 2, 3], 50_000)
    assert runs.find(np.concatenate([half, [9], half]), np.array([300_001])).tolist() == [
        [0, 150_000, 3], [150_001, 150_000, 3]]


def digests(doc_id, text):
    words = looped(doc_id, (text or "").encode().split())
    found = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def write(tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: str(r))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{w}" for w in loops(rng)) + rng.choice(["", "\n", " é\x0b"]), "en", "a", 0)
            for k in range(300)] + [r for r in data.ROWS if r[1] != data.LONG]
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(300)) > 10
    got = QUERIES["op13_periodic_runs"](spark, write(tmp_path, data.documents(spark, rows)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert ordered(got.collect()) == ordered(digests(r[0], r[1]) for r in rows)


def test_odd_rows(spark):
    docs = data.clashing(data.documents(spark))
    got = {r.doc_id: r for r in runs.detect(docs).where("doc_id is null or doc_id <> 2").collect()}
    assert runs.detect(docs).where("doc_id = 2").count() == 2
    assert got[3].n_words == 0 and got[3].collapsed == "" and got[3].runs == []
    assert got[5].collapsed == "" and got[6].collapsed == "one"
    assert [tuple(r) for r in got[10].runs] == [(0, 90_000, 3)] and got[10].collapsed == "lorem ipsum dolor"
    assert None in got
    none = runs.detect(data.empty(spark))
    assert none.count() == 0 and none.withColumn("b", runs.longest("runs")).select(F.col("b.length")).count() == 0
