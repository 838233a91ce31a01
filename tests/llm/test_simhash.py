import random

import data
import numpy as np
import xxhash
from pyspark.sql import functions as F

from patronage.llm import simhash
from patronage.llm.components import components


def brute_print(text, width=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(rows, radius=2):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        r = find(k)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted((str(d), f"{p:016x}", least.get(find(k))) for k, ((d, _), p) in enumerate(zip(rows, prints)))


def result(df):
    return sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in df.collect())


def variants(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for g in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(30, 150))]
        for _ in range(rng.randint(1, 8)):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in data.ROWS] + [(100 + d, t) for d, t in variants(1, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(simhash.near_duplicates(df)) == brute_classes(rows)


def test_hot_buckets_are_cut_without_losing_links(spark):
    rng = random.Random(3)
    fps = {0}
    for _ in range(400):  # all share most buckets
        x = 0
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x |= 1 << b
        fps.add(x)
    signed = [(int(np.uint64(x).astype(np.int64)), k) for k, x in enumerate(sorted(fps))]
    prints = spark.createDataFrame(signed, "_fp long, first_id long")
    whole = {r._fp: r.component_id for r in simhash.classes(prints, 2, split=100_000).collect()}
    cut = {r._fp: r.component_id for r in simhash.classes(prints, 2, split=8).collect()}
    assert whole == cut and len(whole) == len(fps)
    assert len(set(cut.values())) < len(fps)


def test_near_finds_exactly_the_close_pairs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = np.unique(np.array([int(b) ^ int(sum(1 << int(k) for k in set(rng.integers(0, 64, rng.integers(0, 5)))))
                              for b in base for _ in range(30)], np.uint64))
    want = {(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= 3}
    assert set(zip(*(x.tolist() for x in simhash.near(fps, list(range(64)), 3)))) == want


def test_components_of_long_paths(spark):
    n = 60
    links = spark.createDataFrame([(k * 7 % n, (k + 1) * 7 % n) for k in range(n - 1) if k % 20 != 19] + [(5, 5)],
                                  "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    for k in range(n):
        block = [j * 7 % n for j in range(k // 20 * 20, k // 20 * 20 + 20)]
        assert got[k * 7 % n] == min(block)
    assert components(links.where("a < 0")).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = data.clashing(data.documents(spark))
    out = simhash.first_of_each(docs)
    assert out.schema.names == docs.schema.names
    ids = sorted(str(r.doc_id) for r in out.collect())
    assert ids == sorted(map(str, [1, 3, 6, 7, 8, 9, None, 10, 11]))
    assert simhash.first_of_each(data.empty(spark)).count() == 0
    assert simhash.near_duplicates(data.empty(spark)).count() == 0
    nulls = data.documents(spark).withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.first_of_each(nulls).count() == 9
