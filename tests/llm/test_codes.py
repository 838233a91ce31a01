import hashlib
import math
import random

import data
import numpy as np
import pytest
from pyspark.sql import types as T

from patronage.llm import codes
from patronage.llm.queries import QUERIES

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def table(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema)


def brute(rows, size=256, parts=4, rounds=4, scale=1024):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    first = {}
    for (i, v, _), c in zip(kept, cut):
        if i is not None and (i not in first or v < first[i][0]):
            first[i] = (v, c)
    starts = [first[i][1] for i in sorted(first)[:size]]
    books = [[s[p] for s in starts] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for c in cut:
                own[near(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(o) for x in zip(*o)] if o else e for o, e in zip(own, books[p])]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, label), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), e, total[label], sha)
            for (i, _, label), f, e in zip(kept, found, errors)]


def same(df, want):
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))


def query(spark, tmp_path, rows):
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    return QUERIES["op12_vector_codes"](spark, str(tmp_path))


def random_rows(n, width, seed, spread=1.0, labels=(0, 1, None)):
    rng = random.Random(seed)
    return [(k * 3, [rng.gauss(0, spread) for _ in range(width)], rng.choice(labels)) for k in range(n)]


def test_query_equals_brute_force(spark, tmp_path):
    rows = random_rows(400, 8, 1)
    rows += [(1, None, 1), (2, [1.0] * 7 + [None], 1), (4, [float("nan")] + [0.0] * 7, 0), (5, [float("inf")] * 8, 0),
             (None, [0.25] * 8, 2), (9, rows[3][1], None), (9, rows[3][1], None), (10, [0.0] * 8, 1)]
    same(query(spark, tmp_path, rows), brute(rows))


@pytest.mark.parametrize("width", [4, 12, 20])  # parts of 1, 3 and 5 components are padded
def test_padded_parts_and_small_books(spark, tmp_path, width):
    rows = random_rows(30, width, width)
    same(query(spark, tmp_path, rows), brute(rows))


def test_equal_vectors_share_the_lowest_entry(spark, tmp_path):
    rows = [(k, [0.5, -0.5, 0.25, 1.0], 1) for k in range(300)]
    got = query(spark, tmp_path, rows).collect()
    assert {r.code for r in got} == {"00000000"} and {r.label_error for r in got} == {0}


def test_large_components_stay_exact(spark, tmp_path):
    rows = random_rows(300, 64, 3, 3e4) + [(1000, [1e5] * 64, 0), (1001, [-1e5] * 64, 0)]
    assert codes._kind(100_000 * 1024, 16) is object and codes._kind(10_000 * 1024, 16) is np.int64
    same(query(spark, tmp_path, rows), brute(rows))


def test_elimination_equals_full_distances():
    rng = np.random.default_rng(4)
    for width, high in ((16, 5), (16, 3000), (3, 2), (1, 9)):
        x, e = rng.integers(-high, high, (3000, width)), rng.integers(-high, high, (100, width))
        full = ((x[:, None] - e[None]) ** 2).sum(axis=2)
        index, distance = codes.nearest(x, e)
        assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
        index, distance = codes.nearest(x[:50].astype(object) * 10 ** 12, e.astype(object) * 10 ** 12)
        assert (index == full[:50].argmin(axis=1)).all() and (distance == full[:50].min(axis=1).astype(object) * 10 ** 24).all()


def test_sequency_order():
    rows = codes.sequency_rows(16)
    assert ((rows[:, 1:] != rows[:, :-1]).sum(axis=1) == np.arange(16)).all()
    assert (rows @ rows.T == 16 * np.eye(16)).all()


def test_no_vectors_and_wrong_lengths(spark):
    for rows in ([], [(1, None, 1)], [(None, [1.0] * 4, 1)]):
        vectors = data.clashing(table(spark, rows))
        books = codes.train(vectors)
        assert codes.with_label_error(codes.encode(vectors, books)).count() == 0
        assert len(codes.books_digest(books)) == 64
    for rows in ([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 6, 1)]):
        with pytest.raises(ValueError):
            codes.train(table(spark, rows))


def test_clashing_columns_and_doubles(spark):
    rows = random_rows(40, 8, 6)
    schema = T.StructType([VECTORS[0], T.StructField("embedding", T.ArrayType(T.DoubleType())), VECTORS[2]])
    plain = table(spark, rows)
    as_double = data.clashing(plain.select("vec_id", plain.embedding.cast("array<double>").alias("embedding"), "label"))
    assert as_double.schema["embedding"].dataType == schema[1].dataType
    a, b = codes.train(plain), codes.train(as_double)
    assert (a == b).all()
    same(codes.encode(as_double, b), [tuple(r) for r in codes.encode(plain, a).collect()])
