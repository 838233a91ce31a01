import random
import re
import zlib
from collections import Counter

import data
import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import ann, classifier, rules


def corpus(n, seed=1):
    """Good and bad documents with their labels."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows, marks = [], []
    for k in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(40, 200))]
        bad = k % 4 == 0
        if bad:
            own = ([w.upper() + "!!" for w in own], [w + "###" for w in own], own[:3] * (len(own) // 3))[k // 4 % 3]
        rows.append((k, " ".join(own) + ".", "en", "a", 1))
        if k % 5:
            marks.append((k, int(not bad), 0))
    return rows, marks


def test_classifier_on_documents_it_never_saw(spark):
    rows, marks = corpus(1200)
    got = classifier.score(data.clashing(data.documents(spark, rows)), data.labels(spark, marks)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(1200) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    right = sum((r.doc_id % 4 != 0) == (r.predicted == 1) for r in held) / len(held)
    assert right >= 0.97


def test_labels_of_held_out_documents_teach_nothing(spark):
    rows, marks = corpus(400)
    lies = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in marks]
    docs = data.documents(spark, rows)
    one, two = ({r.doc_id: r.score for r in classifier.score(docs, data.labels(spark, m)).collect()}
                for m in (marks, lies))
    assert one == pytest.approx(two)


def test_partition_sums_are_the_normal_equations(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, classifier.STATISTICS))
    y = (x[:, 0] > 0).astype(int)
    rows = [(x[k].tolist(), int(y[k]), k % 4 == 0) for k in range(300)]
    df = spark.createDataFrame(rows, "_x array<double>, _y int, _calibrate boolean").repartition(7)
    m = classifier.fit(df, features=32)
    fit = np.arange(300) % 4 != 0
    z = m.features(x[fit])
    want = np.linalg.solve(z.T @ z + 1e-4 * fit.sum() * np.eye(33), z.T @ y[fit])
    assert np.allclose(m.ridge, want, atol=1e-8)
    assert (np.diff(m.calibrated) >= 0).all()
    kernel = m.features(x[:5])[:, :-1] @ m.features(x[5:10])[:, :-1].T
    wide = classifier.Model(m.mean, m.scale, rng.normal(size=(12, 60_000)) / 3, rng.uniform(0, 6.28318, 60_000))
    a, b = ((v - m.mean) / m.scale for v in (x[:5], x[5:10]))
    gauss = np.exp(-((a[:, None] - b[None]) ** 2).sum(-1) / 18)
    assert np.allclose(wide.features(x[:5])[:, :-1] @ wide.features(x[5:10])[:, :-1].T, gauss, atol=0.03)
    assert kernel.shape == gauss.shape


def test_pool_adjacent_is_the_least_squares_fit():
    total, ones = np.array([1, 1, 0, 2, 1, 1.0]), np.array([0, 1, 0, 0, 1, 1.0])
    fit = classifier.pool_adjacent(total, ones)
    assert fit.tolist() == pytest.approx([0, 1 / 3, 1 / 3, 1 / 3, 1, 1])


def test_classifier_odd_rows(spark):
    docs = data.clashing(data.documents(spark))
    none = classifier.score(docs, data.labels(spark)).collect()
    assert len(none) == len(data.ROWS) and all(r.score == 0.5 for r in none)
    odd = data.labels(spark, [(None, 1, 0), (1, None, 0), (1, 7, 0), (99, 1, 0), (2, 1, 0), (6, 0, 0)])
    assert classifier.score(docs, odd).count() == len(data.ROWS)
    kept = classifier.accepted(docs, data.labels(spark))
    assert kept.schema.names == docs.schema.names and kept.count() == len(data.ROWS)
    assert classifier.score(data.empty(spark), odd).count() == 0
    assert classifier.accepted(data.empty(spark), data.labels(spark)).count() == 0


def test_accepted_drops_what_is_rejected(spark):
    rows, marks = corpus(400)
    docs = data.documents(spark, rows)
    kept = {r.doc_id for r in classifier.accepted(docs, data.labels(spark, marks)).collect()}
    said = {r.doc_id for r in classifier.score(docs, data.labels(spark, marks)).collect() if r.predicted}
    assert kept == said and 0 < len(kept) < len(rows)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


def test_rule_statistics_are_the_plain_ones(spark):
    rng = random.Random(3)
    rows = [(k, "".join(rng.choice(["a", "b", "é", "#", "|", " ", " ", "\n", "\t", "\x0b", "a b a b a", "漢"])
                        for _ in range(rng.randint(0, 60))), "en", "a", 1) for k in range(100, 500)]
    rows += data.ROWS
    got = rules.statistics(data.clashing(data.documents(spark, rows))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in got) == sorted(
        (str(r[0]), *brute_statistics(r[1])) for r in rows)


def test_rules_cover_bad_documents_and_keep_good_ones(spark):
    rows, marks = corpus(1500)
    rows += [(5000, "too short", "en", "a", 1), (5001, "a b c d e f g h " * 10, "en", "a", 1)]
    got = {r.doc_id: r for r in rules.judge(data.documents(spark, rows), data.labels(spark, marks)).collect()}
    assert not got[5000].kept and got[5000].base_failed and not got[5001].kept and got[5001].base_failed
    good = [got[k].kept for k in range(1500) if k % 4]
    bad = [got[k].kept for k in range(1500) if k % 4 == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)
    assert all(not r.kept or (r.rule is None and not r.base_failed) for r in got.values())


def test_rules_odd_rows_and_no_python_in_the_plan(spark):
    docs = data.clashing(data.documents(spark))
    got = rules.judge(docs, data.labels(spark)).collect()
    assert len(got) == len(data.ROWS)
    assert all(r.kept != r.base_failed and r.rule is None for r in got)
    assert rules.judge(data.empty(spark), data.labels(spark, [(1, 1, 0)])).count() == 0
    plan = rules.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_verdict_is_an_ordered_conditional(spark):
    listed = [[("words", ">=", 20)], [("words", "<", 5), ("symbols_per_word", ">=", 0.5)]]
    df = spark.createDataFrame([(30, 0), (3, 3), (3, 0)], "n_words long, n_symbols long")
    assert [r[0] for r in df.select(rules.verdict(listed)).collect()] == [False, False, True]
    assert [r[0] for r in df.select(rules.verdict([])).collect()] == [True] * 3


def brute_neighbours(rows, every, k):
    use = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v
           and np.isfinite(v).all() and any(v)}
    out = {}
    for q in sorted(i for i in use if i % every == 0):
        near = [(-(use[q] @ v) / np.sqrt(use[q] @ use[q]) / np.sqrt(v @ v), i) for i, v in use.items() if i != q]
        out[q] = sorted((round(s, 12), i) for s, i in near)[:k]
    return out


def search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit(0))
    out = {}
    for r in sorted(ann.search(df, **options).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((round(-r.score, 12), r.vec_id, r.rank))
    return out


def test_neighbours_reach_recall(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=64).astype(np.float32).tolist(), 0) for k in range(2500)]
    want = brute_neighbours([r[:2] for r in rows], 50, 5)
    got = search(spark, rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in want[q]} & {i for _, i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert all([r for *_, r in x] == [1, 2, 3, 4, 5] for x in got.values())
    exact = search(spark, rows, probes=128, tables=1)
    assert {q: [i for _, i, _ in x] for q, x in exact.items()} == {q: [i for _, i in x] for q, x in want.items()}


def test_neighbours_of_huge_and_tiny_vectors(spark):
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(60, 6))
    scale = 10.0 ** rng.choice([-300, -200, 0, 200, 300], 60)
    schema = "vec_id long, embedding array<double>, label int"
    found = []
    for x in (plain, plain * scale[:, None]):
        df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], schema)
        found.append(sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.search(df, every=5).collect()))
    assert len(found[0]) == 60 and found[0] == found[1]


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=4 if k % 3 else 5).astype(np.float32).tolist(), 0) for k in range(120)] + [(500, [1.0] * 7, 0)]
    got = search(spark, rows, probes=16)
    want = {}
    for size in (4, 5):
        want |= brute_neighbours([r[:2] for r in rows if len(r[1]) == size], 50, 5)
    assert {q: [i for _, i, _ in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}


def test_buckets_and_probes_follow_the_rows(spark):
    """With two axes a bucket holds few rows; short queries still meet all of them."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    rows = [(k, (centres[k % 40] + 0.1 * rng.normal(size=16)).astype(np.float32).tolist(), 0) for k in range(2000)]
    want = brute_neighbours([r[:2] for r in rows], 50, 5)
    for options in ({"block": 64}, {"axes": 3, "probes": 1, "tables": 1, "block": 64}):
        got = search(spark, rows, **options)
        hits = sum(len({i for _, i in want[q]} & {i for _, i, _ in got[q]}) for q in want)
        assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
        assert hits >= (0.9 if "probes" not in options else 0.3) * 5 * len(want)


def test_clustered_vectors_are_compared_with_few():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(1000, 64))
    x = np.repeat(centres, 100, axis=0) + 0.3 * rng.normal(size=(100_000, 64))
    x = ann._unit(x[rng.permutation(len(x))])
    turns = ann.Turns(64, 8, 1, 11)
    probes = ann.fitted_probes(x[:4096], turns, 1, 0.95)
    keys, asks = turns.keys(x), x[:60]
    score = ann.cosines(asks, x)
    score[np.arange(60), np.arange(60)] = -np.inf
    near = np.argsort(-score, axis=1, kind="stable")[:, :5]
    hits = met = 0
    for q, own in enumerate(turns.probes(asks, probes)):
        seen = np.zeros(len(x), bool)
        for t in range(8):
            mine = np.isin(keys[:, t], own[t])
            met += mine.sum()
            seen |= mine
        hits += seen[near[q]].sum()
    assert hits >= 0.9 * 300 and met / 60 < 0.1 * len(x)


def test_neighbours_ties_copies_and_blocks(spark):
    rng = np.random.default_rng(2)
    one = rng.normal(size=8).astype(np.float32).tolist()
    rows = [(k, one if k % 3 else rng.normal(size=8).astype(np.float32).tolist(), 0) for k in range(200)]
    want = brute_neighbours([r[:2] for r in rows], 50, 5)
    got = search(spark, rows, block=16, probes=16, tables=2)
    assert {q: [i for _, i, _ in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}


def test_neighbours_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0, 0.0], 0), (0, [1.0, 0.0, 0.0], 0), (50, [1.0, 0.1, 0.0], 0), (1, [0.0, 0.0, 0.0], 0),
            (2, None, 0), (3, [nan, 1.0, 0.0], 0), (4, [1.0, None, 0.0], 0), (5, [-1.0, 0.0, 0.0], 0),
            (None, [1.0, 0.0, 0.0], 0), (7, [float("inf"), 0.0, 0.0], 0), (8, [], 0), (9, [0.0, 1.0, 0.0], 0)]
    got = search(spark, rows)
    assert {q: [i for _, i, _ in x] for q, x in got.items()} == {0: [50, 9, 5], 50: [0, 9, 5]}
    assert search(spark, rows[:0]) == {} and search(spark, [(1, [1.0], 0)]) == {}
    assert search(spark, [(0, [1.0], 0)]) == {}
