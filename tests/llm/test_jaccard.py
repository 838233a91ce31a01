import random

import data
import numpy as np
import pytest

from patronage.llm import jaccard


def gram_set(text, width=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent=80, width=5):
    sets = [gram_set(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted(str((r[0], len(s), least.get(find(k)))) for k, (r, s) in enumerate(zip(rows, sets)))


def result(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def edited(rng, words, vocabulary, edits):
    out = list(words)
    for _ in range(edits if out else 0):
        k = rng.randrange(max(1, len(out)))
        out[k:k + 1] = rng.choice([[rng.choice(vocabulary)], [], out[k:k + 1] + [rng.choice(vocabulary)]])
    return out


def groups(seed, n, vocabulary=60):
    """Texts with copies from exact to far, so that many pairs lie at the limit."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    rows = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 9, 40, 120]))]
        for _ in range(rng.randint(1, 12)):
            rows.append((len(rows), " ".join(edited(rng, base, words, rng.choice([0, 1, 1, 2, 3, 5, 8]))), "en", "a", 0))
            base = rows[-1][1].split() if rng.random() < 0.2 and rows[-1][1] else base  # chains
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = groups(seed, 60)
    assert result(jaccard.classes(data.documents(spark, rows), load=1000, sets_a_task=40)) == brute(rows)


def test_other_widths_and_percents(spark):
    rows = groups(7, 25)
    got = jaccard.classes(data.documents(spark, rows), width=3, percent=60, rounds=1, parts=3)
    assert result(got) == brute(rows, 60, 3)


def test_a_large_group_of_near_copies_and_a_common_passage(spark, monkeypatch):
    """Hundreds of near copies of one text, linked with it or just not, and a
    passage that most texts hold, dealt by set."""
    rng = random.Random(3)
    words = [f"v{k}" for k in range(2000)]
    base, passage = [rng.choice(words) for _ in range(100)], [rng.choice(words) for _ in range(60)]
    rows = [(k, " ".join(edited(rng, base, words, rng.randint(0, 6))), "en", "a", 0) for k in range(250)]
    rows += [(300 + k, " ".join([rng.choice(words) for _ in range(rng.choice([0, 5, 60]))] + passage), "en", "a", 0)
             for k in range(250)]
    held = []
    plain = jaccard._shared

    def shared(docs, width, text_col, hot, *cuts):
        held.append(len(hot))
        return plain(docs, width, text_col, hot, *cuts)
    monkeypatch.setattr(jaccard, "_shared", shared)
    monkeypatch.setattr(jaccard, "_LEAST_HOT", 100)
    assert result(jaccard.classes(data.documents(spark, rows), load=2000)) == brute(rows)
    assert held[0] >= 50


def test_pairs_apart_by_their_parity_make_no_row(spark):
    rng = random.Random(4)
    words = [f"v{k}" for k in range(30)]
    base = [rng.choice(words) for _ in range(150)]
    rows = [(k, " ".join(edited(rng, base, words, rng.choice([1, 2, 9]))), "en", "a", 0) for k in range(200)]
    docs = data.documents(spark, rows)
    shared = jaccard._shared(docs, 5, "text", np.zeros(0, np.uint64), 2, 3)
    sets = jaccard._with_common(jaccard._candidates(shared, 80, 3)).cache()
    n = sets.count()
    alone = jaccard._rooted(jaccard._prefixes(sets, 80), spark.createDataFrame([], "node long, root long"))
    pairs = jaccard._across(sets, alone, 80).count()
    # leaders are met once for each n-gram of a prefix at most
    assert jaccard._to_prefix_leaders(sets, alone, 80).count() <= alone.count()
    own = list({frozenset(gram_set(r[1])) for r in rows})
    linked = sum(100 * len(x & y) >= 80 * len(x | y) for i, x in enumerate(own) for y in own[:i])
    assert n > 100 and linked <= pairs < 0.25 * n * n
    sets.unpersist()


def test_odd_rows(spark):
    rows = [r for r in data.ROWS if r[0] != 10] + [(12, "ONE", "en", "c", 3), (14, "one\x0btwo three", "en", "c", 3),
                                                  (15, "One two\nTHREE ", "en", "c", 3), (None, "one", "en", "c", 3)]
    assert result(jaccard.classes(data.clashing(data.documents(spark, rows)))) == brute(rows)
    long = jaccard.classes(data.documents(spark, [(1, data.LONG, "en", "a", 0), (2, data.LONG + "x", "en", "a", 0)]))
    assert result(long) == brute([(1, data.LONG), (2, data.LONG + "x")])
    assert jaccard.classes(data.empty(spark)).count() == 0
    assert result(jaccard.classes(data.documents(spark, [(None, None, None, None, None)]))) == ["(None, 0, None)"]


def test_names_of_n_grams():
    a, b = jaccard.gram_sets([b"a b c d e f", b"A  B\tc d e\nF a b c d e"], 5)
    assert len(a) == 2 and len(b) == 6 and np.isin(a, b).all()
    assert len(jaccard.gram_sets([b"a b", b"a", b"", b"a b a b"], 5)[2]) == 0
    short = jaccard.gram_sets([b"a b", b"b a", b"a b c"], 5)
    assert len({int(x[0]) for x in short}) == 3
