import re

import data
import pytest

from patronage.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), most=3.0):
    """Reshare the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if most * sizes[s] < level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= full
    return out


def test_targets_and_taken_words(spark):
    rows = data.ROWS
    got = mixing.mix(data.documents(spark)).collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    want, source_of = brute_targets(sizes), {r[0]: r[3] for r in rows}
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        assert r.taken == sum(c.words for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
        taken[s] += r.taken
    assert all(int(want[s]) == taken[s] for s in sizes)


def test_reruns_and_row_order_agree(spark):
    key = lambda df: sorted((str(r.doc_id), r.taken, str(r.copies)) for r in df.collect())
    assert key(mixing.mix(data.documents(spark))) == key(mixing.mix(data.documents(spark, data.ROWS[::-1])))


def test_positions_follow_the_schedule(spark):
    """By half of the training a source has fed the share its schedule's integral says."""
    rows = [(k, "w w w w", "en", f"s{k % 3}", 7) for k in range(3000)]
    got = mixing.mix(data.documents(spark, rows)).collect()
    fed = {}
    for r in got:
        s = rows[r.doc_id][3]
        half, whole = fed.get(s, (0, 0))
        fed[s] = (half + sum(c.words for c in r.copies if c.position <= 0.5), whole + r.taken)
    share = {s: h / w for s, (h, w) in fed.items()}
    assert share["s0"] == pytest.approx(5 / 8, abs=0.01)  # 7.5 -> 2.5: (7.5 + 5) / 2 / 2 of 5
    assert share["s1"] == pytest.approx(1 / 2, abs=0.01)
    assert share["s2"] == pytest.approx(3 / 8, abs=0.01)


def test_training_order_keeps_columns_and_sorts(spark):
    docs = data.clashing(data.documents(spark))
    out = mixing.training_order(docs)
    assert out.schema.names == docs.schema.names
    rows = out.collect()
    taken = {}
    for r in rows:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert rows and all(n <= 6 for n in taken.values()) and not {3, 4, 5} & set(taken)


def test_empty_table_own_schedules_and_bad_schedule(spark):
    assert mixing.mix(data.empty(spark)).count() == 0
    assert mixing.training_order(data.empty(spark)).count() == 0
    only = mixing.mix(data.documents(spark), by_source={s: ((0, 0.0), (1, 0.0)) for s in ("a", "b", "c", "d")})
    assert all(r.taken == 0 for r in only.collect() if r.doc_id in (1, 2, 6, 7, 8))
    with pytest.raises(ValueError):
        mixing.mix(data.documents(spark), cycle=[((0.0, 1.0), (0.5, 1.0))])
