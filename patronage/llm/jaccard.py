"""Similarity join of documents by n-gram Jaccard, vertically partitioned.

N-grams (``width`` words) are named by 64 bits in one global order and this
order is cut into fragments: a fragment gets its own n-grams of every set and
counts there, and what it counted is summed per set or per pair.

1. Documents with the same set of n-grams are one set (named by a 64-bit hash
   of its sorted names: two of m sets share it by chance with odds m * m / 2**65).
2. Each fragment counts in how many sets its n-grams occur.  A set that shares m
   of its n n-grams with any other set at all can only be linked when
   100 * m >= percent * n; sums over fragments drop most sets here, and
   every n-gram of one set.  A fragment has about ``load`` n-grams, and a task
   sums up about ``sets_a_task`` sets; n-grams travel packed, not as rows.
   N-grams that 1/64 of all documents hold aren't counted but taken as shared,
   in fragments dealt by set, so that no task gets all their holders.
3. Sets that stay have their n-grams ordered by frequency, then name.  Linked
   sets share one of their first m - least + 1 (their prefix; ``least`` is the
   overlap they need).
4. Of a group of near copies not all pairs are compared.  First each set meets
   the leader, the set with the most common n-grams, among those with its least
   rehashed n-gram, ``rounds`` times with other hashes; the links found give
   components.  Then each set meets, for each n-gram of its prefix, the leader of
   those that share it, if of another component.  Last, sets that share a prefix
   n-gram and are still of different components are compared, all of them: for
   each n-gram, those outside its largest component with all others.  N-grams
   fall into cells, and a set has the parity of its n-grams in each; cells that
   differ bound what lies outside the overlap, and pairs apart by this bound make
   no row.
5. A pair's overlap is counted in each of ``parts`` fragments by itself and
   summed; a link needs 100 * overlap >= percent * union.

Defined cases: a text with fewer words than ``width`` is one n-gram; null or
empty text, or text without words, has none and is linked with nothing; null
ids count for no minimum (a component of null ids has a null id); repeated rows
are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import column, gather, slices, text_of
from .components import components

_HOT, _LEAST_HOT = 64, 1000  # an n-gram of 1 / _HOT of the documents, and of so many, is dealt by set
_COMMON = (1 << 31) - 1  # the frequency such an n-gram counts as
_ODD = 16  # words of 64 parity bits


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Names of ``width`` words in a row, from each place on."""
    n = max(0, len(words) - width + 1)
    name = np.full(n, width, np.uint64)
    for k in range(width):
        name = _mixed(name * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
    return name


def gram_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct names of each text's n-grams; A-Z count as a-z."""
    held = [t.lower().split() for t in texts]
    coded = pa.array([w for own in held for w in own], pa.large_binary()).dictionary_encode()
    names = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    words = names[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else names
    grams, out, at = _rolled(words, width), [], 0
    for own in held:
        n = len(own)
        whole = grams[at:at + n - width + 1] if n >= width else _rolled(words[at:at + n], n) if n else words[:0]
        out.append(np.unique(whole))
        at += n
    return out


def _set_name(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def _documents(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, sid (null without words) and, in one row of each slice, the
    n-grams that many of the slice's sets hold with their number of sets."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs[text_col]).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            sets = gram_sets(texts, width)
            sids = [_set_name(s) if len(s) else None for s in sets]
            once = {i: s for i, s in zip(sids, sets) if i is not None}
            grams, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *once.values()]), return_counts=True)
            often = counts >= max(8, len(once) // (2 * _HOT))
            hot = list(zip(grams[often].view(np.int64).tolist(), counts[often].tolist()))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sids, pa.int64()),
                 pa.array([[{"gram": g, "sets": c} for g, c in hot], *[None] * (len(sets) - 1)],
                          pa.list_(pa.struct([("gram", pa.int64()), ("sets", pa.int64())])))],
                ["doc_id", "n", "sid", "hot"])

    return source.mapInArrow(run, "doc_id long, n long, sid long, hot array<struct<gram: long, sets: long>>")


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each stretch of equal keys."""
    cuts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])


def _packed(rows: list[tuple], key: str, names: tuple[str, ...]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * (1 + len(names))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                                      [key, *names])


def _unpacked(rows: pa.Table, *kinds: tuple[str, str]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in kinds]


def _shared(docs: DataFrame, width: int, text_col: str, hot: np.ndarray, fragments: int, buckets: int) -> DataFrame:
    """Packed by bucket of sets: the n-grams of a set in one fragment that occur in
    other sets, too, and the number of sets of each."""
    source = docs.select(text_of(docs[text_col]).alias("_text"))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "_text"):
            once = {_set_name(s): s for s in gram_sets(texts, width) if len(s)}
            if not once:
                continue
            sids, sizes = np.array(list(once), np.int64), np.array([len(s) for s in once.values()])
            grams, own = np.concatenate(list(once.values())), np.repeat(np.arange(len(sids)), sizes)
            to = ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
            if len(hot):
                found = hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] == grams
                to[found] = fragments + np.mod(sids[own[found]], fragments)
            order = np.argsort(to, kind="stable")
            to, grams, own = to[order], grams[order], own[order]
            rows = []
            for a, b in _runs(to):
                first = np.flatnonzero(np.diff(own[a:b], prepend=-1))
                whose = own[a:b][first]
                rows.append((int(to[a]), sids[whose].tobytes(), sizes[whose].astype("<i4").tobytes(),
                             np.diff(first, append=b - a).astype("<i4").tobytes(), grams[a:b].tobytes()))
            yield _packed(rows, "fragment", ("sids", "sizes", "counts", "grams"))

    def count(rows: pa.Table) -> pa.Table:
        sids, sizes, counts, grams = _unpacked(rows, ("sids", "<i8"), ("sizes", "<i4"), ("counts", "<i4"), ("grams", "<u8"))
        # a set that several slices hold counts once
        first = np.zeros(len(sids), bool)
        first[np.unique(sids, return_index=True)[1]] = True
        grams = grams[np.repeat(first, counts)]
        sids, sizes, counts = sids[first], sizes[first], counts[first]
        if rows.column("fragment")[0].as_py() >= fragments:
            freqs = np.full(len(grams), _COMMON)
        else:
            order = np.argsort(grams, kind="stable")
            new = np.diff(grams[order], prepend=grams[order[:1]]) != 0
            each = np.bincount(np.cumsum(new))
            freqs = np.empty(len(grams), np.int64)
            freqs[order] = np.repeat(each, each)
        stay = freqs > 1
        counts = np.add.reduceat(stay.astype(np.int64), np.cumsum(counts) - counts)
        grams, freqs = grams[stay], freqs[stay]
        starts, bucket = np.cumsum(counts) - counts, np.mod(sids, buckets)
        order = np.argsort(bucket, kind="stable")
        order = order[counts[order] > 0]
        out = []
        for a, b in _runs(bucket[order]):
            mine = order[a:b]
            out.append((int(bucket[mine[0]]), sids[mine].tobytes(), sizes[mine].tobytes(),
                        counts[mine].astype("<i4").tobytes(), gather(grams, starts[mine], counts[mine]).tobytes(),
                        gather(freqs, starts[mine], counts[mine]).astype("<i4").tobytes()))
        return pa.Table.from_batches([_packed(out, "bucket", ("sids", "sizes", "counts", "grams", "freqs"))])

    dealt = source.mapInArrow(deal, "fragment int, sids binary, sizes binary, counts binary, grams binary")
    return dealt.repartition(2 * fragments, "fragment").groupBy("fragment").applyInArrow(
        count, "bucket int, sids binary, sizes binary, counts binary, grams binary, freqs binary")


def _least(n: str | Column, percent: int) -> Column:
    """The overlap that a set of ``n`` n-grams needs with any set it is linked with."""
    return F.ceil((F.col(n) if isinstance(n, str) else n) * percent / 100).cast("int")


def _candidates(shared: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Sets that share enough: sid, n, own (n-grams that no other set has), grams
    (freq, gram) in the global order, odd (parity bits of the n-grams' cells)."""
    def summed(rows: pa.Table) -> pa.Table:
        sids, sizes, counts, grams, freqs = _unpacked(
            rows, ("sids", "<i8"), ("sizes", "<i4"), ("counts", "<i4"), ("grams", "<i8"), ("freqs", "<i4"))
        names, first, where = np.unique(sids, return_index=True, return_inverse=True)
        n, m = sizes[first].astype(np.int64), np.bincount(where, counts, len(names)).astype(np.int64)
        enough = m * 100 >= n * percent
        held = np.repeat(where, counts)
        stay = enough[held]
        held, grams, freqs = held[stay], grams[stay], freqs[stay]
        order = np.lexsort((grams, freqs, held))
        grams, freqs = grams[order], freqs[order]
        names, n, m = names[enough], n[enough], m[enough]
        pairs = pa.StructArray.from_arrays([pa.array(freqs), pa.array(grams)], ["freq", "gram"])
        ends = np.cumsum(m)
        return pa.table([pa.array(names), pa.array(n), pa.array(n - m),
                         pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pairs),
                         pa.array(_parities(grams, ends), pa.list_(pa.int64()))], ["sid", "n", "own", "grams", "odd"])

    return shared.repartition(2 * buckets, "bucket").groupBy("bucket").applyInArrow(
        summed, "sid long, n long, own long, grams array<struct<freq: int, gram: long>>, odd array<long>")


def _parities(grams: np.ndarray, ends: np.ndarray, block: int = 4096) -> list[np.ndarray]:
    """Each set's parity bits: cells that an odd number of its n-grams fall in."""
    cells, width, out = (grams.view(np.uint64) % np.uint64(64 * _ODD)).astype(np.int64), 64 * _ODD, []
    begins = np.append(0, ends)
    for k in range(0, len(ends), block):
        some = begins[k:k + block + 1]
        own = np.repeat(np.arange(len(some) - 1), np.diff(some))
        odd = np.bincount(own * width + cells[some[0]:some[-1]], minlength=(len(some) - 1) * width) & 1
        out += list(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(-1, _ODD))
    return out


def _near(percent: int) -> Column:
    """Whether a pair (columns ending in _a and _b) may be linked: every n-gram of
    one set alone flips one parity bit, so bits that differ, and n-grams that no
    other set has, are at most those outside the overlap."""
    apart = sum(F.bit_count(F.col("odd_a")[k].bitwiseXOR(F.col("odd_b")[k])) for k in range(_ODD))
    return (apart + F.col("own_a") + F.col("own_b")) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)


def _sides(*cols: str) -> list[list[Column]]:
    return [[F.col(c).alias(f"{c}{end}") for c in cols] for end in ("_a", "_b")]


def _with_common(sets: DataFrame) -> DataFrame:
    """``sets`` with how common their n-grams are: the text that others are copies
    of has the most common ones."""
    return sets.withColumn("common", F.aggregate(
        "grams", F.lit(0.0), lambda s, g: s + F.log2(g["freq"].cast("double"))) / F.col("n"))


def _pairs(ids: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(sid_a, sid_b, ...) with n_a and n_b, of those that may be linked."""
    a, b = _sides("sid", "n", "own", "odd")
    return ids.distinct().join(sets.select(a), "sid_a").join(sets.select(b), "sid_b").where(_near(percent)).select(
        *ids.columns, "n_a", "n_b")


def _to_leaders(sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """Pairs of each set and its leaders."""
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.array_min(F.transform(
        "grams", lambda g: F.xxhash64(F.lit(k), g["gram"]))).alias("key")) for k in range(rounds)])
    keyed = materialize(sets.select("sid", "common", F.explode(keys).alias("x")).select(
        "sid", "common", "x.k", "x.key"), "jaccard-keys")
    leaders = keyed.groupBy("k", "key").agg(F.max(F.struct("common", "sid")).alias("lead"),
                                            F.count(F.lit(1)).alias("held")).where("held > 1")
    return _pairs(keyed.join(leaders, ["k", "key"]).where("sid <> lead.sid").select(
        F.col("sid").alias("sid_a"), F.col("lead.sid").alias("sid_b")), sets, percent)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(sid, common, gram): what a set shares one of with any set it is linked with."""
    prefix = F.slice("grams", 1, F.size("grams") - _least("n", percent) + 1)
    return sets.select("sid", "common", F.explode(F.transform(prefix, lambda g: g["gram"])).alias("gram"))


def _rooted(prefixes: DataFrame, joined: DataFrame) -> DataFrame:
    return materialize(prefixes.join(joined.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "common", "gram", F.coalesce("root", "sid").alias("root")), "jaccard-prefixes")


def _to_prefix_leaders(sets: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Pairs of a set and the leader of those that share a prefix n-gram with it, if
    another component's: one for each n-gram of its prefix."""
    leaders = held.groupBy("gram").agg(F.max(F.struct("common", "sid", "root")).alias("lead"), F.min("root").alias("r0"),
                                       F.max("root").alias("r1")).where("r0 <> r1").select("gram", "lead")
    return _pairs(held.join(leaders, "gram").where("root <> lead.root").select(
        F.col("sid").alias("sid_a"), F.col("lead.sid").alias("sid_b"), F.col("root").alias("root_a"),
        F.col("lead.root").alias("root_b")), sets, percent)


def _across(sets: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different components that share an n-gram of their prefixes."""
    sizes = held.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("held"))
    most = sizes.groupBy("gram").agg(F.max(F.struct("held", "root")).alias("most"), F.count(F.lit(1)).alias("roots")).where(
        "roots > 1").select("gram", F.col("most.root").alias("most"))
    mixed = materialize(held.join(most, "gram").join(sets.select("sid", "n", "own", "odd"), "sid"), "jaccard-mixed")
    a, b = _sides("sid", "n", "own", "odd", "root")
    few = mixed.where("root <> most").select("gram", *a)
    return few.join(mixed.select("gram", "most", *b), "gram").where(
        (F.col("root_a") != F.col("root_b"))
        & ((F.col("root_b") == F.col("most")) | (F.col("sid_a") < F.col("sid_b")))
        & _near(percent)).select("sid_a", "sid_b", "n_a", "n_b", "root_a", "root_b").distinct()


def _links(pairs: DataFrame, pieces: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked, by overlaps counted in each fragment."""
    left = pieces.select(F.col("sid").alias("sid_a"), "part", F.col("grams").alias("grams_a"))
    right = pieces.select(F.col("sid").alias("sid_b"), "part", F.col("grams").alias("grams_b"))
    counted = pairs.join(left, "sid_a").join(right, ["sid_b", "part"]).select(
        *pairs.columns, F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    return counted.groupBy(*pairs.columns).agg(F.sum("overlap").alias("overlap")).where(
        F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent)


def linked_sets(sets: DataFrame, percent: int, rounds: int, parts: int) -> DataFrame:
    """(node, root) of all sets that are linked."""
    def piece(part: int) -> Column:
        own = F.filter("grams", lambda g: F.pmod(F.shiftright(g["gram"], 40), F.lit(parts)) == part)
        return F.struct(F.lit(part).alias("part"), F.transform(own, lambda g: g["gram"]).alias("grams"))

    pieces = materialize(
        sets.select("sid", F.explode(F.array(*[piece(k) for k in range(parts)])).alias("x")).select(
            "sid", "x.part", "x.grams").where(F.size("grams") > 0), "jaccard-pieces")
    near = _links(_to_leaders(sets, percent, rounds), pieces, percent)
    joined = materialize(components(near.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))), "jaccard-joined")
    prefixes = _prefixes(sets, percent)
    for step in (_to_prefix_leaders, _across):
        more = _links(step(sets, _rooted(prefixes, joined), percent), pieces, percent)
        # many links between two components are one
        joined = _merged(joined, more.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct())
    return joined


def _merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after ``links`` between roots, or sets that had no link."""
    last = materialize(components(links), "jaccard-last")
    both = joined.join(last.select(F.col("node").alias("root"), F.col("root").alias("last")), "root", "left").select(
        "node", F.coalesce("last", "root").alias("root"))
    return materialize(both.unionByName(last.join(joined.select("node"), "node", "left_anti").select("node", "root")),
                       "jaccard-joined")


def classes(docs: DataFrame, width: int = 5, percent: int = 80, rounds: int = 4, parts: int = 8,
            load: int = 4_000_000, sets_a_task: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id
    (the smallest id that links reach, its own included)."""
    rows = materialize(_documents(docs, width, id_col, text_col), "jaccard-docs")
    n_docs, n_grams = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    hot = rows.select(F.explode("hot").alias("x")).groupBy("x.gram").agg(F.sum("x.sets").alias("sets")).where(
        F.col("sets") >= max(_LEAST_HOT, n_docs // _HOT)).select("gram")  # at most _HOT times the mean set
    hot = np.sort(hot.toArrow().column("gram").to_numpy().view(np.uint64))
    buckets = 1 + n_docs // sets_a_task
    shared = _shared(docs, width, text_col, hot, 1 + (n_grams or 0) // load, buckets)
    sets = materialize(_with_common(_candidates(shared, percent, buckets)), "jaccard-sets")
    joined = linked_sets(sets, percent, rounds, parts)
    # from sets back to documents; copies meet here, as one row with map-side minima
    firsts = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id"))
    named = firsts.join(joined, firsts["sid"] == joined["node"], "left").select(
        "sid", F.coalesce("root", "sid").alias("root"), "first_id")
    named = materialize(named, "jaccard-classes")
    least = named.groupBy("root").agg(F.min("first_id").alias("least"))
    named = named.join(least, "root").select("sid", "least")
    return rows.join(named, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
