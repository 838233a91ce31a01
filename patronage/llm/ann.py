"""Approximate nearest neighbours by cross-polytope hashing.

1. Each table turns unit vectors by three rounds of random signs and a fast
   Hadamard transform; the nearest signed axis (the largest coordinate by
   size) of the turned vector is its key.  ``axes`` such keys, from turns of
   their own, make a bucket; raise it with the table, since buckets hold
   rows / (2 * dimension) ** axes.
2. Every row goes to its bucket in each of ``tables`` tables.  A query goes to
   its own and the next nearest buckets, ``probes`` in each table.
   ``axes`` follows the number of rows, so that a bucket holds about ``block``
   rows; ``probes`` is the least by which a sample of ``sample`` rows finds
   ``recall`` of its nearest (``fitted_probes``).
3. A bucket is searched in blocks of about ``block`` rows by 8 * ``block`` queries,
   however many rows it holds: large buckets are cut by hash on both sides.
   In a block, exact cosines in double precision give each query's ``k``
   nearest; only those leave it.
4. The best of all blocks are each query's result.  A query that found fewer
   than ``k`` meets all rows, in blocks.

Defined cases: vectors that are null, zero or hold null or non-finite
components take no part, nor do null ids; vectors of different lengths have no
cosine, so each length is searched by itself; rows that share a query's id are
its own; repeated rows of another id count once; equal scores go to the smaller id; an empty table, or one without
queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import column


MOST_PROBES = 512  # in a table


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast orthonormal Hadamard transform of rows; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(n, width) / np.sqrt(width)


class Turns:
    """The pseudo-rotations of all tables."""

    def __init__(self, dimension: int, tables: int, axes: int, seed: int):
        self.width = 1 << max(0, dimension - 1).bit_length()
        self.tables, self.axes = tables, axes
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, axes, 3, self.width))

    def turned(self, x: np.ndarray, table: int, axis: int) -> np.ndarray:
        x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        for signs in self.signs[table, axis]:
            x = hadamard(x * signs)
        return x

    def keys(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        out = np.zeros((len(x), self.tables), np.int64)
        for t, a in product(range(self.tables), range(self.axes)):
            y = self.turned(x, t, a)
            top = np.abs(y).argmax(axis=1)
            out[:, t] = out[:, t] * 2 * self.width + 2 * top + (y[np.arange(len(y)), top] > 0)
        return out

    def probes(self, x: np.ndarray, n: int, tables: Iterable[int] | None = None) -> np.ndarray:
        """The ``n`` nearest buckets of each row in each table (or in those of
        ``tables``): row, table, probe."""
        n, tables = min(n, (2 * self.width) ** self.axes), list(range(self.tables) if tables is None else tables)
        out = np.zeros((len(x), len(tables), n), np.int64)
        for place, t in enumerate(tables):
            best, key = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for a in range(self.axes):
                y = self.turned(x, t, a)
                near = np.concatenate([-y, y], axis=1)  # nearness to each signed axis
                name = np.concatenate([2 * np.arange(self.width), 2 * np.arange(self.width) + 1])
                both = (best[:, :, None] + near[:, None, :]).reshape(len(x), -1)
                names = (key[:, :, None] * 2 * self.width + name).reshape(len(x), -1)
                pick = np.argsort(-both, axis=1, kind="stable")[:, :n]
                best, key = np.take_along_axis(both, pick, 1), np.take_along_axis(names, pick, 1)
            out[:, place] = key
        return out


def _rows(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    values = batch.column(name)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: no
    square overflows or vanishes, and no cosine changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def cosines(asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of each pair of scaled rows, term by term in one order for every
    pair, so equal vectors tie."""
    norm = [np.sqrt(np.einsum("nd,nd->n", x, x)) for x in (asks, rows)]
    return np.einsum("qd,nd->qn", asks, rows) / (norm[0][:, None] * norm[1])


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): usable vectors, each id and vector once; single precision stays so until it is computed with."""
    v = vectors[vector_col]
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates(["id", "v"])


def _bucketed(rows: DataFrame, key_lists: str) -> DataFrame:
    """A row (t, key, id, v) for each bucket; key_lists is an array per table."""
    each = rows.select("id", "v", F.posexplode(key_lists).alias("t", "keys"))
    return each.select("t", F.explode("keys").alias("key"), "id", "v")


def _search(data: DataFrame, queries: DataFrame, k: int, block: int) -> DataFrame:
    """Best rows of each query in each block: (query_id, vec_id, score).  Queries are
    cut eight times coarser than rows: a row is copied for each 8 * ``block`` queries
    of its bucket, a query for each ``block`` rows."""
    def counted(rows: DataFrame, name: str, size: int) -> DataFrame:
        return rows.groupBy("t", "key").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    # one row per bucket that both sides use; staged, so the joins know its size
    cuts = materialize(counted(data, "rows", block).join(counted(queries, "asks", 8 * block), ["t", "key"]), "ann-buckets")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        own_part = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        return rows.join(cuts, ["t", "key"]).select(
            "t", "key", "id", "v", own_part.alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))

    names = ["t", "key", "rows", "asks"]

    def best(rows: pa.Table, asks: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if rows.num_rows and asks.num_rows:
            rows = rows.sort_by("id")
            ids, x = rows.column("id").to_numpy(), _scaled(_rows(rows, "v"))
            for at in range(0, asks.num_rows, 256):
                part = asks.slice(at, 256)
                own = part.column("id").to_numpy()
                score = cosines(_scaled(_rows(part, "v")), x)
                score[own[:, None] == ids] = -np.inf
                least = np.partition(score, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
                for j, (mine, s) in enumerate(zip(own.tolist(), score)):
                    near = np.flatnonzero((s >= least[j]) & (s > -np.inf))
                    near = near[np.argsort(-s[near], kind="stable")][:k]
                    found[0] += [mine] * len(near)
                    found[1] += ids[near].tolist()
                    found[2] += s[near].tolist()
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                         pa.array(found[2], pa.float64())], ["query_id", "vec_id", "score"])

    return dealt(data, "rows", "asks").groupBy(*names).cogroup(
        dealt(queries, "asks", "rows").groupBy(*names)).applyInArrow(best, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fitted_probes(x: np.ndarray, turns: Turns, k: int, recall: float, asks: int = 256) -> int:
    """The least number of probes in each table by which the first ``asks`` rows of a
    sample find ``recall`` of their ``k`` nearest in it.  Neighbours in a sample are
    farther than those among all rows, so all rows need no more."""
    x = _unit(x)
    n, asks = len(x), min(asks, len(x))
    k = min(k, n - 1)
    if k < 1:
        return 1
    score = cosines(x[:asks], x)
    score[np.arange(asks), np.arange(asks)] = -np.inf
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    keys = turns.keys(x)
    # the probe at which a query's table reaches a neighbour's bucket
    at = np.full((asks, k), np.iinfo(np.int64).max)
    for t in range(turns.tables):
        probes = turns.probes(x[:asks], MOST_PROBES, (t,))[:, 0]
        for q in range(asks):
            place = {key: p for p, key in enumerate(probes[q].tolist())}
            at[q] = np.minimum(at[q], [place.get(key, MOST_PROBES) for key in keys[near[q], t].tolist()])
    found = np.sort(at.ravel())
    return int(min(MOST_PROBES, 1 + found[min(len(found) - 1, int(np.ceil(recall * len(found))) - 1)]))


def _of_length(rows: DataFrame, n: int, length: int, every: int, k: int, tables: int, recall: float, axes: int | None,
               probes: int | None, block: int, sample: int, seed: int) -> DataFrame:
    """``search`` among the ``n`` rows of one length."""
    rows, kind = rows.where(F.size("v") == length), rows.schema["v"].dataType.simpleString()
    width = Turns(length, 0, 1, seed).width
    if axes is None:  # buckets of about a block, however many rows there are
        axes = 1
        while n > block * (2 * width) ** axes:
            axes += 1
    turns = Turns(length, tables, axes, seed)
    if probes is None:
        drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
        # the k nearest of n rows are so many of a sample's, if it has any of them
        probes = fitted_probes(_rows(drawn, "v"), turns, -(-k * drawn.num_rows // n), recall)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = turns.keys(_unit(_rows(batch, "v")))
                yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "v"), pa.array(list(keys))],
                                                 ["id", "v", "keys"])

    def probing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                near = turns.probes(_unit(_rows(part, "v")), probes)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "id"), column(part, "v"), pa.array([list(x) for x in near])], ["id", "v", "near"])

    hashed = materialize(rows.mapInArrow(keyed, f"id long, v {kind}, keys array<long>"), "ann-rows")
    data = _bucketed(hashed.withColumn("keys", F.transform("keys", lambda x: F.array(x))), "keys")
    queries = hashed.where(F.col("id") % every == 0).select("id", "v")
    asked = materialize(queries.mapInArrow(probing, f"id long, v {kind}, near array<array<long>>"), "ann-queries")
    found = materialize(_ranked(_search(data, _bucketed(asked, "near"), k, block), k), "ann-found")
    # queries that found too few meet all rows, in blocks of one bucket
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = materialize(queries.join(full, "id", "left_anti"), "ann-short")
    if not short.isEmpty():
        one = [F.lit(0).alias("t"), F.lit(0).cast("long").alias("key"), "id", "v"]
        rest = _ranked(_search(hashed.select(*one), short.select(*one), k, block), k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, every: int = 50, k: int = 5, tables: int = 8, recall: float = 0.95,
           axes: int | None = None, probes: int | None = None, block: int = 4096, sample: int = 4096, seed: int = 11, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each query (ids divisible by ``every``):
    query_id, rank, vec_id, score."""
    rows = materialize(valid(vectors, id_col, vector_col), "ann-valid")
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()
    parts = [_of_length(rows, r.n, r.length, every, k, tables, recall, axes, probes, block, sample, seed)
             for r in lengths]
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, parts)
