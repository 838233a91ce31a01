"""A26 for wide tables: correlations from sums of a Gram matrix.

Each task multiplies its batches as matrices and keeps k x k sums: products,
squares and values of each column over the rows where the other is present, and
the number of these rows.  One row per column and task is then added up, also
batch by batch, so memory is k x k numbers whatever the table holds.  Columns
are shifted by their mean first, so that sums of squares keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = ("xy", "x", "y", "xx", "yy", "n", "bad")


def _matrices(batch: pa.RecordBatch, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shifted values (0 where null or not finite), presence, and not-finite marks."""
    x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    there = ~np.stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    odd = there & ~np.isfinite(x)
    return np.where(there & ~odd, x - shift, 0.0), there.astype(np.float64), odd.astype(np.float64)


def correlations(df: DataFrame, cols: Sequence[str], nd: int = 6) -> DataFrame:
    """(col_a, col_b, corr) for every pair of ``cols``, nulls left out pairwise; null
    where fewer than two rows or no spread remain, NaN where a value isn't finite."""
    names, k = list(cols), len(cols)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    finite = [F.avg(F.when(F.col(f"c{i}").between(-1e300, 1e300), F.col(f"c{i}"))).alias(f"c{i}") for i in range(k)]
    means = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in rows.agg(*finite).first()])

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((k, k)) for s in _SUMS}
        for batch in batches:
            x, there, odd = _matrices(batch, means)
            at, square = x.T @ there, (x * x).T @ there
            bad = odd.T @ there
            for name, part in zip(_SUMS, (x.T @ x, at, at.T, square, square.T, there.T @ there, bad + bad.T)):
                sums[name] += part
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), *[pa.array(list(sums[s]), pa.list_(pa.float64())) for s in _SUMS]], ["i", *_SUMS])

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            parts = np.stack([batch.column(s).flatten().to_numpy().reshape(batch.num_rows, k) for s in _SUMS], axis=1)
            for i, part in zip(batch.column("i").to_pylist(), parts):
                total[i] = total[i] + part if i in total else part
        a, b, found = [], [], []
        for i, sums in total.items():
            xy, x, y, xx, yy, n, bad = sums[:, i:]
            with np.errstate(all="ignore"):
                var_x, var_y = xx - x * x / n, yy - y * y / n
                r = (xy - x * y / n) / np.sqrt(var_x * var_y)
            # a column without spread keeps only rounding errors of its shift
            flat = (var_x <= 1e-28 * n * means[i] ** 2) | (var_y <= 1e-28 * n * means[i:] ** 2)
            a += [names[i]] * (k - i)
            b += names[i:]
            found += [float("nan") if w else None if m < 2 or f else v for v, m, f, w in zip(
                r.tolist(), n.tolist(), flat.tolist(), (bad > 0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(found, pa.float64())],
                                         ["col_a", "col_b", "corr"])

    schema = "i int, " + ", ".join(f"`{s}` array<double>" for s in _SUMS)
    # a row of zeros for each column: a table without rows has pairs, too
    zeros = df.sparkSession.range(k).select(F.col("id").cast("int").alias("i"), *[
        F.array_repeat(F.lit(0.0), k).alias(s) for s in _SUMS])
    parts = rows.mapInArrow(summed, schema).unionByName(zeros).repartition(max(1, k // 16), "i")
    return parts.mapInArrow(added, "col_a string, col_b string, corr double").withColumn("corr", F.round("corr", nd))
