"""Quality classifier: random Fourier features, ridge regression, isotonic
calibration.

1. Statistics: one pass over whole texts gives each document a short vector
   (lengths, case, symbols, repetition).  They are staged; the text is read
   once.  Nothing but the text enters a vector.
2. Features: standardised statistics x become sqrt(2/m) cos(xW + b) with W
   drawn from a normal distribution, so that inner products approximate a
   Gaussian kernel of width ``sigma``.
3. Fit: each partition of labelled rows sums Z'Z and Z'y; the sums are added
   by Spark (one row per feature and partition) and the driver solves one
   system of ``features`` + 1 unknowns.
4. Calibration: on labelled rows kept out of the fit, scores are counted in
   ``bins`` equal bins; pool-adjacent-violators over the bins gives a
   non-decreasing map to the share of label 1.

Mean, deviation, sums and counts cover all labelled training rows; what the
driver holds is bounded by ``features`` and ``bins``.

Defined cases: null text counts as empty; an empty text gets the score of the
statistics of an empty text; null or other labels than 0 and 1, and labels of
null ids or of ids without a document, teach nothing; repeated labels of an id
count each; without labelled rows of both classes every score is the share of
label 1 among them (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import packed, slices, text_of

_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SYMBOLS, _SHOUTS, _STOPS = b"#*$%&|<>", b"!?", b".,;:"
STATISTICS = 12


def statistics(text: bytes) -> list[float]:
    """Statistics of one text in UTF-8, all finite."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))

    def count(chars: bytes) -> int:
        return len(text) - len(text.translate(None, chars))

    upper, lower = count(_UPPER), count(_LOWER)
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    return [
        np.log1p(len(words)), sum(map(len, words)) / n, upper / (upper + lower + 1), count(_DIGITS) / size,
        count(_SYMBOLS) / n, count(_SHOUTS) / n, count(_STOPS) / n, len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))), len(set(zip(words, words[1:]))) / n,
    ]


def with_statistics(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """The columns of ``keep`` and ``_x``, the statistics of the whole text."""
    source = docs.select(*keep, text_of(docs[text_col]).alias("_text"))
    fields = source.schema.fields[:-1]
    names = [*[f.name for f in fields], "_x"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            x = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], names)

    return source.mapInArrow(run, T.StructType([*fields, T.StructField("_x", T.ArrayType(T.DoubleType()))]))


def _matrix(batch: pa.RecordBatch, name: str = "_x") -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name))
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    ridge: np.ndarray | None = None
    low: float = -0.5
    high: float = 1.5
    calibrated: np.ndarray | None = None  # share of label 1 by bin of the raw score

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.hstack([z, np.ones((len(z), 1))])

    def bins(self, x: np.ndarray) -> np.ndarray:
        raw = self.features(x) @ self.ridge
        k = len(self.calibrated)
        return np.clip(((raw - self.low) / (self.high - self.low) * k).astype(np.int64), 0, k - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated[self.bins(x)]


def pool_adjacent(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit of ones / total by bin; bins without
    rows take the value between their neighbours (the nearest at the ends)."""
    blocks: list[list[float]] = []  # weight, sum, first bin, last bin
    for k in np.flatnonzero(total):
        blocks.append([total[k], ones[k], k, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, s, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + s, blocks[-1][2], last]
    at = [x for b in blocks for x in (b[2], b[3])]
    return np.interp(np.arange(len(total)), at, [b[1] / b[0] for b in blocks for _ in (0, 1)])


def fit(labelled: DataFrame, features: int = 256, sigma: float = 3.0, penalty: float = 1e-4, bins: int = 2048,
        seed: int = 7) -> Model:
    """``labelled``: _x, _y (0 or 1) and _calibrate (rows of the calibration part)."""
    k = STATISTICS
    first = labelled.agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("ones"),
        *[f(F.col("_x")[i]).alias(f"{n}{i}") for i in range(k) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    draw = np.random.default_rng(seed)
    model = Model(np.array([first[f"m{i}"] or 0.0 for i in range(k)]),
                  np.array([first[f"s{i}"] or 1.0 for i in range(k)]),
                  draw.normal(size=(k, features)) / sigma, draw.uniform(0, 2 * np.pi, features))
    n, ones = first["n"], first["ones"] or 0
    model.ridge, model.calibrated = np.zeros(features + 1), np.full(bins, ones / n if n else 0.5)
    if not 0 < ones < n:
        return model

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((features + 1, features + 2))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                z = model.features(_matrix(part))
                y = part.column(1).to_numpy(zero_copy_only=False).astype(float)
                gram += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(features + 1), pa.int32()), pa.array(list(gram))],
                                         ["i", "part"])

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(_matrix(b, "part").sum(axis=0) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total])], ["i", "part"])

    schema = "i int, part array<double>"
    fitted = labelled.where("not _calibrate").select("_x", "_y").mapInArrow(sums, schema)
    rows = fitted.groupBy("i").applyInArrow(added, schema).collect()  # features + 1 rows
    gram = np.array([r["part"] for r in sorted(rows, key=lambda r: r["i"])])
    weight = max(1.0, gram[-1, -2])  # rows: the last feature is 1
    model.ridge = np.linalg.solve(gram[:, :-1] + penalty * weight * np.eye(features + 1), gram[:, -1])

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, right = np.zeros(bins), np.zeros(bins)
        for batch in batches:
            at = model.bins(_matrix(batch))
            total += np.bincount(at, minlength=bins)
            right += np.bincount(at, batch.column(1).to_numpy(zero_copy_only=False), minlength=bins)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used]), pa.array(right[used])],
                                         ["bin", "n", "ones"])

    held = labelled.where("_calibrate").select("_x", "_y").mapInArrow(binned, "bin long, n double, ones double")
    counts = held.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect()  # <= bins rows
    if counts:
        total, right = np.zeros(bins), np.zeros(bins)
        for r in counts:
            total[r["bin"]], right[r["bin"]] = r["n"], r["ones"]
        model.calibrated = pool_adjacent(total, right)
    return model


def _scored(staged: DataFrame, model: Model) -> DataFrame:
    """``staged`` with its ``_x`` replaced by ``_score``."""
    source = staged.select(*[c for c in staged.columns if c != "_x"], "_x")
    fields = source.schema.fields[:-1]
    names = [*[f.name for f in fields], "_score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(model.score(_matrix(part)))], names)

    return source.mapInArrow(run, T.StructType([*fields, T.StructField("_score", T.DoubleType())]))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """The fold that never teaches: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_rows(staged: DataFrame, labels: DataFrame, label_col: str, id_col: str, folds: int,
                  calibrate_fold: int) -> DataFrame:
    """(_x, _y, _calibrate) of the documents that may teach."""
    taught = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id"), folds))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return staged.select("doc_id", "_x").join(taught, F.col("doc_id") == F.col("_id")).select(
        "_x", "_y", (fold == calibrate_fold).alias("_calibrate"))


def score(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3, folds: int = 5,
          calibrate_fold: int = 1, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    staged = materialize(with_statistics(docs, text_col, [docs[id_col].alias("doc_id")]), "quality-statistics")
    model = fit(materialize(labelled_rows(staged, labels, label_col, id_col, folds, calibrate_fold),
                            "quality-labelled"), **options)
    return _scored(staged, model).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"),
                                         F.col("_score").alias("score"),
                                         (F.col("_score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3, folds: int = 5,
             calibrate_fold: int = 1, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns as they are."""
    vectors = with_statistics(docs, text_col, [docs[id_col].alias("doc_id")])
    model = fit(materialize(labelled_rows(vectors, labels, label_col, id_col, folds, calibrate_fold),
                            "quality-labelled"), **options)
    # the statistics are computed anew, in one step with the score, rather than stored beside the texts
    rows = docs.select(packed(docs), text_of(docs[text_col]).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            scores = model.score(np.array([statistics(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([batch.columns[0], pa.array(scores)], ["_row", "_score"])

    scored = rows.mapInArrow(run, T.StructType([rows.schema.fields[0], T.StructField("_score", T.DoubleType())]))
    return scored.where(F.col("_score") >= threshold).select("_row.*")
