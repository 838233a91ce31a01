"""K-means tiers.

Solvers are Spark ML's.  "Best of n starts" fits one model per seed on the
same cached feature frame; the fits are independent Spark jobs submitted
from driver threads, so they share the cluster instead of queueing.  The
elbow needs no models, only inertias: Spark draws its starts, and one pass over
the rows is then an iteration of all of them.  The cluster -> tier mapping has
one row per cluster (k rows, a proven bound) and is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
import warnings
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import RFM_COLUMNS, PowerTransformer
from .reports import tier_names

SCALED = ("R_scaled", "F_scaled", "M_scaled")
DEFAULT_TIERS = ("Diamond", "Standard")


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns -> one ML vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _fit_one(df: DataFrame, k: int, seed: int, features: str, max_iter: int) -> KMeansModel:
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="Cluster", maxIter=max_iter).fit(df)
    if 0 < max_iter <= model.summary.numIter:
        warnings.warn(f"k-means with k={k}, seed={seed} stopped at {max_iter} iterations before it settled",
                      RuntimeWarning, stacklevel=3)
    return model


def kmeans_best_of(df: DataFrame, k: int, n_init: int = 10, seed: int = 42, features: str = "features",
                   max_iter: int = 300) -> KMeansModel:
    """K clusters, ``n_init`` seeded starts, lowest within-cluster SSE wins."""
    cached = df.select(features).persist()
    try:
        with ThreadPoolExecutor(max_workers=min(n_init, 8)) as pool:
            models = list(pool.map(lambda s: _fit_one(cached, k, s, features, max_iter),
                                   [seed + i for i in range(n_init)]))
    finally:
        cached.unpersist()
    return min(models, key=lambda m: m.summary.trainingCost)


def inertia_k1(df: DataFrame, cols: Sequence[str]) -> float:
    """SSE of one cluster = n * sum of population variances (closed form)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(c) for c in cols]).first()
    return float(row["n"] * sum(row[c] or 0.0 for c in cols))


def _best_per_k(data: DataFrame, ks: Sequence[int], n_init: int, seed: int, features: str, max_iter: int,
                parallelism: int) -> dict[int, KMeansModel]:
    """The best of ``n_init`` starts for every k; all fits are submitted together."""
    jobs = [(k, seed + i) for k in ks for i in range(n_init)]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        models = list(pool.map(lambda job: (job[0], _fit_one(data, *job, features, max_iter)), jobs))
    best: dict[int, KMeansModel] = {}
    for k, m in models:
        if k not in best or m.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = m
    return best


def k_selection(df: DataFrame, ks: Sequence[int] = range(2, 8), n_init: int = 10, features: str = "features",
                seed: int = 42, max_iter: int = 300, parallelism: int = 16) -> DataFrame:
    """Silhouette (squared Euclidean, Spark's) and inertia per k, plus best k.

    All (k, seed) fits are independent jobs over one cached frame and are
    submitted together; the best start per k is kept."""
    spark = df.sparkSession
    data = df.select(features).persist()
    rows = []
    try:
        best = _best_per_k(data, ks, n_init, seed, features, max_iter, parallelism)
        ev = ClusteringEvaluator(featuresCol=features, predictionCol="Cluster", distanceMeasure="squaredEuclidean")
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            sils = dict(pool.map(lambda k: (k, ev.evaluate(best[k].transform(data))), list(best)))
        rows = [(int(k), float(sils[k]), float(best[k].summary.trainingCost)) for k in sorted(best)]
    finally:
        data.unpersist()
    best_k = max(rows, key=lambda r: r[1])[0]
    return spark.createDataFrame([(k, s, i, k == best_k) for k, s, i in rows],
                                 "k int, silhouette double, inertia double, is_best boolean")


def _packed():
    """For ``mapInArrow``: a row of doubles per batch, column after column."""
    import pyarrow as pa

    def run(batches):  # inside, so that it travels by value
        for batch in batches:
            table = np.stack([x.to_numpy(zero_copy_only=False) for x in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["block"])

    return run


def _nearest_sums(centres: Sequence[np.ndarray], rows_at_once: int = 4096):
    """For ``mapInArrow`` over ``_packed`` rows: what an iteration of every set of
    centres takes from a partition, as one row of doubles: per centre the number
    of its rows and their sums, and per set its squared distances."""
    import pyarrow as pa

    def run(batches):
        shift = np.concatenate(centres).mean(axis=0)  # keeps the products below near the distances
        at = [c - shift for c in centres]
        both = [(-2.0 * c, (c * c).sum(axis=1)[:, None]) for c in at]
        sums = [np.zeros((len(c), c.shape[1] + 1)) for c in at]
        costs = np.zeros(len(at))
        for block in (x for batch in batches for x in batch.column(0)):
            table = np.frombuffer(block.as_buffer()).reshape(len(shift), -1)
            for a in range(0, table.shape[1], rows_at_once):
                x = table[:, a:a + rows_at_once] - shift[:, None]
                own = (x * x).sum(axis=0)
                ones_x = np.concatenate([np.ones((1, x.shape[1])), x]).T
                for m, (twice, square) in enumerate(both):
                    far = twice @ x
                    far += square
                    least = far.min(axis=0)
                    mine = (far == least).astype(float)
                    if mine.sum() != x.shape[1]:  # as near to two centres: the first one has the row
                        mine = (np.arange(len(far))[:, None] == far.argmin(axis=0)).astype(float)
                    sums[m] += mine @ ones_x
                    costs[m] += np.maximum(least + own, 0.0).sum()
        for s in sums:
            s[:, 1:] += s[:, :1] * shift
        found = np.concatenate([*[s.ravel() for s in sums], costs])
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["found"])

    return run


def kmeans_inertias(df: DataFrame, jobs: Sequence[tuple[int, int]], features: str = "features", max_iter: int = 300,
                    tol: float = 1e-4, parallelism: int = 4) -> list[float]:
    """The inertia that Spark's ``KMeans`` ends with, for each (k, seed) of ``jobs``.

    Spark's own seeding gives each job's first centres (a fit without iterations),
    for ``parallelism`` jobs at once, as each holds the rows as vectors meanwhile.
    ``df`` should be a stage table, which every seeding reads.
    Lloyd's iterations then run for all jobs together, each pass over the rows
    being one iteration of every job that has not settled, by Spark's rules: a
    centre without rows stays, a job ends when no centre moves by more than
    ``tol``, its inertia is that of the last pass.  A task returns a row of sums
    per partition, whatever the number of rows."""
    if not jobs:
        return []
    data = df.select(features)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        centres = list(pool.map(lambda job: np.array(_fit_one(data, *job, features, 0).clusterCenters()), jobs))
    width, x = centres[0].shape[1], vector_to_array(features)
    rows = data.select(*[x[i].alias(f"x{i}") for i in range(width)]).mapInArrow(_packed(), "block binary").persist()
    try:
        inertias, moving = [0.0] * len(jobs), list(range(len(jobs)))
        for _ in range(max_iter):
            parts = rows.mapInArrow(_nearest_sums([centres[m] for m in moving]), "found binary").collect()
            found, at, settled = sum(np.frombuffer(p["found"]) for p in parts), 0, set()
            for i, m in enumerate(moving):
                k = len(centres[m])
                sums = found[at:at + k * (width + 1)].reshape(k, width + 1)
                at += k * (width + 1)
                held = sums[:, 0] > 0
                new = centres[m].copy()
                new[held] = sums[held, 1:] / sums[held, :1]
                if (((new - centres[m]) ** 2).sum(axis=1) <= tol * tol).all():
                    settled.add(m)
                centres[m], inertias[m] = new, float(found[i - len(moving)])
            moving = [m for m in moving if m not in settled]
            if not moving:
                break
        for m in moving:
            warnings.warn(f"k-means with k={jobs[m][0]}, seed={jobs[m][1]} stopped at {max_iter} iterations before it "
                          "settled", RuntimeWarning, stacklevel=2)
    finally:
        rows.unpersist()
    return inertias


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(1, 11), n_init: int = 10,
          features: str = "features", seed: int = 42, max_iter: int = 300, parallelism: int = 6) -> DataFrame:
    """Inertia for k = 1..10 (k = 1 in closed form; K-means needs k > 1), the best of ``n_init`` starts per k."""
    jobs = [(k, seed + i) for k in ks if k != 1 for i in range(n_init)]
    least: dict[int, float] = {}
    for (k, _), inertia in zip(jobs, kmeans_inertias(df, jobs, features, max_iter, parallelism=parallelism)):
        least[k] = min(inertia, least.get(k, inertia))
    rows = [(int(k), inertia_k1(df, cols) if k == 1 else least[k]) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def silhouette(df: DataFrame, label: str = "Cluster", features: str = "features") -> float:
    """Spark's silhouette (squared Euclidean, O(n·k), no pairwise join)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=label,
                               distanceMeasure="squaredEuclidean").evaluate(df.withColumn(label, F.col(label).cast("double")))


def fit_segmentation(rfm: DataFrame, k: int | str = 2, n_init: int = 10, seed: int = 42,
                     cols: Sequence[str] = RFM_COLUMNS) -> PipelineModel:
    """Power transform (standardising) + assembler + best-of-n K-means, as one
    ``PipelineModel`` that saves and loads (S13) and scores new rows (M23).
    ``k="auto"`` takes the k of the best silhouette (M07)."""
    prep = Pipeline(stages=[
        PowerTransformer(inputCols=list(cols), outputCols=list(SCALED)),
        VectorAssembler(inputCols=list(SCALED), outputCol="features"),
    ]).fit(rfm)
    if k == "auto":
        k = k_selection(prep.transform(rfm), n_init=n_init, seed=seed).where("is_best").first()["k"]
    km = kmeans_best_of(prep.transform(rfm), k, n_init=n_init, seed=seed)
    return PipelineModel(stages=[*prep.stages, km])


def tier_mapping(labeled: DataFrame, names: Sequence[str] = DEFAULT_TIERS) -> DataFrame:
    """One row per cluster -> tier name (Diamond first)."""
    means = labeled.groupBy("Cluster").agg(*[F.avg(c).alias(c) for c in RFM_COLUMNS])
    return tier_names(means, "Cluster", names).select("Cluster", "Segment")


def label_customers(model: PipelineModel, rfm: DataFrame, mapping: DataFrame | None = None,
                    names: Sequence[str] = DEFAULT_TIERS) -> DataFrame:
    """M06 + M09 / M23: predict clusters and attach tier names; a cluster
    without a name falls back to 'Cluster n'."""
    pred = model.transform(rfm).withColumn("Cluster", F.col("Cluster").cast("int"))
    if mapping is None:
        mapping = tier_mapping(pred, names)
    out = pred.join(F.broadcast(mapping), "Cluster", "left")  # k rows
    return out.withColumn("Segment", F.coalesce(F.col("Segment"),
                                                F.concat(F.lit("Cluster "), F.col("Cluster").cast("string"))))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
