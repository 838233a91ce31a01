"""Feature engineering on per-customer RFM tables.

Every dataset-wide statistic (quantiles, means, deviations, likelihoods) is
one aggregation feeding lazy scalar subqueries or a fitted model's params;
no customer table is collected.  The power transform is a Spark ML
``Estimator`` / ``Model`` pair so it saves and loads inside a
``PipelineModel`` with the scaler and K-means (S13, M23).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import box_cox, yeo_johnson
from ..session import materialize
from .stats import quantile_edges, quantiles

RFM_COLUMNS = ("Recency", "Frequency", "Monetary")


def remove_outliers(df: DataFrame, cols: Sequence[str] = RFM_COLUMNS, lo: float = 0.05,
                    hi: float = 0.95, k: float = 1.5, stage: bool = True) -> DataFrame:
    """Per column in turn keep [q_lo - k*IQR, q_hi + k*IQR]; the quantiles
    of each column are taken on the rows left by the previous column.

    With ``stage`` the input and every intermediate table are written once, so
    each quantile pass scans one column of a stage table instead of
    re-running the upstream plan inside nested subqueries.
    """
    out = materialize(df, "outliers-in") if stage else df
    for i, c in enumerate(cols):
        q_lo, q_hi = quantile_edges(out, c, [lo, hi])
        span = q_hi - q_lo
        out = out.filter((F.col(c) >= q_lo - k * span) & (F.col(c) <= q_hi + k * span))
        if stage and i < len(cols) - 1:
            out = materialize(out, f"outliers-{c}")
    return out


def outlier_flags(df: DataFrame, cols: Sequence[str] = RFM_COLUMNS, lo: float = 0.25,
                  hi: float = 0.75, k: float = 1.5) -> DataFrame:
    """Flag (do not drop) values outside the fences of the full table."""
    out, edges = df, quantiles(df, cols, [lo, hi])
    for c in cols:
        q_lo, q_hi = (F.lit(x).cast("double") for x in edges[c])
        span = q_hi - q_lo
        out = out.withColumn(f"{c}_outlier", (F.col(c) < q_lo - k * span) | (F.col(c) > q_hi + k * span))
    return out


def standard_scale(df: DataFrame, cols: Sequence[str] = RFM_COLUMNS, suffix: str = "_scaled",
                   names: Sequence[str] | None = None) -> DataFrame:
    """(x - mean) / population std, statistics from one aggregation."""
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)])
    out = df
    for i, c in enumerate(cols):
        m = stats.select(f"m{i}").scalar()
        s = stats.select(f"s{i}").scalar()
        name = names[i] if names else f"{c}{suffix}"
        out = out.withColumn(name, F.when(s > 0, (F.col(c) - m) / s).otherwise(F.lit(0.0)))
    return out


# --- power transforms -----------------------------------------------------------
def _transform_expr(method: str, x: Column | str, lam: float) -> Column:
    if method == "yeo-johnson":
        return yeo_johnson(x, lam)
    return box_cox(F.col(x) + 1.0 if isinstance(x, str) else x + 1.0, lam)


def _transform_lam_col(method: str, x: Column, lam: Column) -> Column:
    """The transform with lambda as a Column (for the grid search)."""
    if method == "yeo-johnson":
        pos = F.when(lam == 0, F.log1p(x)).otherwise((F.pow(x + 1.0, lam) - 1.0) / lam)
        neg = F.when(lam == 2, -F.log1p(-x)).otherwise(-(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam))
        return F.when(x >= 0, pos).otherwise(neg)
    y = x + 1.0
    return F.when(lam == 0, F.log(y)).otherwise((F.pow(y, lam) - 1.0) / lam)


def _per_lambda(method: str, x: Column):
    # one-argument lambda: ``transform`` treats a 2-argument one as (element, index)
    return lambda lam: _transform_lam_col(method, x, lam)


def fit_lambdas(df: DataFrame, cols: Sequence[str], method: str = "yeo-johnson",
                lo: float = -4.0, hi: float = 4.0, passes: int = 4, points: int = 21) -> list[float]:
    """Maximum-likelihood lambda per column.

    log L(l) = -n/2 * ln(var_pop(T_l(x))) + (l - 1) * sum(J(x)),
    J = sign(x) * ln(1 + |x|) (Yeo-Johnson) or ln(x + 1) (Box-Cox on x + 1).

    Each pass evaluates a grid of candidate lambdas per column: every row
    expands into (grid index, transformed values) with ``posexplode`` and one
    partial ``groupBy(index)`` returns var_pop per candidate — a handful of
    expressions whatever the grid size, and only ``points`` rows come back.
    The grid then narrows around the best candidate; while that lies on an
    edge of the first grid, the grid moves on beyond it instead, so ``lo`` and
    ``hi`` bound nothing.
    """
    xs = [F.col(c).cast("double") for c in cols]
    jac_exprs = [F.sum(F.signum(x) * F.log1p(F.abs(x))) if method == "yeo-johnson" else F.sum(F.log(x + 1.0))
                 for x in xs]
    head = df.agg(F.count(F.lit(1)).alias("n"), *[j.alias(f"j{i}") for i, j in enumerate(jac_exprs)]).first()
    n = head["n"]
    jac = [head[f"j{i}"] or 0.0 for i in range(len(cols))]
    centers = [(lo, hi)] * len(cols)
    best = [1.0] * len(cols)
    narrowed = [0] * len(cols)
    while min(narrowed, default=passes) < passes:
        grids = [[a + i * (b - a) / (points - 1) for i in range(points)] for a, b in centers]
        arrays = []
        for i, x in enumerate(xs):
            lams = F.array(*[F.lit(float(v)) for v in grids[i]])
            arrays.append(F.transform(lams, _per_lambda(method, x)).alias(f"t{i}"))
        zipped = df.select(F.posexplode(F.arrays_zip(*arrays)).alias("pos", "v"))
        rows = zipped.groupBy("pos").agg(*[F.var_pop(F.col("v")[f"t{i}"]).alias(f"v{i}") for i in range(len(cols))]
                                         ).collect()  # <= points rows
        variances = {r["pos"]: r for r in rows}
        new_centers = []
        for i in range(len(cols)):
            scores = []
            for j, lam in enumerate(grids[i]):
                v = variances[j][f"v{i}"] if j in variances else None
                ok = v is not None and math.isfinite(v) and v > 0
                scores.append(-n / 2.0 * math.log(v) + (lam - 1.0) * jac[i] if ok else -math.inf)
            j = max(range(len(scores)), key=lambda k: scores[k])
            best[i] = grids[i][j]
            step, width = grids[i][1] - grids[i][0], grids[i][-1] - grids[i][0]
            at_edge = j in (0, points - 1) and math.isfinite(scores[j]) and width >= hi - lo
            if at_edge:  # the likelihood still rises: look further on
                new_centers.append((best[i] - width, best[i] + step) if j == 0 else (best[i] - step, best[i] + width))
            else:
                narrowed[i] += 1
                new_centers.append((best[i] - step, best[i] + step))
        centers = new_centers
    return best


class _PowerParams(HasInputCols, HasOutputCols):
    method = Param(Params._dummy(), "method", "yeo-johnson or box-cox",
                   typeConverter=TypeConverters.toString)
    standardize = Param(Params._dummy(), "standardize", "zero mean, unit population std",
                        typeConverter=TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(method="yeo-johnson", standardize=True)


class PowerTransformerModel(Model, _PowerParams, DefaultParamsReadable, DefaultParamsWritable):
    lambdas = Param(Params._dummy(), "lambdas", "fitted lambda per column", typeConverter=TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean of transformed column", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population std of transformed column",
                 typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, method="yeo-johnson", standardize=True,
                 lambdas=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        method = self.getOrDefault("method")
        ins, outs = self.getInputCols(), self.getOutputCols()
        lams = self.getOrDefault("lambdas")
        std = self.getOrDefault("standardize")
        out = dataset
        for i, (c, o) in enumerate(zip(ins, outs)):
            y = _transform_expr(method, c, lams[i])
            if std:
                m, s = self.getOrDefault("means")[i], self.getOrDefault("stds")[i]
                y = (y - F.lit(m)) / F.lit(s if s > 0 else 1.0)
            out = out.withColumn(o, y)
        return out


class PowerTransformer(Estimator, _PowerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Per-column power transform with lambda by maximum likelihood."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, method="yeo-johnson", standardize=True):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PowerTransformerModel:
        method = self.getOrDefault("method")
        ins = self.getInputCols()
        # iterative passes over the same rows: keep only the inputs, persisted
        dataset = dataset.select(*ins).persist()
        lams = fit_lambdas(dataset, ins, method)
        stats = dataset.agg(*[F.avg(_transform_expr(method, c, lams[i])).alias(f"m{i}") for i, c in enumerate(ins)],
                            *[F.stddev_pop(_transform_expr(method, c, lams[i])).alias(f"s{i}")
                              for i, c in enumerate(ins)]).first()
        dataset.unpersist()
        return PowerTransformerModel(
            inputCols=ins, outputCols=self.getOutputCols(), method=method,
            standardize=self.getOrDefault("standardize"), lambdas=[float(x) for x in lams],
            means=[float(stats[f"m{i}"]) for i in range(len(ins))],
            stds=[float(stats[f"s{i}"] or 0.0) for i in range(len(ins))])


def power_transform_fixed(df: DataFrame, cols: Sequence[str], lambdas: Sequence[float],
                          method: str = "yeo-johnson", suffix: str = "_t",
                          standardize: bool = True) -> DataFrame:
    """M03/M04 with given lambdas: transform, then standardise (population std)."""
    out = df
    tcols = []
    for c, lam in zip(cols, lambdas):
        out = out.withColumn(f"{c}{suffix}", _transform_expr(method, c, lam))
        tcols.append(f"{c}{suffix}")
    if standardize:
        out = standard_scale(out, tcols, names=tcols)
    return out
