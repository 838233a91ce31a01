import numpy as np
from pyspark.sql import functions as F

from paths import SF_SMALL
from patronage.operators import classify as CL
from patronage.operators import cluster as CU
from patronage.operators import features as FE
from patronage.plans import queries as Q


def _yj(x, lam):
    return np.where(x >= 0,
                    np.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam,
                    -np.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam))


def test_yeo_johnson_lambda_is_mle(spark):
    rng = np.random.default_rng(7)
    x = rng.lognormal(2, 0.8, 2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = FE.fit_lambdas(df, ["x"])[0]
    grid = np.linspace(-2, 2, 4001)
    jac = np.sum(np.sign(x) * np.log1p(np.abs(x)))
    ll = [-len(x) / 2 * np.log(np.var(_yj(x, g))) + (g - 1) * jac for g in grid]
    assert abs(lam - grid[int(np.argmax(ll))]) < 2e-3


def test_kmeans_inertia_falls_and_tiers_ordered(spark, tmp_path):
    rfm = Q.customer_features(spark, SF_SMALL)
    model = CU.fit_segmentation(rfm, k=2, n_init=3)
    labeled = CU.label_customers(model, rfm)
    means = labeled.groupBy("Segment").agg(F.avg("Monetary").alias("m")).collect()
    by = {r.Segment: r.m for r in means}
    assert set(by) == {"Diamond", "Standard"}
    # saved == loaded predictions
    CU.save_model(model, str(tmp_path / "m"))
    again = CU.label_customers(CU.load_model(str(tmp_path / "m")), rfm)
    a = {r.customer_id: r.Cluster for r in labeled.select("customer_id", "Cluster").collect()}
    b = {r.customer_id: r.Cluster for r in again.select("customer_id", "Cluster").collect()}
    assert a == b
    elbow = CU.elbow(CU.assemble(FE.standard_scale(rfm, names=list(CU.SCALED)), CU.SCALED), CU.SCALED,
                     ks=range(1, 5), n_init=2).orderBy("k").toPandas()
    assert (np.diff(elbow.inertia.values) <= 1e-6).all()


def test_stratified_split_exact_and_folds_balanced(spark):
    df = spark.range(0, 1003).select(F.col("id").cast("string").alias("customer_id"),
                                     F.when(F.col("id") % 10 < 3, "a").otherwise("b").alias("y"))
    split = CL.stratified_split(df, "y").groupBy("y", "split").count().collect()
    got = {(r.y, r.split): r["count"] for r in split}
    n_a = df.where("y = 'a'").count()
    assert got[("a", "train")] == round(n_a * 0.8)
    folds = CL.stratified_folds(df, "y", k=5).groupBy("fold").count().toPandas()
    assert folds["count"].max() - folds["count"].min() <= 2


def test_classification_report_zero_division(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, prediction string")
    rep = {r.cls: r for r in CL.classification_report(pred).collect()}
    assert rep["c"].precision == 0.0 and rep["c"].recall == 0.0 and rep["c"].f1 == 0.0
    assert rep["accuracy"].precision == 0.5
    assert rep["a"].precision == 1.0 and rep["a"].recall == 0.5
