"""Forests over counted cells, held against Spark ML's own."""
import numpy as np
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from patronage.operators import classify as CL
from patronage.operators import forest as FO


def _table(spark, n, classes=3, seed=2):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 10, n), rng.integers(-2, 3, n)], axis=1).astype(float)
    y = (x[:, 0] * 2 > x[:, 1]).astype(int) + (x[:, 2] > 0)
    y = np.where(rng.random(n) < 0.1, rng.integers(0, classes, n), y)
    rows = [(str(i), *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "customer_id string, a double, b double, c double, label double")
    return CL.assemble_features(df, ["a", "b", "c"])


def _by_spark(estimator, folded, k, depth, least):
    right = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    fit = estimator.copy({estimator.maxDepth: depth, estimator.minInstancesPerNode: least})
    return np.mean([right.evaluate(fit.fit(folded.where(F.col("fold") != f)).transform(folded.where(F.col("fold") == f)))
                    for f in range(k)])


def test_a_tree_without_chance_is_sparks_tree(spark):
    folded = CL.stratified_folds(_table(spark, 1500), "label", "customer_id", 2).cache()
    one = CL.random_forest(n_trees=1).setBootstrap(False).setFeatureSubsetStrategy("all")
    got = FO.forest_grid(one, folded, (1, 12), (1, 25), k=2, least_rows=0)
    assert got is None  # a cell for every row: nothing to gain
    folded.unpersist()
    folded = CL.stratified_folds(_table(spark, 12000), "label", "customer_id", 2).cache()
    got = FO.forest_grid(one, folded, (1, 12), (1, 25), k=2, least_rows=0)
    assert set(got) == {(d, m) for d in (1, 12) for m in (1, 25)}
    for (depth, least), found in got.items():
        assert abs(found - _by_spark(one, folded, 2, depth, least)) < 1e-9
    folded.unpersist()


def test_forests_score_as_sparks_forests(spark):
    folded = CL.stratified_folds(_table(spark, 12000), "label", "customer_id", 2).cache()
    forest = CL.random_forest(n_trees=30)
    got = FO.forest_grid(forest, folded, (2, 8), (1, 4), k=2, least_rows=0)
    for (depth, least), found in got.items():
        assert abs(found - _by_spark(forest, folded, 2, depth, least)) < 0.02
    assert got == FO.forest_grid(forest, folded, (2, 8), (1, 4), k=2, least_rows=0)  # repeatable
    alone = FO.forest_grid(forest, folded, (2,), (4,), k=2, least_rows=0)
    assert alone[2, 4] == got[2, 4]  # the upper part of deeper trees
    folded.unpersist()


def test_grid_search_of_many_rows_makes_no_fit_per_parameter(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(CL, "CrossValidator", lambda **named: calls.append(named))
    real = CL.forest_grid
    monkeypatch.setattr(CL, "forest_grid", lambda *args: real(*args, least_rows=0))
    rows = CL.grid_search(CL.random_forest(n_trees=5), _table(spark, 12000), (2, 6), (1, 3), k=2).collect()
    assert {(r.max_depth, r.min_instances) for r in rows} == {(d, m) for d in (2, 6) for m in (1, 3)}
    assert all(0.7 < r.cv_accuracy <= 1 for r in rows) and not calls


def test_rows_that_spark_refuses_are_left_to_spark(spark):
    table, one = _table(spark, 3000), CL.random_forest(n_trees=1)
    nan = F.when(F.col("b") > 8, F.lit(float("nan"))).otherwise(F.col("b"))
    for odd in (CL.assemble_features(table.drop("features").withColumn("b", nan), ["a", "b", "c"]),
                table.withColumn("label", F.when(F.col("a") > 1, F.col("label")))):
        folded = odd.withColumn("fold", (F.col("customer_id").cast("int") % 2).cast("int"))
        assert FO.forest_grid(one, folded, (2,), (1,), k=2, least_rows=0) is None
