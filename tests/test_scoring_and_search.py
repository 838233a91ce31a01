"""Results of fitted queries that no SQL can express: held against a second way."""
import numpy as np
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from paths import SF_SMALL
from patronage.operators import classify as CL
from patronage.operators import cluster as CU
from patronage.operators import features as FE
from patronage.plans import queries as Q
from patronage.plans.registry import QUERIES


def test_streamed_scores_equal_batch_scores(spark):
    streamed = {r.customer_id: (r.Cluster, r.Segment) for r in QUERIES["r05_stream_scoring"](spark, SF_SMALL).collect()}
    rfm = Q.customer_features(spark, SF_SMALL)
    model = CU.fit_segmentation(rfm, k=2)
    mapping = CU.tier_mapping(CU.label_customers(model, rfm).select("Cluster", *FE.RFM_COLUMNS))
    arriving = Q.guest_base(spark, SF_SMALL).withColumnRenamed("user_id", "customer_id")
    batch = CU.label_customers(model, arriving, mapping)
    assert streamed == {r.customer_id: (r.Cluster, r.Segment) for r in batch.collect()}
    assert len(streamed) == arriving.count() and {s for _, s in streamed.values()} <= {"Diamond", "Standard"}


def test_grid_search_equals_folds_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [(str(k), float(a), float(b), float((a * b > 0) != (rng.random() < 0.1))) for k, (a, b) in
            enumerate(rng.normal(size=(300, 2)))]
    df = CU.assemble(spark.createDataFrame(rows, "customer_id string, a double, b double, label double"), ["a", "b"])
    got = {(r.max_depth, r.min_instances): r.cv_accuracy for r in
           CL.grid_search(CL.decision_tree(), df, depths=(1, 4), min_instances=(1, 20), k=3).collect()}
    folded = CL.stratified_folds(df, "label", "customer_id", 3).cache()
    right = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    for depth, least in got:
        tree = CL.decision_tree().setMaxDepth(depth).setMinInstancesPerNode(least)
        each = [right.evaluate(tree.fit(folded.where(F.col("fold") != k)).transform(folded.where(F.col("fold") == k)))
                for k in range(3)]
        assert abs(got[depth, least] - np.mean(each)) < 1e-9
    assert got[4, 1] > got[1, 1]
    folded.unpersist()


def test_box_cox_query_uses_its_lambdas(spark):
    out = QUERIES["m04_box_cox_fit"](spark, SF_SMALL).toPandas().set_index("customer_id")
    base = FE.remove_outliers(Q.rfm_customers(spark, SF_SMALL))
    raw = base.select("customer_id", *FE.RFM_COLUMNS).toPandas().set_index("customer_id").loc[out.index]
    lambdas = FE.fit_lambdas(base, list(FE.RFM_COLUMNS), method="box-cox")
    for column, name, lam in zip(FE.RFM_COLUMNS, out.columns, lambdas):
        x = raw[column].astype(float).to_numpy() + 1
        want = np.log(x) if abs(lam) < 1e-9 else (x ** lam - 1) / lam
        assert np.allclose(out[name], (want - want.mean()) / want.std(), atol=1e-6)  # standardised
