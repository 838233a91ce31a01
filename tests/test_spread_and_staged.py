"""Stage tables dealt over tasks for model fits, lines staged once, and the joins that build lines."""
import threading

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paths import SF_SMALL
from patronage.operators import cluster as CU
from patronage.operators import increment as INC
from patronage.operators import warehouse as WH
from patronage.plans import queries as Q
from patronage.session import materialize, spread
from patronage.sources import fixtures as X
from patronage.sources.tables import register_tables


def test_a_stage_of_one_file_is_dealt_over_the_cores(spark):
    one = materialize(spark.range(0, 1000, 1, 1), "one-file")
    used = lambda df: df.select(F.input_file_name()).distinct().count()
    assert used(one) == 1
    dealt = spread(one, "dealt", rows_per_task=100)
    assert used(dealt) == 8  # twice the four cores
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    assert spread(one, "same", rows_per_task=1000) is one


def test_elbow_submits_all_its_fits_together(spark, monkeypatch):
    data = spark.range(60).select((F.col("id") % 7).cast("double").alias("x")).withColumn(
        "features", array_to_vector(F.array("x")))
    together, real = threading.Barrier(6, timeout=60), CU._fit_one

    def fit(*args):
        together.wait()  # breaks unless the fits of both k are under way
        return real(*args)

    monkeypatch.setattr(CU, "_fit_one", fit)
    rows = CU.elbow(data, ["x"], ks=(1, 2, 3), n_init=3).collect()
    assert [r.k for r in rows] == [1, 2, 3]
    assert rows[0].inertia > rows[1].inertia > rows[2].inertia


def test_lines_are_joined_by_part_and_order_only(spark):
    plan = X.sales(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    line = next(x for x in plan.splitlines() if "l_orderkey" in x and "Relation" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    assert len(joins) == 4 and sum(depth(j) < depth(line) for j in joins[:2]) == 2
    assert "o_custkey" not in joins[0] and "o_custkey" not in joins[1]
    register_tables(spark, SF_SMALL)
    for text in (X.SALES_SQL, X.ALL_ONLINE_SQL):
        a, b = X._sql(spark, SF_SMALL, text), spark.sql(text)
        assert a.columns == b.columns and a.count() == b.count()
        assert a.exceptAll(b).isEmpty()


def test_the_incremental_load_stages_its_lines_once(spark, monkeypatch):
    made = []

    def counted(df, name):
        made.append(name)
        return materialize(df, name)
    for module in (Q, WH, INC):
        monkeypatch.setattr(module, "materialize", counted)
    Q.r01(spark, SF_SMALL)
    assert made.count("sales-lines") == 1
    assert not {"warehouse-lines", "load-lines", "load-unseen"} & set(made)


def test_elbow_iterates_all_starts_in_one_pass_and_ends_as_spark_does(spark, monkeypatch):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(5, 3)) * 4
    points = [(*map(float, middle[i % 5] + rng.normal(size=3)),) for i in range(400)]
    points += [(1e3, 0.0, 0.0)] * 3 + [(0.0, 0.0, float(i % 2)) for i in range(40)]
    data = CU.assemble(spark.createDataFrame(points, "a double, b double, c double"), ["a", "b", "c"]).repartition(3).cache()
    jobs = [(k, seed) for k in (2, 4, 7) for seed in (1, 2, 3)]
    want = [CU._fit_one(data, k, seed, "features", 300).summary.trainingCost for k, seed in jobs]
    short = [CU._fit_one(data, k, seed, "features", 2).summary.trainingCost for k, seed in jobs]
    asked, real = [], CU._fit_one
    monkeypatch.setattr(CU, "_fit_one", lambda *args: asked.append(args[-1]) or real(*args))
    assert np.allclose(CU.kmeans_inertias(data, jobs), want, rtol=1e-9)
    assert np.allclose(CU.kmeans_inertias(data, jobs, max_iter=2), short, rtol=1e-9)
    rows = {r.k: r.inertia for r in CU.elbow(data, ["a", "b", "c"], ks=(1, 2, 4, 7), n_init=3, seed=1).collect()}
    assert all(np.isclose(rows[k], min(w for (j, _), w in zip(jobs, want) if j == k), rtol=1e-9) for k in (2, 4, 7))
    assert set(asked) == {0}  # Spark gives the starts only
    data.unpersist()


def test_a_row_as_near_to_two_centres_counts_once(spark):
    run = CU._nearest_sums([np.array([[0.0], [2.0], [2.0], [0.0]])], rows_at_once=2)
    import pyarrow as pa
    found = np.frombuffer(next(run(CU._packed()([pa.record_batch({"x0": pa.array([1.0, 0.0, 2.0])})])))["found"][0].as_py())
    assert found.tolist() == [2, 1, 1, 2, 0, 0, 0, 0, 1]
