import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronage.operators.keys import with_running_total, with_sequential_id
from patronage.operators.stats import group_quantiles, quantile_edges, quantiles


def test_sequential_id_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    out = with_sequential_id(df, ["v", "g"], name="sid", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "g")))
    joined = out.join(ref, ["v", "g"])
    assert joined.where(F.col("sid") != F.col("rn")).count() == 0
    assert out.agg(F.min("sid"), F.max("sid"), F.countDistinct("sid")).first() == (1, 5000, 5000)


def test_running_total(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("k"), (F.col("id") % 5 + 1).alias("w"))
    out = with_running_total(df, ["k"], "w", name="cum", num_partitions=6).orderBy("k").toPandas()
    assert (out["cum"].values == np.cumsum(out["w"].values)).all()


def test_quantiles_all_methods_agree(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.lognormal(3, 1, 3000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.05, 0.25, 0.5, 0.95]
    want = np.quantile(vals, probs)  # linear interpolation
    got = df.select(*[e.alias(f"q{i}") for i, e in enumerate(quantile_edges(df, "x", probs))]).first()
    assert np.allclose(list(got), want)


def test_group_quantiles_with_hot_group_ties_and_nulls(spark):
    rng = np.random.default_rng(2)
    rows = [("hot" if k % 3 else None, float(rng.integers(0, 50)) if k % 7 else None) for k in range(4000)]
    rows += [("one", 3.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["quantiles"] for r in group_quantiles(df, ["g"], "x", [0.0, 0.3, 1.0]).collect()}
    assert set(got) == {"hot", None, "one"}
    for g in got:
        assert np.allclose(got[g], np.quantile([x for k, x in rows if k == g and x is not None], [0.0, 0.3, 1.0]))
    both = quantiles(df.select("x", (F.col("x") * 2).alias("y"), F.lit(None).alias("z")), ["x", "y", "z"], [0.5])
    assert both["y"][0] == 2 * both["x"][0] and both["z"] == [None]
