"""Gram-matrix correlations, ranks from counts, mergeable distinct counts."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.operators import gram
from patronage.operators import reports as RP
from patronage.operators import sketches as SK
from patronage.operators.keys import expanded_ranks


def _matrix(df):
    return {(r.col_a, r.col_b): r["corr"] for r in df.collect()}


def test_three_hundred_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 300)) @ rng.normal(size=(300, 300)) * 10.0 ** rng.integers(-3, 6, 300) + 1e5
    pdf = pd.DataFrame(x, columns=[f"v{k}" for k in range(300)]).mask(rng.random(x.shape) < 0.1)
    got = _matrix(RP.correlations(spark.createDataFrame(pdf).repartition(7), list(pdf.columns)))
    want = pdf.corr()
    assert len(got) == 300 * 301 // 2
    assert max(abs(got[a, b] - want.at[a, b]) for a, b in got) < 2e-6


def test_gram_equals_corr_calls(spark):
    rows = [(1.0, 2, None, 5.0, 7.0), (2.0, 1, 3.0, 5.0, None), (4.0, 7, 1.0, 5.0, None), (None, 3, 2.0, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b int, c double, flat double, `once.x` double")
    cols = ["a", "b", "c", "flat"]
    plain, wide = _matrix(RP.correlations(df.drop("flat"), cols[:3])), _matrix(gram.correlations(df, [*cols, "once.x"]))
    assert {k: v for k, v in wide.items() if set(k) <= set(cols[:3])} == plain
    assert all(v is None for k, v in wide.items() if "flat" in k or "once.x" in k)
    odd = _matrix(gram.correlations(df.withColumn("a", F.when(F.col("b") == 7, float("inf")).otherwise(F.col("a"))), cols))
    assert np.isnan(odd["a", "b"]) and odd["b", "c"] == plain["b", "c"]
    assert set(_matrix(gram.correlations(df.limit(0), cols)).values()) == {None}


def test_ranks_of_a_value_in_half_of_the_rows(spark):
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, 5.0).otherwise((F.col("id") % 1000).cast("double")).alias("v"))
    ranks = expanded_ranks(df, "v", name="i", rows_per_task=2_000, piece=500)
    tasks = [r["count"] for r in ranks.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == n and max(tasks) < 3 * n / 20
    got = ranks.orderBy("i").toPandas()
    assert (got["i"] == np.arange(1, n + 1)).all()
    assert (got["v"].to_numpy() == np.sort(df.toPandas()["v"].to_numpy())).all()
    assert expanded_ranks(df.limit(0), "v").count() == 0


def test_sketches_roll_up(spark):
    df = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 5_000).alias("who"))
    months = SK.distinct_sketches(df, {"month": F.col("month")}, ["who"])
    year = SK.estimates(SK.rolled_up(months, {"year": F.lit(1)}, ["who"]), ["who"]).first()
    assert year.lines == 60_000 and abs(year.who - 5_000) <= 3 * SK.error() * 5_000
    each = SK.estimates(months, ["who"]).collect()
    exact = {r.month: r.n for r in df.groupBy("month").agg(F.countDistinct("who").alias("n")).collect()}
    assert all(abs(r.who - exact[r.month]) <= 4 * SK.error() * exact[r.month] for r in each)
    assert SK.error(14) < SK.error(12) == pytest.approx(1.04 / 64)
