import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from patronage.functions import exprs as E


def test_null_markers_and_digits(spark):
    df = spark.createDataFrame([("CUST001",), ("-9",), ("N/A",), ("abc",), (None,), ("17850.0",)], "v string")
    out = df.select(E.null_if_marker("v").alias("m"), E.first_digit_run("v").alias("d"),
                    E.id_before_dot("v").alias("i")).collect()
    assert [r.m for r in out] == ["CUST001", None, None, "abc", None, "17850.0"]
    assert [r.d for r in out] == [1, 9, 0, 0, 0, 17850]
    assert [r.i for r in out] == ["CUST001", "-9", "N/A", "abc", "0", "17850"]


def test_hash_matches_duckdb(spark):
    ids = [str(i) for i in range(50)]
    got = [r.h for r in spark.createDataFrame([(i,) for i in ids], "c string")
           .select(E.hash_int("c", "age:").alias("h")).collect()]
    con = duckdb.connect()
    want = [con.execute(f"select ('0x' || substr(md5('age:{i}'), 1, 8))::BIGINT").fetchone()[0] for i in ids]
    assert got == want


def test_edge_score_handles_tied_edges(spark):
    # frequency mostly 1: quantile edges tie, a strict cut would fail
    vals = [1] * 8 + [2, 5]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    edges = [F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.8)]
    got = [r.s for r in df.select(E.edge_score("x", edges).alias("s")).collect()]
    assert got == [1] * 8 + [5, 5]
    rev = [r.s for r in df.select(E.edge_score("x", edges, reverse=True).alias("s")).collect()]
    assert rev == [5] * 8 + [1, 1]


def test_rank_ntile_matches_qcut_of_ranks(spark):
    for n in (5, 7, 13, 59, 101):
        pdf = pd.DataFrame({"rn": np.arange(1, n + 1)})
        want = pd.qcut(pdf.rn, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
        got = [r.s for r in spark.createDataFrame(pdf).withColumn("s", E.rank_ntile("rn", F.lit(n), 5))
               .orderBy("rn").collect()]
        assert got == want, n


def test_yeo_johnson_formula(spark):
    xs = [-3.0, -0.5, 0.0, 0.5, 4.0]
    for lam in (0.0, 0.5, 2.0, -1.3):
        got = [r.y for r in spark.createDataFrame([(x,) for x in xs], "x double")
               .select(E.yeo_johnson("x", lam).alias("y")).collect()]
        want = []
        for x in xs:
            if x >= 0:
                want.append(np.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam)
            else:
                want.append(-np.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam))
        assert np.allclose(got, want)


def test_segment_cascade(spark):
    rows = [(5, 5, 5), (3, 3, 3), (3, 1, 2), (2, 2, 2), (2, 1, 1), (1, 2, 2), (1, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "r int, f int, m int")
    got = [x.s for x in df.select(E.segment_of("r", "f", "m").alias("s")).collect()]
    assert got == ["Champions", "Loyal Customers", "Potential Loyalists", "Promising", "Needs Attention",
                   "At Risk", "Lost", "Others"]


def test_year_shift_clamps_leap_day(spark):
    df = spark.createDataFrame([("2008-02-29",), ("2016-03-01",)], "d string").select(F.to_date("d").alias("d"))
    got = [str(r.d) for r in df.select(E.shift_old_years("d").alias("d")).collect()]
    assert got == ["2021-02-28", "2016-03-01"]
