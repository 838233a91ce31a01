"""Limits, data loss and reloads: cases that once went wrong."""
import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from patronage.operators import classify as CL
from patronage.operators import cleaning as C
from patronage.operators import cluster as CU
from patronage.operators import features as FE
from patronage.operators import merge as MG
from patronage.operators import rfm as R
from patronage.operators import transform as TR
from patronage.operators import increment as INC
from patronage.operators import warehouse as WH
from patronage.operators.cleaning import SourceSpec
from patronage.plans import more_queries as M
from patronage.plans import queries as Q
from patronage.sources import files as FS
from patronage.sources import fixtures as X
from patronage.sources.registry import SOURCES, fixture_sources
from patronage.plans.registry import QUERIES


def test_a_source_of_any_name_is_merged(spark):
    src = {n: (s, C.clean_source(df, s)) for n, (s, df) in fixture_sources(spark, SF_SMALL).items()}
    shop = SourceSpec(name="Shop", date_formats=("M/d/yyyy H:mm",), rank=3)
    extra = C.clean_source(X.raw_online(spark, SF_SMALL), shop)
    merged = MG.merge_sources(TR.transform_sources([*src.values(), (shop, extra)]), keep_source=True,
                              ranks={s.name: s.rank for s in (*SOURCES, shop)})
    rows = {r.source: r["count"] for r in merged.groupBy("source").count().collect()}
    assert set(rows) == {"Kaggle", "UCI", "ORD", "Shop"} and rows["Shop"] == extra.count() == rows["UCI"]
    ids = {s: {r[0] for r in merged.where(F.col("source") == s).select("transaction_id").distinct().collect()
               if r[0].isdigit()} for s in rows}
    assert not ids["Shop"] & (ids["UCI"] | ids["ORD"] | ids["Kaggle"])
    with pytest.raises(ValueError):
        TR.transform_sources([(SourceSpec("x", (), kind="mail"), extra)])


def test_lambda_beyond_the_first_bracket(spark):
    x = np.random.default_rng(3).normal(10, 0.4, 3000) ** (1 / 7.5)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = FE.fit_lambdas(df, ["x"])[0]
    grid = np.linspace(-20, 40, 6001)
    jac = np.sum(np.log1p(x))

    def likelihood(g):
        y = np.log1p(x) if g == 0 else ((x + 1) ** g - 1) / g
        return -len(x) / 2 * np.log(np.var(y)) + (g - 1) * jac
    assert lam > 4 and abs(lam - grid[int(np.argmax([likelihood(g) for g in grid]))]) < 0.02


def test_depth_limits_are_explicit():
    with pytest.raises(ValueError):
        CL.decision_tree(max_depth=40)
    with pytest.raises(ValueError):
        CL.random_forest(max_depth=31)
    assert CL.random_forest().getMaxDepth() == CL.decision_tree().getMaxDepth() == 30
    assert CL.random_forest(max_depth=4).getMaxDepth() == 4


def test_a_fit_that_stops_early_says_so(spark):
    rows = np.random.default_rng(0).normal(size=(400, 3)).tolist()
    df = CU.assemble(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    with pytest.warns(RuntimeWarning, match="stopped at 1 iterations"):
        CU.kmeans_best_of(df, 5, n_init=1, max_iter=1)


LINES = ("transaction_id string, date date, customer_id string, gender string, age int, country string, "
         "category string, quantity int, unit_price double, total_amount double")


def _lines(spark, rows):
    return spark.createDataFrame(rows, LINES)


def test_reload_of_the_same_lines_adds_nothing(spark):
    day = dt.date(2024, 1, 1)
    lines = _lines(spark, [("1", day, "a", "Male", 20, "X", "c", 1, 2.5, 2.5), ("2", None, "a", "Male", 20, "X", "c", 1, 2.5, 2.5),
                           ("3", day, "b", None, None, None, None, 2, 1.1, 2.2), ("3", day, "b", None, None, None, None, 2, 1.1, 2.2)])
    wh = WH.build_warehouse(lines)
    assert wh.fact_sales.count() == 4
    again = INC.incremental_load(wh, lines)
    assert again.fact_sales.count() == 4 and again.dim_customer.count() == 2
    more = INC.incremental_load(again, lines.unionByName(_lines(spark, [("4", None, "c", "Female", 5, "Y", None, 1, 1.0, 1.0)])))
    added = more.fact_sales.where("transaction_id = '4'").collect()
    assert more.fact_sales.count() == 5 and len(added) == 1
    assert added[0].date_id is None and added[0].category_id is None and added[0].unit_price == Decimal("1.00")
    assert INC.incremental_load(more, lines).fact_sales.count() == 5
    assert {r.table_name: (r.repeated_keys, r.as_declared) for r in WH.schema_checks(more).collect()} == {
        t: (0, True) for t in WH.PRIMARY_KEYS}


def test_hot_guest_in_warehouse_joins_and_profiles(spark):
    day = dt.date(2024, 1, 1)
    rows = [(str(k), day, "0" if k % 3 else str(k), "Male", 30, "X", f"c{k % 4}", 1, 2.0, 2.0) for k in range(6000)]
    wh = WH.build_warehouse(_lines(spark, rows))
    assert wh.dim_customer.count() == 2000
    star = WH.star_join_rfm(wh)
    assert star.count() == 6000 and star.where("customer_id = '0'").count() == 4001
    database = "hot_guest"
    stored = WH.persist_warehouse(wh, database, buckets=4)
    assert WH.star_join_rfm(stored).count() == 6000
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_one_dimension_builds_no_fact(spark):
    wh = WH.build_warehouse(X.sales(spark, SF_SMALL))
    assert wh.dim_category.count() > 0
    assert not {"numbered", "fact_sales", "dim_customer"} & set(wh.__dict__)
    plan = wh.dim_customer._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_failed_names_are_marked_one_by_one(spark):
    df = spark.createDataFrame([(1, "Quiz"), (2, "apple"), (3, None), (4, "zebra")], "k int, product_name string")
    got = {r.k: (r.category, r.failed) for r in
           TR.categorize(df, classifier=M._by_first_letter, failed="failed").collect()}
    assert got == {1: ("Other", True), 2: ("Books", False), 3: ("Other", False), 4: ("Toys", False)}


def test_guests_can_be_left_out(spark):
    day = dt.date(2024, 1, 1)
    lines = _lines(spark, [("1", day, "0", None, None, None, None, 1, 1.0, 1.0), ("2", day, "7", None, None, None, None, 1, 1.0, 1.0)])
    assert {r.customer_id for r in R.rfm(lines, exclude_guests=True).collect()} == {"7"}
    assert R.rfm(lines).count() == 2


def test_impute_strategies(spark):
    df = spark.createDataFrame([(k, None if k % 3 else float(k), "x" if k < 5 else None) for k in range(2000)],
                               "k int, v double, s string").repartition(5)
    filled = {r.k: r.v for r in C.impute(df, "v", "ffill", ["k"]).collect()}
    assert all(v == k - k % 3 for k, v in filled.items())
    assert C.impute(df, "s", "mode").where("s <> 'x'").count() == 0
    assert C.impute(df, "v", "median").where("v is null").count() == 0
    with pytest.raises(ValueError):
        C.impute(df, "v", "guess")


# --- invariants of the queries without an oracle -----------------------------------
def test_k_selection_and_silhouette(spark):
    rows = {r.k: r for r in Q.m07(spark, SF_SMALL).collect()}
    assert sorted(rows) == list(range(2, 8)) and sum(r.is_best for r in rows.values()) == 1
    assert max(rows.values(), key=lambda r: r.silhouette).is_best
    assert all(-1 <= r.silhouette <= 1 for r in rows.values()) and rows[2].inertia >= rows[7].inertia
    one = Q.m21(spark, SF_SMALL).first()
    assert -1 <= one.silhouette_squared_euclidean <= 1


def test_classifiers_predict_and_survive_saving(spark):
    rows = M.s13(spark, SF_SMALL).collect()
    for model in ("tree", "forest"):
        own = [r for r in rows if r.model == model]
        assert own and sum(r.label == r.prediction for r in own) / len(own) >= 0.8
    direct = {r.customer_id: r.prediction for r in Q.m13(spark, SF_SMALL).collect()}
    assert {r.customer_id: r.prediction for r in rows if r.model == "tree"} == direct
    sure = Q.m27(spark, SF_SMALL).collect()
    assert len(sure) == len(direct) and all(0.5 <= r.confidence <= 1 for r in sure)


def test_importances_cross_validation_grid_and_pca(spark):
    for df in (Q.m19(spark, SF_SMALL), M.m19_tree(spark, SF_SMALL)):
        values = [r.importance for r in df.collect()]
        assert abs(sum(values) - 1) < 1e-6 and values == sorted(values, reverse=True)
    cv = Q.m17(spark, SF_SMALL).first()
    assert cv.folds == 5 and 0.5 <= cv.cv_mean <= 1 and cv.cv_std >= 0
    pcs = M.m20_labels(spark, SF_SMALL).toPandas()
    assert abs(pcs.pc1.mean()) < 1e-6 * max(1, pcs.pc1.abs().max()) and pcs.pc1.var() >= pcs.pc2.var()
    assert (pcs.tree_label == pcs.label).mean() >= 0.8
    report = {(r.model, r.cls): r for r in Q.m22(spark, SF_SMALL).collect()}
    assert all(0 <= r.f1 <= 1 for r in report.values()) and ("decision_tree", "accuracy") in report


def test_forest_queries_fit_whole_forests(spark, monkeypatch):
    made, real = [], M.CL.random_forest

    def forest(*args, **named):
        made.append(real(*args, **named).getNumTrees())
        return M.CL.decision_tree(max_depth=2)  # only what is asked for counts here

    monkeypatch.setattr(M.CL, "random_forest", forest)
    for query in (M.m17_forest, M.m20_labels, M.s13):
        query(spark, SF_SMALL)
    assert made == [100] * 3


def test_registered_grid_search_is_over_forests(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(Q, "training_table", lambda spark, sf_dir: (None, None))
    monkeypatch.setattr(Q.CL, "grid_search", lambda est, table, depths=None, min_instances=None:
                        asked.append((type(est).__name__, est.getNumTrees(), depths, min_instances)))
    QUERIES["m26_grid_search"](spark, SF_SMALL)
    assert asked == [("RandomForestClassifier", 100, (10, 20, 30), (1, 2, 4))]


def test_grid_and_stream_scoring(spark):
    grid = Q.m26(spark, SF_SMALL).collect()
    assert {(r.max_depth, r.min_instances) for r in grid} == {(d, m) for d in (3, 5, 10) for m in (1, 5, 10)}
    assert all(0 <= r.cv_accuracy <= 1 for r in grid)
    key = lambda df: sorted((r.customer_id, r.Segment) for r in df.collect())
    assert key(Q.r05(spark, SF_SMALL)) == key(Q.m23(spark, SF_SMALL))


def test_box_cox_lambda_is_mle(spark):
    x = np.random.default_rng(5).lognormal(1, 0.6, 2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = FE.fit_lambdas(df, ["x"], method="box-cox")[0]
    grid, jac = np.linspace(-4, 4, 4001), np.sum(np.log(x + 1))

    def likelihood(g):
        y = np.log(x + 1) if g == 0 else ((x + 1) ** g - 1) / g
        return -len(x) / 2 * np.log(np.var(y)) + (g - 1) * jac
    assert abs(lam - grid[int(np.argmax([likelihood(g) for g in grid]))]) < 5e-3


def test_column_types_of_the_merged_table(spark):
    got = {r["column"]: r["type"] for r in Q.a23(spark, SF_SMALL).collect()}
    assert got["date"] == "date" and got["total_amount"] == "decimal(15,2)" and got["customer_id"] == "string"
    assert set(got) == set(MG.MERGED_COLUMNS)


def test_json_is_converted_once(spark, tmp_path):
    src, dst = tmp_path / "in.json", str(tmp_path / "out")
    src.write_text('{"orders": [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]}')
    assert FS.convert_json_to_table(spark, str(src), dst)
    assert sorted((r.a, r.b) for r in spark.read.parquet(dst).collect()) == [("1", "x"), ("2", "y")]
    assert not FS.convert_json_to_table(spark, str(src), dst)
    assert not FS.convert_json_to_table(spark, str(tmp_path / "none.json"), str(tmp_path / "other"))


def test_totals_are_recomputed_for_all_lines_or_none(spark):
    from patronage.operators import merge as MG
    cols = ("customer_id string, transaction_id string, date date, quantity int, unit_price double, total_amount double, "
            "source string")
    day = dt.date(2024, 1, 1)
    given = [("1", "t1", day, 2, 3.0, 5.0, "a"), ("2", "t2", day, 1, 4.0, 4.5, "a")]

    def totals(rows, **kw):
        frame = spark.createDataFrame(rows, cols)
        return sorted(float(r.total_amount) for r in MG.merge_sources([frame], **kw).collect())
    assert totals(given) == [4.0, 6.0]
    assert totals(given, per_row=False) == [4.5, 5.0]
    assert totals([*given, ("3", "t3", day, 1, 1.0, None, "a")], per_row=False) == [1.0, 4.0, 6.0]
    frame = spark.createDataFrame(given, cols).drop("total_amount")
    assert sorted(float(r.total_amount) for r in MG.merge_sources([frame], per_row=False).collect()) == [4.0, 6.0]
