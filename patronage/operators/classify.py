"""Classifiers and their evaluation.

Splits and folds avoid per-class windows (a class can hold a third of all
rows): rows get a global position in (class, md5(id)) order from the scalable
sequence helper, and a k-row per-class table (a proven bound) turns that into
the rank inside the class.  Reports are aggregations over (label,
prediction) pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, spread
from .forest import forest_grid
from .keys import with_running_total, with_sequential_id

EXCLUDED = ("customer_id", "Cluster", "Segment")
MAX_TREE_DEPTH = 30  # Spark ML's limit


def numeric_features(df: DataFrame, exclude: Sequence[str] = EXCLUDED) -> list[str]:
    """Numeric columns of the schema except ids and labels."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def encode_labels(df: DataFrame, col: str = "Segment", out: str = "label") -> DataFrame:
    """Alphabetical label encoding (0 = first name)."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df).transform(df)


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """M11."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _class_rank(df: DataFrame, label: str, id_col: str) -> DataFrame:
    """Rank inside the class by md5(id), plus class size, without a window
    over the class."""
    keyed = with_sequential_id(df.withColumn("_h", F.md5(F.col(id_col).cast("string"))), [label, "_h"], name="_gpos")
    classes = keyed.groupBy(label).agg(F.min("_gpos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    return (keyed.join(F.broadcast(classes), label)
                 .withColumn("_rank", F.col("_gpos") - F.col("_start") + 1).drop("_gpos", "_start", "_h"))


def stratified_split(df: DataFrame, label: str, id_col: str = "customer_id", train_frac: float = 0.8) -> DataFrame:
    """Exact per-class train share, repeatable (md5 of id), as a column."""
    ranked = _class_rank(df, label, id_col)
    return (ranked.withColumn("split", F.when(F.col("_rank") <= F.round(F.col("_n") * train_frac), F.lit("train"))
                              .otherwise(F.lit("test"))).drop("_rank", "_n"))


def stratified_folds(df: DataFrame, label: str, id_col: str = "customer_id", k: int = 5) -> DataFrame:
    """fold = (rank inside class - 1) mod k."""
    ranked = _class_rank(df, label, id_col)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def _depth(max_depth: int | None) -> int:
    if max_depth is not None and not 0 <= max_depth <= MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {max_depth} is not between 0 and {MAX_TREE_DEPTH}, the deepest tree Spark grows")
    return MAX_TREE_DEPTH if max_depth is None else max_depth


def decision_tree(max_depth: int | None = None, seed: int = 42, label: str = "label",
                  features: str = "features") -> DecisionTreeClassifier:
    """Gini tree; no depth given -> Spark's maximum."""
    return DecisionTreeClassifier(impurity="gini", maxDepth=_depth(max_depth), seed=seed, labelCol=label, featuresCol=features)


def random_forest(n_trees: int = 100, max_depth: int | None = None, seed: int = 42, label: str = "label",
                  features: str = "features") -> RandomForestClassifier:
    """Bootstrap, sqrt(features) per split; no depth given -> full trees, up to Spark's maximum."""
    return RandomForestClassifier(numTrees=n_trees, maxDepth=_depth(max_depth), featureSubsetStrategy="sqrt", bootstrap=True, seed=seed,
                                  impurity="gini", labelCol=label, featuresCol=features)


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M15."""
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          nd: int = 6) -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro
    and weighted averages; 0 where a ratio would divide by zero."""
    # one pass over the predictions; everything else reads a row per pair of classes
    pairs = materialize(pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n")), "report-pairs")
    tp = pairs.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = pairs.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    predn = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(predn, "cls", "full").join(tp, "cls", "left")
              .select(F.col("cls").cast("string").alias("cls"),
                      F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("support", F.lit(0)).alias("support"),
                      F.coalesce("predicted", F.lit(0)).alias("predicted")))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec).withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                         F.lit(0.0)))
    total = pairs.select(F.sum("n")).scalar()
    acc = pairs.select(F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).cast("double")
                       / F.sum("n")).scalar()
    classes = per.where(F.col("support") > 0)
    macro = classes.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                        F.sum("support").cast("bigint").alias("support"))
    weighted = classes.agg(F.lit("weighted avg").alias("cls"),
                           (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
                           (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
                           (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"),
                           F.sum("support").cast("bigint").alias("support"))
    accuracy_row = classes.agg(F.lit("accuracy").alias("cls"), acc.alias("precision"), acc.alias("recall"),
                               acc.alias("f1"), F.sum("support").cast("bigint").alias("support"))
    out = per.select("cls", "precision", "recall", "f1", F.col("support").cast("bigint")) \
             .unionByName(accuracy_row).unionByName(macro).unionByName(weighted)
    return out.select("cls", *[F.round(c, nd).alias(c) for c in ("precision", "recall", "f1")], "support")


def confusion_matrix(pred: DataFrame, classes: Sequence, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Dense matrix over the ordered class list (rows = true class)."""
    return pred.groupBy(F.col(label).alias("actual")).agg(
        *[F.count_if(F.col(prediction) == c).cast("bigint").alias(f"pred_{c}") for c in classes])


def cross_validate(estimator, df: DataFrame, label: str = "label", id_col: str = "customer_id", k: int = 5,
                   features: str = "features") -> DataFrame:
    """Stratified k-fold accuracy, mean and std, via ``CrossValidator``."""
    folded = spread(stratified_folds(df, label, id_col, k), "folds")
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev,
                        foldCol="fold", numFolds=k, parallelism=min(k, 4))
    model = cv.fit(folded)
    std = model.stdMetrics[0] if getattr(model, "stdMetrics", None) else None
    return df.sparkSession.createDataFrame([(k, float(model.avgMetrics[0]), float(std) if std is not None else None)],
                                           "folds int, cv_mean double, cv_std double")


def feature_importances(spark, model, names: Sequence[str]) -> DataFrame:
    """Importances with names, largest first (one value per feature)."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature"))


def pca_projection(df: DataFrame, features: str = "features", k: int = 2) -> DataFrame:
    """Centred features -> first k principal components (pc1, pc2 …)."""
    centred = StandardScaler(inputCol=features, outputCol="_c", withMean=True, withStd=False).fit(df).transform(df)
    proj = PCA(k=k, inputCol="_c", outputCol="_pc").fit(centred).transform(centred)
    arr = vector_to_array("_pc")
    return proj.select(*[c for c in df.columns], *[arr[i].alias(f"pc{i + 1}") for i in range(k)])


def with_confidence(pred: DataFrame, probability: str = "probability") -> DataFrame:
    """confidence = largest class probability."""
    return pred.withColumn("confidence", F.array_max(vector_to_array(probability)))


def grid_search(estimator, df: DataFrame, depths=(3, 5, 10), min_instances=(1, 5, 10), label: str = "label",
                id_col: str = "customer_id", k: int = 5) -> DataFrame:
    """Grid over depth and minimum rows per node, stratified CV accuracy.
    Forests over many rows are grown over counted cells (``forest.forest_grid``)."""
    folded = spread(stratified_folds(df, label, id_col, k), "folds")
    schema = "max_depth int, min_instances int, cv_accuracy double"
    if isinstance(estimator, RandomForestClassifier):
        found = forest_grid(estimator, folded, depths, min_instances, label, k)
        if found is not None:
            return df.sparkSession.createDataFrame([(d, m, found[d, m]) for d in depths for m in min_instances], schema)
    grid = (ParamGridBuilder().addGrid(estimator.maxDepth, list(depths))
            .addGrid(estimator.minInstancesPerNode, list(min_instances)).build())
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    model = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, foldCol="fold",
                           numFolds=k, parallelism=4).fit(folded)
    rows = [(int(pm[estimator.maxDepth]), int(pm[estimator.minInstancesPerNode]), float(m))
            for pm, m in zip(grid, model.avgMetrics)]
    return df.sparkSession.createDataFrame(rows, schema)


def exact_auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    """ROC AUC by the rank-sum (Mann-Whitney) form with average ranks for
    ties; ranks come from a running count over the distinct scores, so no
    single-task window over all rows."""
    per = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(positive)).alias("_p"))
    cum = with_running_total(per, ["_s"], "_n", name="_cum")
    avg_rank = (F.col("_cum") - F.col("_n") + 1 + F.col("_cum")) / 2.0
    return cum.agg(F.sum(F.col("_p") * avg_rank).alias("_r"), F.sum("_p").alias("_np"),
                   (F.sum("_n") - F.sum("_p")).alias("_nn")).select(
        F.round(F.try_divide(F.col("_r") - F.col("_np") * (F.col("_np") + 1) / 2.0,
                             F.col("_np") * F.col("_nn")), 6).alias("auc"))


def metrics_by_period(pred: DataFrame, period: str = "month", label: str = "label",
                      prediction: str = "prediction", threshold: float = 0.85, max_drop: float = 0.02) -> DataFrame:
    """Accuracy per period, change vs previous, retrain flag."""
    per = pred.groupBy(period).agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                   F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))
    w = Window.orderBy(period)  # one row per period: bounded
    change = F.col("accuracy") - F.lag("accuracy").over(w)
    return per.select(period, "rows", F.round("accuracy", 6).alias("accuracy"),
                      F.round(change, 6).alias("change"),
                      ((F.col("accuracy") < threshold) | F.coalesce(change < -max_drop, F.lit(False))).alias("retrain"))
