"""Failure classifiers on MLlib, trained and scored as Spark jobs."""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranges import exact_quantiles

LABEL = "failure_label"
# Training settings of the two classifiers.
GBT = {"trees": 500, "depth": 8, "step": 0.05, "subsample": 0.8, "patience": 50, "seed": 42}
FOREST = {"trees": 300, "depth": 12, "leaf": 10, "seed": 42}


def numeric_columns(df: DataFrame, leave_out) -> list[str]:
    kinds = ("int", "bigint", "tinyint", "smallint", "float", "double")
    return [n for n, t in df.dtypes if t in kinds and n not in leave_out]


def three_way_split(df: DataFrame, test_share: float = 0.2, validation_share: float = 0.1):
    """Add ``split``: train, validation, test in time order.

    Both cuts come from one count of the times, and are looked up here: training and
    scoring read ``df`` several times.
    """
    at = F.unix_micros("timestamp")
    stamps = df.select(at.cast("double").alias("_at"))
    probs = {"validate": 1 - (test_share + validation_share), "test": 1 - test_share}
    cuts = exact_quantiles(stamps, "_at", probs, []).first()
    validate_from, test_from = (F.lit(cuts[c] if cuts else None).cast("double") for c in probs)
    return df.withColumn(
        "split",
        F.when(at < validate_from, "train").when(at < test_from, "validation").otherwise("test"),
    )


def _weighted(df: DataFrame, balanced: bool) -> DataFrame:
    """Add ``weight``: n0/n1 for positives, or balanced over both classes."""
    train = df.filter("split = 'train'")
    y = F.col(LABEL)
    counts = train.agg(
        F.count_if(y == 1).alias("n1"), F.count_if(y == 0).alias("n0"), F.count("*").alias("n")
    ).first()
    n1, n0 = max(counts["n1"], 1), max(counts["n0"], 1)
    if balanced:
        weight = F.when(y == 1, counts["n"] / (2 * n1)).otherwise(counts["n"] / (2 * n0))
    else:
        weight = F.when(y == 1, n0 / n1).otherwise(1.0)
    return df.withColumn("weight", weight)


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def _best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Trees up to the lowest loss, and whether ``patience`` rounds after it were no
    lower. Where such rounds come first, later ones don't count."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best] or losses[best] != losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def _first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model after its first ``n`` rounds."""
    if n == model.getNumTrees:
        return model
    gateway, whole = SparkContext._active_spark_context._gateway, model._java_obj
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for k, (tree, weight) in enumerate(zip(whole.trees()[:n], model.treeWeights[:n])):
        trees[k], weights[k] = tree, float(weight)
    return GBTClassificationModel(
        ml.classification.GBTClassificationModel(model.uid, trees, weights, model.numFeatures, model.numClasses)
    )


def train_gbt(df: DataFrame, features: list[str], **settings) -> PipelineModel:
    """Boosted trees on rows with ``split``; boosting ends when the loss on validation rows
    hasn't fallen for ``patience`` rounds, and the trees up to its lowest value stay.

    MLlib's own stop takes the first round that gains under a hundredth, so with small steps
    it would leave a tree or two. Its boosting can't be taken up again either: a first run
    has twice ``patience`` rounds, and one of all rounds follows where that was too short.
    """
    s = GBT | settings
    assembler = _assembler(features)
    rows = assembler.transform(_weighted(df.filter("split != 'test'"), balanced=False))
    known, held = rows.filter("split = 'train'"), rows.filter("split = 'validation'")
    stops = not held.isEmpty()
    booster = GBTClassifier(
        labelCol=LABEL,
        weightCol="weight",
        maxDepth=s["depth"],
        stepSize=s["step"],
        subsamplingRate=s["subsample"],
        seed=s["seed"],
    )
    lengths = {min(2 * s["patience"], s["trees"]), s["trees"]} if stops else {s["trees"]}
    for n in sorted(lengths):
        model = booster.setMaxIter(n).fit(known)
        if not stops:
            break
        best, settled = _best_round(model.evaluateEachIteration(held), s["patience"])
        if settled or n == s["trees"]:
            model = _first_trees(model, best)
            break
    return PipelineModel([assembler, model])


def train_forest(df: DataFrame, features: list[str], **settings) -> PipelineModel:
    """Random forest with balanced class weights."""
    s = FOREST | settings
    rows = _weighted(df.filter("split = 'train'"), balanced=True)
    forest = RandomForestClassifier(
        labelCol=LABEL,
        weightCol="weight",
        numTrees=s["trees"],
        maxDepth=s["depth"],
        minInstancesPerNode=s["leaf"],
        seed=s["seed"],
    )
    return Pipeline(stages=[_assembler(features), forest]).fit(rows)


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Failure probability and decision of every row."""
    scored = model.transform(df).withColumn(
        "failure_probability", vector_to_array("probability")[1]
    )
    out = scored.drop("features", "rawPrediction", "probability", "prediction")
    return out.withColumnRenamed("failure_probability", "probability").withColumn(
        "prediction", (F.col("probability") >= threshold).cast("int")
    )


def feature_importance(
    spark: SparkSession, model: PipelineModel, features: list[str]
) -> DataFrame:
    """Features by importance; one number per feature comes from the model."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save_model(model: PipelineModel, threshold: float, importance: DataFrame, path: str) -> None:
    """Model, decision threshold and importances under one folder."""
    spark = importance.sparkSession
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(threshold,)], "threshold double").write.mode("overwrite").parquet(
        f"{path}/threshold"
    )
    importance.write.mode("overwrite").parquet(f"{path}/importance")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, float, DataFrame]:
    model = PipelineModel.load(f"{path}/model")
    threshold = spark.read.parquet(f"{path}/threshold").first()["threshold"]
    return model, threshold, spark.read.parquet(f"{path}/importance")


def time_series_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Expanding folds: fold k trains on the first k of ``folds`` + 1 time blocks
    and tests on the next one. Rows appear once per fold that uses them."""
    stamps = df.select(F.unix_micros("timestamp").cast("double").alias("_at"))
    probs = {f"c{k}": k / (folds + 1) for k in range(1, folds + 1)}
    cuts = exact_quantiles(stamps, "_at", probs, []).select(F.struct("*")).scalar()
    at = F.unix_micros("timestamp")
    block = sum((at >= cuts[c]).cast("int") for c in probs)
    used = F.sequence(F.greatest(F.lit(1), F.col("_block")), F.lit(folds))
    return (
        df.withColumn("_block", block)
        .withColumn("fold", F.explode(used))
        .withColumn("role", F.when(F.col("_block") == F.col("fold"), "test").otherwise("train"))
        .drop("_block")
    )


def fold_sizes(df: DataFrame, folds: int = 5) -> DataFrame:
    """Rows, time range and positives of each fold and role."""
    return (
        time_series_folds(df, folds)
        .groupBy("fold", "role")
        .agg(
            F.count("*").alias("n"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
            F.sum(LABEL).alias("positives"),
        )
        .orderBy("fold", "role")
    )
