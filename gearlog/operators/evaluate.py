"""Evaluation of predictions.

Input rows have ``label`` (0/1), ``probability`` and, where decisions are
counted, ``prediction`` (0/1). ``by`` names grouping columns such as the model.
Everything that depends on score order works on counts per distinct score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import cumulative, exact_quantiles
from ..params import CostMatrix

BY = ["model"]
COST = CostMatrix()
# Thresholds of the two tables and the calibration bin edges.
TABLE_THRESHOLDS = [0.1 + 0.05 * i for i in range(18)]
CURVE_THRESHOLDS = [0.05 + 0.05 * i for i in range(19)]
CALIBRATION_EDGES = [0.1 * i for i in range(1, 10)]


def _ratio(a: Column, b: Column) -> Column:
    """a / b, or 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _confusion_aggs() -> list[Column]:
    y, d = F.col("label"), F.col("prediction")
    return [
        F.count_if((y == 1) & (d == 1)).alias("tp"),
        F.count_if((y == 0) & (d == 1)).alias("fp"),
        F.count_if((y == 1) & (d == 0)).alias("fn"),
        F.count_if((y == 0) & (d == 0)).alias("tn"),
    ]


def confusion_counts(df: DataFrame, by=BY) -> DataFrame:
    """True and false positives and negatives."""
    return df.groupBy(*by).agg(*_confusion_aggs())


def _rates() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    sides = [(tp + fp), (tp + fn), (tn + fp), (tn + fn)]
    root = F.lit(1.0)
    for s in sides:
        root = root * F.sqrt(s.cast("double"))
    return {
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "specificity": _ratio(tn, tn + fp),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        "mcc": _ratio(tp.cast("double") * tn - fp.cast("double") * fn, root),
        "fpr": _ratio(fp, fp + tn),
        "fnr": _ratio(fn, fn + tp),
    }


def _cost(m: CostMatrix = COST, with_tn: bool = True) -> Column:
    total = F.col("fp") * m.fp + F.col("fn") * m.fn + F.col("tp") * m.tp
    return total + F.col("tn") * m.tn if with_tn else total


def _sizes() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {"n_samples": tp + fp + fn + tn, "n_positive": tp + fn, "n_negative": fp + tn}


def _costs(costs: CostMatrix = COST) -> dict[str, Column]:
    total = _cost(costs)
    return {"cost_total": total, "cost_per_sample": total / _sizes()["n_samples"]}


def _phm(early: float = 0.1, late: float = 1.0) -> Column:
    r = _rates()
    loss = (F.lit(early) * r["fpr"] + F.lit(late) * r["fnr"]) / (early + late)
    return F.greatest(F.lit(0.0), F.lit(1.0) - loss)


def _brier() -> Column:
    error = F.pow(F.col("probability") - F.col("label"), F.lit(2))
    return F.when(F.min("label") == F.max("label"), 1.0).otherwise(F.avg(error))


def classification_metrics(df: DataFrame, by=BY) -> DataFrame:
    """Counts and rates of the decisions; a rate without cases is 0."""
    columns = _sizes() | _rates()
    return confusion_counts(df, by).select(*by, *[e.alias(n) for n, e in columns.items()])


def cost_total(df: DataFrame, by=BY, costs: CostMatrix = COST) -> DataFrame:
    """Cost of all decisions, in total and per row."""
    return confusion_counts(df, by).select(
        *by, *[e.alias(n) for n, e in _costs(costs).items()]
    )


def phm_score(df: DataFrame, by=BY, early: float = 0.1, late: float = 1.0) -> DataFrame:
    """Score that punishes missed failures more than false alarms, at best 1."""
    return confusion_counts(df, by).select(*by, _phm(early, late).alias("phm_score"))


def score_counts(df: DataFrame, by=BY) -> DataFrame:
    """Positive and negative rows per distinct score."""
    return df.groupBy(*by, "probability").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )


def _ranked(df: DataFrame, by) -> DataFrame:
    """Per distinct score, the rows at or above it and the totals of the group."""
    ranked = cumulative(score_counts(df, by), "probability", ["pos", "neg"], list(by), descending=True)
    totals = ranked.groupBy(*by).agg(F.max("cum_pos").alias("P"), F.max("cum_neg").alias("N"))
    return ranked.join(totals, list(by))


def ranking_metrics(df: DataFrame, by=BY) -> DataFrame:
    """Area under the ROC curve and average precision (0.5 and 0 for one class)."""
    above = F.col("cum_pos") - F.col("pos") / 2
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    one_class = (F.max("P") == 0) | (F.max("N") == 0)
    return (
        _ranked(df, by)
        .groupBy(*by)
        .agg(
            F.when(one_class, 0.5)
            .otherwise(
                F.try_divide(
                    F.sum(F.col("neg") * above), F.max("P").cast("double") * F.max("N")
                )
            )
            .alias("roc_auc"),
            F.when(one_class, 0.0)
            .otherwise(F.try_divide(F.sum(F.col("pos") * precision), F.max("P")))
            .alias("avg_precision"),
        )
    )


def roc_auc(df: DataFrame, by=BY) -> DataFrame:
    return ranking_metrics(df, by).select(*by, "roc_auc")


def average_precision(df: DataFrame, by=BY) -> DataFrame:
    return ranking_metrics(df, by).select(*by, "avg_precision")


def brier(df: DataFrame, by=BY) -> DataFrame:
    """Mean squared error of the probability; 1 when there is only one class."""
    return df.groupBy(*by).agg(_brier().alias("brier_score"))


def all_metrics(df: DataFrame, by=BY) -> DataFrame:
    """Every metric of a model in one row: one aggregate over the rows, one over scores."""
    counts = df.groupBy(*by).agg(*_confusion_aggs(), _brier().alias("brier_score"))
    columns = _sizes() | _rates() | _costs() | {"phm_score": _phm()}
    flat = counts.select(*by, "brier_score", *[e.alias(n) for n, e in columns.items()])
    return flat.join(ranking_metrics(df, by), list(by))


def lead_time(df: DataFrame, by=BY, threshold: float = 0.5) -> DataFrame:
    """Hours to failure of the detected true failures, and the share detected.

    Needs ``time_to_failure_hours``.
    """
    true = df.filter("label = 1")
    found = F.col("probability") >= threshold
    hours = F.when(found, F.col("time_to_failure_hours"))
    rates = true.groupBy(*by).agg(
        F.avg(hours).alias("mean_detection_lead_time"),
        F.avg(found.cast("double")).alias("detection_rate"),
    )
    median = exact_quantiles(
        true.filter(found), "time_to_failure_hours", {"median_detection_lead_time": 0.5}, list(by)
    )
    return rates.join(median, list(by))


def prognostic_horizon_rows(
    df: DataFrame, by=BY, order=("timestamp", "machine_id"), threshold: float = 0.5
) -> DataFrame:
    """Hours to failure at the last row, in ``order``, with a detected failure."""
    hit = df.filter((F.col("label") == 1) & (F.col("probability") >= threshold))
    return hit.groupBy(*by).agg(
        F.max_by("time_to_failure_hours", F.struct(*order)).alias("prognostic_horizon_hours")
    )


def compare_models(df: DataFrame) -> DataFrame:
    """Main metrics of each model, best F1 first."""
    return (
        all_metrics(df)
        .select(
            "model",
            "accuracy",
            "precision",
            "recall",
            "f1_score",
            "mcc",
            "roc_auc",
            "avg_precision",
            "cost_total",
            "cost_per_sample",
        )
        .orderBy(F.desc("f1_score"), "model")
    )


def _at_thresholds(df: DataFrame, thresholds: list[float], by) -> DataFrame:
    """Confusion counts at each threshold, from one pass over the rows.

    Each row is counted under the number of thresholds its score reaches; the
    counts at a threshold are sums over these few bins.
    """
    reached = sum((F.col("probability") >= t).cast("int") for t in thresholds)
    bins = df.groupBy(*by, reached.alias("_bin")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    rows = []
    for i, t in enumerate(thresholds):
        hit = F.col("_bin") > i
        rows.append(
            F.struct(
                F.lit(t).alias("threshold"),
                F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
                F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
                F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
                F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"),
            )
        )
    return bins.groupBy(*by).agg(F.array(*rows).alias("r")).select(*by, F.inline("r"))


def threshold_table(df: DataFrame, thresholds=TABLE_THRESHOLDS, by=BY) -> DataFrame:
    """Quality and cost of the decisions at a list of thresholds."""
    r = _rates()
    return _at_thresholds(df, thresholds, by).select(
        *by,
        "threshold",
        *[r[n].alias(n) for n in ("precision", "recall", "f1_score")],
        _cost().alias("cost_total"),
        *[r[n].alias(n) for n in ("fpr", "fnr")],
    )


def cost_curve(df: DataFrame, thresholds=CURVE_THRESHOLDS, by=BY) -> DataFrame:
    """Precision, recall and cost along thresholds; ``is_best`` marks the cheapest."""
    r = _rates()
    points = _at_thresholds(df, thresholds, by).select(
        *by, "threshold", r["precision"].alias("precision"), r["recall"].alias("recall"),
        _cost(with_tn=False).alias("cost"),
    )
    best = points.groupBy(*by).agg(F.min_by("threshold", F.struct("cost", "threshold")).alias("_best"))
    return (
        points.join(best, list(by))
        .withColumn("is_best", F.col("threshold") == F.col("_best"))
        .drop("_best")
    )


def roc_curve(df: DataFrame, by=BY) -> DataFrame:
    """False against true positive rate per distinct score, from the origin."""
    points = _ranked(df, by).select(
        *by,
        _ratio(F.col("cum_neg"), F.col("N")).alias("fpr"),
        _ratio(F.col("cum_pos"), F.col("P")).alias("tpr"),
        F.col("probability").alias("threshold"),
    )
    origin = df.select(*by).distinct().select(
        *by,
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(origin)


def pr_curve(df: DataFrame, by=BY) -> DataFrame:
    """Precision and recall per distinct score, ending at precision 1, recall 0."""
    points = _ranked(df, by).select(
        *by,
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        _ratio(F.col("cum_pos"), F.col("P")).alias("recall"),
        F.col("probability").alias("threshold"),
    )
    end = df.select(*by).distinct().select(
        *by,
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(end)


def calibration(df: DataFrame, by=BY) -> DataFrame:
    """Mean predicted probability and share of positives in ten equal bins."""
    index = sum((F.col("probability") > e).cast("int") for e in CALIBRATION_EDGES)
    return (
        df.groupBy(*by, index.alias("bin"))
        .agg(
            F.avg("probability").alias("mean_predicted"),
            F.avg("label").alias("fraction_positive"),
            F.count("*").alias("n"),
        )
        .orderBy(*by, "bin")
    )


def model_report(df: DataFrame, by=BY) -> DataFrame:
    """Metrics with the cost of true negatives left out, and the four counts."""
    r = _rates()
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    cost = _cost(with_tn=False)
    return (
        confusion_counts(df, by)
        .join(ranking_metrics(df, by), list(by))
        .select(
            *by,
            *[r[m].alias(m) for m in ("accuracy", "precision", "recall", "f1_score", "mcc")],
            "roc_auc",
            "avg_precision",
            cost.alias("expected_cost"),
            (cost / n).alias("cost_per_sample"),
            *[F.col(c).alias(f"{c}_count") for c in ("fp", "fn", "tp", "tn")],
        )
    )


def confusion_cost_cells(df: DataFrame, by=BY, costs: CostMatrix = COST) -> DataFrame:
    """The four outcomes with count, unit cost and total cost."""
    cells = [
        F.struct(
            F.lit(name.upper()).alias("cell"),
            F.col(name).alias("n"),
            F.lit(unit).alias("unit_cost"),
            (F.col(name) * unit).alias("total_cost"),
        )
        for name, unit in (
            ("tn", costs.tn),
            ("fp", costs.fp),
            ("fn", costs.fn),
            ("tp", costs.tp),
        )
    ]
    return confusion_counts(df, by).select(*by, F.inline(F.array(*cells)))


def tuned_threshold(df: DataFrame, by=BY, costs: CostMatrix = COST) -> DataFrame:
    """The score that minimises false-alarm and miss cost; the lowest of equals."""
    cost = F.col("cum_neg") * costs.fp + (F.col("P") - F.col("cum_pos")) * costs.fn
    return (
        _ranked(df, by)
        .groupBy(*by)
        .agg(F.min(F.struct(cost.alias("cost"), F.col("probability"))).alias("m"))
        .select(*by, F.col("m.probability").alias("threshold"), F.col("m.cost").alias("cost"))
    )


def ensemble_vote(
    df: DataFrame, key: list[str], weights: dict[str, float], threshold: float = 0.5
) -> DataFrame:
    """Weighted mean of the models' probabilities per row key."""
    w = F.lit(0.0)
    for model, weight in weights.items():
        w = F.when(F.col("model") == model, weight).otherwise(w)
    voted = df.withColumn("_w", w).groupBy(*key).agg(
        F.max("label").alias("label"),
        F.try_divide(F.sum(F.col("_w") * F.col("probability")), F.sum("_w")).alias("probability"),
    )
    return voted.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))
