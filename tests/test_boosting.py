"""Boosting goes on as long as its settings say."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from gearlog import catalog
from gearlog.operators import modeling
from gearlog.params import FEATURE_SENSORS, FIXTURE
from gearlog.sources.shared import shared_path
from gearlog.sources.tables import standardise
from tests.fixtures import noisy, tables


@pytest.fixture(scope="module")
def labelled(spark):
    df = standardise(tables(spark, telemetry=noisy(3, 60)).telemetry)
    label = ((F.col("vibration") > 42) & (F.col("voltage") > 168)).cast("int")
    path = shared_path(spark, "labelled")
    df.withColumn("failure_label", label).write.parquet(path)
    return modeling.three_way_split(spark.read.parquet(path))


@pytest.mark.slow
def test_small_gains_do_not_end_the_boosting(spark, labelled):
    names = list(FEATURE_SENSORS)
    whole = modeling.train_gbt(labelled, names, trees=12, depth=2, patience=3)
    assert whole.stages[-1].getNumTrees > 6
    modeling.save_model(whole, 0.5, modeling.feature_importance(spark, whole, names), path := shared_path(spark, "m"))
    again = modeling.load_model(spark, path)[0]
    assert modeling.predict(again, labelled).exceptAll(modeling.predict(whole, labelled)).count() == 0


@pytest.mark.slow
def test_first_trees_are_a_shorter_run(labelled):
    names = list(FEATURE_SENSORS)
    rows = modeling._assembler(names).transform(labelled)
    booster = GBTClassifier(labelCol="failure_label", maxDepth=2, stepSize=0.3, seed=1)
    long, short = booster.setMaxIter(4).fit(rows), booster.setMaxIter(2).fit(rows)
    cut = modeling._first_trees(long, 2)
    assert cut.getNumTrees == 2 and cut.treeWeights == short.treeWeights
    assert cut.transform(rows).exceptAll(short.transform(rows)).count() == 0


@pytest.mark.parametrize(
    "losses, patience, best",
    [
        ([3.0, 2.0, 1.0], 2, (3, False)),
        ([3.0, 2.0, 2.5, 2.5, 1.0], 2, (2, True)),
        ([3.0, 2.0, 2.5, 1.0, 1.0], 2, (4, False)),
        ([1.0, 1.0, 1.0], 2, (1, True)),
    ],
)
def test_patience(losses, patience, best):
    assert modeling._best_round(losses, patience) == best


class Improving:
    """Takes the place of the classifier; each tree lowers the loss."""

    asked = []

    def __init__(self, **settings):
        self.depth = settings["maxDepth"]

    def setMaxIter(self, n):
        self.asked.append((n, self.depth))
        return self

    def fit(self, rows):
        if len(self.asked) == 2:
            raise RuntimeError("enough seen")
        return self

    def evaluateEachIteration(self, rows):
        return [-float(k) for k in range(self.asked[-1][0])]


def test_the_query_trains_the_whole_model(labelled, monkeypatch):
    monkeypatch.setattr(catalog, "_model_rows", lambda t, p: (labelled, list(FEATURE_SENSORS)))
    monkeypatch.setattr(modeling, "GBTClassifier", Improving)
    with pytest.raises(RuntimeError, match="enough seen"):
        catalog.HISTORY["gbt_predictions"](None, FIXTURE)
    assert Improving.asked == [(100, 8), (500, 8)]
