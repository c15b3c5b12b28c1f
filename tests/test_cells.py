"""Learners over cells against Spark ML's over rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from panelwright.operators import cells as S
from panelwright.operators import models as M
from panelwright.operators import trees as TR


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows of three features with 12, 5 and 25 values, a class and an amount that they do not tell for certain."""
    rng = np.random.default_rng(6)
    x = np.stack([rng.integers(0, k, 3000) for k in (12, 5, 25)], axis=1).astype(float) / [1, 2, 10]
    amount = np.round(x[:, 0] * (x[:, 1] > 1) + x[:, 2] + rng.normal(size=3000))
    label = np.digitize(amount, [3, 6]).astype(float)
    table = [(i, float(c), float(a), *map(float, v)) for i, (c, a, v) in enumerate(zip(label, amount, x))]
    return M.materialise(spark.createDataFrame(table, "k int, class double, amount double, a double, b double, c double"))


def vectors(rows, label):
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).withColumn("label", F.expr(label))


def outputs(model, df, column="prediction"):
    value = vector_to_array(column) if column != "prediction" else F.array(column)
    return np.array([r["v"] for r in model.transform(df).orderBy("k").select(value.alias("v")).collect()])


@pytest.mark.parametrize("kind", ["forest", "boosted", "regressor"])
def test_without_chance_the_trees_are_those_of_rows(rows, kind):
    df = vectors(rows, {"forest": "class", "boosted": "double(class > 0)", "regressor": "amount"}[kind])
    cells, splits = S.cells_of(df, ["a", "b", "c"], ["label"])
    assert cells.count() < 3000 and cells.agg(F.sum(S.ROWS)).first()[0] == 3000
    more, settings = {"weightCol": S.ROWS}, {"maxDepth": 4, "minInstancesPerNode": 3, "seed": 1}
    if kind == "forest":
        settings |= {"numTrees": 2, "maxDepth": 7, "bootstrap": False, "featureSubsetStrategy": "all"}
        one, two = S.CellForest(**settings, **more).on(splits).fit(cells), RandomForestClassifier(**settings).fit(df)
        assert [t.toDebugString.split("\n", 1)[1] for t in one.trees] == [t.toDebugString.split("\n", 1)[1] for t in two.trees]
        assert np.allclose(outputs(one, df, "probability"), outputs(two, df, "probability"))
    else:
        mine, theirs = (S.CellBooster, GBTClassifier) if kind == "boosted" else (S.CellBoosterRegressor, GBTRegressor)
        settings |= {"maxIter": 8, "stepSize": 0.3}
        one, two = mine(**settings, **more).on(splits).fit(cells), theirs(**settings).fit(df)
        column = "rawPrediction" if kind == "boosted" else "prediction"
        assert np.allclose(outputs(one, df, column), outputs(two, df, column), atol=1e-9)
        assert one.treeWeights == two.treeWeights and [t.numNodes for t in one.trees] == [t.numNodes for t in two.trees]
    assert np.allclose(one.featureImportances.toArray(), two.featureImportances.toArray())
    assert type(one) is type(two) and one.getMaxDepth() == settings["maxDepth"]


def test_a_row_is_drawn_as_often_as_by_rows(rows):
    df = vectors(rows, "class")
    cells, splits = S.cells_of(df, ["a", "b", "c"], ["label"])
    forest = S.CellForest(numTrees=60, maxDepth=3, seed=4, weightCol=S.ROWS).on(splits).fit(cells)
    roots = np.array([r["rows"] for r in TR.tree_nodes(forest).filter("node = 0").collect()])
    assert len(roots) == 60 and abs(roots.mean() - 3000) < 5 * 3000 ** 0.5 / 60 ** 0.5 and 0.4 < roots.var() / 3000 < 2.2  # Poisson
    asked = {r["tree"]: r["feature"] for r in TR.tree_nodes(forest).filter("node = 0").collect()}
    assert len(set(asked.values())) > 1  # two of three features a node
    boost = S.CellBooster(maxIter=60, maxDepth=2, seed=4, subsamplingRate=0.8, weightCol=S.ROWS).on(splits).fit(
        cells.withColumn("label", F.expr("double(label > 0)")))
    roots = np.array([r["rows"] for r in TR.tree_nodes(boost).filter("node = 0").collect()])
    assert abs(roots.mean() - 2400) < 5 * 480 ** 0.5 / 60 ** 0.5 and 0.4 < roots.var() / 480 < 2.2  # binomial


def test_fewer_trees_and_less_depth_are_parts_of_the_larger_forest(rows):
    cells, splits = S.cells_of(vectors(rows, "class"), ["a", "b", "c"], ["label"])
    make = lambda n, d: S.CellForest(numTrees=n, maxDepth=d, seed=3, weightCol=S.ROWS).on(splits).fit(cells)
    text = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.trees]
    whole = make(7, 6)
    assert text(TR.first_trees(whole, 4, 3)) == text(make(4, 3)) and text(TR.first_trees(whole, 4)) == text(make(4, 6))


def test_many_values_are_binned(spark):
    rows = M.materialise(spark.range(20_000).select(F.rand(3).alias("x"), F.randn(4).alias("y"), F.lit(1.0).alias("one"),
                                                    (F.col("id") % 3).cast("double").alias("label")))
    cells, splits = S.cells_of(rows, ["x", "y", "one"], ["label"])
    assert [len(s) for s in splits] == [S.BINS - 1, S.BINS - 1, 0]
    assert cells.count() <= 3 * S.BINS ** 2 and cells.agg(F.sum(S.ROWS)).first()[0] == 20_000
    assert max(abs(np.array(splits[0]) - np.arange(1, 32) / 32)) < 0.02
    # a cell's stand-ins lie in its bins
    back = cells.select(vector_to_array("features").alias("v")).select(*[F.col("v")[i].alias(c) for i, c in enumerate("xy")])
    assert {int(np.searchsorted(splits[0], r["x"], side="left")) for r in back.collect()} == set(range(S.BINS))


def test_learner_gets_cells_where_they_are_few(rows, monkeypatch):
    """A learner passed over all rows hundreds of times."""
    from pyspark.ml.functions import array_to_vector

    df = rows.select("k", F.col("class").cast("string").alias("label_"), F.col("class").alias("label"),
                     array_to_vector(F.array("a", "b")).alias("features"))
    ready, splits = M.learner_rows(df, rows, 2, ["k", "label_"], ["k"], None)
    assert ready.count() <= 3 * 12 * 5 and ready.agg(F.sum(S.ROWS)).first()[0] == 3000 and [len(s) for s in splits] == [11, 4]
    folded, _ = M.learner_rows(df, rows, 2, ["k", "label_"], ["k"], lambda x: M.stratified_folds(x, "label_", ["k"], 3))
    sizes = [r["n"] for r in folded.groupBy("fold").agg(F.sum(S.ROWS).alias("n")).collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 3 and sum(sizes) == 3000
    monkeypatch.setattr(S, "MOST", 50)
    ready, splits = M.learner_rows(df, rows, 2, ["k", "label_"], ["k"], None)
    assert splits is None and ready.count() == 3000 and S.ROWS not in ready.columns


@pytest.mark.parametrize("most", [1 << 16, 0])
def test_searches_take_the_same_point_by_cells_and_by_rows(rows, monkeypatch, most):
    monkeypatch.setattr(S, "MOST", most)
    model = M.fit_classifier(rows.withColumn("class", F.col("class").cast("string")), ["a", "b", "c"], "class", ["k"], "forest",
                             grid={"numTrees": [4], "maxDepth": [1, 6]}, folds=2)
    assert model.stages[-2].getOrDefault("maxDepth") == 6
    found = M.fit_regressor(rows, ["a", "b", "c"], "amount", ["k"], "boosted", grid={"maxIter": [1, 6], "maxDepth": [3], "stepSize": [0.3]}, folds=2)
    assert found.stages[-1].getNumTrees == 6
