"""Model operators: closed forms, quality thresholds, splits, saved models."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from panelwright.operators import clusters as K
from panelwright.operators import evaluation as E
from panelwright.operators import features as D
from panelwright.operators import models as M
from panelwright.operators import trees as TR
from panelwright.plans import training as T
from panelwright.sources.model_store import load_model, save_model


@pytest.fixture(scope="module")
def panel(spark):
    """Six entities, 15 years of months; the class is cut from a noisy linear score."""
    rng = random.Random(11)
    rows = []
    for e in range(6):
        for i in range(180):
            a, b = rng.gauss(e, 1), rng.uniform(0, 5)
            tws = math.sin(i / 6) * 5 + rng.gauss(0, 0.3)
            score = round(min(max(0.3 * e + 0.2 * b - 0.1 * tws + rng.gauss(0, 0.05), 0.0), 5.0), 4)
            rows.append((f"C{e}", f"{2008 + i // 12}-{i % 12 + 1:02d}", 2008 + i // 12, a, b if rng.random() < 0.95 else None,
                         tws, score, "Low" if score < 1 else "Moderate" if score < 2 else "High" if score < 3.5 else "Extreme"))
    return spark.createDataFrame(
        rows, "country_code string, date string, year int, water_stress_score double, drought_risk_score double, "
        "tws_anomaly_cm double, drought_composite_score double, drought_risk_class string").cache()


KEY = ["country_code", "date"]
VECTORS = StructType([StructField("fold", IntegerType()), StructField("label", DoubleType()), StructField("features", VectorUDT())])
POINTS = StructType([StructField("e", IntegerType()), StructField("features", VectorUDT())])


def test_ridge_equals_closed_form(spark, panel):
    names = ["water_stress_score", "drought_risk_score", "tws_anomaly_cm"]
    model = M.fit_regressor(panel, names, "drought_composite_score", KEY, "ridge", {"alpha": 25.0})
    rows = panel.select(*names, "drought_composite_score").collect()
    x = np.array([[v or 0.0 for v in r[:3]] for r in rows])
    y = np.array([r[3] for r in rows])
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 25.0 * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(model.stages[-1].coefficients.toArray(), want, atol=1e-9)
    assert model.stages[-1].intercept == pytest.approx(y.mean())
    assert M.model_features(model) == names


def test_scale_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "v double, c double")
    got = M.standardised(df, ["v", "c"]).orderBy("v").collect()
    assert [r["v"] for r in got] == pytest.approx([-1.0690, -0.2673, 1.3363], abs=1e-4)
    assert [r["c"] for r in got] == [0.0, 0.0, 0.0]


def test_splits(spark, panel):
    train, test = D.split_by_year(panel, 2018, KEY, label="drought_risk_class")
    assert train.agg(F.max("year")).first()[0] == 2017 and test.agg(F.min("year")).first()[0] == 2018
    for fallback in (panel.drop("year"), panel.withColumn("year", F.lit(2030))):
        train, test = D.split_by_year(fallback, 2018, KEY, label="drought_risk_class")
        assert train.count() + test.count() == panel.count()
        for r in panel.groupBy("drought_risk_class").count().collect():
            n = test.filter(F.col("drought_risk_class") == r[0]).count()
            assert abs(n - r["count"] / 5) <= 1
    train, test = D.split_by_year(panel.drop("year"), 2018, KEY)
    assert 0.1 < test.count() / panel.count() < 0.3 and train.join(test, KEY).count() == 0


def test_sample_ignores_partitions(panel):
    pick = lambda df: sorted(map(tuple, D.bounded_sample(df.select(*KEY), KEY, 50).collect()))
    assert pick(panel.repartition(3)) == pick(panel.repartition(9)) and len(pick(panel)) == 50


def test_classifier_run(spark, panel, tmp_path):
    trained = T.train_classifiers(
        panel, tune=False, params={"RandomForest": {"numTrees": 15, "maxDepth": 6}, "GBT": {"maxIter": 4, "maxDepth": 3}},
        reference_mode=True)
    assert set(trained.models) == {"RandomForest", "GBT"}
    assert all(s["f1_weighted"] > 0.85 and s["accuracy"] > 0.85 for s in trained.scores.values())
    assert trained.best == max(trained.scores, key=lambda n: trained.scores[n]["f1_weighted"])
    assert "drought_composite_score" in trained.features
    for name, model in trained.models.items():
        got = M.class_probabilities(model, trained.test, KEY)
        shares = [c for c in got.columns if c.startswith("p_")]
        assert len(shares) >= 3
        assert all(sum(r[c] for c in shares) == pytest.approx(1.0) for r in got.collect())
        save_model(model, str(tmp_path), "drought_classifier", name)
        again = load_model(str(tmp_path), "drought_classifier", name).transform(trained.test)
        both = again.select(*KEY, F.col("predicted").alias("p2")).join(model.transform(trained.test).select(*KEY, "predicted"), KEY)
        assert both.count() == trained.test.count() and both.filter("p2 <> predicted").count() == 0
        ranked = M.importance(model).collect()
        assert ranked[0]["feature"] == "drought_composite_score" and sum(r["importance"] for r in ranked) == pytest.approx(1.0)
    lost = M.permutation_importance(trained.models["RandomForest"], trained.test, "drought_risk_class", KEY).collect()
    assert lost[0]["feature"] == "drought_composite_score" and lost[0]["drop"] > 0.2 and len(lost) == 4


def test_safe_mode_leaves_the_score_out(panel):
    trained = T.train_classifiers(panel, tune=False, kinds={"RandomForest": "forest"},
                                  params={"RandomForest": {"numTrees": 3, "maxDepth": 3}})
    assert "drought_composite_score" not in trained.features
    with pytest.raises(ValueError, match="target column"):
        T.train_classifiers(panel.drop("drought_risk_class"))


def test_regressor_run_with_search(spark, panel):
    lagged = T.lagged_panel(panel)
    assert lagged.count() == 6 * 177
    trained = T.train_regressors(lagged, kinds={"Ridge": "ridge"})
    assert trained.features == sorted(trained.features) and "month_sin" in trained.features
    assert trained.scores["Ridge"]["R2"] > 0.6 and trained.best == "Ridge"
    boosted = T.train_regressors(lagged, tune=False, kinds={"GBT_Reg": "boosted"}, params={"GBT_Reg": {"maxIter": 5}})
    assert boosted.scores["GBT_Reg"]["RMSE"] < 1.0
    cases = spark.createDataFrame([("a", 2.0, 9.0), ("b", 2.0, -90.0)], "id string, drought_composite_score_lag1 double, x double")
    got = M.forecast(trained.models["Ridge"], cases, ["id"]).collect()
    assert len(got) == 2 and all(0.0 <= r["forecast"] <= 5.0 and r["forecast_class"] for r in got)
    with pytest.raises(ValueError, match="no rows"):
        T.train_regressors(lagged.limit(0))


def test_train_all_saves_and_logs(spark, panel, tmp_path):
    small = {"RandomForest": {"numTrees": 3, "maxDepth": 3}, "GBT": {"maxIter": 2, "maxDepth": 2},
             "Ridge": {"alpha": 1.0}, "GBT_Reg": {"maxIter": 2, "maxDepth": 2}}
    classes, values = T.train_all(panel, str(tmp_path / "models"), str(tmp_path / "runs"), False, small)
    assert sorted(p.name for p in (tmp_path / "models").iterdir()) == [
        "drought_classifier_gbt", "drought_classifier_randomforest", "stress_predictor_gbt_reg", "stress_predictor_ridge"]
    run = spark.read.json(str(tmp_path / "runs")).first()
    assert run["data_rows"] == panel.count() and run["regression"]["Ridge"]["RMSE"] == values.scores["Ridge"]["RMSE"]
    cases = M.scenarios(classes.models["RandomForest"], spark.createDataFrame([("a", 4.0)], "id string, water_stress_score double"))
    got = M.class_probabilities(classes.models["RandomForest"], cases, ["id"]).first()
    assert got["predicted"] in ("Low", "Moderate", "High", "Extreme")


def test_forest_search_picks_the_better_point(panel):
    train = panel.filter("year < 2018")
    model = M.fit_classifier(train, ["drought_composite_score"], "drought_risk_class", KEY, "forest",
                             grid={"numTrees": [3], "maxDepth": [0, 5]}, folds=3)
    assert model.stages[-2].getOrDefault("maxDepth") == 5


def test_class_report_lists_absent_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "y string, p string")
    got = {r["class"]: r for r in E.class_report(df, "y", "p", ["a", "b", "z"]).collect()}
    assert tuple(got["z"])[1:] == (0.0, 0.0, 0.0, 0)
    assert got["a"]["precision"] == 1.0 and got["a"]["recall"] == 0.5 and got["a"]["f1"] == pytest.approx(2 / 3)
    scores = E.class_scores(df, "y", "p", ["a", "b", "z"]).first()
    assert scores["accuracy"] == 0.75 and scores["f1_weighted"] == pytest.approx((2 / 3 + 0.8) / 2, abs=1e-4)


def test_regression_scores_and_choice(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    got = E.regression_scores(df, "y", "p").first()
    gap = np.array([0.5, 0.0, 1.0])
    assert got["RMSE"] == pytest.approx(np.sqrt((gap ** 2).mean()), abs=1e-4) and got["MAE"] == 0.5
    assert got["R2"] == pytest.approx(1 - (gap ** 2).sum() / ((np.array([1, 2, 4]) - 7 / 3) ** 2).sum(), abs=1e-4)
    assert E.best_model({"a": {"RMSE": 2.0}, "b": {"RMSE": 1.0}}, "RMSE", False) == "b"
    assert E.comparison(spark, {"a": {"F1": 0.5}}).first()["F1"] == 0.5


def test_zones_are_ordered_by_score(spark):
    rows = [(f"e{i}", float(i // 3) * 4 + 0.1 * (i % 3), float(i // 3)) for i in range(12)]
    df = spark.createDataFrame(rows, "e string, a double, s double")
    profiles = K.entity_profiles(df, ["e"], ["a", "s"])
    zones = K.risk_zones(profiles, ["e"], ["a", "s"], "s", restarts=3).collect()
    assert {r["e"]: r["cluster_name"] for r in zones} == {f"e{i}": K.ZONES[i // 3] for i in range(12)}
    cost = [r["inertia"] for r in K.elbow(K.scaled_vectors(profiles, ["a", "s"]), [2, 3, 4], 3).orderBy("k").collect()]
    assert cost[0] > cost[1] > cost[2]


def test_regressor_fold_count():
    assert [M.regressor_folds(n) for n in (1000, 50, 30, 5)] == [5, 5, 3, 2]


def jobs_of(spark, work):
    """Result and number of jobs of a piece of work."""
    tracker, group = spark.sparkContext.statusTracker(), f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    out = work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(tracker.getJobIdsForGroup(group))


def ridge_errors(x, y, fold, alphas):
    """Mean over the folds of the root mean squared residual of each penalty, by solving every fold."""
    out = []
    for a in alphas:
        per = []
        for f in sorted(set(fold)):
            t, h = fold != f, fold == f
            c, m = x[t].mean(0), y[t].mean()
            b = np.linalg.solve((x[t] - c).T @ (x[t] - c) + a * np.eye(x.shape[1]), (x[t] - c).T @ (y[t] - m))
            per.append(np.sqrt(np.mean((y[h] - m - (x[h] - c) @ b) ** 2)))
        out.append(np.mean(per))
    return np.array(out)


@pytest.mark.parametrize("noise", [0.0, 0.5, 5.0])
def test_ridge_search_equals_fitting_every_fold(spark, noise):
    rng = np.random.default_rng(int(noise * 10))
    n, d, alphas = 90, 6, [0.01, 0.1, 1.0, 10.0, 100.0]
    x = rng.normal(size=(n, d))
    y = 1e3 + x @ rng.normal(size=d) + noise * rng.normal(size=n)
    fold = np.arange(n) * 5 // n
    rows = [(int(f), float(v), Vectors.dense(r)) for f, v, r in zip(fold, y, x)]
    folded = spark.createDataFrame(rows, VECTORS).repartition(3)
    moments = M.fold_moments(folded, d, float(y.mean()))
    whole = sum(list(moments.values())[1:], list(moments.values())[0])
    assert whole.n == n and np.allclose(whole.xx, x.T @ x) and np.allclose(whole.xy, x.T @ (y - y.mean()))
    want = ridge_errors(x, y, fold, alphas)
    fits = {f: [(whole - held).ridge(a) for a in alphas] for f, held in moments.items()}
    assert np.allclose(M._residual_errors(folded, fits, float(y.mean()), 5), want, atol=1e-9)
    if noise:
        got = np.mean([[m.squared_error(*fit) ** 0.5 for fit in fits[f]] for f, m in moments.items()], axis=0)
        assert np.allclose(got, want, atol=1e-9)
    best, jobs = jobs_of(spark, lambda: M._search_ridge(folded, alphas, d, float(y.mean())))
    assert best == alphas[int(np.argmin(want))]
    assert jobs <= (3 if noise else 6)  # of one grouped aggregate, or two; not one for each fit


def test_every_start_at_once(spark):
    """Costs no worse than many starts of plain k-means; as many jobs for 40 starts as for 2, or nearly."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 3)) * 8
    x = np.concatenate([c + rng.normal(size=(40, 3)) for c in centres])
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], POINTS).repartition(3)
    fits, jobs = jobs_of(spark, lambda: K.fit_all(df, [1, 2, 3, 4, 5], 8))
    _, few = jobs_of(spark, lambda: K.fit_all(df, [5], 2))
    assert jobs < 3 * few + 60 and jobs < 40 * 5

    def plain(k):
        best = np.inf
        for s in range(30):
            c = x[np.random.default_rng(s).choice(len(x), k, replace=False)]
            for _ in range(100):
                near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
                c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(k)])
            best = min(best, ((x[:, None] - c[None]) ** 2).sum(2).min(1).sum())
        return best

    for k in (1, 2, 3, 4, 5):
        assert fits[k].cost <= plain(k) * 1.0001 and len(fits[k].centres) == k
        own = ((x[:, None] - np.array(fits[k].centres)[None]) ** 2).sum(2)
        assert fits[k].cost == pytest.approx(own.min(1).sum(), rel=1e-9)
    got = {r["e"]: r["cluster"] for r in K.assigned(df, fits[5]).collect()}
    assert [got[i] for i in range(len(x))] == own.argmin(1).tolist()
    same = spark.createDataFrame([(i, Vectors.dense([1.0, 2.0])) for i in range(6)], POINTS)
    assert K.fit_all(same, [3], 2)[3].centres == [[1.0, 2.0]] and K.fit_all(same, [3], 2)[3].cost == 0
    with pytest.raises(ValueError):
        K.fit_all(same.filter("e > 9"), [2])


@pytest.fixture(scope="module")
def gridded(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(240, 3)), 2)
    y = np.digitize(x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0), [-0.5, 0.6]).astype(float)
    rows = [(int(i % 3), float(v), Vectors.dense(r)) for i, (v, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, VECTORS).repartition(2).cache()


def predictions(model, df):
    return [r["prediction"] for r in model.transform(df).orderBy("features", "fold").collect()]


def test_first_rounds_of_boosting_are_the_shorter_model(gridded):
    from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
    from pyspark.ml.regression import GBTRegressor

    df = gridded.select("*", F.col("features").cast("string").alias("_o"))
    sort = lambda m: [r["prediction"] for r in m.transform(df).orderBy("_o", "fold", "label").collect()]
    make = lambda n: GBTRegressor(maxIter=n, maxDepth=3, seed=5, subsamplingRate=0.8).fit(df)
    assert sort(TR.first_trees(make(6), 3)) == sort(make(3))
    many = lambda n: OneVsRest(classifier=GBTClassifier(maxIter=n, maxDepth=2, seed=5)).fit(df)
    assert sort(TR.first_trees(many(4), 2)) == sort(many(2))
    forest = RandomForestClassifier(numTrees=5, seed=3).fit(df)
    short = TR.first_trees(forest, 2)
    assert short.getNumTrees == 2 and [t.toDebugString for t in short.trees] == [t.toDebugString for t in forest.trees[:2]]


def test_staged_search_equals_cross_validation(gridded):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator

    grid = {"maxIter": [1, 4], "maxDepth": [1, 3]}
    make = lambda v: GBTRegressor(seed=1, labelCol="label", **v)
    points = M.grid_points(grid)
    cv = CrossValidator(estimator=Pipeline(stages=[]), numFolds=3, foldCol="fold",
                        evaluator=RegressionEvaluator(metricName="rmse"))
    cv.setEstimatorParamMaps([{cv.getEstimator().stages: [make(v)]} for v in points])
    metrics = cv.fit(gridded).avgMetrics
    assert M._search(gridded, grid, "maxIter", make, 3, 2, False) == points[int(np.argmin(metrics))]


def test_weighted_f1(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(4)
    rows = [(n, float(rng.randint(0, 3)), float(rng.randint(0, 4))) for n in (1, 2) for _ in range(60)]
    df = spark.createDataFrame(rows, "n int, label double, p double")
    got = M._weighted_f1(df)
    for n in (1, 2):
        want = MulticlassClassificationEvaluator(metricName="f1", predictionCol="p").evaluate(df.filter(F.col("n") == n))
        assert got[n] == pytest.approx(want)


def shapley(nodes, x, width):
    """Shapley values of one tree for one row, by every subset of known features."""
    from itertools import combinations

    def value(known, i=0):
        n = nodes[i]
        if n["left"] < 0:
            return np.array(n["value"])
        if n["feature"] in known:
            return value(known, n["left"] if x[n["feature"]] <= n["threshold"] else n["right"])
        a, b = nodes[n["left"]], nodes[n["right"]]
        return (value(known, n["left"]) * a["rows"] + value(known, n["right"]) * b["rows"]) / n["rows"]

    out = []
    for j in range(width):
        others = [k for k in range(width) if k != j]
        out.append(sum(
            math.factorial(len(s)) * math.factorial(width - len(s) - 1) / math.factorial(width)
            * (value({*s, j}) - value(set(s))) for r in range(width) for s in combinations(others, r)))
    return np.array(out), value(set())


@pytest.mark.parametrize("kind", ["forest", "boosted", "regressor"])
def test_attributions_are_shapley_values(spark, panel, kind):
    names = ["water_stress_score", "drought_risk_score", "tws_anomaly_cm"]
    small = panel.filter("country_code < 'C3'")
    if kind == "regressor":
        model = M.fit_regressor(small, names, "drought_composite_score", KEY, "boosted", {"maxIter": 3, "maxDepth": 3})
    else:
        params = {"numTrees": 3, "maxDepth": 5} if kind == "forest" else {"maxIter": 2, "maxDepth": 3}
        model = M.fit_classifier(small, names, "drought_risk_class", KEY, kind, params)
    found = TR.attributions(model, small, KEY, at_most=12).collect()
    assert len({(r["country_code"], r["date"]) for r in found}) == 12
    learner = M._learner(model)
    by_tree = {}
    for r in TR.tree_nodes(learner).collect():
        by_tree.setdefault(r["tree"], {})[r["node"]] = r
    scored = model.transform(small)
    if kind == "forest":
        scored = scored.withColumn("_out", vector_to_array("probability"))
    elif kind == "regressor":
        scored = scored.withColumn("_out", F.array("prediction"))
    else:  # margins of the boosters, which leave out the factor of the loss
        scored = scored.withColumn("_out", vector_to_array("rawPrediction"))
    scored = {(r["country_code"], r["date"]): r for r in scored.withColumn("_x", vector_to_array("features")).collect()}
    outputs = list(dict.fromkeys(r["output"] for r in found))
    got = {(r["country_code"], r["date"], r["output"], r["feature"]): r for r in found}
    for k in {(r["country_code"], r["date"]) for r in found}:
        want = [shapley(t, scored[k]["_x"], 3) for t in by_tree.values()]
        for c, o in enumerate(outputs):
            mine = [got[(*k, o, f)] for f in names]
            assert [r["attribution"] for r in mine] == pytest.approx([sum(w[0][j][c] for w in want) for j in range(3)], abs=1e-9)
            assert sum(r["attribution"] for r in mine) + mine[0]["base"] == pytest.approx(scored[k]["_out"][c], abs=1e-9)


def test_forest_cut_off_is_a_forest_of_less_depth(gridded):
    from pyspark.ml.classification import RandomForestClassifier

    make = lambda d: RandomForestClassifier(numTrees=4, maxDepth=d, seed=3, featureSubsetStrategy="all").fit(gridded)
    deep = make(7)
    assert max(t.depth for t in deep.trees) > 3
    for d in (0, 1, 3):
        cut = TR.first_trees(deep, 4, d)
        assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in make(d).trees]
        assert predictions(cut, gridded) == predictions(make(d), gridded) and cut.getMaxDepth() == d


def test_forest_search_fits_once_for_all_depths(gridded):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    grid, fitted = {"numTrees": [5], "maxDepth": [1, 2, 6], "minInstancesPerNode": [1, 4]}, []
    make = lambda v: RandomForestClassifier(seed=1, featureSubsetStrategy="all", **v)
    points = M.grid_points(grid)
    cv = CrossValidator(estimator=Pipeline(stages=[]), numFolds=3, foldCol="fold", evaluator=MulticlassClassificationEvaluator(metricName="f1"))
    cv.setEstimatorParamMaps([{cv.getEstimator().stages: [make(v)]} for v in points])
    metrics = cv.fit(gridded).avgMetrics
    found = M._search(gridded, grid, "numTrees", lambda v: fitted.append(v) or make(v), 3, 2, True)
    assert found == points[int(np.argmax(metrics))]
    assert len(fitted) == 2 * 3 and {v["maxDepth"] for v in fitted} == {6}


def test_learners_get_rows_of_one_split_over_the_cores(spark, monkeypatch):
    monkeypatch.setattr(M, "FEW_ROWS", 100)
    rows = spark.range(1000).withColumn("label", F.col("id") % 2).coalesce(1)
    assert len(M.dealt(rows, 1000, ["id"]).inputFiles()) == min(spark.sparkContext.defaultParallelism, 10)
    assert len(M.dealt(rows.limit(80), 80, ["id"]).inputFiles()) == 1
    monkeypatch.setattr(M, "MANY_ROWS", 50)
    spread = M.dealt(rows, 1000, ["id"])
    assert len(spread.inputFiles()) == 20 and spread.agg(F.sum("id")).first()[0] == 499500


def test_boosters_of_a_classifier_are_fitted_side_by_side(gridded, monkeypatch):
    seen = []
    true = M.OneVsRest
    monkeypatch.setattr(M, "OneVsRest", lambda **values: seen.append(values.get("parallelism", 1)) or true(**values))
    rows = gridded.select(F.monotonically_increasing_id().alias("k"), F.col("label").cast("string").alias("class"), "fold")
    M.fit_classifier(M.materialise(rows), ["fold"], "class", ["k"], "boosted", {"maxIter": 1, "maxDepth": 1})
    assert seen and min(seen) > 1
