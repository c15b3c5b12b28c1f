"""Classification and regression on panels with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..session import materialise
from .cells import ROWS, CellBooster, CellBoosterRegressor, CellForest, cells_of
from .features import READY, assembler, bounded_sample, median_stage, scale_stage, seeded_order, standard_scale
from .positions import contiguous_folds, stratified_folds, with_positions
from .trees import first_trees

# Seeds, defaults and search grids of the models.
SEED = 42
FOREST_DEFAULT = {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2}
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [10, 15, 20], "minInstancesPerNode": [1, 2]}
BOOST_DEFAULT = {"maxIter": 300, "maxDepth": 8, "stepSize": 0.05}
BOOST_GRID = {"maxIter": [200, 300], "maxDepth": [6, 8], "stepSize": [0.05, 0.1]}
BOOST_SAMPLING = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]
RIDGE_DEFAULT = 1.0
CLASSIFIER_FOLDS = 3
REGRESSOR_FOLDS = 5
SAMPLE_ROWS = 500
# Rows that are worth a task of their own, and those that one task should not exceed.
FEW_ROWS, MANY_ROWS = 50_000, 1_000_000


def grid_points(grid: dict[str, list]) -> list[dict]:
    """Every combination of a search grid."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def label_indexer(train: DataFrame, label: str) -> StringIndexerModel:
    """M3: classes present in the data, alphabetical."""
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(train)


def dealt(rows: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """``n`` rows stored for a learner, which passes over them very often: evenly over the cores, however their source is
    split, but small tables in few tasks."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, -(-n // FEW_ROWS)), -(-n // MANY_ROWS), 1)
    return materialise(rows.repartition(parts, *key))


def as_columns(rows: DataFrame, keep: Sequence[str], width: int) -> tuple[DataFrame, list[str]]:
    """Stored rows with ``keep`` and a column for each of the vector's values, and the names of these."""
    names = [f"_x{i}" for i in range(width)]
    flat = rows.select(*keep, vector_to_array("features").alias("_x"))
    return materialise(flat.select(*keep, *[F.get("_x", i).alias(c) for i, c in enumerate(names)])), names


def fit_classifier(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    kind: str = "forest",
    params: dict | None = None,
    grid: dict[str, list] | None = None,
    folds: int = CLASSIFIER_FOLDS,
    parallelism: int = 4,
    fit_medians_on: DataFrame | None = None,
) -> PipelineModel:
    """Impute, index, assemble, fit; with a grid, search it first.

    The search uses shuffled stratified folds and weighted F1, then refits on all
    training rows. ``fit_medians_on`` widens imputation to other rows (T24).
    """
    indexer = label_indexer(train, label)
    impute = median_stage(train if fit_medians_on is None else fit_medians_on, features)
    prepare = Pipeline(stages=[impute, assembler(features)]).fit(train)
    prepared = indexer.transform(prepare.transform(train)).select(*key, *([label] if label != "label" else []), "label", "features")

    def estimator(values: dict, splits: list | None = None):
        weights = {} if splits is None else {"weightCol": ROWS}
        if kind == "forest":
            made = (RandomForestClassifier if splits is None else CellForest)(
                seed=SEED, featuresCol="features", labelCol="label", **weights, **values)
            return made if splits is None else made.on(splits)
        if kind == "boosted":
            # the booster is two-class; one model per class (T10), side by side, as the jobs of one are many and short
            booster = (GBTClassifier if splits is None else CellBooster)(seed=SEED, **BOOST_SAMPLING, **weights, **values)
            return OneVsRest(classifier=booster if splits is None else booster.on(splits), labelCol="label", parallelism=parallelism, **weights)
        raise ValueError(f"unknown classifier {kind!r}")

    values = params or (FOREST_DEFAULT if kind == "forest" else BOOST_DEFAULT)
    fold = (lambda rows: stratified_folds(rows, label, key, folds, SEED)) if grid else None
    ready, splits = learner_rows(prepared, train, len(features), [*key, *([label] if label != "label" else [])], key, fold)
    make = lambda v: estimator(v, splits)
    if grid:
        values = _search(ready, grid, "numTrees" if kind == "forest" else "maxIter", make, folds, parallelism, True)
    model = make(values).fit(ready)
    decode = IndexToString(inputCol="prediction", outputCol="predicted", labels=list(indexer.labels))
    return PipelineModel(stages=[*prepare.stages, model, decode])


def learner_rows(prepared: DataFrame, train: DataFrame, width: int, keep: Sequence[str], key: Sequence[str], fold) -> tuple[DataFrame, list | None]:
    """What a tree learner is fitted on: cells and the thresholds of their bins where they are few, else all rows.

    ``fold`` adds the column of that name to rows with ``keep``, for a search.
    """
    plain, names = as_columns(prepared, [*keep, "label"] if fold else ["label"], width)
    found = cells_of(plain, names, ["label"])
    if found and fold:
        found = cells_of(materialise(fold(plain)), names, ["fold", "label"])
    if found:
        return materialise(found[0]), found[1]
    ready = dealt(prepared, train.count(), key)
    return (materialise(fold(ready)) if fold else ready), None


def _search(folded: DataFrame, grid: dict[str, list], size: str, estimator, folds: int, parallelism: int, classes: bool) -> dict:
    """The grid point with the best mean score over the folds in column ``fold``, the first of equals.

    Points that differ only in ``size``, the number of trees, share a fit of the largest: boosting passes the smaller
    ones on its way, and of a forest the first trees are one of that size. Forests that differ in depth share a fit of the
    deepest too: no split depends on the depth allowed, so its trees, cut off, are trees of a lower limit (boosting's next
    tree depends on the last, so it has a fit per depth). All points of a chain are scored in one job.
    """
    points = grid_points(grid)
    deep = "maxDepth" if size == "numTrees" and "maxDepth" in grid else None
    chains: dict[tuple, list[tuple]] = {}
    for v in points:
        chains.setdefault(tuple((k, x) for k, x in v.items() if k not in (size, deep)), []).append((v[size], v.get(deep)))

    def score(task) -> list[tuple[dict, float]]:
        rest, fold = task
        cuts = chains[rest]
        most = {size: max(n for n, _ in cuts)} | ({deep: max(d for _, d in cuts)} if deep else {})
        model = estimator(dict(rest) | most).fit(folded.filter(F.col("fold") != fold))
        reached = max(t.depth for t in model.trees) if deep else None
        # a limit that no tree reaches cuts nothing
        same = {(n, d): (n, None if d is None or d >= reached else d) for n, d in cuts}
        made = list(dict.fromkeys(same.values()))
        weight = F.col(ROWS) if ROWS in folded.columns else F.lit(1)  # cells stand for several rows
        held = folded.filter(F.col("fold") == fold).select("label", "features", weight.alias(ROWS))
        for i, (n, d) in enumerate(made):
            part = model if n == most[size] and d is None else first_trees(model, n, d)
            held = part.setPredictionCol(f"_p{i}").transform(held).select(*held.columns, f"_p{i}")
        sizes = [F.struct(F.lit(i).alias("n"), F.col(f"_p{i}").alias("p")) for i in range(len(made))]
        each = held.select("label", ROWS, F.inline(F.array(*sizes)))
        error = F.sqrt(F.sum(F.col(ROWS) * (F.col("p") - F.col("label")) ** 2) / F.sum(ROWS))
        found = _weighted_f1(each) if classes else {
            r["n"]: r["e"] for r in each.groupBy("n").agg(error.alias("e")).collect()}
        return [(dict(rest) | {size: n} | ({deep: d} if deep else {}), found[made.index(same[n, d])]) for n, d in cuts]

    with ThreadPoolExecutor(parallelism) as pool:
        scores = [x for found in pool.map(score, product(chains, range(folds))) for x in found]
    mean = [sum(s for v, s in scores if v == point) / folds for point in points]
    return points[mean.index((max if classes else min)(mean))]


def _weighted_f1(pairs: DataFrame) -> dict[int, float]:
    """Per ``n`` the mean F1 of the classes, weighted by their rows; from counts of (label, prediction) pairs."""
    out: dict[int, float] = {}
    counts = pairs.groupBy("n", "label", "p").agg((F.sum(ROWS) if ROWS in pairs.columns else F.count(F.lit(1))).alias("k")).collect()
    for n in {r["n"] for r in counts}:
        own = [(r["label"], r["p"], r["k"]) for r in counts if r["n"] == n]
        rows = sum(k for _, _, k in own)
        out[n] = 0.0
        for c in {label for label, _, _ in own}:
            support, called = sum(k for a, _, k in own if a == c), sum(k for _, p, k in own if p == c)
            out[n] += support / rows * 2 * sum(k for a, p, k in own if a == p == c) / (support + called)
    return out


def regressor_folds(rows: int) -> int:
    """Five folds, fewer for very short tables."""
    return max(2, min(REGRESSOR_FOLDS, rows // 10))


def ridge(alpha: float, rows: int, deviation: float, label: str = "label") -> LinearRegression:
    """M8: least squares plus ``alpha`` times the squared coefficients.

    Spark averages the loss over rows and scales by the label's deviation, so the
    penalty is converted; the intercept is not penalised.
    """
    return LinearRegression(
        solver="normal", elasticNetParam=0.0, standardization=False, labelCol=label,
        regParam=alpha * deviation / rows)


def _label_shape(df: DataFrame) -> tuple[int, float, float]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s"), F.avg("label").alias("m")).first()
    return row["n"], row["s"] or 1.0, row["m"] or 0.0


def fit_regressor(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    order: Sequence[str],
    kind: str = "ridge",
    params: dict | None = None,
    grid: dict[str, list] | None = None,
    folds: int | None = None,
    parallelism: int = 4,
) -> PipelineModel:
    """Scale, assemble, fit; with a grid, search it over contiguous folds."""
    prepare = Pipeline(stages=[scale_stage(train, features), assembler(features)]).fit(train)
    labelled = prepare.transform(train).withColumn("label", F.col(target).cast("double"))
    prepared = labelled.select(*order, "label", "features")
    if kind == "ridge":
        ready = dealt(prepared, train.count(), order)
        rows, deviation, middle = _label_shape(ready)
        alpha = (params or {}).get("alpha", RIDGE_DEFAULT)
        if grid:
            folded = materialise(contiguous_folds(ready, order, folds or regressor_folds(rows)))
            alpha = _search_ridge(folded, grid["alpha"], len(features), middle)
        model = ridge(alpha, rows, deviation).fit(ready)
    elif kind == "boosted":
        values = params or BOOST_DEFAULT
        folds = (folds or regressor_folds(train.count())) if grid else None
        fold = (lambda rows: contiguous_folds(rows, order, folds)) if grid else None
        ready, splits = learner_rows(prepared, train, len(features), order, order, fold)

        def boost(v: dict):
            if splits is None:
                return GBTRegressor(seed=SEED, labelCol="label", **BOOST_SAMPLING, **v)
            return CellBoosterRegressor(seed=SEED, labelCol="label", weightCol=ROWS, **BOOST_SAMPLING, **v).on(splits)

        if grid:
            values = _search(ready, grid, "maxIter", boost, folds, parallelism, False)
        model = boost(values).fit(ready)
    else:
        raise ValueError(f"unknown regressor {kind!r}")
    return PipelineModel(stages=[*prepare.stages, model])


#: Two candidates whose mean squared errors, as shares of the label's square, lie this close are told apart by their residuals.
CLOSE = 1e-11
#: Sums of one aggregate.
SUMS = 400


@dataclass
class Moments:
    """Sums over rows that least squares needs; they add up over disjoint sets of rows."""

    n: float
    x: np.ndarray
    y: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    def __sub__(self, other: Moments) -> Moments:
        return Moments(*(a - b for a, b in zip(vars(self).values(), vars(other).values())))

    def __add__(self, other: Moments) -> Moments:
        return Moments(*(a + b for a, b in zip(vars(self).values(), vars(other).values())))

    def ridge(self, alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept; the penalty is on the coefficients alone."""
        centred = self.xx - np.outer(self.x, self.x) / self.n + alpha * np.eye(len(self.x))
        slope = np.linalg.lstsq(centred, self.xy - self.x * self.y / self.n, rcond=None)[0]
        return slope, float(self.y - self.x @ slope) / self.n

    def squared_error(self, slope: np.ndarray, base: float) -> float:
        """Mean squared residual on these rows."""
        total = (self.yy - 2 * slope @ self.xy - 2 * base * self.y + slope @ self.xx @ slope
                 + 2 * base * (self.x @ slope) + self.n * base * base)
        return max(float(total), 0.0) / self.n


def fold_moments(folded: DataFrame, width: int, middle: float) -> dict[int, Moments]:
    """Moments of every fold, the label less ``middle``: one grouped aggregate, or several for very many features."""
    x = [F.get(vector_to_array("features"), i) for i in range(width)]
    y = F.col("label") - F.lit(middle)
    sums = {"n": F.lit(1.0), "y": y, "yy": y * y}
    for i in range(width):
        sums |= {f"x{i}": x[i], f"xy{i}": x[i] * y} | {f"xx{i}_{j}": x[i] * x[j] for j in range(i + 1)}
    names, found = list(sums), {}
    for i in range(0, len(names), SUMS):
        for row in folded.groupBy("fold").agg(*[F.sum(sums[c]).alias(c) for c in names[i:i + SUMS]]).collect():
            found.setdefault(row["fold"], {}).update(row.asDict())
    square = lambda v: np.array([[v[f"xx{max(i, j)}_{min(i, j)}"] for j in range(width)] for i in range(width)]).reshape(width, width)
    line = lambda v, c: np.array([v[f"{c}{i}"] for i in range(width)])
    return {fold: Moments(v["n"], line(v, "x"), v["y"], square(v), line(v, "xy"), v["yy"]) for fold, v in found.items()}


def _search_ridge(folded: DataFrame, alphas: Sequence[float], width: int, middle: float) -> float:
    """M10 for ridge: the penalty with the least mean error over the folds.

    One job gathers the moments of each fold. All folds less one give that fold's training side, from which every
    penalty is solved and scored on the driver, whose work depends on the number of features alone. Fits so good, or so
    alike, that rounding hides the difference are scored again by their residuals, in one more job for all of them.
    """
    by_fold = fold_moments(folded, width, middle)
    whole = reduce(lambda a, b: a + b, by_fold.values())
    fits = {f: [(whole - held).ridge(a) for a in alphas] for f, held in by_fold.items()}
    squares = {f: [held.squared_error(*fit) for fit in fits[f]] for f, held in by_fold.items()}
    errors = np.mean([np.sqrt(v) for v in squares.values()], axis=0)
    scale = (whole.yy / whole.n) ** 0.5 or 1.0
    # an error of CLOSE in a mean square is this much of its root
    doubt = np.mean([scale * CLOSE / np.maximum(np.sqrt(np.array(v)) / scale, CLOSE ** 0.5) for v in squares.values()], axis=0)
    best = int(np.argmin(errors))
    if any(i != best and errors[i] - errors[best] <= doubt[i] + doubt[best] for i in range(len(alphas))):
        errors = _residual_errors(folded, fits, middle, len(alphas))
    return alphas[int(np.argmin(errors))]


def _residual_errors(folded: DataFrame, fits: dict[int, list], middle: float, n: int) -> np.ndarray:
    """Mean over the folds of each penalty's root mean squared residual."""
    table = folded.sparkSession.createDataFrame(
        [(f, [[*map(float, slope), float(base)] for slope, base in of]) for f, of in fits.items()],
        "fold int, _fits array<array<double>>")
    known = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    guess = lambda i: F.aggregate(F.zip_with(known, F.col("_fits")[i], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    gaps = [F.col("label") - F.lit(middle) - guess(i) for i in range(n)]
    # one row a fold
    rows = folded.join(F.broadcast(table), "fold").groupBy("fold").agg(
        *[F.sqrt(F.avg(g * g)).alias(f"e{i}") for i, g in enumerate(gaps)]).collect()
    return np.mean([[row[f"e{i}"] for i in range(n)] for row in rows], axis=0)


def model_features(model: PipelineModel) -> list[str]:
    """Feature names in the order the model was fitted with."""
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return [c.removesuffix(READY) for c in inputs]


def _learner(model: PipelineModel):
    after = [i for i, s in enumerate(model.stages) if isinstance(s, VectorAssembler)][0]
    return model.stages[after + 1]


def importance(model: PipelineModel) -> DataFrame:
    """Features by importance; one row per feature."""
    learner = _learner(model)
    parts = learner.models if isinstance(learner, OneVsRestModel) else [learner]
    names = model_features(model)
    shares = [sum(float(p.featureImportances[i]) for p in parts) / len(parts) for i in range(len(names))]
    table = SparkSession.active().createDataFrame(list(zip(names, shares)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def top_importance(model: PipelineModel, k: int = 10) -> DataFrame:
    """O3."""
    return importance(model).limit(k)


def class_probabilities(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Decoded class and one probability column per class.

    One-versus-rest margins pass a sigmoid and are scaled to sum to 1 (T10).
    """
    labels = next(s for s in model.stages if isinstance(s, IndexToString)).getLabels()
    scored = model.transform(df)
    if isinstance(_learner(model), OneVsRestModel):
        margin = vector_to_array("rawPrediction")
        odds = F.transform(margin, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
        scored = scored.withColumn("_odds", odds)
        total = F.aggregate("_odds", F.lit(0.0), lambda a, x: a + x)
        share = F.transform("_odds", lambda o: o / total)
    else:
        share = vector_to_array("probability")
    scored = scored.withColumn("_share", share)
    return scored.select(
        *keep, "predicted", *[F.get("_share", i).alias(f"p_{name}") for i, name in enumerate(labels)])


def permutation_importance(
    model: PipelineModel, df: DataFrame, label: str, key: Sequence[str], at_most: int | None = None, seed: int = SEED
) -> DataFrame:
    """Accuracy lost when one feature's values are permuted, over all rows.

    Every feature gets its own permutation: a row takes the value of the row that
    holds its place in a second seeded order. Places come from range partitions,
    so no task sees a whole order, and all permuted copies are scored in one job.
    ``at_most`` limits the rows to a sample.
    """
    features = model_features(model)
    rows = materialise(df if at_most is None else bounded_sample(df, key, at_most, seed))
    placed = with_positions(rows, key, "_at")
    donors = []
    for i, f in enumerate(features):
        mixed = rows.select(*key, F.col(f).cast("double").alias("_value"), seeded_order(key, seed + 1 + i).alias("_order"))
        donors.append(with_positions(mixed, ["_order", *key], "_at").select(F.lit(i).alias("_f"), "_at", "_value"))
    copies = placed.withColumn("_f", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    mixed = copies.join(reduce(DataFrame.unionByName, donors), ["_f", "_at"], "left").withColumns({
        f: F.when(F.col("_f") == i, F.col("_value")).otherwise(F.col(f).cast("double"))
        for i, f in enumerate(features)})
    right = (F.col("predicted") == F.col(label)).cast("double")
    scores = materialise(model.transform(mixed).groupBy("_f").agg(F.avg(right).alias("accuracy")))
    base = scores.filter("_f = -1").select(F.col("accuracy").alias("base")).first()["base"]
    names = F.array(*[F.lit(f) for f in features])
    return (
        scores.filter("_f >= 0")
        .select(F.element_at(names, F.col("_f") + 1).alias("feature"),
                (F.lit(base) - F.col("accuracy")).alias("drop"))
        .orderBy(F.desc("drop"), "feature")
    )


def scenarios(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows that set some features; all others are 0."""
    features = model_features(model)
    return rows.withColumns({
        f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in rows.columns else F.lit(0.0) for f in features})


def forecast(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Forecast score, limited to 0..5, with its class."""
    scored = model.transform(scenarios(model, rows))
    limited = scored.withColumn("forecast", X.clip("prediction", 0.0, 5.0))
    return limited.select(*keep, "forecast", X.band("forecast").alias("forecast_class"))


def standardised(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """M5 as plain columns."""
    fitted = standard_scale(df if fit_on is None else fit_on, features)
    return df.withColumns({
        f: (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s) for f, (m, s) in fitted.items()})
