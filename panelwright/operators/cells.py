"""Tree learners over cells: training rows that no tree can tell apart.

A tree learner sees a feature only by its bin, of which there are at most ``BINS``. Rows of the same bins and label form a
cell, and a cell with its number of rows says all that the learner asks of them. With d features there are at most
``BINS`` ** d cells a label, however many rows and whatever values they hold. Where they are ``MOST`` at most, forests and
boosters are fitted on them, otherwise on the rows by Spark ML.

The learners follow Spark ML's: thresholds halfway between a few values and at quantiles of many, Gini impurity or variance,
the same conditions for a leaf, merged leaves of one prediction, Poisson numbers of a row in each tree of a forest, and rows
left out of boosting rounds. Of n equal rows that are taken independently a binomial number is in a round, and a Poisson
number in a forest's tree; these are drawn at once for a cell, so trees have the distribution they have by rows. The result is
a model of Spark ML, in its stored form.
"""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path

# the panel part's workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS, MOST = 32, 1 << 16
#: Rows of a cell.
ROWS = "_rows"
#: Entries (a cell in a tree) and nodes that are looked at together.
ENTRIES, NODES = 1 << 20, 1 << 12
#: A variance below this share of the mean square is what rounding leaves of equal values.
ROUNDING = 1e-13
#: Impurity below which a node is not split (Spark ML's).
PURE = 2.0 ** -52

NODE = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
        "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


def thresholds(rows: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Per column at most ``BINS`` - 1 rising thresholds; a value goes left of those that are not below it."""
    if not columns:
        return []
    # twice the number of bins is far beyond the error of the estimate
    about = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [i for i, c in enumerate(columns) if about[c] <= 2 * BINS]
    found: dict[int, list[float]] = {i: [] for i in few}
    if few:
        each = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(columns[i]).alias("v")) for i in few]))
        for row in rows.select(each).distinct().collect():  # some 2 * BINS a column
            found[row["i"]].append(row["v"])
    out: dict[int, list[float]] = {}
    for i, values in found.items():
        if len(values) <= BINS:
            values = sorted(values)
            out[i] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    many = [i for i in range(len(columns)) if i not in out]
    if many:
        shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
        row = rows.agg(*[F.struct(F.percentile_approx(columns[i], shares, 10_000).alias("q"), F.max(columns[i]).alias("top")).alias(f"c{i}")
                         for i in many]).first()
        for i in many:
            out[i] = [t for t in sorted(set(row[f"c{i}"]["q"] or [])) if t < row[f"c{i}"]["top"]]
    return [out[i] for i in range(len(columns))]


def cells_of(rows: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> tuple[DataFrame, list[list[float]]] | None:
    """``(*groups, features, _rows)`` and the thresholds, or None where rows have more than ``MOST`` cells.

    ``groups`` has the label, and the fold of a search, whose fits share the thresholds of all rows. A cell's features stand
    for all values of its bins.
    """
    splits = thresholds(rows, columns)
    bins = [sum(((F.col(c) > F.lit(t)).cast("int") for t in own), F.lit(0)) for c, own in zip(columns, splits)]
    binned = rows.select(*groups, *[b.alias(f"_b{i}") for i, b in enumerate(bins)])
    names = [*groups, *[f"_b{i}" for i in range(len(columns))]]
    about = binned.agg(F.approx_count_distinct(F.struct(*names)).alias("n")).first()["n"]
    if about > 1.2 * MOST:
        return None
    cells = materialise(binned.groupBy(*names).agg(F.count(F.lit(1)).alias(ROWS)))
    if cells.count() > MOST:
        return None
    stands = [F.element_at(F.array(*[F.lit(float(t)) for t in [*own, own[-1] + abs(own[-1]) + 1 if own else 0.0]]), F.col(f"_b{i}") + 1)
              for i, own in enumerate(splits)]
    return cells.select(*groups, array_to_vector(F.array(*stands)).alias("features"), ROWS), splits


# growing trees

def _gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1)
    return 1 - ((stats / np.maximum(total, 1)[..., None]) ** 2).sum(axis=-1)


def _variance(stats: np.ndarray) -> np.ndarray:
    n = np.maximum(stats[..., 0], 1)
    square = stats[..., 2] / n
    found = square - (stats[..., 1] / n) ** 2
    return np.where(found <= ROUNDING * square, 0.0, found)


def grow(bins: np.ndarray, cell: np.ndarray, tree: np.ndarray, stats: np.ndarray, classes: bool, depth: int, least: int, gain_least: float,
         chosen: int, draw: Sequence[np.random.Generator]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Trees of entries ``(cell, tree, stats)``, level by level, and the leaf that each entry comes to.

    ``stats`` of an entry are its rows by class, or rows, sum and sum of squares. Every node looks at ``chosen`` features.
    """
    impurity = _gini if classes else _variance
    count = (lambda s: s.sum(axis=-1)) if classes else (lambda s: s[..., 0])
    width, most, kinds = bins.shape[1], int(bins.max(initial=0)) + 1, stats.shape[1]
    nodes = {k: [] for k in ("tree", "stats", "impurity", "left", "right", "feature", "bin", "gain", "level")}
    place = tree.astype(np.int64)  # the node of each entry, by its number in all
    first = 0
    now = {"tree": np.arange(len(draw)), "stats": np.stack([np.bincount(tree, stats[:, s], len(draw)) for s in range(kinds)], axis=1)}
    now["impurity"] = impurity(now["stats"])
    open_ = np.ones(len(draw), dtype=bool)
    for level in range(depth + 1):
        size = len(now["tree"])
        left, feature = np.full(size, -1), np.full(size, -1)
        cut, gain = np.full(size, -1), np.full(size, -1.0)
        asked = np.flatnonzero(open_) if level < depth else np.zeros(0, dtype=int)
        children = []
        if len(asked):
            allowed = np.ones((len(asked), width), dtype=bool)
            if chosen < width:
                keys = np.concatenate([draw[t].random((k, width)) for t, k in zip(*np.unique(now["tree"][asked], return_counts=True))])
                allowed = keys.argsort(axis=1).argsort(axis=1) < chosen
            number = np.full(size, -1)
            number[asked] = np.arange(len(asked))
            here = np.flatnonzero(place >= first)
            here = here[number[place[here] - first] >= 0]
            mine = number[place[here] - first]
            order = np.argsort(mine, kind="stable")
            here, mine = here[order], mine[order]
            edges = np.searchsorted(mine, np.arange(0, len(asked) + NODES, NODES))
            for part, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                own = asked[part * NODES:(part + 1) * NODES]
                if not len(own):
                    continue
                at, row = mine[a:b] - part * NODES, here[a:b]
                whole, n = now["stats"][own], count(now["stats"][own])
                best, side = np.full(len(own), -np.inf), np.zeros((len(own), kinds))
                for f in range(width):
                    code = at * most + bins[cell[row], f]
                    low = np.stack([np.bincount(code, stats[row, s], len(own) * most) for s in range(kinds)], axis=1)
                    low = low.reshape(len(own), most, kinds).cumsum(axis=1)[:, :-1]
                    if not low.shape[1]:
                        continue
                    high = whole[:, None] - low
                    ln, hn = count(low), count(high)
                    won = now["impurity"][own][:, None] - (ln * impurity(low) + hn * impurity(high)) / np.maximum(n, 1)[:, None]
                    won[(ln < least) | (hn < least) | (won < gain_least) | ~allowed[part * NODES:part * NODES + len(own), f][:, None]] = -np.inf
                    top = won.argmax(axis=1)
                    value = won[np.arange(len(own)), top]
                    better = value > best
                    best[better], cut[own[better]], feature[own[better]] = value[better], top[better], f
                    side[better] = low[better, top[better]]
                ok = best > 0
                feature[own[~ok]] = cut[own[~ok]] = -1
                gain[own[ok]] = best[ok]
                children.append((own[ok], side[ok]))
        split = np.concatenate([c[0] for c in children]) if children else np.zeros(0, dtype=int)
        left[split] = first + size + 2 * np.arange(len(split))
        right = np.where(left >= 0, left + 1, -1)
        for k, v in (("tree", now["tree"]), ("stats", now["stats"]), ("impurity", now["impurity"]), ("left", left), ("right", right),
                     ("feature", feature), ("bin", cut), ("gain", gain), ("level", np.full(size, level))):
            nodes[k].append(v)
        if not len(split):
            break
        low = np.concatenate([c[1] for c in children])
        here = np.flatnonzero(place >= first)
        from_ = place[here] - first
        here, from_ = here[left[from_] >= 0], from_[left[from_] >= 0]
        place[here] = left[from_] + (bins[cell[here], feature[from_]] > cut[from_])
        both = np.stack([low, now["stats"][split] - low], axis=1).reshape(-1, kinds)
        now = {"tree": np.repeat(now["tree"][split], 2), "stats": both, "impurity": impurity(both)}
        open_ = now["impurity"] >= PURE
        first += size
    return {k: np.concatenate(v) for k, v in nodes.items()}, place


def predictions(nodes: dict[str, np.ndarray], classes: bool) -> np.ndarray:
    """Of every node: the class of most rows, the first of equals, or the mean."""
    stats = nodes["stats"]
    return stats.argmax(axis=1).astype(float) if classes else stats[:, 1] / np.maximum(stats[:, 0], 1)


def stored(nodes: dict[str, np.ndarray], guess: np.ndarray, splits: list[list[float]], classes: bool, tree: int) -> pa.RecordBatch:
    """Nodes in Spark ML's form, each before its left and that before its right side; leaves of one prediction are merged."""
    left, right = nodes["left"].copy(), nodes["right"].copy()
    levels = [np.flatnonzero(nodes["level"] == k) for k in range(int(nodes["level"].max()) + 1)]
    below = np.ones(len(left), dtype=np.int64)
    for at in levels[::-1]:
        at = at[left[at] >= 0]
        a, b = left[at], right[at]
        same = (left[a] < 0) & (left[b] < 0) & (guess[a] == guess[b])
        left[at[same]] = right[at[same]] = -1
        at, a, b = at[~same], a[~same], b[~same]
        below[at] = 1 + below[a] + below[b]
    number = np.full(len(left) + 1, -1)
    number[levels[0]] = 0
    for at in levels:
        at = at[(left[at] >= 0) & (number[at] >= 0)]
        number[left[at]] = number[at] + 1
        number[right[at]] = number[at] + 1 + below[left[at]]
    kept = np.flatnonzero(number[:-1] >= 0)
    kept = kept[np.lexsort((number[kept], nodes["tree"][kept]))]
    inner = left[kept] >= 0
    feature = np.where(inner, nodes["feature"][kept], -1)
    limits = [[splits[f][b]] if f >= 0 else [] for f, b in zip(feature, nodes["bin"][kept])]
    of = nodes["stats"][kept]
    i32 = lambda v: pa.array(np.asarray(v), pa.int32())
    split = pa.StructArray.from_arrays(
        [i32(feature), pa.array(limits, pa.list_(pa.float64())), i32(np.full(len(kept), -1))],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    raw = of.sum(axis=1) if classes else of[:, 0]
    data = pa.StructArray.from_arrays(
        [i32(number[kept]), pa.array(guess[kept]), pa.array(nodes["impurity"][kept]),
         pa.array(list(of), pa.list_(pa.float64())), pa.array(np.rint(raw).astype(np.int64)),
         pa.array(np.where(inner, nodes["gain"][kept], -1.0)), i32(number[left[kept]]), i32(number[right[kept]]), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.RecordBatch.from_arrays([i32(nodes["tree"][kept] + tree), data], ["treeID", "nodeData"])


# the learners

def chosen_features(strategy: str, width: int, trees: int, classes: bool) -> int:
    """How many features a node looks at, by Spark ML's names, shares and numbers."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classes else "onethird"
    by_name = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}
    if strategy in by_name:
        return by_name[strategy]
    if strategy.isdigit():
        return min(int(strategy), width)
    return max(1, math.ceil(float(strategy) * width))


class _OnCells:
    """A learner of Spark ML, fitted on cells; ``splits`` are the thresholds of their bins."""

    splits: list[list[float]]

    def on(self, splits: list[list[float]]):
        self.splits = splits
        return self

    def _taken(self, dataset: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bins, labels and rows of the cells, in one order whatever order they come in."""
        found = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"),
                               F.col(self.getWeightCol()).cast("long").alias("n")).toArrow()
        x = np.array(found.column("x").to_pylist(), dtype=float).reshape(found.num_rows, -1)
        bins = np.stack([np.searchsorted(np.array(t), x[:, i], side="left") for i, t in enumerate(self.splits)], axis=1)
        y, n = found.column("y").to_numpy(), found.column("n").to_numpy()
        if not len(n) or np.isnan(y).any():
            raise ValueError("no training rows, or a row without label")
        order = np.lexsort((y, *bins.T))
        bins, y, n = bins[order], y[order], n[order]
        # cells of several folds
        first = np.flatnonzero(np.append(True, (bins[1:] != bins[:-1]).any(axis=1) | (y[1:] != y[:-1])))
        return bins[first], y[first], np.add.reduceat(n, first)

    def _growth(self, width: int, trees: int, classes: bool) -> dict:
        return {"depth": self.getMaxDepth(), "least": self.getMinInstancesPerNode(), "gain_least": self.getMinInfoGain(),
                "chosen": chosen_features(self.getFeatureSubsetStrategy(), width, trees, classes), "classes": classes}

    def _load(self, nodes: DataFrame, weights: Sequence[float], kind, tree_class: str, more: dict):
        """The model of Spark ML whose trees' nodes are given."""
        spark, path = SparkSession.active(), scratch_path(SparkSession.active(), "trees")
        plain = {p.name: v for p, v in self._paramMap.items() if p.name != "weightCol"}
        usual = {p.name: v for p, v in self._defaultParamMap.items()}
        head = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        group = "regression" if kind is GBTRegressionModel else "classification"
        meta = head | {"class": f"org.apache.spark.ml.{group}.{kind.__name__}", "uid": self.uid, "paramMap": plain,
                       "defaultParamMap": usual, "numFeatures": len(self.splits), "numTrees": len(weights)} | more
        own = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
               "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed"}
        if "Classification" in tree_class:
            own |= {"probabilityCol", "rawPredictionCol"}
        pick = lambda of: {k: v for k, v in of.items() if k in own}
        tree = lambda i: json.dumps(head | more | {
            "class": f"org.apache.spark.ml.{tree_class}", "uid": f"tree_{uuid.uuid4().hex[:12]}", "paramMap": pick(plain),
            "defaultParamMap": pick(usual), "numFeatures": len(self.splits)})
        nodes.write.parquet(f"{path}/data")
        spark.createDataFrame([(i, tree(i), float(w)) for i, w in enumerate(weights)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(
            f"{path}/treesMetadata")
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return kind.load(path)


class CellForest(_OnCells, RandomForestClassifier):
    """A random forest classifier; its trees are dealt over the tasks."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        bins, y, n = self._taken(dataset)
        trees, seed, rate, splits = self.getNumTrees(), self.getSeed(), self.getSubsamplingRate(), self.splits
        classes = int(y.max()) + 1
        settings = self._growth(bins.shape[1], trees, True)
        again = self.getBootstrap()
        at_once = max(1, ENTRIES // len(n))

        def run(batches):
            for batch in batches:
                numbers = batch.column(0).to_numpy()
                for begin in range(0, len(numbers), at_once):
                    own = numbers[begin:begin + at_once]
                    # a tree's draws depend on its number alone
                    draw = [np.random.default_rng([seed % (1 << 63), int(t)]) for t in own]
                    rows = np.stack([d.poisson(rate * n) if again else n if rate >= 1 else d.binomial(n, rate) for d in draw])
                    tree, cell = np.nonzero(rows)
                    stats = np.zeros((len(cell), classes))
                    stats[np.arange(len(cell)), y[cell].astype(int)] = rows[tree, cell]
                    nodes, _ = grow(bins, cell, tree, stats, draw=draw, **settings)
                    found = stored(nodes, predictions(nodes, True), splits, True, 0)
                    yield pa.RecordBatch.from_arrays([pa.array(own[found.column(0).to_numpy()], pa.int32()), found.column(1)], found.schema.names)

        spark = dataset.sparkSession
        parts = max(1, min(trees, spark.sparkContext.defaultParallelism, trees * len(n) // FEW_ENTRIES))
        return self._load(spark.range(0, trees, 1, parts).mapInArrow(run, NODE), [1.0] * trees, RandomForestClassificationModel,
                          "classification.DecisionTreeClassificationModel", {"numClasses": classes})


#: Entries worth a task of their own.
FEW_ENTRIES = 1 << 16


class _CellBooster(_OnCells):
    """Gradient boosting; one task, as a round needs the one before."""

    def _boost(self, dataset: DataFrame, classes: bool, kind):
        bins, y, n = self._taken(dataset)
        rounds, step, rate, seed = self.getMaxIter(), self.getStepSize(), self.getSubsamplingRate(), self.getSeed()
        settings, splits = self._growth(bins.shape[1], 1, False), self.splits
        y = 2 * y - 1 if classes else y

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                cell, tree, now = np.arange(len(n)), np.zeros(len(n), dtype=int), np.zeros(len(n))
                for k in range(rounds):
                    draw = np.random.default_rng([seed % (1 << 63), k])
                    # the first tree is fitted to the labels, the others to the loss's negative gradient
                    wanted = y if not k else 4 * y / (1 + np.exp(np.clip(2 * y * now, -700, 700))) if classes else 2 * (y - now)
                    rows = n if rate >= 1 else draw.binomial(n, rate)
                    stats = np.stack([rows, rows * wanted, rows * wanted ** 2], axis=1).astype(float)
                    nodes, leaf = grow(bins, cell, tree, stats, draw=[draw], **settings)
                    guess = predictions(nodes, False)
                    now = now + (step if k else 1.0) * guess[leaf]
                    yield stored(nodes, guess, splits, False, k)

        nodes = dataset.sparkSession.range(0, 1, 1, 1).mapInArrow(run, NODE)
        return self._load(nodes, [1.0] + [step] * (rounds - 1), kind, "regression.DecisionTreeRegressionModel", {})


class CellBooster(_CellBooster, GBTClassifier):
    """A two-class booster."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        return self._boost(dataset, True, GBTClassificationModel)


class CellBoosterRegressor(_CellBooster, GBTRegressor):
    """A booster of least squares."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        return self._boost(dataset, False, GBTRegressionModel)
