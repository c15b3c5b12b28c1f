"""Fitted tree ensembles as tables: shorter ensembles (M10) and attributions per row."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel, RandomForestClassificationModel
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from .features import READY, bounded_sample

SAMPLE_ROWS = 500


def _saved(model) -> str:
    """The model in Spark's own stored form: ``metadata``, ``treesMetadata`` (tree, its metadata, weight), ``data`` (nodes)."""
    path = scratch_path(SparkSession.active(), "trees")
    model.save(path)
    return path


def first_trees(model, n: int, depth: int | None = None):
    """The ensemble of a fitted model's first ``n`` trees: what boosting had after ``n`` rounds, or a smaller forest.

    With ``depth`` the trees of a forest classifier are cut off there, which gives trees fitted with that limit.
    """
    if isinstance(model, OneVsRestModel):
        short = OneVsRestModel([first_trees(m, n) for m in model.models])
        for p in model.params:
            if model.isSet(p):
                short.set(short.getParam(p.name), model.getOrDefault(p))
        return short
    spark, path = SparkSession.active(), _saved(model)
    short = scratch_path(spark, "trees")
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    meta["numTrees"] = n
    meta["paramMap"] |= {p: n for p in ("numTrees", "maxIter") if p in meta["paramMap"]}
    nodes = spark.read.parquet(f"{path}/data").filter(F.col("treeID") < n)
    if depth is not None:
        meta["paramMap"] |= {"maxDepth": depth}
        nodes = _cut_off(nodes, depth)
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{short}/metadata")
    spark.read.parquet(f"{path}/treesMetadata").filter(F.col("_1") < n).write.parquet(f"{short}/treesMetadata")
    nodes.write.parquet(f"{short}/data")
    return type(model).load(short)


def _cut_off(nodes: DataFrame, depth: int) -> DataFrame:
    """Stored nodes of classification trees without those below ``depth``.

    Siblings that are leaves of one class then become one leaf, as in a fit of that depth. A node is stored before its
    children, and numbers have no gaps. One tree, a part of a model that fits the driver, is one group.
    """

    def cut(tree):
        tree = tree.sort_values("id")
        left, right, guess = (tree[c].to_numpy() for c in ("left", "right", "prediction"))
        left, right = left.copy(), right.copy()
        level = np.zeros(len(tree), dtype=np.int32)
        for i in range(len(tree)):
            if left[i] >= 0:
                level[left[i]] = level[right[i]] = level[i] + 1
        kept = level <= depth
        left[level == depth] = right[level == depth] = -1
        for i in range(len(tree) - 1, -1, -1):
            a, b = left[i], right[i]
            if kept[i] and a >= 0 and left[a] < 0 and left[b] < 0 and guess[a] == guess[b]:
                left[i] = right[i] = -1
                kept[a] = kept[b] = False
        number = np.append(np.cumsum(kept) - 1, -1)  # -1 stays -1
        return tree.assign(number=number[:-1], left=number[left], right=number[right])[kept][["treeID", "id", "number", "left", "right"]]

    node = F.col("nodeData")
    shape = nodes.select("treeID", node["id"].alias("id"), node["prediction"].alias("prediction"),
                         node["leftChild"].alias("left"), node["rightChild"].alias("right"))
    found = shape.groupBy("treeID").applyInPandas(cut, "treeID int, id int, number int, left int, right int")
    leaf = F.col("left") < 0
    none = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                    F.lit(-1).alias("numCategories"))
    changed = (node.withField("id", F.col("number")).withField("leftChild", F.col("left")).withField("rightChild", F.col("right"))
               .withField("gain", F.when(leaf, -1.0).otherwise(node["gain"]))
               .withField("split", F.when(leaf, none).otherwise(node["split"])))
    return nodes.withColumn("id", node["id"]).join(found, ["treeID", "id"]).select(
        "treeID", changed.cast(nodes.schema["nodeData"].dataType).alias("nodeData"))


def tree_nodes(model) -> DataFrame:
    """All nodes of an ensemble: ``tree``, ``node``, ``left``, ``right`` (-1 at a leaf), ``feature``, ``threshold``, ``rows`` (of
    the training data in it), and ``value``: what a leaf adds to each of the model's outputs, its tree's weight included.

    Outputs are the class probabilities of a forest classifier, the margin of each class of one-versus-rest boosters, and
    the prediction of a regressor.
    """
    parts = model.models if isinstance(model, OneVsRestModel) else [model]
    found = None
    for i, part in enumerate(parts):
        path, spark = _saved(part), SparkSession.active()
        weight = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("_w"))
        node, split = F.col("nodeData"), F.col("nodeData.split")
        if isinstance(part, RandomForestClassificationModel):
            total = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x)
            value = F.transform(node["impurityStats"], lambda x: x / total / F.lit(float(part.getNumTrees)))
        else:
            # boosters weigh their trees, a forest has equal ones
            share = F.col("_w") if hasattr(part, "treeWeights") and "GBT" in type(part).__name__ else F.lit(1.0 / part.getNumTrees)
            value = F.array(*[node["prediction"] * share if j == i else F.lit(0.0) for j in range(len(parts))])
        nodes = spark.read.parquet(f"{path}/data").join(F.broadcast(weight), "treeID").select(  # one row a tree
            (F.col("treeID") * len(parts) + i).alias("tree"), node["id"].alias("node"), node["leftChild"].alias("left"),
            node["rightChild"].alias("right"), split["featureIndex"].alias("feature"),
            F.get(split["leftCategoriesOrThreshold"], 0).alias("threshold"), node["rawCount"].alias("rows"), value.alias("value"))
        found = nodes if found is None else found.unionByName(nodes)
    return materialise(found)


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """One row per leaf: ``tree``, ``node``, ``value``, and ``path``: for each feature asked on the way its bounds (above ``low``,
    at most ``high``) and ``z``, the share of the training rows that goes the leaf's way where it is asked."""
    inner = nodes.filter("left >= 0")
    both = F.array(*[F.struct(F.col(side).alias("child"), F.lit(side == "left").alias("is_left")) for side in ("left", "right")])
    down = inner.select("tree", "node", "feature", "threshold", F.col("rows").alias("_of"), F.inline(both))
    child = nodes.select("tree", F.col("node").alias("child"), "rows")
    step = F.struct("feature", F.when(~F.col("is_left"), F.col("threshold")).alias("low"),
                    F.when(F.col("is_left"), F.col("threshold")).alias("high"), (F.col("rows") / F.col("_of")).alias("z"))
    edges = materialise(down.join(child, ["tree", "child"]).select("tree", "node", "child", step.alias("step")))
    level = materialise(nodes.filter("node = 0").select("tree", "node", F.array().cast(edges.select(F.array("step")).dtypes[0][1]).alias("steps")))
    levels = [level]
    while not level.isEmpty():  # once a level of the deepest tree
        level = materialise(level.join(edges, ["tree", "node"]).select(
            "tree", F.col("child").alias("node"), F.concat("steps", F.array("step")).alias("steps")))
        levels.append(level)
    reached = levels[0]
    for more in levels[1:]:
        reached = reached.unionByName(more)
    ends = nodes.filter("left < 0").select("tree", "node", "value").join(reached, ["tree", "node"])
    asked = ends.select("tree", "node", F.inline("steps")).groupBy("tree", "node", "feature").agg(
        F.max("low").alias("low"), F.min("high").alias("high"), F.product("z").alias("z"))
    path = asked.groupBy("tree", "node").agg(F.collect_list(F.struct("feature", "low", "high", "z")).alias("path"))
    return materialise(ends.select("tree", "node", "value").join(path, ["tree", "node"], "left").withColumn(
        "path", F.coalesce("path", F.array().cast(path.dtypes[2][1]))))


def attributions(
    model: PipelineModel, df: DataFrame, key: Sequence[str], at_most: int = SAMPLE_ROWS, seed: int = 42,
) -> DataFrame:
    """What each feature adds to each output of a tree model, for at most ``at_most`` rows in a seeded order.

    One row per ``key``, ``output`` (class, or "prediction") and ``feature``: ``attribution`` and ``base``, the output with no
    feature known. These are Shapley values in which an unknown feature sends a row down both sides by the training rows'
    shares. A leaf's part of them follows from its path alone: with z the share and o whether the row goes the
    leaf's way at a feature, feature j gets (o_j - z_j) times the integral over u in [0, 1] of the product over the path's
    other features of z (1 - u) + o u. That polynomial is integrated exactly by a few Gauss nodes, so a leaf costs
    its path's length, not the subsets of it. Base and attributions of an output sum to the model's value, on every row.

    The sample's size is bounded by ``at_most``, so leaves x sample rows are met on the row's number.
    """
    after = next(i for i, s in enumerate(model.stages) if isinstance(s, VectorAssembler))
    names = [c.removesuffix(READY) for c in model.stages[after].getInputCols()]
    decode = [s for s in model.stages if isinstance(s, IndexToString)]
    outputs = list(decode[0].getLabels()) if decode else ["prediction"]
    ready = bounded_sample(df, key, at_most, seed)
    for stage in model.stages[:after + 1]:
        ready = stage.transform(ready)
    rows = ready.select(*key, vector_to_array("features").alias("_x")).collect()
    spark = df.sparkSession
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in key)
    sample = materialise(spark.createDataFrame(
        [(i, *[r[c] for c in key], [float(v) for v in r["_x"]]) for i, r in enumerate(rows)], f"_row int, {kinds}, _x array<double>"))
    leaves = leaf_paths(tree_nodes(model.stages[after + 1]))
    longest = leaves.agg(F.max(F.size("path"))).first()[0] or 0
    points, weights = np.polynomial.legendre.leggauss(max(1, (longest + 1) // 2))
    points, weights = [(float(p) + 1) / 2 for p in points], [float(w) / 2 for w in weights]

    numbers = F.sequence(F.lit(0), F.lit(len(rows) - 1)) if rows else F.array().cast("array<int>")
    met = leaves.filter(F.size("path") > 0).withColumn("_row", F.explode(numbers)).join(F.broadcast(sample.select("_row", "_x")), "_row")
    here = lambda p: F.get("_x", p["feature"])
    inside = lambda p: (p["low"].isNull() | (here(p) > p["low"])) & (p["high"].isNull() | (here(p) <= p["high"]))
    both = met.select("_row", "value", F.transform("path", lambda p: F.struct(
        p["feature"].alias("f"), p["z"].alias("z"), F.when(inside(p), 1.0).otherwise(0.0).alias("o"))).alias("_path"))
    factor = lambda p, u: p["z"] * F.lit(1 - u) + p["o"] * F.lit(u)
    product = lambda u: F.aggregate("_path", F.lit(1.0), lambda a, p: a * factor(p, u))
    whole = both.select("*", *[product(u).alias(f"_w{q}") for q, u in enumerate(points)])
    share = lambda p: (p["o"] - p["z"]) * sum(
        F.col(f"_w{q}") * F.lit(w) / factor(p, u) for q, (u, w) in enumerate(zip(points, weights)))
    parts = whole.select("_row", "value", F.inline(F.transform("_path", lambda p: F.struct(p["f"].alias("f"), share(p).alias("_phi")))))
    summed = parts.groupBy("_row", "f").agg(*[F.sum(F.col("_phi") * F.col("value")[c]).alias(f"_o{c}") for c in range(len(outputs))])
    known = F.aggregate("path", F.lit(1.0), lambda a, p: a * p["z"])
    base = leaves.agg(*[F.sum(F.col("value")[c] * known).alias(f"b{c}") for c in range(len(outputs))]).first()
    every = sample.select("_row", *key, F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("f"))
    cells = F.array(*[F.struct(F.lit(o).alias("output"), F.coalesce(f"_o{c}", F.lit(0.0)).alias("attribution"),
                               F.lit(base[f"b{c}"]).alias("base")) for c, o in enumerate(outputs)])
    labels = F.array(*[F.lit(n) for n in names])
    return every.join(summed, ["_row", "f"], "left").select(
        *key, labels[F.col("f")].alias("feature"), F.inline(cells))
