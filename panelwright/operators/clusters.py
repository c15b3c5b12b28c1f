"""Entity clustering."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .aggregates import group_means, name_by_rank
from .models import standardised

# Profile features, sweep, final cluster count, restarts, seed, zone names (ascending).
PROFILE_FEATURES = [
    "water_stress_score", "drought_risk_score", "tws_anomaly_cm", "groundwater_anomaly_cm",
    "drought_composite_score", "seasonal_variability", "interannual_variability",
]
SWEEP = range(2, 9)
CLUSTERS = 4
RESTARTS = 10
SEED = 42
ZONES = ["Low Risk Zone", "Moderate Risk Zone", "High Risk Zone", "Critical Zone"]


def entity_profiles(panel: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Mean of each feature per entity; entities with a missing mean left out."""
    return materialise(group_means(panel, keys, features).na.drop("any"))


def scaled_vectors(profiles: DataFrame, features: Sequence[str]) -> DataFrame:
    """Standardised profiles as vectors."""
    scaled = standardised(profiles, features)
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(scaled)
    return materialise(vectors.select(*[c for c in profiles.columns if c not in features], "features"))


@dataclass(frozen=True)
class Fit:
    """The best of several starts: its centres and the sum of squared distances to them."""

    k: int
    start: int
    centres: list[list[float]]
    cost: float


def _uniform(*parts) -> Column:
    """A number in (0, 1) that looks random and depends on its parts alone."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))


def _near(centres: Column) -> Column:
    """Squared distance to, and number of, the nearest of some centres; the first of equals."""
    gap = lambda x, c: (x - c) * (x - c)
    total = lambda c: F.aggregate(F.zip_with("_at", c, gap), F.lit(0.0), lambda s, x: s + x)
    return F.array_min(F.transform(centres, lambda c, i: F.struct(total(c).alias("d"), i.alias("c"))))


def _met(points: DataFrame, centres: dict[int, list]) -> DataFrame:
    """Every point with every open start and its centres: a table of starts x clusters rows at most."""
    rows = [(run, at) for run, at in centres.items()]
    table = points.sparkSession.createDataFrame(rows, "run int, centres array<array<double>>")
    runs = F.array(*[F.lit(run) for run, _ in rows])
    return points.withColumn("run", F.explode(runs)).join(F.broadcast(table), "run")


def fit_all(
    vectors: DataFrame, sweep: Sequence[int], restarts: int = RESTARTS, seed: int = SEED, most: int = 300, tol: float = 1e-4,
) -> dict[int, Fit]:
    """The best fit of each cluster count, all starts of all counts at the same time.

    Starts differ by seed. Centres begin far apart: the next one is drawn with a chance proportional to the squared
    distance to those before it, as the row with the least -ln(u) / distance, so one grouped aggregate draws for all
    starts. Then one grouped aggregate an iteration moves the centres of all starts; those that moved no
    further than ``tol`` drop out. Jobs grow with iterations, not with starts; starts x clusters rows reach the driver
    from each. A start has fewer clusters than asked where there are fewer different rows.
    """
    points = materialise(vectors.select(vector_to_array("features").alias("_at")))
    if points.isEmpty():
        raise ValueError("no rows to cluster")
    width = len(points.first()["_at"])
    runs = {i * restarts + j: (k, j) for i, k in enumerate(sweep) for j in range(restarts)}
    centres: dict[int, list] = {run: [] for run in runs}
    for step in range(max(sweep)):
        open_ = {run: at for run, at in centres.items() if len(at) == step < runs[run][0]}
        if not open_:
            break
        chance = _uniform(F.lit(seed), F.col("run"), F.lit(step), F.col("_at"))
        weight = F.lit(1.0) if step == 0 else _near(F.col("centres"))["d"]
        drawn = _met(points, open_).select("run", "_at", weight.alias("w"), chance.alias("u")).filter("w > 0")
        for row in drawn.groupBy("run").agg(F.min_by("_at", -F.log("u") / F.col("w")).alias("next")).collect():
            centres[row["run"]].append(list(row["next"]))
    moving, cost = dict(centres), {}
    for step in range(most + 1):
        near = _met(points, moving).select("run", "_at", _near(F.col("centres")).alias("near"))
        found = near.groupBy("run", "near.c").agg(
            F.count(F.lit(1)).alias("n"), F.sum("near.d").alias("cost"), *[F.sum(F.col("_at")[i]).alias(f"s{i}") for i in range(width)])
        new, total = {run: list(at) for run, at in moving.items()}, dict.fromkeys(moving, 0.0)
        for row in found.collect():
            total[row["run"]] += row["cost"]
            new[row["run"]][row["c"]] = [row[f"s{i}"] / row["n"] for i in range(width)]
        cost |= total
        # a start that has come to rest keeps the centres its cost was measured at
        moving = {run: at for run, at in new.items() if step < most and any(
            sum((x - y) ** 2 for x, y in zip(a, b)) > tol * tol for a, b in zip(at, centres[run]))}
        centres |= moving
        if not moving:
            break
    fits = {}
    for run, (k, j) in runs.items():
        if k not in fits or cost[run] < fits[k].cost:
            fits[k] = Fit(k, j, centres[run], cost[run])
    return fits


def assigned(vectors: DataFrame, fit: Fit, into: str = "cluster") -> DataFrame:
    """Number of the nearest centre beside every row."""
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in fit.centres])
    return vectors.withColumn("_at", vector_to_array("features")).withColumn(into, _near(centres)["c"]).drop("_at")


def elbow(vectors: DataFrame, sweep: Sequence[int] = SWEEP, restarts: int = RESTARTS, seed: int = SEED) -> DataFrame:
    """Cost per cluster count."""
    fits = fit_all(vectors, sweep, restarts, seed)
    rows = [(k, float(fits[k].cost)) for k in sweep]
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double")


def risk_zones(
    profiles: DataFrame, keys: Sequence[str], features: Sequence[str], score: str,
    k: int = CLUSTERS, names: Sequence[str] = ZONES, restarts: int = RESTARTS, seed: int = SEED,
) -> DataFrame:
    """Cluster label per entity, clusters named by ascending mean score."""
    vectors = scaled_vectors(profiles, features)
    fit = fit_all(vectors, [k], restarts, seed)[k]
    clusters = materialise(assigned(vectors, fit).select(*keys, "cluster"))
    return name_by_rank(profiles.join(clusters, list(keys)), "cluster", score, names, "cluster_name")
