"""Quantiles, profiles and grid matching against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import aggregates as A
from panelwright.operators import grid as G
from panelwright.operators import joins as J
from panelwright.operators import profile as P
from panelwright.operators import quantiles as Q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    rows = []
    for g, n in (("hot", 4000), ("b", 37), ("c", 2), ("d", 1)):
        for _ in range(n):
            x = 1.5 if rng.random() < 0.3 else rng.gauss(0, 10)
            rows.append((g, x if rng.random() < 0.9 else None, float(rng.randint(0, 3))))
    rows += [("none", None, 1.0), (None, 5.0, 1.0), ("b", float("nan"), 2.0)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, x double, k double").repartition(5).cache()


def wanted(rows, g, i):
    found = [r[i] for r in rows if r[0] == g and r[i] is not None and not math.isnan(r[i])]
    return len(found), list(np.quantile(found, PROBS))


@pytest.mark.parametrize("accuracy,task_rows", [(20_000, 10 ** 6), (200, 10 ** 6), (20, 10 ** 6), (200, 50), (20, 50)])
def test_grouped_quantiles_are_exact(values, accuracy, task_rows, monkeypatch):
    rows, df = values
    monkeypatch.setattr(Q, "TASK_ROWS", task_rows)
    got = {(r["g"], r["column"]): r for r in Q.exact_quantiles(df, ["x", "k"], PROBS, ["g"], accuracy).collect()}
    assert ("none", "x") not in got and not any(k[0] is None for k in got)
    for g in ("hot", "b", "c", "d"):
        for i, c in ((1, "x"), (2, "k")):
            n, q = wanted(rows, g, i)
            assert got[(g, c)]["n"] == n
            assert got[(g, c)]["q"] == pytest.approx(q, abs=1e-9)


@pytest.mark.parametrize("accuracy,task_rows", [(20_000, 10 ** 6), (50, 10 ** 6), (50, 20)])
def test_table_quantiles_are_exact(values, accuracy, task_rows, monkeypatch):
    rows, df = values
    monkeypatch.setattr(Q, "TASK_ROWS", task_rows)
    found = [r[1] for r in rows if r[1] is not None and not math.isnan(r[1])]
    got = Q.table_quantiles(df, ["x"], PROBS, accuracy)["x"]
    assert got == pytest.approx(list(np.quantile(found, PROBS)), abs=1e-9)


def test_missed_bracket_is_widened(values, monkeypatch):
    rows, df = values
    true_search, used = Q._search, []

    def shifted(df, columns, probs, by, accuracy, slack):
        used.append(slack)
        if len(used) == 1:  # first answer claims nothing was found
            return true_search(df, columns, probs, by, accuracy, slack).withColumn(
                "q", F.transform("q", lambda x: F.lit(None).cast("double")))
        return true_search(df, columns, probs, by, accuracy, slack)

    monkeypatch.setattr(Q, "_search", shifted)
    found = [r[2] for r in rows]
    assert Q.table_quantiles(df, ["k"], [0.5])["k"] == [float(np.quantile(found, 0.5))]
    assert used[1] > used[0]


def test_quantiles_of_seven_values(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 3, 7, 8, 2, 9, 5)], "v double")
    assert Q.table_quantiles(df, ["v"], [0.01, 0.99])["v"] == pytest.approx([1.06, 8.94])
    empty = df.filter("v > 100")
    assert Q.table_quantiles(empty, ["v"], [0.5])["v"] == [None]


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 5.0, 1.0), (4.0, 1.0, 1.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["r"] for r in P.correlation_matrix(df, ["a", "b", "c"], digits=10).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(-0.0524142418)
    assert got[("a", "a")] == 1.0 and got[("a", "c")] is None and got[("c", "c")] is None
    lower = P.correlation_matrix(df, ["a", "b", "c"], lower=True)
    assert sorted((r["a"], r["b"]) for r in lower.collect()) == [("b", "a"), ("c", "a"), ("c", "b")]


def test_correlation_of_many_columns(spark):
    """300 columns with gaps, offsets and scales, a constant, one that is constant in some pairs, and one with a single value."""
    rng = np.random.default_rng(4)
    n, d = 400, 300
    x = rng.normal(size=(n, d)) + rng.normal(size=(n, 1))
    x = x * 10.0 ** rng.integers(-6, 7, d) + 10.0 ** rng.integers(-3, 2, d)
    gaps = rng.random((n, d)) < 0.1
    x[:, 7] = 0.3
    gaps[:200, 11], x[200:, 12], gaps[200:, 13] = True, 5.5, True
    gaps[1:, 17] = True
    names = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame([[None if g else float(v) for v, g in zip(*r)] for r in zip(x, gaps)],
                               ", ".join(f"{c} double" for c in names)).repartition(4)
    got = {(r["a"], r["b"]): r["r"] for r in P.correlation_matrix(df, names, digits=9).collect()}
    assert len(got) == d * d
    for i, j in [(i, j) for i in range(d) for j in (7, 11, 12, 13, 17, (i * 31 + 5) % d, i)]:
        both = ~gaps[:, i] & ~gaps[:, j]
        a, b = x[both, i], x[both, j]
        if len(a) < 2 or a.min() == a.max() or b.min() == b.max():
            assert got[names[i], names[j]] is None, (i, j)
        else:
            assert got[names[i], names[j]] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=2e-7), (i, j)


def test_correlation_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert [r["r"] for r in P.correlation_matrix(df, ["a", "b"]).collect()] == [None] * 4
    assert [r["r"] for r in P.correlation_matrix(df.filter("a > 1"), ["a", "b"]).collect()] == [None] * 4


def test_constants_over_many_partitions(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("c"), F.rand(1).alias("x"), (F.col("id") * 0.1).alias("y")).repartition(8)
    got = {(r["a"], r["b"]): r["r"] for r in P.correlation_matrix(df, ["c", "x", "y"]).collect()}
    assert got[("c", "x")] is None and got[("c", "c")] is None and got[("x", "x")] == 1.0
    from panelwright.operators.features import standard_scale

    assert standard_scale(df, ["c"])["c"] == (0.1, 1.0)


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 5, 5)], "v double")
    got = P.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in got] == [1, 1, 1, 0, 2]
    assert sum(r["density"] for r in got) == pytest.approx(1.0)
    flat = P.histogram(df.filter("v = 5"), "v", 4).collect()
    assert sum(r["count"] for r in flat) == 2


def test_density_of_many_scales(spark):
    """Far outliers, ties, and cells far apart; absolute error against the kernel's peak."""
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.normal(1e6, 1, 3000), rng.exponential(40, 2000) + 1e6, np.full(500, 1e6 + 3.25), [1e6 + 9000.0]])
    df = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(3)
    got = P.density(df, "v", 700).orderBy("i").collect()
    h = np.std(data, ddof=1) * len(data) ** -0.2
    want = [np.exp(-0.5 * ((r["x"] - data) / h) ** 2).mean() / (h * math.sqrt(2 * math.pi)) for r in got]
    assert np.abs(np.array([r["density"] for r in got]) - want).max() * h < 1e-12
    plan = P.density(df, "v", 700)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("HashAggregate")  # cells, not values, are spread


def test_density_is_the_whole_sum(spark):
    rng = random.Random(1)
    data = [rng.gauss(3, 2) for _ in range(60)] + [100.0]
    df = spark.createDataFrame([(x,) for x in data], "v double")
    h = np.std(data, ddof=1) * len(data) ** -0.2
    xs = np.linspace(min(data) - 0.5 * (max(data) - min(data)), max(data) + 0.5 * (max(data) - min(data)), 200)
    want = [np.exp(-0.5 * ((x - np.array(data)) / h) ** 2).sum() / (len(data) * h * math.sqrt(2 * math.pi)) for x in xs]
    got = P.density(df, "v", 200).orderBy("i").collect()
    assert [r["x"] for r in got] == pytest.approx(list(xs))
    assert [r["density"] for r in got] == pytest.approx(want, rel=1e-9)


def test_describe_and_nulls(values):
    rows, df = values
    one = {r["column"]: r for r in P.describe(df, ["x"]).collect()}["x"]
    xs = [r[1] for r in rows if r[1] is not None and not math.isnan(r[1])]
    assert one["count"] == len(xs) and one["p25"] == pytest.approx(np.quantile(xs, 0.25), abs=1e-3)
    profile = P.null_profile(df.select("g", "x", "k")).collect()
    assert [r["column"] for r in profile] == ["x", "g"]
    assert profile[0]["missing"] == sum(r[1] is None for r in rows)


def test_box_summary(values):
    rows, df = values
    box = {r["g"]: r for r in P.box_summary(df.filter("x is not null and not isnan(x)"), "g", "x").collect()}["hot"]
    xs = np.array([r[1] for r in rows if r[0] == "hot" and r[1] is not None])
    q1, q3 = np.quantile(xs, [0.25, 0.75])
    inside = xs[(xs >= q1 - 1.5 * (q3 - q1)) & (xs <= q3 + 1.5 * (q3 - q1))]
    assert (box["whisker_low"], box["whisker_high"]) == (inside.min(), inside.max())


def nearest(axis, x):
    return axis[int(np.argmin(np.abs(np.array(axis) - x)))]


@pytest.mark.parametrize("axis", [
    [0.5, 1.5, 2.5], [7.0], list(np.arange(0.25, 360, 0.5)), [0.0, 1e-6, 2e-6, 5.0, 1000.0, 1e6], [-3.0, -1.0, 8.0]])
def test_nearest_on_axis(spark, axis):
    rng = random.Random(2)
    xs = [rng.uniform(min(axis) - 5, max(axis) + 5) for _ in range(200)] + axis[:50]
    xs += [(a + b) / 2 for a, b in zip(axis, axis[1:])][:50] + [-97.0, 1e9, -1e9]
    points = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    cells = spark.createDataFrame([(float(a),) for a in axis * 2], "at double")
    got = {r["i"]: r["cell"] for r in G.nearest_on_axis(points, "x", cells, "at", "cell").collect()}
    assert got == {i: nearest(axis, x) for i, x in enumerate(xs)}


def test_nearest_with_an_outlier_and_a_hot_place(spark):
    """2,000 axis values and a fill value; a third of the points at one place, some missing."""
    axis = [i * 0.5 for i in range(2000)] + [1e10]
    points = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 250.2).when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, float("nan"))
        .otherwise(F.col("id") * 0.21 - 20).alias("x"), F.lit("kept").alias("_gap"))
    found = G.nearest_on_axis(points, "x", spark.createDataFrame([(a,) for a in axis], "at double"), "at", "cell")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    got = found.collect()
    assert len(got) == 6000 and all(r["_gap"] == "kept" for r in got)
    for r in got:
        missing = r["x"] is None or math.isnan(r["x"])
        assert r["cell"] == (None if missing else nearest(axis, r["x"])), r
    slices = found.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
    assert slices < 4000  # the hot place is split


def test_tie_follows_the_index_on_a_descending_axis(spark):
    cells = spark.createDataFrame([(2.5, 0), (1.5, 1), (0.5, 2)], "at double, i int")
    points = spark.createDataFrame([(2.0,), (1.0,), (None,)], "x double")
    got = [r["cell"] for r in G.nearest_on_axis(points, "x", cells, "at", "cell", "i").collect()]
    assert sorted(got, key=str) == [1.5, 2.5, None]


def test_longitude_modes(spark):
    grid = spark.createDataFrame([(0.0, 0.25 + 0.5 * i) for i in range(720)], "lat double, lon double")
    points = spark.createDataFrame([(1.0, -97.0)], "lat double, lon double")
    assert G.nearest_cell(points, grid).first()["cell_lon"] == 0.25
    assert G.nearest_cell(points, grid, lon_mode="wrap").first()["cell_lon"] == 262.75
    with pytest.raises(ValueError):
        G.nearest_cell(points, grid, lon_mode="other")


def test_extract_series_limits(spark):
    grid = spark.createDataFrame(
        [(0.0, 0.0, 1, 1.00005, 1e10), (0.0, 0.0, 2, 1e10, 3.0), (0.0, 0.0, 3, 1.1e10, 3.0), (0.0, 0.0, 4, float("nan"), 3.0),
         (5.0, 5.0, 1, 1.0, 1.0)], "lat double, lon double, time int, v double, u double")
    points = spark.createDataFrame([("p", 0.4, -3.0)], "name string, lat double, lon double")
    got = G.extract_series(points, grid, "v", "u").orderBy("time").collect()
    assert [(r["name"], r["lat"], r["time"], r["v"], r["u"]) for r in got] == [
        ("p", 0.4, 1, round(1.00005, 4), None), ("p", 0.4, 2, 1e10, 3.0)]
    assert "u" not in G.extract_series(points, grid.drop("u"), "v", "u").columns


def test_left_join_suffix_and_uniqueness(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, v int")
    got = J.left_join_suffixed(fact, dim, ["k"], "_d").orderBy("v", "v_d").collect()
    assert [tuple(r) for r in got] == [("a", 1, 10), ("a", 1, 11), ("b", 2, None), (None, 3, None)]
    with pytest.raises(ValueError, match="not unique"):
        J.left_join_suffixed(fact, dim, ["k"], "_d", require_unique=True)


def test_names_by_rank_and_members(spark):
    df = spark.createDataFrame([(7, "x", 3.0), (7, "y", 5.0), (2, "z", 1.0), (9, "w", 9.0)], "c int, e string, s double")
    named = {r["c"]: r["n"] for r in A.name_by_rank(df, "c", "s", ["low", "mid", "top", "more"], "n").collect()}
    assert named == {2: "low", 7: "mid", 9: "top"}
    with pytest.raises(ValueError):
        A.name_by_rank(df, "c", "s", ["low", "mid"], "n")
    text = {r["c"]: r["members"] for r in A.member_text(df, "c", "e", [7, 2]).collect()}
    assert text == {7: "x, y", 2: "z"}


def test_frequency_drops_missing_and_orders_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in A.frequency(df, "v").collect()] == [("c", 2), ("a", 1), ("b", 1)]
