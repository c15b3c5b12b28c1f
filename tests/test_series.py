"""Series features: fixed values, and equality of the whole and the blocked layout."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import positions as P
from panelwright.operators import series as S

VALUES = [2.0, 4.0, 1.0, 7.0, 3.0, 8.0, 6.0]


def series(spark, values, e="a"):
    return spark.createDataFrame([(e, i, v) for i, v in enumerate(values)], "e string, t int, v double")


def listed(df, name, digits=4):
    return [None if r[0] is None else round(r[0], digits) for r in df.orderBy("t").select(name).collect()]


def test_fixed_values(spark):
    df = series(spark, VALUES)
    frames = {"m": S.trailing_mean("v", 3), "s": S.trailing_std("v", 3), "d": S.step_change("v")}
    out = S.row_frames(df, ["e"], "t", frames, before=3, bounded=True)
    assert listed(out, "m") == [2, 3, 2.3333, 4, 3.6667, 6, 5.6667]
    assert listed(out, "s") == [None, 1.4142, 1.5275, 3, 3.0551, 2.6458, 2.5166]
    assert listed(out, "d") == [None, 2, -3, 6, -4, 5, -2]
    full = S.series_features(df, ["e"], "t", "v", "v", bounded=True)
    assert listed(full, "v_cumulative_change") == [0, 2, -1, 5, 1, 6, 4]
    assert listed(full, "v_zscore") == [-0.9211, -0.1625, -1.3003, 0.9752, -0.5418, 1.3545, 0.596]
    assert listed(full, "v_trend_per_year") == [9.4286] * 7


def test_mean_with_a_gap_and_identity(spark):
    df = series(spark, [1.0, 3.0, None, 7.0, 8.0, 2.0, 9.0])
    out = S.row_frames(df, ["e"], "t", {"m": S.trailing_mean("v", 3), "one": S.trailing_mean("v", 1)}, 3, bounded=True)
    assert listed(out, "m") == [1, 2, 2, 5, 7.5, 5.6667, 6.3333]
    assert listed(out, "one") == [1, 3, None, 7, 8, 2, 9]
    slope = S.with_trend(df, ["e"], "t", "v", "s", bounded=True)
    assert listed(slope, "s") == [round(12 * 0.9316770186335405, 4)] * 7


def test_trend_of_short_series_is_zero(spark):
    assert listed(S.with_trend(series(spark, VALUES[:5]), ["e"], "t", "v", "s", bounded=True), "s") == [0.0] * 5
    thin = series(spark, [1.0, None, None, None, None, 2.0])
    assert listed(S.with_trend(thin, ["e"], "t", "v", "s", bounded=True), "s") == [0.0] * 6


def test_z_score_of_one_row_is_missing(spark):
    assert listed(S.series_features(series(spark, [3.0]), ["e"], "t", "v", "v", bounded=True), "v_zscore") == [None]


def test_fitted_line_needs_more_than_ten_rows(spark):
    assert listed(S.with_fitted_line(series(spark, VALUES), ["e"], "t", "v", "f", bounded=True), "f") == [None] * 7
    values = [float(i % 4) if i != 5 else None for i in range(12)]
    fit = np.poly1d(np.polyfit(range(12), [v or 0.0 for v in values], 1))(range(12))
    got = listed(S.with_fitted_line(series(spark, values), ["e"], "t", "v", "f", bounded=True), "f")
    assert got == pytest.approx(list(fit), abs=1e-4)


def test_gap_fill(spark):
    df = series(spark, [None, 1.0, None, None, 7.0, None])
    assert listed(S.fill_linear(df, ["e"], "t", ["v"], bounded=True), "v") == [1, 1, 3, 5, 7, 7]
    empty = series(spark, [None, None])
    assert listed(S.fill_linear(empty, ["e"], "t", ["v"], bounded=True), "v") == [None, None]
    years = spark.createDataFrame([("a", 2000, 0.0), ("a", 2001, None), ("a", 2010, 10.0)], "e string, t int, v double")
    assert listed(S.fill_linear(years, ["e"], "t", ["v"], bounded=True), "v") == [0, 5, 10]
    assert listed(S.fill_linear(years, ["e"], "t", ["v"], by="time", bounded=True), "v") == [0, 1, 10]


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity holds most rows; gaps of all lengths; entities smaller than a frame."""
    rng = random.Random(3)
    rows = [("hot", t, rng.random() if rng.random() < 0.6 else None) for t in range(400)]
    rows += [("hot", t, None) for t in range(400, 470)]
    rows += [(f"e{i}", t, rng.random()) for i in range(30) for t in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "e string, t int, v double").repartition(7).cache()


def same(a, b, digits=9):
    key = lambda r: (r["e"], r["t"])
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        for n in a.columns:
            if isinstance(x[n], float) and y[n] is not None:
                assert x[n] == pytest.approx(y[n], abs=10.0 ** -digits), (n, x, y)
            else:
                assert x[n] == y[n], (n, x, y)


FRAMES = {"m": S.trailing_mean("v", 6), "s": S.trailing_std("v", 12), "l": S.lag_of("v", 12), "n": S.lead_of("v", 3),
          "d": S.step_change("v")}


@pytest.mark.parametrize("block", [13, 50, 64])
def test_blocked_frames_equal_whole_frames(skewed, block):
    whole = S.row_frames(skewed, ["e"], "t", FRAMES, 12, 3, bounded=True)
    same(whole, S.row_frames(skewed, ["e"], "t", FRAMES, 12, 3, block_rows=block))


def test_blocked_features_equal_whole_features(skewed):
    same(S.series_features(skewed, ["e"], "t", "v", "v", bounded=True),
         S.series_features(skewed, ["e"], "t", "v", "v", block_rows=40), 4)
    same(S.with_trend(skewed, ["e"], "t", "v", "x", bounded=True),
         S.with_trend(skewed, ["e"], "t", "v", "x", block_rows=40), 4)
    same(S.with_fitted_line(skewed, ["e"], "t", "v", "x", bounded=True),
         S.with_fitted_line(skewed, ["e"], "t", "v", "x", block_rows=40), 6)


@pytest.mark.parametrize("by", ["position", "time"])
def test_blocked_fill_equals_whole_fill(skewed, by):
    same(S.fill_linear(skewed, ["e"], "t", ["v"], by, bounded=True),
         S.fill_linear(skewed, ["e"], "t", ["v"], by, block_rows=17))


def test_lag_features_without_entity(spark):
    df = series(spark, [float(i) for i in range(20)]).drop("e")
    out = S.lag_features(df, [], "t", "v", block_rows=13).orderBy("t").collect()
    assert [r["v_future"] for r in out] == [float(i + 3) for i in range(17)]
    assert [r["v_lag12"] for r in out] == [None] * 12 + [0.0, 1.0, 2.0, 3.0, 4.0]
    assert "v_rolling_mean_3" not in out[0]


def test_block_must_hold_a_frame(skewed):
    with pytest.raises(ValueError):
        S.row_frames(skewed, ["e"], "t", FRAMES, 12, 3, block_rows=12)


def test_positions_are_exact(skewed):
    got = P.with_positions(skewed, ["e", "t"]).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(len(got)))
    assert [(r["e"], r["t"]) for r in got] == sorted((r["e"], r["t"]) for r in got)


def test_contiguous_folds(spark):
    df = series(spark, [1.0] * 11)
    got = P.contiguous_folds(df, ["t"], 5).orderBy("t").collect()
    assert [r["fold"] for r in got] == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_stratified_folds_are_even_and_stable(skewed):
    marked = skewed.withColumn("label", F.when(F.col("e") == "hot", "h").otherwise("x"))
    one = P.stratified_folds(marked, "label", ["e", "t"], 3)
    sizes = one.groupBy("label").pivot("fold", [0, 1, 2]).count().collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in sizes)
    two = P.stratified_folds(marked.repartition(2), "label", ["e", "t"], 3)
    assert sorted(map(tuple, one.select("e", "t", "fold").collect())) == sorted(
        map(tuple, two.select("e", "t", "fold").collect()))


def test_results_do_not_depend_on_partitions(skewed):
    make = lambda df: S.series_features(df, ["e"], "t", "v", "v", bounded=True)
    same(make(skewed.repartition(1)), make(skewed.repartition(16)))
