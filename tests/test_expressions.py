"""Hand-checked values of the column expressions and cleaning operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.functions import columns as C
from panelwright.functions import scalars as X
from panelwright.operators import clean
from panelwright.operators.reshape import pivot_first, pivot_mean
from panelwright.sources import lookups as L


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clip_keeps_missing(spark):
    assert column(spark, [None, -9999.0, 7.0], X.clip("v", 0.0, 5.0)) == [None, 0.0, 5.0]


def test_to_number(spark):
    texts = ["1.5", " 2 ", "-3e2", ".5", "5.", "1.5d", "nan", "abc", "", None, "1,5"]
    want = [1.5, 2.0, -300.0, 0.5, 5.0, None, None, None, None, None, None]
    assert column(spark, texts, X.to_number("v"), "string") == want


def test_sentinels(spark):
    values = [9998.9, 9999.0, 10000.0, None, -9999.0]
    assert column(spark, values, X.blank_from("v")) == [9998.9, None, None, None, -9999.0]
    assert column(spark, values, X.blank_equal("v")) == [9998.9, None, 10000.0, None, -9999.0]


def test_rounding_is_half_even(spark):
    assert column(spark, [2.5, 3.5], X.round_even("v", 0)) == [2.0, 4.0]
    rng = np.random.default_rng(4)
    values = [float(x) for x in rng.integers(-(10 ** 9), 10 ** 9, 20_000) / 800]
    assert column(spark, values, X.round_even("v")) == list(np.round(values, 4))


def test_validity_limits(spark):
    nan = float("nan")
    values = [1e10, -1e10, 1.1e10, nan, None]
    assert column(spark, values, X.is_valid_measure("v")) == [True, True, False, False, False]
    assert column(spark, values, X.blank_fill("v")) == [None, None, None, None, None]
    assert column(spark, [9.9e9], X.blank_fill("v")) == [9.9e9]


def test_bands(spark):
    values = [0.99, 1.0, 2.0, 3.49, 3.5, None]
    names = ["Low", "Moderate", "High", "High", "Extreme"]
    assert column(spark, values, X.band("v")) == [*names, None]
    assert column(spark, values, X.band("v", null_label="Extreme")) == [*names, "Extreme"]


def test_weighted_score(spark):
    df = spark.createDataFrame([(4.0, 3.0, 2.5, 0.0), (4.0, None, 2.5, 0.0)], "a double, b double, c double, d double")
    weights = {"a": 0.25, "b": 0.25, "c": 0.3, "d": 0.2}
    assert [r[0] for r in df.select(X.weighted_score(weights, df.columns)).collect()] == [2.5, 1.75]
    part = df.select(X.weighted_score(weights, ["a", "c"]))  # weights rescaled to 1
    assert part.first()[0] == pytest.approx((4 * 0.25 + 2.5 * 0.3) / 0.55, abs=5e-5)
    with pytest.raises(ValueError):
        X.weighted_score(weights, ["z"])


def test_inverted_scale_of_a_constant(spark):
    assert column(spark, [3.0], X.inverted_scale("v", F.lit(3.0), F.lit(3.0))) == [5.0]


def test_first_keyword_order_and_shadowing(spark):
    texts = ["Total renewable water resources per capita", "PRECIPITATION in depth", "other", None]
    first = column(spark, texts, X.first_keyword("v", L.VARIABLE_KEYWORDS), "string")
    assert first == ["total_renewable_water_km3", "precipitation_mm", None, None]
    longest = column(spark, texts, X.first_keyword("v", L.VARIABLE_KEYWORDS, longest=True), "string")
    assert longest[0] == "renewable_water_per_capita"


def test_months_and_seasons(spark):
    texts = ["2002-12", "2003-02", "2003-03", "2003-08", "2003-11"]
    assert column(spark, texts, X.season(X.month_of_text("v")), "string") == ["DJF", "DJF", "MAM", "JJA", "SON"]
    assert column(spark, ["2003-03", "bad", None], X.year_of_text(X.month_text(X.parse_month("v"))), "string") == [2003, None, None]


def test_labels_and_markers(spark):
    assert column(spark, ["tws_3month_avg", "water_stress_score"], X.label_text("v"), "string") == [
        "Tws 3Month Avg", "Water Stress Score"]
    assert column(spark, [1.0, 2.0, None], X.marker_size("v")) == [5.0, 6.0, None]
    assert column(spark, [0.5, 1.5, 2.0, 4.0], X.marker_colour("v")) == ["green", "orange", "red", "darkred"]


def test_regex_is_case_blind_and_null_is_false(spark):
    assert column(spark, ["SDG 6.4.2 stress", "rain", None], X.matches("v", "sdg 6.4.2|Precip"), "string") == [
        True, False, False]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 1.0, "x", 2.0, 3.0)], "year int, water_score double, name string, tws double, z double")
    assert C.numeric_columns(df, ["year"]) == ["water_score", "tws", "z"]
    assert C.topic_columns(df, ["water", "tws"]) == ["year", "water_score", "tws", "z"]  # fewer than 3 hits
    assert C.topic_columns(df, ["water", "tws"], at_least=2) == ["water_score", "tws"]
    assert C.topic_columns(df, ["tws"], fallback=2) == ["year", "water_score"]
    assert C.feature_columns(df, ["tws", "none"], ["year"]) == ["tws"]
    assert C.feature_columns(df, ["none"], ["year"]) == ["water_score", "tws", "z"]
    assert C.existing(df, ["z", "q", "name"]) == ["z", "name"]


def test_clean_indicators_pattern_is_applied_after_renaming(spark):
    df = spark.createDataFrame(
        [("A", "9999", "7", "9999"), ("B", "x", "-2", "3"), (None, "1", "1", "1")],
        "name_0 string, bws_raw string, bws_score string, iav_score string")
    got = clean.clean_indicators(df, L.STATIC_RENAMES, "country").orderBy("country").collect()
    assert [tuple(r) for r in got] == [("A", None, 5.0, "9999"), ("B", None, 0.0, "3")]


def test_two_pass_fill_uses_the_filled_column(spark):
    rows = [("a", 1.0), ("a", None), ("a", None), ("b", 10.0), ("c", None)]
    want = [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 10.0), ("c", 1.0)]
    for more, filled in (([], []), ([(None, None)], [(None, 1.0)]), ([(None, 2.0)], [(None, 2.0)])):
        df = spark.createDataFrame(rows + more, "e string, v double")
        got = clean.fill_two_pass(df, "e", ["v"]).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want + filled))
    nothing = spark.createDataFrame([("a", None), (None, None)], "e string, v double")
    assert [r["v"] for r in clean.fill_two_pass(nothing, "e", ["v"]).collect()] == [None, None]


def test_pivots(spark):
    df = spark.createDataFrame(
        [("a", 1, "p", 6.0, 2), ("a", 1, "p", 5.0, 1), ("a", 1, "p", None, 0), ("a", 2, "p", 7.0, 3), ("b", 1, "q", 8.0, 4),
         (None, 1, "q", 9.0, 5), ("d", 1, "other", 9.0, 6)],
        "e string, y int, variable string, value double, ord int")
    first = pivot_first(df, ["e", "y"], "variable", "value", ["p", "q"], "ord").orderBy("e", "y")
    assert [tuple(r) for r in first.collect()] == [("a", 1, 5.0, None), ("a", 2, 7.0, None), ("b", 1, None, 8.0)]
    mean = pivot_mean(df, ["e", "y"], "variable", "value", ["p", "q"]).orderBy("e", "y")
    assert [tuple(r) for r in mean.collect()] == [("a", 1, 5.5, None), ("a", 2, 7.0, None), ("b", 1, None, 8.0)]
