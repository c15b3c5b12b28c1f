"""Cases that earlier versions got wrong."""

import datetime as dt

from pyspark.sql import functions as F

from panelwright.functions import scalars as X
from panelwright.operators.clean import clean_indicators
from panelwright.operators.positions import stratified_split
from panelwright.operators.profile import box_summary
from panelwright.operators.quantiles import _search, medians
from panelwright.operators.series import fill_linear
from panelwright.plans.consolidate import annual_indicators
from panelwright.sources.tables import read_text_table


def test_shares_that_are_not_one_over_a_whole_number(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4).alias("label"))
    for share in (0.15, 0.2, 0.3, 0.7):
        split = stratified_split(df, "label", ["id"], share)
        for r in split.groupBy("label").agg(F.count_if("is_test").alias("n")).collect():
            assert abs(r["n"] - 250 * share) < 1


def test_gap_fill_by_date_and_timestamp(spark):
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 5)]
    df = spark.createDataFrame([("a", d, v) for d, v in zip(days, (0.0, None, 8.0))], "e string, t date, v double")
    for kind in ("date", "timestamp"):
        for bounded in (True, False):
            typed = df.withColumn("t", F.col("t").cast(kind))
            got = fill_linear(typed, ["e"], "t", ["v"], by="time", bounded=bounded, block_rows=2).orderBy("t").collect()
            assert [r["v"] for r in got] == [0.0, 2.0, 8.0]


def test_dates_of_all_forms(spark):
    texts = ["2010-05", "2010-05-17", "2010-05-17T03:04:05Z", "2010-05-17 03:04:05.5+02:00", "2010-13", "May", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(X.parse_month("t").alias("d")).collect()
    day = dt.date(2010, 5, 17)
    assert [r["d"] for r in got] == [dt.date(2010, 5, 1), day, day, day, None, None, None]


def test_a_hot_group_is_spread(spark):
    """Nine rows of ten in one group, broadcasts off: the grouped passes start inside each way of the join."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("g"), (F.col("id") * 37 % 1009).cast("double").alias("v"))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        got = {r["g"]: r["v"] for r in medians(df, ["v"], ["g"]).collect()}
        box = box_summary(df, "g", "v")
        plan = box._jdf.queryExecution().executedPlan().toString()
        assert "_way" in plan and plan.index("partial_max") > plan.index("Exchange hashpartitioning(g")
        hot = {r["g"]: r for r in box.collect()}
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    rows = df.toPandas().groupby("g")["v"]
    assert got == rows.median().to_dict()
    assert hot[99]["q1"] == rows.quantile(0.25)[99] and hot[99]["n"] == rows.size()[99]


def test_stored_tables_lie_in_the_run_folder(spark):
    from panelwright.session import materialise, run_folder

    stored = materialise(spark.range(3))
    assert all(run_folder(spark).removeprefix("file:") in f for f in stored.inputFiles())


def test_csv_cells_with_line_breaks(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n"one\ntwo",3\nfour,5\n')
    got = read_text_table(spark, "x", str(tmp_path / "x.csv"), multi_line=True).collect()
    assert [tuple(r) for r in got] == [("one\ntwo", "3"), ("four", "5")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_doubles_are_not_parsed_again(spark):
    cells = [0.5, -3.0, 7.25, 9998.5, 9999.0, 1e300, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([("A", x, None if x is None else str(x)) for x in cells], "k string, a_score double, b_score string")
    got = clean_indicators(rows, {}, "k")
    assert [r["a_score"] for r in got.collect()] == [0.5, 0.0, 5.0, 5.0, None, None, None, None, None, None]
    assert [r["b_score"] for r in got.collect()] == [r["a_score"] for r in got.collect()]
    assert "RLIKE" not in _plan(got.select("a_score"))


def test_annual_text_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("variable,country,year,value\nLow x,N1,2001,4\nlow,N1,2001,5\nhigh,N1,2002,x\nhigh,N2,2002,7\n")
    raw = read_text_table(spark, "annual", str(tmp_path / "a.csv"), ordinal=True)
    codes = spark.createDataFrame([("N1", "C1"), ("N2", "C2")], "name string, code string")
    got = annual_indicators(raw, codes, [("high", "h"), ("low", "l")])
    assert "FileScan csv" not in _plan(got)
    assert sorted((r["country_code"], r["year"], r["h"], r["l"]) for r in got.collect()) == [("C1", 2001, None, 4.0), ("C2", 2002, 7.0, None)]


def test_quantile_passes_do_not_sort_the_rows(spark):
    data = spark.range(3000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v")
    found = _search(data, ["v"], [0.5], ["g"], 100, 0.04)
    assert "SortAggregate" not in _plan(found)
    assert sorted((r["g"], r["n"], r["q"][0]) for r in found.collect()) == [(0, 1000, 1498.5), (1, 1000, 1499.5), (2, 1000, 1500.5)]
