"""Stored panels, pruning, and keyword tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelwright.functions import scalars as X
from panelwright.operators import incremental as N
from panelwright.operators import joins as J
from panelwright.operators import series as S
from panelwright.operators.keywords import first_keyword_of_table
from panelwright.sources import tables as T


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def panel(spark):
    rows = [(f"e{e}", y * 12 + m, float(e * 100 + y * 12 + m), 2000 + y) for e in range(7) for y in range(4) for m in range(12)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "e string, t int, v double, y int").repartition(6)


def test_series_on_a_stored_panel_need_no_exchange(spark, tmp_path):
    source = panel(spark)
    stored = T.store_panel(source, "stored_series", str(tmp_path / "p"), ["e"], "t", 4, ["y"])
    frames = {"mean3": S.trailing_mean("v", 3), "std6": S.trailing_std("v", 6), "step": S.step_change("v"),
              "lag": S.lag_of("v", 1), "lead": S.lead_of("v", 3)}
    assert S.largest_group(stored, ["e"]) == 48
    rolled = S.row_frames(stored, ["e"], "t", frames, before=12, after=3, bounded=True)
    full = S.series_features(stored, ["e"], "t", "v", "v", bounded=True)
    trend = S.with_trend(stored, ["e"], "t", "v", "slope", bounded=True)
    filled = S.fill_linear(stored.select("e", "t", F.when(F.col("t") % 5 > 1, F.col("v")).alias("v")), ["e"], "t", ["v"], bounded=True)
    for made in (rolled, full, trend, filled):
        assert "Exchange" not in plan_of(made)
    plain = S.row_frames(source, ["e"], "t", frames, before=12, after=3, bounded=True)
    assert sorted(map(str, rolled.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_attached_panel_keeps_its_layout(spark, tmp_path):
    path = str(tmp_path / "p")
    T.store_panel(panel(spark), "stored_once", path, ["e"], "t", 4, ["y"])
    again = T.attach_panel(spark, "attached", path, ["e"], "t", 4, ["y"])
    assert sorted(map(str, again.select("e", "t", "v", "y").collect())) == sorted(
        map(str, panel(spark).select("e", "t", "v", "y").collect()))
    assert "Exchange" not in plan_of(S.row_frames(again, ["e"], "t", {"m": S.trailing_mean("v", 3)}, before=3, bounded=True))
    plan = plan_of(again.filter("y = 2001"))
    assert "PartitionFilters: [isnotnull(y" in plan


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    stored = T.store_panel(panel(spark), "stored_facts", str(tmp_path / "p"), ["e"], "t", 4, ["y"])
    facts = spark.createDataFrame(
        [("e0", 2000, 1.0, "a"), ("e0", 2002, 2.0, None), ("e3", 2001, None, "c"), ("none", 2001, 5.0, "d"), ("e5", None, 9.0, "x")],
        "e string, y int, w double, s string")
    annual = T.store_panel(facts, "stored_annual", str(tmp_path / "a"), ["e"], "y", 4)
    both = J.bucket_join(stored, annual, ["e"], ["y"])
    assert "Exchange" not in plan_of(both)
    want = stored.join(facts, ["e", "y"], "left").select("e", "t", "v", "y", "w", "s")
    assert sorted(map(str, both.select("e", "t", "v", "y", "w", "s").collect())) == sorted(map(str, want.collect()))


def test_found_periods_prune_the_scan(spark, tmp_path):
    stored = T.store_panel(panel(spark), "stored_pruned", str(tmp_path / "p"), ["e"], "t", 4, ["y"])
    best = stored.groupBy("y").agg(F.max("v").alias("top")).orderBy(F.desc("top"), "y").limit(2)
    kept = J.prune_to(stored, best, "y")
    assert "dynamicpruning" in plan_of(kept).lower()
    assert {r["y"] for r in kept.select("y").distinct().collect()} == {2002, 2003} and kept.count() == 7 * 24
    assert J.prune_to(stored, best.filter("y < 0"), "y").isEmpty()
    threshold = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    for key in threshold:
        spark.conf.set(key, "-1")
    try:
        assert J.prune_to(stored, best, "y").count() == 7 * 24
    finally:
        for key in threshold:
            spark.conf.unset(key)


def test_keyword_table_equals_the_list(spark):
    rng = random.Random(6)
    letters = "abcdé "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += [t.upper() for t in texts[:40]] + texts[:40] + [None, "", "İstanbul", "a"]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(400)]
    words += [w.upper() for w in words[:30]] + words[:30]
    pairs = [(w, f"n{i}") for i, w in enumerate(words)]
    rng.shuffle(pairs)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(3)
    table = spark.createDataFrame([(w, n, p) for p, (w, n) in enumerate(pairs)] + [(None, "x", -1)],
                                  "keyword string, clean_name string, priority int")
    for few in (table, table.filter(F.length("keyword") > 4)):
        kept = [(r["keyword"], r["clean_name"]) for r in few.orderBy("priority").collect() if r["keyword"] is not None]
        for longest in (False, True):
            got = {r["i"]: r["name"] for r in first_keyword_of_table(docs, "text", few, "name", longest=longest).collect()}
            want = {r["i"]: r["name"] for r in docs.select("i", X.first_keyword("text", kept, longest).alias("name")).collect()}
            assert got == want
    empty = table.limit(1).withColumn("keyword", F.lit(""))
    assert {r["i"] for r in first_keyword_of_table(docs, "text", empty, "name").filter("name is not null").collect()} == {
        i for i, t in enumerate(texts) if t is not None}
    assert first_keyword_of_table(docs, "text", table.limit(0), "name").filter("name is not null").isEmpty()


def test_profile_reads_only_new_partitions(spark, tmp_path):
    rng = random.Random(1)
    rows = [(y, rng.gauss(1e6, 3) if rng.random() < 0.9 else None, f"w{rng.randint(0, 5000)}" if rng.random() < 0.8 else None,
             float("nan") if rng.random() < 0.1 else float(rng.randint(0, 9))) for y in (2000, 2001, 2002, None) for _ in range(3000)]
    rows += [(2003, None, None, None)] * 5
    df = spark.createDataFrame(rows, "y int, v double, w string, k double").cache()
    path, states = str(tmp_path / "t"), str(tmp_path / "s")
    df.filter("y < 2002 or y is null").write.partitionBy("y").parquet(path)
    _, fresh = N.refresh_profile(spark, path, states, "y")
    assert fresh == [None, 2000, 2001]
    df.filter("y >= 2002").write.mode("append").partitionBy("y").parquet(path)
    profile, fresh = N.refresh_profile(spark, path, states, "y")
    assert fresh == [2002, 2003]

    def check(profile, whole):
        got = {r["column"]: r for r in profile.collect()}
        for c in ("v", "w", "k"):
            known = [x for r in whole if (x := r[c]) is not None and x == x]
            assert got[c]["rows"] == len(whole) and got[c]["count"] == len(known) and got[c]["missing"] == len(whole) - len(known)
            assert abs(got[c]["about_distinct"] / len(set(known)) - 1) < 0.06
            if c == "w":
                assert (got[c]["first"], got[c]["last"]) == (min(known), max(known)) and got[c]["mean"] is None
                continue
            mean = math.fsum(known) / len(known)
            assert got[c]["mean"] == pytest.approx(mean, rel=1e-13) and (got[c]["min"], got[c]["max"]) == (min(known), max(known))
            assert got[c]["std"] == pytest.approx(math.sqrt(math.fsum((x - mean) ** 2 for x in known) / (len(known) - 1)), rel=1e-9)
            for q in (0.25, 0.5, 0.75):
                at = got[c][f"about_p{int(q * 100)}"]
                below, upto = sum(x < at for x in known) / len(known), sum(x <= at for x in known) / len(known)
                assert below - 0.03 <= q <= upto + 0.03

    check(profile, df.collect())
    again, fresh = N.refresh_profile(spark, path, states, "y")
    assert fresh == []
    check(again, df.collect())
    # a partition made anew
    other = df.filter("y = 2001").withColumn("v", F.col("v") + 5)
    other.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("y").parquet(path)
    spark.catalog.refreshByPath(path)
    profile, fresh = N.refresh_profile(spark, path, states, "y")
    assert fresh == [2001]
    check(profile, df.filter("y <> 2001 or y is null").union(other).collect())
    # the states serve a table that lacks some partitions
    fewer = str(tmp_path / "u")
    df.filter("y >= 2002").write.partitionBy("y").parquet(fewer)
    profile, fresh = N.refresh_profile(spark, fewer, states, "y")
    assert fresh == [2002, 2003]
    check(profile, df.filter("y >= 2002").collect())
