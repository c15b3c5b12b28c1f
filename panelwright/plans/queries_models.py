"""Model queries (M1-M21, S8, X14, O3). Learners are checked on planted rules, whose answers SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import scalars as X
from ..operators import clean, evaluation, features, models, trees
from ..operators import clusters as K
from ..operators.clean import round_numeric
from ..session import materialise, scratch_path
from ..sources.model_store import load_model, save_model
from . import inputs as I
from .registry import query

TEST_YEAR = 2000
KEY = ["o_orderkey"]
PLANTED = ["priority", "month", "noise"]
BOOST = models.BOOST_DEFAULT


def _planted(spark, sf):
    """Orders whose class and amount follow from their priority and month by a rule; a third feature is noise.

    Any learner that works reproduces the rule, so SQL can state what it predicts.
    """
    orders = I.table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.month("o_orderdate").cast("double").alias("month"), (F.col("o_orderkey") % 5).cast("double").alias("noise"))
    rule = F.when(F.col("priority") <= 2, "High").when(F.col("month") >= 7, "Moderate").otherwise("Low")
    return materialise(orders.withColumn("class", rule).withColumn("amount", F.when(F.col("month") >= 7, 3.0).otherwise(1.0)))


_RULED = """
WITH planted AS (
  SELECT o_orderkey, year(o_orderdate) AS y, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
         CAST(month(o_orderdate) AS DOUBLE) AS month, CAST(o_orderkey % 5 AS DOUBLE) AS noise FROM orders
),
ruled AS (SELECT *, CASE WHEN priority <= 2 THEN 'High' WHEN month >= 7 THEN 'Moderate' ELSE 'Low' END AS class FROM planted),
test AS (SELECT * FROM ruled WHERE y >= 2000)"""


def _classifier(spark, sf, kind="forest", **more):
    """A classifier with the reference's settings, and its test rows."""
    train, test = features.split_by_year(_planted(spark, sf), TEST_YEAR, KEY, "y", "class")
    return models.fit_classifier(train, PLANTED, "class", KEY, kind, **more), test


def _classified(model, test):
    shares = models.class_probabilities(model, test, ["o_orderkey", "class"])
    total = sum(F.col(c) for c in shares.columns if c.startswith("p_"))
    return shares.select("o_orderkey", "class", "predicted", F.round(total, 6).alias("total"))


@query("feature_choice", """
SELECT 'wanted' AS rule, feature, known FROM (
  SELECT 'p_size' AS feature, count(p_size) AS known FROM part UNION ALL SELECT 'p_retailprice', count(p_retailprice) FROM part)
UNION ALL
SELECT 'numeric', feature, known FROM (
  SELECT 'p_size' AS feature, count(p_size) AS known FROM part UNION ALL SELECT 'p_retailprice', count(p_retailprice) FROM part)
""")
def feature_choice(spark, sf):
    """M1: wanted columns that exist; where none does, all numeric ones but the key."""
    part = I.table(spark, sf, "part")
    found = None
    for rule, wanted in (("wanted", ["p_retailprice", "p_size", "p_weight"]), ("numeric", ["p_weight"])):
        names = C.feature_columns(part, wanted, ["p_partkey"])
        known = part.agg(*[F.count(c).alias(c) for c in names])
        cells = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("feature"), F.col(c).alias("known")) for c in names])
        rows = known.select(F.inline(cells))
        found = rows if found is None else found.unionByName(rows)
    return found


@query("impute_median", "WITH " + I.SPARSE + """,
m AS (SELECT median(p1) AS m1, median(p2) AS m2, median(p3) AS m3, median(p4) AS m4, median(p5) AS m5 FROM sparse)
SELECT e, y, round_even(coalesce(p1, m1), 4) AS p1, round_even(coalesce(p2, m2), 4) AS p2,
       round_even(coalesce(p3, m3), 4) AS p3, round_even(coalesce(p4, m4), 4) AS p4, round_even(coalesce(p5, m5), 4) AS p5
FROM sparse, m
""")
def impute_median(spark, sf):
    """M2."""
    wide = materialise(I.annual_sparse(spark, sf))
    return round_numeric(clean.fill_medians(wide, [f"p{i}" for i in range(1, 6)]))


@query("standardise", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st,
                  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, round_even((l_quantity - mq) / sq, 6) AS l_quantity,
       round_even((l_tax - mt) / st, 6) AS l_tax, round_even((l_extendedprice - mp) / sp, 6) AS l_extendedprice
FROM lineitem, s
""")
def standardise(spark, sf):
    """M5, T9."""
    line = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice")
    names = ["l_quantity", "l_tax", "l_extendedprice"]
    return models.standardised(line, names).withColumns({c: X.round_even(c, 6) for c in names})


_RULE = "CASE WHEN l_quantity > 30 THEN 'A' WHEN l_discount > 0.05 THEN 'N' ELSE 'R' END"


def _rule_rows(spark, sf):
    line = I.table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_discount")
    rule = F.when(F.col("l_quantity") > 30, "A").when(F.col("l_discount") > 0.05, "N").otherwise("R")
    return line.select("l_returnflag", rule.alias("predicted"))


_REPORT = f"""
WITH pairs AS (SELECT l_returnflag AS actual, {_RULE} AS predicted FROM lineitem),
k AS (SELECT c AS class, count(*) FILTER (WHERE actual = c AND predicted = c) AS hit,
             count(*) FILTER (WHERE predicted = c) AS called, count(*) FILTER (WHERE actual = c) AS support
      FROM pairs, (VALUES ('A'), ('N'), ('R'), ('X')) t(c) GROUP BY 1),
r AS (SELECT class, CASE WHEN called = 0 THEN 0.0::DOUBLE ELSE hit::DOUBLE / called END AS precision,
             CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hit::DOUBLE / support END AS recall,
             CASE WHEN called + support = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * hit / (called + support) END AS f1, support
      FROM k)"""


@query("eval_classifier", _REPORT + """
SELECT class, round_even(precision, 6) AS precision, round_even(recall, 6) AS recall, round_even(f1, 6) AS f1, support FROM r
""")
def eval_classifier(spark, sf):
    """M11, T25."""
    report = evaluation.class_report(_rule_rows(spark, sf), "l_returnflag", "predicted", ["A", "N", "R", "X"])
    return report.withColumns({c: X.round_even(c, 6) for c in ("precision", "recall", "f1")})


@query("eval_classifier_scores", _REPORT + """
SELECT round_even(sum(f1 * support) / sum(support), 4) AS f1_weighted,
       round_even(sum(recall * support) / sum(support), 4) AS accuracy FROM r
""")
def eval_classifier_scores(spark, sf):
    """M11."""
    return evaluation.class_scores(_rule_rows(spark, sf), "l_returnflag", "predicted", ["A", "N", "R", "X"])


@query("confusion_table", f"""
SELECT l_returnflag AS actual, {_RULE} AS predicted, count(*) AS rows FROM lineitem GROUP BY 1, 2
""")
def confusion_table(spark, sf):
    """M11."""
    return evaluation.confusion(_rule_rows(spark, sf), "l_returnflag", "predicted")


def _price_guess(spark, sf):
    line = I.table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    return line.select("l_extendedprice", (F.col("l_quantity") * 1500.0).alias("guess"))


@query("eval_regressor", """
SELECT round_even(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 4) AS "RMSE",
       round_even(avg(abs(l_extendedprice - l_quantity * 1500)), 4) AS "MAE",
       round_even(1 - avg((l_extendedprice - l_quantity * 1500) ** 2) / var_pop(l_extendedprice), 4) AS "R2"
FROM lineitem
""")
def eval_regressor(spark, sf):
    """M12."""
    return evaluation.regression_scores(_price_guess(spark, sf), "l_extendedprice", "guess")


@query("model_choice", """
WITH m AS (
  SELECT 'by_quantity' AS model, round_even(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 4) AS "RMSE" FROM lineitem
  UNION ALL
  SELECT 'constant', round_even(sqrt(avg((l_extendedprice - 38000) ** 2)), 4) FROM lineitem
)
SELECT model, "RMSE", "RMSE" = (SELECT min("RMSE") FROM m) AS best FROM m
""")
def model_choice(spark, sf):
    """M13, M20."""
    rows = _price_guess(spark, sf).withColumn("flat", F.lit(38000.0))
    found = {}
    for name, guess in (("by_quantity", "guess"), ("constant", "flat")):
        found[name] = {"RMSE": evaluation.regression_scores(rows, "l_extendedprice", guess).first()["RMSE"]}
    best = evaluation.best_model(found, "RMSE", largest=False)
    return evaluation.comparison(spark, found).withColumn("best", F.col("model") == best)


@query("actual_vs_pred", """
SELECT least(min(l_extendedprice), min(l_quantity * 1500.0::DOUBLE)) AS low,
       greatest(max(l_extendedprice), max(l_quantity * 1500.0::DOUBLE)) AS high FROM lineitem
""")
def actual_vs_pred(spark, sf):
    """M21."""
    return evaluation.value_range(_price_guess(spark, sf), "l_extendedprice", "guess")


_LINE_STATS = """
WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM lineitem),
z AS (SELECT (l_quantity - m) / sd AS x, l_extendedprice AS y FROM lineitem, s),
fit AS (SELECT sum((x - (SELECT avg(x) FROM z)) * (y - (SELECT avg(y) FROM z)))
               / (sum((x - (SELECT avg(x) FROM z)) ** 2) + 100.0) AS slope, avg(y) AS base, avg(x) AS mx FROM z)"""


@query("ridge", _LINE_STATS + """
SELECT round_even(slope, 3) AS slope, round_even(base - slope * mx, 3) AS intercept FROM fit
""")
def ridge(spark, sf):
    """M5, M8: one-feature ridge against its closed form (alpha 100)."""
    line = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    model = models.fit_regressor(line, ["l_quantity"], "l_extendedprice", ["l_orderkey", "l_linenumber"],
                                 "ridge", {"alpha": 100.0})
    fitted = model.stages[-1]
    one = spark.createDataFrame([(float(fitted.coefficients[0]), float(fitted.intercept))], "slope double, intercept double")
    return round_numeric(one, 3)


@query("ridge_search", """
WITH x AS (SELECT o_orderkey, o_totalprice / 1000 AS v FROM orders),
s AS (SELECT avg(v) AS m, stddev_pop(v) AS sd FROM x),
f AS (SELECT 3 * sum(((v - m) / sd) * (v - m)) / (sum(((v - m) / sd) ** 2) + 0.01) AS slope, avg(3 * v + 7) AS base FROM x, s)
SELECT o_orderkey, round_even(base + slope * (v - m) / sd, 3) AS prediction FROM x, s, f
""")
def ridge_search(spark, sf):
    """Five contiguous folds; a target without noise wants the least penalty, whose fit has a closed form."""
    rows = I.table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("v"))
    rows = rows.withColumn("target", F.col("v") * 3 + 7)
    model = models.fit_regressor(rows, ["v"], "target", KEY, "ridge", grid={"alpha": models.RIDGE_ALPHAS})
    return round_numeric(model.transform(rows).select("o_orderkey", "prediction"), 3)


@query("rf", _RULED + " SELECT o_orderkey, class, class AS predicted, 1.0::DOUBLE AS total FROM test")
def rf(spark, sf):
    """Class of the test years; the class probabilities sum to 1."""
    return _classified(*_classifier(spark, sf))


@query("gbt", _RULED + """
SELECT o_orderkey, CASE WHEN month >= 7 THEN 'late' ELSE 'early' END AS class,
       CASE WHEN month >= 7 THEN 'late' ELSE 'early' END AS predicted, 1.0::DOUBLE AS total FROM test
""")
def gbt(spark, sf):
    """One booster per class."""
    return _classified(*_single(spark, sf, "boosted", BOOST))


@query("gbt_regressor", _RULED + """
SELECT o_orderkey, CASE WHEN month >= 7 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction FROM test
""")
def gbt_regressor(spark, sf):
    """M9."""
    train, test = features.split_by_year(_planted(spark, sf), TEST_YEAR, KEY, "y")
    model = models.fit_regressor(train, PLANTED, "amount", KEY, "boosted", BOOST)
    return model.transform(test).select("o_orderkey", X.round_even("prediction", 2).alias("prediction"))


@query("cv", _RULED + " SELECT 1.0::DOUBLE AS f1_weighted, 1.0::DOUBLE AS accuracy FROM (SELECT count(*) AS n FROM test) WHERE n > 0")
def cv(spark, sf):
    """Forest chosen from the grid by stratified folds; scores on the test years."""
    model, test = _classifier(spark, sf, grid=models.FOREST_GRID)
    return evaluation.class_scores(model.transform(test), "class", "predicted", ["High", "Low", "Moderate"])


def _single(spark, sf, kind="forest", params=None):
    """A classifier of a class that depends on the month alone."""
    rows = _planted(spark, sf).withColumn("class", F.when(F.col("month") >= 7, "late").otherwise("early"))
    train, test = features.split_by_year(rows, TEST_YEAR, KEY, "y", "class")
    return models.fit_classifier(train, ["month", "noise"], "class", KEY, kind, params), test


@query("importance", "SELECT * FROM (VALUES ('month', 1.0::DOUBLE), ('noise', 0.0::DOUBLE)) t(feature, importance)")
def importance(spark, sf):
    """All importance is the month's."""
    return models.importance(_single(spark, sf)[0]).withColumn("importance", F.round("importance", 1))


@query("topk_importance", "SELECT 'month' AS feature")
def topk_importance(spark, sf):
    """O3."""
    return models.top_importance(_single(spark, sf)[0], 1).select("feature")


_PLACES = ", ".join(f"row_number() OVER (ORDER BY md5(concat_ws('|', {models.SEED + 1 + i}, o_orderkey)), o_orderkey) AS r{i}"
                    for i in range(3))


@query("permutation", _RULED + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS place, {_PLACES} FROM test),
lost AS (
  SELECT 'priority' AS feature, avg((CASE WHEN d.priority <= 2 THEN 'High' WHEN a.month >= 7 THEN 'Moderate' ELSE 'Low' END = a.class)::INT) AS acc
  FROM placed a JOIN placed d ON a.place = d.r0
  UNION ALL
  SELECT 'month', avg((CASE WHEN a.priority <= 2 THEN 'High' WHEN d.month >= 7 THEN 'Moderate' ELSE 'Low' END = a.class)::INT)
  FROM placed a JOIN placed d ON a.place = d.r1
  UNION ALL SELECT 'noise', 1.0
)
SELECT feature, round_even(1.0::DOUBLE - acc, 6) AS drop FROM lost
""")
def permutation(spark, sf):
    """All test rows; the noise costs nothing."""
    model, test = _classifier(spark, sf)
    return round_numeric(models.permutation_importance(model, test, "class", KEY), 6)


@query("attribution", _RULED + f"""
SELECT o_orderkey, feature, CASE WHEN feature = 'month' THEN CAST(CASE WHEN month >= 7 THEN 1 ELSE -1 END AS INTEGER) ELSE 0 END AS direction,
       0.0::DOUBLE AS gap
FROM (SELECT * FROM test ORDER BY md5(concat_ws('|', {models.SEED}, o_orderkey)), o_orderkey LIMIT {models.SAMPLE_ROWS}),
     (VALUES ('month'), ('noise')) f(feature)
""")
def attribution(spark, sf):
    """Attributions of a bounded sample; base and attributions sum to the probability, all of it is the month's."""
    model, test = _single(spark, sf)
    parts = trees.attributions(model, test, KEY).filter("output = 'late'")
    share = models.class_probabilities(model, test, KEY).select(*KEY, "p_late")
    total = parts.groupBy(*KEY).agg((F.sum("attribution") + F.max("base")).alias("total")).join(share, KEY)
    gap = total.select(*KEY, F.round(F.abs(F.col("total") - F.col("p_late")), 9).alias("gap"))
    return parts.join(gap, KEY).select(
        *KEY, "feature", F.signum(F.round("attribution", 9)).cast("int").alias("direction"), "gap")


@query("bounded_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat_ws('|', {models.SEED}, o_orderkey)), o_orderkey
LIMIT {models.SAMPLE_ROWS}
""")
def bounded_sample(spark, sf):
    """The sample's size is the feature."""
    line = I.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return features.bounded_sample(line, ["o_orderkey"], models.SAMPLE_ROWS)


@query("model_roundtrip", _RULED + " SELECT count(*) AS rows, 0 AS changed FROM test")
def model_roundtrip(spark, sf):
    """Predictions before and after saving are the same."""
    model, test = _classifier(spark, sf)
    folder = scratch_path(spark, "models")
    save_model(model, folder, "classifier", "Forest")
    before = model.transform(test).select(*KEY, "predicted")
    after = load_model(folder, "classifier", "Forest").transform(test).select(*KEY, F.col("predicted").alias("again"))
    both = before.join(after, KEY)
    return both.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col("predicted") != F.col("again")).cast("int").alias("changed"))


@query("scenario_score", f"""
WITH s AS (SELECT avg(l_discount) AS m, stddev_pop(l_discount) AS sd, count(*) AS n FROM lineitem),
f AS (SELECT sum(((l_discount - m) / sd) * (l_discount * 50)) / (sum(((l_discount - m) / sd) ** 2) + {models.RIDGE_DEFAULT}) AS slope,
             avg(l_discount * 50) AS base FROM lineitem, s),
cases AS (SELECT DISTINCT l_linenumber AS scenario, CASE WHEN l_linenumber <> 3 THEN l_linenumber / 50.0::DOUBLE ELSE 0 END AS x FROM lineitem),
scored AS (SELECT scenario, least(greatest(base + slope * (x - m) / sd, 0.0::DOUBLE), 5.0::DOUBLE) AS v FROM cases, s, f)
SELECT scenario, round_even(v, 3) AS forecast,
       CASE WHEN v < 1 THEN 'Low' WHEN v < 2 THEN 'Moderate' WHEN v < 3.5 THEN 'High' ELSE 'Extreme' END AS forecast_class
FROM scored
""")
def scenario_score(spark, sf):
    """Scenarios set the feature, one of them leaves it out and gets 0; the fit has a closed form."""
    line = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    line = line.withColumn("target", F.col("l_discount") * 50)
    model = models.fit_regressor(line, ["l_discount"], "target", ["l_orderkey", "l_linenumber"], "ridge")
    cases = line.select(F.col("l_linenumber").alias("scenario")).distinct().withColumn(
        "l_discount", F.when(F.col("scenario") != 3, F.col("scenario") / F.lit(50.0)))
    return models.forecast(model, cases, ["scenario"]).withColumn("forecast", X.round_even("forecast", 3))


def _zoned(spark, sf):
    """Customers' nations in four groups that lie far apart in two features."""
    customer = I.table(spark, sf, "customer").select(F.col("c_nationkey").alias("e"))
    group = (F.col("e") % 4).cast("double")
    return customer.select("e", (group * 10).alias("level"), (group * 5 + 1).alias("risk"))


_ZONED = """
WITH zoned AS (SELECT DISTINCT c_nationkey AS e, CAST(c_nationkey % 4 AS INTEGER) AS g FROM customer)"""


@query("kmeans", _ZONED + f"""
SELECT e, g * 5.0::DOUBLE + 1 AS risk, {K.ZONES}[g + 1] AS cluster_name FROM zoned
""")
def kmeans(spark, sf):
    """Zones of nations by their mean profile."""
    profiles = K.entity_profiles(_zoned(spark, sf), ["e"], ["level", "risk"])
    return K.risk_zones(profiles, ["e"], ["level", "risk"], "risk").select("e", "risk", "cluster_name")


@query("kmeans_elbow", _ZONED + """,
n AS (SELECT g, count(*)::DOUBLE AS n FROM zoned GROUP BY 1),
spread AS (SELECT var_pop(g) AS v FROM zoned),
runs AS (SELECT a.g AS lo, b.g AS hi, sum(n.n * n.g * n.g) - sum(n.n * n.g) ** 2 / sum(n.n) AS cost
         FROM n a JOIN n b ON a.g <= b.g JOIN n ON n.g BETWEEN a.g AND b.g GROUP BY 1, 2),
best AS (
  SELECT 2 AS k, min(a.cost + b.cost) AS cost FROM runs a JOIN runs b ON b.lo = a.hi + 1 WHERE a.lo = 0 AND b.hi = 3
  UNION ALL
  SELECT 3, min(a.cost + b.cost + c.cost) FROM runs a JOIN runs b ON b.lo = a.hi + 1 JOIN runs c ON c.lo = b.hi + 1
  WHERE a.lo = 0 AND c.hi = 3
  UNION ALL SELECT k, 0 FROM generate_series(4, 8) t(k)
)
SELECT CAST(k AS INTEGER) AS k, round_even(2 * cost / v, 4) AS inertia FROM best, spread
""")
def kmeans_elbow(spark, sf):
    """Cost per cluster count; groups lie on a line, so the best clusters are runs of groups."""
    profiles = K.entity_profiles(_zoned(spark, sf), ["e"], ["level", "risk"])
    return round_numeric(K.elbow(K.scaled_vectors(profiles, ["level", "risk"])), 4)
