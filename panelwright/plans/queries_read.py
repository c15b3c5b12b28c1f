"""The tables behind the interactive views and first looks, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators.clean import round_numeric
from ..session import materialise
from . import inputs as I
from . import read_views as V
from .registry import query

MONTH = "strftime(t, '%Y-%m') AS month"


@query("map_view", "WITH " + I.SCORED + """
SELECT e, round_even(avg(stress_score), 9) AS stress_score, 'Stress Score' AS label FROM scored GROUP BY 1
""")
def map_view(spark, sf):
    """A2, X12."""
    return round_numeric(V.map_view(I.scored_panel(spark, sf), "stress_score", ["e"]), 9)


@query("marker_view", "WITH " + I.SCORED + """,
means AS (SELECT e, avg(score) AS score, avg(e * 1.5::DOUBLE) AS lat, avg(e * -2.0::DOUBLE) AS lon FROM scored GROUP BY 1)
SELECT e, round_even(score, 9) AS score, round_even(lat, 6) AS lat, round_even(lon, 6) AS lon,
       round_even(greatest(5.0::DOUBLE, score * 3), 9) AS radius,
       CASE WHEN score < 1 THEN 'green' WHEN score < 2 THEN 'orange' WHEN score < 3.5 THEN 'red' ELSE 'darkred' END AS colour
FROM means
""")
def marker_view(spark, sf):
    """A2, X13."""
    placed = I.scored_panel(spark, sf).withColumns({"lat": F.col("e") * 1.5, "lon": F.col("e") * -2.0})
    view = V.marker_view(placed, "score", ["e"])
    return view.withColumns({"score": X.round_even("score", 9), "radius": X.round_even("radius", 9),
                             "lat": X.round_even("lat", 6), "lon": X.round_even("lon", 6)})


@query("series_view", "WITH " + I.SCORED + f""",
one AS (SELECT e, t, v, score, row_number() OVER (ORDER BY t) AS x FROM scored WHERE e = 7)
SELECT e, {MONTH}, v, score, round_even(regr_intercept(v, x) OVER () + x * regr_slope(v, x) OVER (), 4) AS v_trend,
       round_even(regr_intercept(score, x) OVER () + x * regr_slope(score, x) OVER (), 6) AS score_trend
FROM one
""")
def series_view(spark, sf):
    """P17, P21, O1, W11, W12."""
    view = V.series_view(I.scored_panel(spark, sf), "e", 7, ["v", "score", "absent"], "t")
    return view.select("e", X.month_text("t").alias("month"), "v", "score", X.round_even("v_trend").alias("v_trend"),
                       X.round_even("score_trend", 6).alias("score_trend"))


@query("season_view", "WITH " + I.SCORED + """
SELECT e, season, round_even(avg(score), 9) AS score FROM scored WHERE e IN (2, 4, 6) GROUP BY 1, 2
""")
def season_view(spark, sf):
    """P15, A2."""
    return round_numeric(V.season_view(I.scored_panel(spark, sf), "score", "e", "e", [2, 4, 6]), 9)


@query("class_view", "WITH " + I.SCORED + """
SELECT class, count(*) AS count, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 6) AS percent
FROM scored GROUP BY 1
""")
def class_view(spark, sf):
    """A7, A10."""
    return round_numeric(V.class_view(I.scored_panel(spark, sf), "class"), 6)


@query("class_table", "WITH " + I.SCORED + """,
top AS (SELECT e FROM (SELECT e, avg(score) AS mean FROM scored GROUP BY 1) ORDER BY mean DESC, e LIMIT 15)
SELECT e, count(*) FILTER (WHERE class = 'Low') AS "Low", count(*) FILTER (WHERE class = 'Moderate') AS "Moderate",
       count(*) FILTER (WHERE class = 'High') AS "High", count(*) FILTER (WHERE class = 'Extreme') AS "Extreme"
FROM scored WHERE e IN (SELECT e FROM top) GROUP BY 1
""")
def class_table(spark, sf):
    """A8, J6."""
    return V.class_table(materialise(I.scored_panel(spark, sf)), "e", "class", "score")


_TOPICS = ["l_extendedprice", "l_discount", "l_tax"]


@query("correlation_view", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round_even(corr({a}, {b}), 3) AS r FROM lineitem" for a in _TOPICS for b in _TOPICS))
def correlation_view(spark, sf):
    """P8, A14."""
    return V.correlation_view(I.table(spark, sf, "lineitem"), ["price", "disc", "tax"])


@query("first_static_look", "WITH " + I.DIRTY + """
SELECT e, round_even(avg(CASE WHEN ind_raw <> 9999 THEN ind_raw END), 4) AS ind_raw,
       round_even(avg(CASE WHEN plain <> 9999 THEN plain END), 6) AS plain_score FROM dirty GROUP BY 1
""")
def first_static_look(spark, sf):
    """P6b, P8, A1."""
    dirty = I.dirty_indicators(spark, sf).select("e", "ind_raw", F.col("plain").alias("plain_score"), "price")
    means = V.first_static_look(dirty, ["e"])
    return means.withColumns({"ind_raw": X.round_even("ind_raw"), "plain_score": X.round_even("plain_score", 6)})


@query("first_annual_look", "WITH " + I.ANNUAL + """
SELECT e, y, avg(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE variable = '1-URGENT') AS urgent,
       avg(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE variable = '5-LOW') AS low
FROM annual_long WHERE regexp_matches(variable, 'urgent|low', 'i') GROUP BY 1, 2
""")
def first_annual_look(spark, sf):
    """P18, A16."""
    cents = I.annual_long(spark, sf).withColumn("value", F.round(F.col("value") * 100).cast("long"))
    look = V.first_annual_look(cents, "urgent|low", ["1-URGENT", "5-LOW"], ["e", "y"])
    return look.toDF("e", "y", "urgent", "low")


@query("date_parts", "WITH " + I.PANEL + """
SELECT e, strftime(t, '%Y-%m-%d') AS day, CAST(year(t) AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m FROM panel
""")
def date_parts(spark, sf):
    """Text months parsed on reload."""
    text = I.monthly_panel(spark, sf).select("e", X.month_text("t").alias("date"))
    dated = V.with_dates(text)
    return dated.select("e", F.col("date").cast("string").alias("day"), F.year("date").alias("y"), F.month("date").alias("m"))
