"""From three raw sources to one scored entity-by-month panel.

static indicators (sub-entity rows) -> one row per entity
annual long facts                   -> one row per entity and year
gridded measurements                -> one row per entity and time step
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.columns import numeric_columns
from ..operators.aggregates import NOT_INDICATORS, mean_of_numeric
from ..operators.clean import clean_indicators, fill_two_pass
from ..operators.grid import extract_series
from ..operators.keywords import first_keyword_of_table
from ..operators.joins import left_join_suffixed, map_values
from ..operators.quantiles import table_quantiles
from ..operators.reshape import pivot_first
from ..operators.series import fill_linear, series_features
from ..session import materialise
from ..sources import lookups as L
from ..sources.tables import ORDINAL


def static_indicators(
    raw: DataFrame,
    renames: dict[str, str] = L.STATIC_RENAMES,
    indicator_cols: Sequence[str] | None = None,
    score_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Clean, impute and average the static indicators per country.

    Parsing text is the costly part, so the typed rows are stored once; the
    passes of the imputation read them back.
    """
    named = clean_indicators(raw, renames, "country", indicator_cols, score_cols)
    named = materialise(named.select("country", "country_code", *numeric_columns(named)))
    if indicator_cols is None:
        indicator_cols = [c for c in named.columns if "_score" in c or "_raw" in c]
    filled = fill_two_pass(named, "country", indicator_cols)
    means = mean_of_numeric(filled, ["country", "country_code"], NOT_INDICATORS)
    return means.withColumn("source", F.lit(L.STATIC_SOURCE))


def annual_indicators(
    raw: DataFrame,
    codes: DataFrame,
    keywords: Sequence[tuple[str, str]] = tuple(L.VARIABLE_KEYWORDS),
    by: str = "position",
) -> DataFrame:
    """Classify, pivot and gap-fill the annual facts per country.

    ``raw`` carries the input order in ``ORDINAL``; the first value of a cell
    wins. Only variables that occur become columns. A country has one row per
    year, so the gap fill's groups are small by construction. The typed rows are
    stored once, so that classifying and pivoting do not parse the text again.
    """
    typed = raw.withColumns({"value": X.to_number("value"), "year": X.to_number("year")})
    usable = materialise(typed.na.drop(subset=["value", "year"]).select("country", "year", "variable", "value", ORDINAL))
    if isinstance(keywords, DataFrame):  # a table of any size (S10)
        classified = first_keyword_of_table(usable, "variable", keywords, "clean_variable")
    else:
        classified = usable.withColumn("clean_variable", X.first_keyword("variable", keywords))
    known = (
        classified.filter(F.col("clean_variable").isNotNull())
        .select("country", F.col("year").cast("int").alias("year"), "clean_variable", "value", ORDINAL)
    )
    coded = map_values(known, "country", codes, "name", "code", "country_code")
    names = sorted(r[0] for r in coded.na.drop(subset=["country_code"]).select("clean_variable").distinct().collect())
    wide = pivot_first(coded, ["country", "country_code", "year"], "clean_variable", "value", names, ORDINAL)
    filled = fill_linear(wide, ["country"], "year", names, by=by, bounded=True)
    return filled.withColumn("source", F.lit(L.ANNUAL_SOURCE))


def monthly_anomalies(
    grid: DataFrame,
    points: DataFrame,
    value: str = "lwe_thickness",
    side: str = "uncertainty",
    lon_mode: str = "as_is",
) -> DataFrame:
    """Series of each point's nearest cell with trailing and whole-series features.

    An entity has one row per time step of the grid, so its window group is
    bounded by the length of the time axis.
    """
    series = extract_series(points, grid, value, side, lon_mode=lon_mode)
    named = series.withColumnsRenamed({value: "tws_anomaly_cm", side: "uncertainty_cm"})
    named = named.withColumn("date", X.month_text("time")).drop("cell_lat", "cell_lon")
    full = series_features(named, ["country_code"], "time", "tws_anomaly_cm", "tws", bounded=True)
    return (
        full.withColumnRenamed("tws_trend_per_year", "tws_trend_cm_yr")
        .withColumn("groundwater_anomaly_cm", X.round_even(F.col("tws_anomaly_cm") * F.lit(0.4)))
        .withColumn("source", F.lit(L.MONTHLY_SOURCE))
        .drop("time")
    )


def build_sources(*builders: Callable[[], DataFrame]) -> list[DataFrame]:
    """Build and store independent sources side by side, so that their jobs share the cluster."""
    with ThreadPoolExecutor(len(builders)) as pool:
        return list(pool.map(lambda build: materialise(build()), builders))


def consolidate(
    static: DataFrame, annual: DataFrame, monthly: DataFrame, require_unique: bool = False
) -> DataFrame:
    """Join the three sources, stored or files, and add score, class and season.

    ``require_unique`` refuses a static or annual table whose join key repeats
    (T11); by default such keys multiply rows, as a plain left join does.
    """
    static = static.drop("country", "source", "lat", "lon")
    joined = left_join_suffixed(monthly, static, ["country_code"], "_aq", require_unique)
    joined = joined.withColumn("year", X.year_of_text("date"))
    if "year" in annual.columns:
        annual = annual.drop("country", "source")
        joined = left_join_suffixed(joined, annual, ["country_code", "year"], "_aqua", require_unique)
    return add_score(materialise(joined))


def add_score(panel: DataFrame) -> DataFrame:
    """Composite score over the components that exist, its class, and the season."""
    scored = panel
    if "tws_anomaly_cm" in panel.columns:
        low, high = table_quantiles(panel, ["tws_anomaly_cm"], [0.01, 0.99])["tws_anomaly_cm"]
        scored = scored.withColumn("tws_score_norm", X.inverted_scale("tws_anomaly_cm", F.lit(low), F.lit(high)))
    return (
        scored.withColumn("drought_composite_score", X.weighted_score(L.SCORE_WEIGHTS, scored.columns))
        .withColumn("drought_risk_class", X.band("drought_composite_score"))
        .withColumn("season", X.season(X.month_of_text("date")))
        .drop("tws_score_norm")
    )
