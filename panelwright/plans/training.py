"""Training runs over the consolidated panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import existing, feature_columns
from ..functions.scalars import RISK_CLASSES, month_cos, month_sin, parse_month
from ..operators import evaluation as E
from ..operators import models as M
from ..operators.features import split_by_year
from ..operators.series import HORIZON, lag_features
from ..session import materialise
from ..sources.model_store import save_model
from ..sources.tables import append_run, run_record

# Targets, features and first test year.
CLASS_TARGET = "drought_risk_class"
SCORE_TARGET = "drought_composite_score"
FIRST_TEST_YEAR = 2018
CLASSIFIER_FEATURES = [
    "water_stress_score", "water_depletion_score", "drought_risk_score",
    "interannual_variability", "seasonal_variability", "groundwater_decline_score",
    "flood_risk_score", "overall_water_risk",
    "tws_anomaly_cm", "groundwater_anomaly_cm", "uncertainty_cm",
    "tws_3month_avg", "tws_6month_avg", "tws_12month_avg",
    "tws_rate_of_change", "tws_cumulative_change", "tws_zscore",
    "tws_trend_cm_yr",
    "sdg642_water_stress_pct", "total_renewable_water_km3",
    "total_water_withdrawal_km3", "precipitation_mm",
    "drought_composite_score",
]
REGRESSOR_FEATURES = [
    "water_stress_score", "water_depletion_score", "drought_risk_score",
    "tws_anomaly_cm", "groundwater_anomaly_cm",
    "tws_3month_avg", "tws_6month_avg", "tws_12month_avg",
    "tws_rate_of_change",
    "sdg642_water_stress_pct", "total_renewable_water_km3",
    "precipitation_mm",
]
FOREST, BOOSTED, RIDGE, BOOSTED_REG = "RandomForest", "GBT", "Ridge", "GBT_Reg"  # names in the score tables


@dataclass
class Trained:
    """Fitted models, their scores on the test rows, and the best one's name."""

    models: dict[str, PipelineModel]
    scores: dict[str, dict[str, float]]
    best: str
    features: list[str]
    train: DataFrame
    test: DataFrame


def lagged_panel(
    panel: DataFrame, target: str = SCORE_TARGET, entity: str = "country_code", date: str = "date",
    horizon: int = HORIZON,
) -> DataFrame:
    """Lags, trailing statistics, future target and cyclic month.

    The panel has one row per entity and month, so a series is short.
    """
    made = lag_features(panel, [entity], date, target, horizon=horizon, bounded=True)
    month = F.month(parse_month(date) if dict(panel.dtypes)[date] == "string" else F.col(date))
    return made.withColumn("month", month).withColumns({
        "month_sin": month_sin("month"), "month_cos": month_cos("month")})


def regressor_features(df: DataFrame, base=tuple(REGRESSOR_FEATURES)) -> list[str]:
    """M1: base columns, lag and trailing columns, cyclic month; sorted."""
    made = [c for c in df.columns if "_lag" in c or "_rolling_" in c]
    return sorted({*existing(df, base), *made, *existing(df, ["month_sin", "month_cos"])})


def train_classifiers(
    panel: DataFrame,
    wanted=tuple(CLASSIFIER_FEATURES),
    label: str = CLASS_TARGET,
    key=("country_code", "date"),
    year: str = "year",
    first_test_year: int = FIRST_TEST_YEAR,
    tune: bool = True,
    reference_mode: bool = False,
    kinds: dict[str, str] | None = None,
    params: dict[str, dict] | None = None,
) -> Trained:
    """Forest and boosted classifiers with their test scores.

    ``reference_mode`` takes imputation medians from all rows and keeps the score
    the class is cut from as a feature; by default both are left out (T24).
    """
    if label not in panel.columns:
        raise ValueError(f"target column {label!r} not found")
    features = feature_columns(panel, wanted, [label, year])
    if not reference_mode:
        features = [f for f in features if f != SCORE_TARGET]
    panel = materialise(panel)
    train, test = split_by_year(panel, first_test_year, list(key), year, label)
    fitted, scores = {}, {}
    for name, kind in (kinds or {FOREST: "forest", BOOSTED: "boosted"}).items():
        grid = (M.FOREST_GRID if kind == "forest" else M.BOOST_GRID) if tune else None
        fitted[name] = M.fit_classifier(
            train, features, label, list(key), kind, (params or {}).get(name), grid,
            fit_medians_on=panel if reference_mode else None)
        scores[name] = E.class_scores(fitted[name].transform(test), label, "predicted", RISK_CLASSES).first().asDict()
    return Trained(fitted, scores, E.best_model(scores, "f1_weighted", True), features, train, test)


def train_regressors(
    lagged: DataFrame,
    target: str = f"{SCORE_TARGET}_future",
    order=("country_code", "date"),
    base=tuple(REGRESSOR_FEATURES),
    year: str = "year",
    first_test_year: int = FIRST_TEST_YEAR,
    tune: bool = True,
    kinds: dict[str, str] | None = None,
    params: dict[str, dict] | None = None,
) -> Trained:
    """Ridge and boosted regressors of the future score with their test scores."""
    features = regressor_features(lagged, base)
    lagged = materialise(lagged)
    if lagged.isEmpty():
        raise ValueError("no rows are left after making lag features")
    train, test = split_by_year(lagged, first_test_year, list(order), year)
    fitted, scores = {}, {}
    for name, kind in (kinds or {RIDGE: "ridge", BOOSTED_REG: "boosted"}).items():
        grid = ({"alpha": M.RIDGE_ALPHAS} if kind == "ridge" else M.BOOST_GRID) if tune else None
        fitted[name] = M.fit_regressor(train, features, target, list(order), kind, (params or {}).get(name), grid)
        scores[name] = E.regression_scores(fitted[name].transform(test), target, "prediction").first().asDict()
    return Trained(fitted, scores, E.best_model(scores, "RMSE", False), features, train, test)


def train_all(
    panel: DataFrame, model_folder: str, log_folder: str, tune: bool = True, params: dict[str, dict] | None = None
) -> tuple[Trained, Trained]:
    """Both training tasks; all models are saved and the run is logged."""
    panel = materialise(panel)
    classes = train_classifiers(panel, tune=tune, params=params)
    values = train_regressors(lagged_panel(panel), tune=tune, params=params)
    for name, model in classes.models.items():
        save_model(model, model_folder, "drought_classifier", name)
    for name, model in values.models.items():
        save_model(model, model_folder, "stress_predictor", name)
    append_run(run_record(panel, classes.scores, values.scores), log_folder)
    return classes, values
