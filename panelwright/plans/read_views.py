"""The read path over a consolidated panel: filters, previews, and the tables behind each view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import columns_with, existing, numeric_columns, topic_columns
from ..functions.scalars import RISK_CLASSES, label_text, marker_colour, marker_size, matches, parse_month
from ..operators.aggregates import cross_tab, group_means, in_top_groups, marker_table, share_of_total
from ..operators.clean import blank_sentinel_everywhere
from ..operators.profile import correlation_matrix
from ..operators.reshape import pivot_mean
from ..operators.series import with_fitted_line

# Size of the preview, usual series columns, topics of the correlation view.
PREVIEW_ROWS = 500
SERIES_COLUMNS = ["tws_anomaly_cm", "drought_composite_score", "groundwater_anomaly_cm", "water_stress_score"]
CORRELATION_TOPICS = ["stress", "drought", "tws", "water", "ground", "precip"]


def filtered(
    panel: DataFrame,
    members: dict[str, Sequence],
    time: str | None = None,
    first=None,
    last=None,
) -> DataFrame:
    """Keep listed members per column (an empty list keeps all) and an inclusive time range.

    The range applies only when both ends are given; absent columns are skipped.
    """
    out = panel
    for column, wanted in members.items():
        if wanted and column in out.columns:
            out = out.filter(F.col(column).isin(*wanted))
    if time in out.columns and first is not None and last is not None:
        kind = dict(out.dtypes)[time]
        out = out.filter(F.col(time).between(F.lit(first).cast(kind), F.lit(last).cast(kind)))
    return out


def preview(panel: DataFrame, columns: Sequence[str], order: Sequence[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows in a total order, chosen columns only."""
    return panel.orderBy(*order).limit(rows).select(*existing(panel, columns))


def with_dates(panel: DataFrame, date: str = "date") -> DataFrame:
    """A reloaded panel with its text month parsed; bad text is missing."""
    return panel.withColumn(date, parse_month(date)) if dict(panel.dtypes).get(date) == "string" else panel


def map_view(panel: DataFrame, value: str, keys: Sequence[str] = ("country_code", "country")) -> DataFrame:
    """Mean of one indicator per entity with its display label."""
    return group_means(panel, list(keys), [value]).withColumn("label", label_text(F.lit(value)))


def marker_view(
    panel: DataFrame, value: str, keys: Sequence[str] = ("country_code", "country"), lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """One marker per entity with a place: size and colour from its mean."""
    return marker_table(panel, list(keys), value, lat, lon).withColumns(
        {"radius": marker_size(value), "colour": marker_colour(value)})


def series_view(
    panel: DataFrame,
    entity: str,
    wanted,
    columns: Sequence[str] | None = None,
    time: str = "date",
    name: str = "country",
    candidates: Sequence[str] = SERIES_COLUMNS,
) -> DataFrame:
    """One entity's indicators in time order, with its name and trend lines.

    A missing indicator list takes the usual candidates that exist. The series of
    one entity has a row per month, so it is small.
    """
    chosen = existing(panel, columns or candidates)
    keep = [entity, time, *existing(panel, [name]), *chosen]
    one = panel.filter(F.col(entity) == F.lit(wanted)).select(*dict.fromkeys(keep))
    for column in chosen:
        one = with_fitted_line(one, [entity], time, column, f"{column}_trend", bounded=True)
    return one.orderBy(time)


def season_view(
    panel: DataFrame, value: str, entity: str = "country", code: str = "country_code", codes: Sequence = (),
    season: str = "season",
) -> DataFrame:
    """Mean per entity and season, for the listed entities or all."""
    return group_means(filtered(panel, {code: codes}), [entity, season], [value])


def class_view(panel: DataFrame, category: str) -> DataFrame:
    """Class counts and their shares."""
    return share_of_total(panel, category)


def class_table(panel: DataFrame, entity: str, category: str, score: str, k: int = 15) -> DataFrame:
    """Class counts of the ``k`` entities with the highest mean score."""
    return cross_tab(in_top_groups(panel, entity, score, k), entity, category, RISK_CLASSES)


def correlation_view(panel: DataFrame, topics: Sequence[str] = CORRELATION_TOPICS) -> DataFrame:
    """Correlations among the columns about the topics."""
    return correlation_matrix(panel, topic_columns(panel, topics))


def first_static_look(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact sentinels blanked, then indicator means per entity, nothing clipped or filled."""
    named = [c for c in columns_with(raw, "_score", "_raw", "_cat", "_label") if c not in keys]
    picked = blank_sentinel_everywhere(raw.select(*keys, *named))
    return group_means(picked, keys, [c for c in numeric_columns(picked) if c not in keys])


def first_annual_look(
    raw: DataFrame, pattern: str, names: Sequence[str], index: Sequence[str] = ("country", "year"),
    variable: str = "variable", value: str = "value",
) -> DataFrame:
    """Facts whose variable matches a pattern, pivoted with means."""
    return pivot_mean(raw.filter(matches(variable, pattern)), index, variable, value, names)
