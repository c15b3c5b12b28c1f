"""Column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season names, band limits and labels, fill limit, sentinel.
SEASON_OF_MONTH = {
    12: "DJF", 1: "DJF", 2: "DJF",
    3: "MAM", 4: "MAM", 5: "MAM",
    6: "JJA", 7: "JJA", 8: "JJA",
    9: "SON", 10: "SON", 11: "SON",
}
SEASONS = ["DJF", "MAM", "JJA", "SON"]
RISK_CUTS = [1.0, 2.0, 3.5]
RISK_CLASSES = ["Low", "Moderate", "High", "Extreme"]
MARKER_COLOURS = ["green", "orange", "red", "darkred"]
SENTINEL = 9999
FILL_LIMIT = 1e10
EPSILON = 1e-8

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def missing_if_nan(col: Column | str) -> Column:
    """NaN and NULL become one notion of missing."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def to_number(col: Column | str) -> Column:
    """P5: text to double; anything that is not a plain number is missing."""
    text = _c(col).cast("string")
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def finite(col: Column | str) -> Column:
    """P5 for doubles: what ``to_number`` makes of their text; NaN and infinite values are missing."""
    c = _c(col)
    return F.when(F.abs(c) < F.lit(math.inf), c)


def blank_from(col: Column | str, limit: float = SENTINEL) -> Column:
    """Values at or above the sentinel are missing."""
    c = _c(col)
    return F.when(c < limit, c)


def blank_equal(col: Column | str, value: float = SENTINEL) -> Column:
    """Exactly the sentinel is missing."""
    return F.nullif(_c(col), F.lit(value))


def clip(col: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; missing stays missing."""
    c = _c(col)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def round_even(col: Column | str, digits: int = 4) -> Column:
    """Scale, round half to even, scale back (T4), as numeric arrays are rounded.

    Unlike ``bround`` this does not go through decimals, so it is also cheap.
    """
    scale = F.lit(10.0 ** digits)
    return F.rint(_c(col) * scale) / scale


def matches(col: Column | str, pattern: str) -> Column:
    """Case-blind regular expression; missing text is false."""
    return F.coalesce(_c(col).rlike(f"(?i){pattern}"), F.lit(False))


def is_valid_measure(col: Column | str, limit: float = FILL_LIMIT) -> Column:
    """P20, main value: present and at most ``limit`` in size."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= limit)


def blank_fill(col: Column | str, limit: float = FILL_LIMIT) -> Column:
    """P20, side value: missing unless strictly below ``limit`` in size."""
    c = _c(col)
    return F.when(~F.isnan(c) & (F.abs(c) < limit), c)


def flag_in(col: Column | str, members: Sequence) -> Column:
    """1.0 where the value is one of ``members``, else 0.0."""
    return F.coalesce(_c(col).isin(*members), F.lit(False)).cast("double")


def first_keyword(
    col: Column | str, keywords: Sequence[tuple[str, str]], longest: bool = False
) -> Column:
    """Name of the first listed keyword found in the lower-cased text.

    With ``longest`` the longest keyword wins instead of the first (T16).
    """
    text = F.lower(_c(col))
    ranked = sorted(keywords, key=lambda kn: -len(kn[0])) if longest else keywords
    return F.coalesce(*[F.when(text.contains(word.lower()), F.lit(name)) for word, name in ranked])


def year_of_text(col: Column | str) -> Column:
    """Year of a ``YYYY-MM`` text."""
    return F.substring(_c(col), 1, 4).cast("int")


def month_of_text(col: Column | str) -> Column:
    """Month of a ``YYYY-MM`` text."""
    return F.substring(_c(col), 6, 2).cast("int")


def season(month: Column | str) -> Column:
    """Meteorological season of a month number."""
    m = _c(month)
    out = F.when(m.isin(*[k for k, s in SEASON_OF_MONTH.items() if s == SEASONS[0]]), SEASONS[0])
    for name in SEASONS[1:]:
        out = out.when(m.isin(*[k for k, s in SEASON_OF_MONTH.items() if s == name]), name)
    return out


def band(
    col: Column | str,
    cuts: Sequence[float] = RISK_CUTS,
    labels: Sequence[str] = RISK_CLASSES,
    null_label: str | None = None,
) -> Column:
    """Label of the first cut the value lies below, else the last label."""
    c = _c(col)
    out = F.when(c.isNull(), F.lit(null_label))
    for cut, label in zip(cuts, labels):
        out = out.when(c < cut, label)
    return out.otherwise(labels[-1])


def weighted_score(weights: dict[str, float], present: Sequence[str], digits: int = 4) -> Column:
    """Weighted sum over the components that exist, weights rescaled to 1."""
    used = {name: w for name, w in weights.items() if name in present}
    if not used:
        raise ValueError(f"none of the score components exist: {list(weights)}")
    total = sum(used.values())
    terms = [F.coalesce(F.col(n), F.lit(0.0)) * F.lit(w / total) for n, w in used.items()]
    score = terms[0]
    for term in terms[1:]:
        score = score + term
    return round_even(score, digits)


def inverted_scale(col: Column | str, low: Column, high: Column, top: float = 5.0) -> Column:
    """``low`` maps to ``top``, ``high`` to 0, clipped; never divides by zero."""
    share = (_c(col) - low) / (high - low + F.lit(EPSILON))
    return clip(F.lit(top) * (F.lit(1.0) - share), 0.0, top)


def month_sin(month: Column | str) -> Column:
    """X8."""
    return F.sin(F.lit(2 * math.pi) * _c(month) / F.lit(12))


def month_cos(month: Column | str) -> Column:
    """X8."""
    return F.cos(F.lit(2 * math.pi) * _c(month) / F.lit(12))


def parse_month(col: Column | str) -> Column:
    """Date of a ``YYYY-MM`` (its first day), ``YYYY-MM-DD`` or timestamp text, whose zone is dropped; bad text is missing."""
    day = F.regexp_extract(_c(col), r"^\s*(\d{4}-\d{2}(?:-\d{2})?)(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?\s*$", 1)
    return F.coalesce(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")), F.try_to_timestamp(day, F.lit("yyyy-MM"))).cast("date")


def month_text(col: Column | str) -> Column:
    """``YYYY-MM`` text of a date or timestamp."""
    return F.date_format(_c(col), "yyyy-MM")


def label_text(col: Column | str) -> Column:
    """Display label of a column name: blanks for underscores, and a capital
    wherever a letter follows a non-letter."""
    words = F.split(F.lower(F.replace(_c(col), F.lit("_"), F.lit(" "))), "(?<=[^a-z])(?=[a-z])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )


def marker_size(col: Column | str) -> Column:
    """Three times the score, at least 5; missing stays missing."""
    c = _c(col)
    return F.when(c.isNotNull(), F.greatest(F.lit(5.0), c * F.lit(3.0)))


def marker_colour(col: Column | str) -> Column:
    """Colour of the score's band."""
    return band(col, RISK_CUTS, MARKER_COLOURS, MARKER_COLOURS[-1])


def midpoint(a: Column | str, b: Column | str) -> Column:
    """X15."""
    return (_c(a) + _c(b)) / F.lit(2.0)


def order_in(col: Column | str, categories: Sequence[str]) -> Column:
    """Place of a category in a given order (1-based, 0 if unknown)."""
    return F.array_position(F.array(*[F.lit(x) for x in categories]), _c(col))
