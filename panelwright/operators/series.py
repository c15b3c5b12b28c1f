"""Row-based time-series features per entity.

Two layouts give the same results:

* ``bounded=True`` - the caller's input has few rows per entity by construction
  (one per calendar month, say). All features of a call share one exchange.
* otherwise the largest entity is measured. If it fits a task the plan is the
  same; if not, rows get exact positions, positions are cut into blocks, and the
  rows at a block's edges are copied into the neighbouring block, so that every
  trailing, lagging or leading frame is complete inside one bounded block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.scalars import EPSILON, round_even
from ..session import materialise
from .joins import lookup_join
from .positions import with_positions

TASK_ROWS = 1_000_000
Frame = Callable[[WindowSpec], Column]

# Trailing windows, lags and forecast horizon in rows.
ROLLING_WINDOWS = [3, 6, 12]
LAG_PERIODS = [1, 3, 6, 12]
HORIZON = 3
TREND_MIN_ROWS = 6
TREND_MIN_VALUES = 3
STEPS_PER_YEAR = 12
LINE_MIN_ROWS = 10


def trailing_mean(value: str, k: int) -> Frame:
    """Mean of the last ``k`` rows, fewer at the start."""
    return lambda w: F.avg(value).over(w.rowsBetween(-(k - 1), 0))


def trailing_std(value: str, k: int) -> Frame:
    """Sample deviation of the last ``k`` rows; missing for a single value."""
    return lambda w: F.stddev_samp(value).over(w.rowsBetween(-(k - 1), 0))


def step_change(value: str) -> Frame:
    """Difference to the previous row."""
    return lambda w: F.col(value) - F.lag(value, 1).over(w)


def lag_of(value: str, k: int) -> Frame:
    """W9."""
    return lambda w: F.lag(value, k).over(w)


def lead_of(value: str, k: int) -> Frame:
    """W10."""
    return lambda w: F.lead(value, k).over(w)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group, by a map-side combined count."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()
    return row["n"] or 0


def _layout(
    df: DataFrame, entity: list[str], time: str, bounded: bool, block_rows: int
) -> tuple[DataFrame, bool]:
    """Rows with their place ``_pos``, and whether whole entities fit a task."""
    if bounded or largest_group(df, entity) <= block_rows:
        w = Window.partitionBy(*entity).orderBy(time)
        return df.withColumn("_pos", F.row_number().over(w).cast("long")), True
    return with_positions(df, [*entity, time], "_pos"), False


def _framed(
    placed: DataFrame, entity: list[str], time: str, features: dict[str, Frame], before: int, after: int,
    whole: bool, block_rows: int,
) -> DataFrame:
    """Placed rows with the features, per whole entity or per block with copied edges."""
    if whole:
        w = Window.partitionBy(*entity).orderBy(time)
        return placed.select("*", *[make(w).alias(name) for name, make in features.items()])
    if block_rows <= max(before, after):
        raise ValueError("block_rows must exceed the frame size")
    w = Window.partitionBy(*entity, "_block").orderBy("_pos")
    blocks = _with_edge_copies(placed, before, after, block_rows)
    framed = blocks.select("*", *[make(w).alias(name) for name, make in features.items()])
    return framed.filter("_own").drop("_own", "_block")


def row_frames(
    df: DataFrame,
    entity: Sequence[str],
    time: str,
    features: dict[str, Frame],
    before: int = 0,
    after: int = 0,
    bounded: bool = False,
    block_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add features that look at most ``before`` rows back and ``after`` ahead.

    ``(entity, time)`` must identify a row.
    """
    placed, whole = _layout(df, list(entity), time, bounded, block_rows)
    return _framed(placed, list(entity), time, features, before, after, whole, block_rows).select(*df.columns, *features)


def _with_edge_copies(df: DataFrame, before: int, after: int, block_rows: int) -> DataFrame:
    block = F.floor(F.col("_pos") / F.lit(block_rows))
    place = F.pmod(F.col("_pos"), F.lit(block_rows))

    def home(shift: int) -> Column:
        return F.struct((block + shift).alias("_block"), F.lit(shift == 0).alias("_own"))

    homes = F.array(
        home(0),
        F.when(place >= block_rows - before, home(1)),
        F.when(place < after, home(-1)),
    )
    return df.select("*", F.inline(F.array_compact(homes)))


def entity_stats(
    df: DataFrame,
    entity: Sequence[str],
    stats: dict[str, Column],
    bounded: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add statistics of the whole entity to its rows.

    Bounded input uses a window next to the other features. Otherwise the
    statistics of ``source`` (default: the same rows) are aggregated with
    map-side combine and joined back, which keeps a hot entity out of any single
    task.
    """
    entity = list(entity)
    if bounded:
        we = Window.partitionBy(*entity)
        return df.select("*", *[agg.over(we).alias(name) for name, agg in stats.items()])
    table = materialise((df if source is None else source).groupBy(*entity).agg(*[a.alias(n) for n, a in stats.items()]))
    return lookup_join(df, table, entity, "left")


def z_score(value: str) -> Column:
    """W5 from the columns ``_mean`` and ``_std``; missing for a one-row entity."""
    return (F.col(value) - F.col("_mean")) / (F.col("_std") + F.lit(EPSILON))


def trend_slope(value: str, position: str) -> dict[str, Column]:
    """Statistics behind W6 and W11."""
    return {
        "_n": F.count(F.lit(1)),
        "_present": F.count(value),
        "_slope": F.regr_slope(F.col(value), F.col(position).cast("double")),
    }


def trend_per_year(steps: int = STEPS_PER_YEAR, digits: int = 4) -> Column:
    """W6 from ``trend_slope``: 0.0 for short or nearly empty entities."""
    short = (F.col("_n") < TREND_MIN_ROWS) | (F.col("_present") < TREND_MIN_VALUES)
    return F.when(short, F.lit(0.0)).otherwise(round_even(F.col("_slope") * F.lit(steps), digits))


def with_trend(
    df: DataFrame, entity: Sequence[str], time: str, value: str, name: str,
    bounded: bool = False, block_rows: int = TASK_ROWS,
) -> DataFrame:
    """Least-squares slope against row position, times 12, on every row."""
    rows, whole = _layout(df, list(entity), time, bounded, block_rows)
    stats = entity_stats(rows, entity, trend_slope(value, "_pos"), whole)
    return stats.select(*df.columns, trend_per_year().alias(name))


def with_fitted_line(
    df: DataFrame, entity: Sequence[str], time: str, value: str, name: str,
    bounded: bool = False, block_rows: int = TASK_ROWS,
) -> DataFrame:
    """Fitted straight line, missing values as 0, for entities of more than 10 rows.

    The fitted values do not depend on where positions start.
    """
    rows, whole = _layout(df, list(entity), time, bounded, block_rows)
    x, y = F.col("_pos").cast("double"), F.coalesce(F.col(value), F.lit(0.0))
    stats = entity_stats(rows, entity, {
        "_n": F.count(F.lit(1)),
        "_slope": F.regr_slope(y, x),
        "_base": F.regr_intercept(y, x),
    }, whole)
    line = F.when(F.col("_n") > LINE_MIN_ROWS, F.col("_base") + F.col("_slope") * F.col("_pos"))
    return stats.select(*df.columns, line.alias(name))


def series_features(
    df: DataFrame, entity: Sequence[str], time: str, value: str, prefix: str,
    windows: Sequence[int] = ROLLING_WINDOWS, bounded: bool = False, block_rows: int = TASK_ROWS,
) -> DataFrame:
    """W1, W3-W6 for one value column, rounded to 4 digits, on one shared layout."""
    frames = {f"{prefix}_{k}month_avg": trailing_mean(value, k) for k in windows}
    frames[f"{prefix}_rate_of_change"] = step_change(value)
    placed, whole = _layout(df, list(entity), time, bounded, block_rows)
    rows = entity_stats(_framed(placed, list(entity), time, frames, max(windows), 0, whole, block_rows), entity, {
        "_first": F.min_by(value, time),
        "_mean": F.avg(value),
        "_std": F.stddev_samp(value),
        **trend_slope(value, "_pos"),
    }, whole, placed)
    return rows.select(
        *df.columns,
        *[round_even(name).alias(name) for name in frames],
        round_even(F.col(value) - F.col("_first")).alias(f"{prefix}_cumulative_change"),
        round_even(z_score(value)).alias(f"{prefix}_zscore"),
        trend_per_year().alias(f"{prefix}_trend_per_year"),
    )


def lag_features(
    df: DataFrame, entity: Sequence[str], time: str, target: str,
    lags: Sequence[int] = LAG_PERIODS, windows: Sequence[int] = ROLLING_WINDOWS,
    horizon: int = HORIZON, bounded: bool = False, block_rows: int = TASK_ROWS,
) -> DataFrame:
    """Lags, trailing statistics and the target ``horizon`` rows ahead.

    With an empty ``entity`` the whole table is one series and, as documented for
    that case, only lags and the future target are made. Rows without a future
    target are dropped (P3).
    """
    frames = {f"{target}_lag{k}": lag_of(target, k) for k in lags}
    if entity:
        for k in windows:
            frames[f"{target}_rolling_mean_{k}"] = trailing_mean(target, k)
            frames[f"{target}_rolling_std_{k}"] = trailing_std(target, k)
    frames[f"{target}_future"] = lead_of(target, horizon)
    out = row_frames(df, entity, time, frames, before=max([*lags, *windows]), after=horizon,
                     bounded=bounded, block_rows=block_rows)
    return out.na.drop(subset=[f"{target}_future"])


def fill_linear(
    df: DataFrame,
    entity: Sequence[str],
    time: str,
    columns: Sequence[str],
    by: str = "position",
    bounded: bool = False,
    block_rows: int = TASK_ROWS,
) -> DataFrame:
    """Linear gap fill per entity; ends take the nearest value, empty stays empty.

    ``by="position"`` spaces rows evenly (T17), ``by="time"`` uses the time: days of a
    date, microseconds of a timestamp, or the number itself.
    """
    entity, columns = list(entity), list(columns)
    if bounded or largest_group(df, entity) <= block_rows:
        placed = df.withColumn("_at", F.row_number().over(Window.partitionBy(*entity).orderBy(time)).cast("double"))
        part, order = list(entity), time
        carried = None
    else:
        placed = with_positions(df, [*entity, time], "_pos")
        placed = placed.withColumn("_at", F.col("_pos").cast("double"))
        placed = placed.withColumn("_block", F.floor(F.col("_pos") / F.lit(block_rows)))
        part, order = [*entity, "_block"], "_pos"
        carried = True
    if by == "time":
        kind = dict(df.dtypes)[time]
        at = {"date": F.unix_date, "timestamp": F.unix_micros}.get(kind, lambda number: number)(F.col(time))
        placed = placed.withColumn("_at", at.cast("double"))

    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_at").alias("x"),
                                                     F.col(c).cast("double").alias("y"))) for c in columns}
    # looking ahead is a running frame in descending order: a frame that ends at
    # the last row would be walked again for every row
    back = Window.partitionBy(*part).orderBy(F.asc(order)).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*part).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    sides = placed.select(
        "*",
        *[F.last(known[c], ignorenulls=True).over(back).alias(f"_p{i}") for i, c in enumerate(columns)],
        *[F.last(known[c], ignorenulls=True).over(ahead).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    if carried:
        sides = _carry_over_blocks(sides, placed, entity, columns, known)
    filled = []
    for c in df.columns:
        if c not in columns:
            filled.append(F.col(c))
            continue
        i = columns.index(c)
        p, n = F.col(f"_p{i}"), F.col(f"_n{i}")
        between = p["y"] + (n["y"] - p["y"]) * (F.col("_at") - p["x"]) / F.nullif(n["x"] - p["x"], F.lit(0.0))
        filled.append(F.coalesce(F.col(c).cast("double"), between, p["y"], n["y"]).alias(c))
    return sides.select(*filled)


def _carry_over_blocks(
    sides: DataFrame, placed: DataFrame, entity: list[str], columns: list[str], known: dict[str, Column]
) -> DataFrame:
    """Bring the nearest known value of earlier and later blocks to each block.

    The helper table has one row per entity and block; it is joined on keys that
    hold at most one block of rows each.
    """
    ends = placed.groupBy(*entity, "_block").agg(
        *[F.max_by(known[c], F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_e{i}")
          for i, c in enumerate(columns)],
        *[F.min_by(known[c], F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_s{i}")
          for i, c in enumerate(columns)],
    )
    blocks = Window.partitionBy(*entity)
    earlier = blocks.orderBy(F.asc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carry = materialise(ends.select(
        *entity, "_block",
        *[F.last(f"_e{i}", ignorenulls=True).over(earlier).alias(f"_cp{i}") for i in range(len(columns))],
        *[F.last(f"_s{i}", ignorenulls=True).over(later).alias(f"_cn{i}") for i in range(len(columns))],
    ))
    both = lookup_join(sides, carry, [*entity, "_block"], "left")
    return both.withColumns({
        **{f"_p{i}": F.coalesce(f"_p{i}", f"_cp{i}") for i in range(len(columns))},
        **{f"_n{i}": F.coalesce(f"_n{i}", f"_cn{i}") for i in range(len(columns))},
    })
