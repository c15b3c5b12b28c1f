"""Points to grid cells and their time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_even
from ..session import materialise
from .clean import drop_fill_values
from .joins import lookup_join
from .series import TASK_ROWS, row_frames

INFINITY = float("inf")


def axis_values(axis: DataFrame, coordinate: str, index: str | None = None) -> DataFrame:
    """Distinct coordinates of one grid axis, stored.

    ``_rank`` breaks ties: the axis index if there is one, else the lower coordinate.
    """
    rank = F.min(F.col(index or coordinate).cast("double"))
    at = F.col(coordinate).cast("double").alias("_at")
    return materialise(axis.filter(F.col(coordinate).isNotNull()).groupBy(at).agg(rank.alias("_rank")))


def axis_gaps(values: DataFrame, bounded: bool) -> DataFrame:
    """Half-open gaps between neighbouring axis values; the ends reach to infinity."""
    here = F.struct(F.col("_at").alias("at"), F.col("_rank").alias("rank"))
    sides = row_frames(values, [], "_at", {
        "_first": lambda w: F.lag("_at", 1).over(w).isNull(),
        "_hi": lambda w: F.lead(here, 1).over(w),
    }, before=1, after=1, bounded=bounded)
    return sides.select(
        F.when(F.col("_first"), F.lit(-INFINITY)).otherwise(F.col("_at")).alias("_from"),
        F.coalesce(F.col("_hi.at"), F.lit(INFINITY)).alias("_to"),
        here.alias("_lo"), "_hi",
    )


def nearest_on_axis(
    points: DataFrame, at: str, axis: DataFrame, coordinate: str, into: str, index: str | None = None
) -> DataFrame:
    """For each point the axis value with the least absolute difference.

    An as-of merge: gaps of the axis and points form one range-sorted table, in
    which a point takes the last gap that begins at or before it. Slices are
    balanced by row count, equal coordinates included, whatever the spread of
    the axis; each slice starts with one row that brings the last gap before it.
    """
    values = axis_values(axis, coordinate, index)
    n = values.count()
    if not n:
        return points.withColumn(into, F.lit(None).cast("double"))
    gaps = axis_gaps(values, n <= TASK_ROWS).select(
        F.col("_from").alias("_x"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"),
        F.struct("_lo", "_hi").alias("_gap"))
    here = points.select(
        F.col(at).cast("double").alias("_x"), F.lit(1).alias("_kind"), F.monotonically_increasing_id().alias("_tie"),
        F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_point"))
    order = ["_x", "_kind", "_tie"]
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialise(
        gaps.unionByName(here, allowMissingColumns=True).repartitionByRange(parts, *order)
        .withColumn("_slice", F.spark_partition_id()))
    # one row a slice, so bounded by the partition count
    ends = sliced.groupBy("_slice").agg(F.max_by("_gap", F.when(F.col("_gap").isNotNull(), F.col("_x"))).alias("_gap"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    brought = ends.select("_slice", F.last("_gap", ignorenulls=True).over(earlier).alias("_gap"), F.lit(-1).alias("_kind"))
    inside = Window.partitionBy("_slice").orderBy((F.col("_kind") >= 0), *order).rowsBetween(Window.unboundedPreceding, 0)
    merged = sliced.unionByName(brought, allowMissingColumns=True).select(
        "_x", "_kind", "_point", F.last("_gap", ignorenulls=True).over(inside).alias("_gap"))
    x, lo, hi = F.col("_x"), F.col("_gap._lo"), F.col("_gap._hi")
    down, up = F.abs(lo["at"] - x), F.abs(hi["at"] - x)
    lower_wins = hi.isNull() | (down < up) | ((down == up) & (lo["rank"] <= hi["rank"]))
    chosen = F.when(x.isNull() | F.isnan(x), None).when(lower_wins, lo["at"]).otherwise(hi["at"])
    return merged.filter(F.col("_kind") == 1).select("_point.*", chosen.alias("_into")).withColumnRenamed("_into", into)


def nearest_cell(
    points: DataFrame, grid: DataFrame, lat: str = "lat", lon: str = "lon", lon_mode: str = "as_is"
) -> DataFrame:
    """J4 on both axes independently: adds ``cell_lat`` and ``cell_lon``.

    ``lon_mode="wrap"`` first moves point longitudes to 0..360 (T19).
    """
    shifted = points
    if lon_mode == "wrap":
        shifted = points.withColumn("_lon", F.pmod(F.col(lon), F.lit(360.0)))
    elif lon_mode == "as_is":
        shifted = points.withColumn("_lon", F.col(lon))
    else:
        raise ValueError(f"unknown lon_mode {lon_mode!r}")
    with_lat = nearest_on_axis(shifted, lat, grid.select(lat), lat, "cell_lat")
    return nearest_on_axis(with_lat, "_lon", grid.select(lon), lon, "cell_lon").drop("_lon")


def extract_series(
    points: DataFrame,
    grid: DataFrame,
    value: str,
    side: str | None = None,
    lat: str = "lat",
    lon: str = "lon",
    lon_mode: str = "as_is",
    digits: int = 4,
) -> DataFrame:
    """Every time step of each point's cell, unusable values dropped.

    Only the cells of the points are read on: the small cell map meets the grid
    on (lat, lon), and the validity filter runs before the join.
    """
    cells = materialise(nearest_cell(points, grid, lat, lon, lon_mode))
    measures = [value] + ([side] if side and side in grid.columns else [])
    usable = drop_fill_values(grid, value, side).withColumnsRenamed({lat: "cell_lat", lon: "cell_lon"})
    rounded = usable.withColumns({m: round_even(m, digits) for m in measures})
    return lookup_join(rounded, cells, ["cell_lat", "cell_lon"], "inner")
