"""Point clouds: class reports, gridding, ground classification."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.attributes import with_point_class
from terrane.operators import raster
from terrane.schema import Grid
from terrane.session import stored

# ── fixed values: gridding and ground-filter parameters ─────────────────────
GROUND_CLASS = 2
OTHER_CLASS = 1
DTM_RADIUS_M = 2.0
DSM_RADIUS_M = 1.5
SMRF = {"scalar": 1.2, "slope": 0.2, "threshold": 0.45, "window": 18.0}
# ── end of fixed values ─────────────────────────────────────────────────────


def in_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Closed range of a point attribute."""
    return df.filter(F.col(column).between(lo, hi))


def extent(points: DataFrame) -> DataFrame:
    return points.agg(F.count(F.lit(1)).alias("point_count"),
                      *[f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))])


def class_histogram(points: DataFrame) -> DataFrame:
    """Points per class with their share; the share is taken on the few class rows."""
    counts = points.groupBy("classification").agg(F.count(F.lit(1)).alias("points"))
    whole = counts.agg(F.sum("points").alias("_all"))
    return (with_point_class(counts).join(F.broadcast(whole))
            .select("classification", "label", "points", (F.col("points") / F.col("_all") * 100).alias("pct"))
            .orderBy("classification"))


def inspect(points: DataFrame) -> DataFrame:
    """Extent and class breakdown as one report."""
    return class_histogram(points).join(F.broadcast(extent(points))).orderBy("classification")


def lowest_surface(points: DataFrame, grid: Grid) -> DataFrame:
    """Smallest z of each occupied cell."""
    return (raster.on_grid(points, F.col("x"), F.col("y"), grid).groupBy("row", "col")
            .agg(F.min("z").alias("value")))


def _reached_cells(points: DataFrame, grid: Grid, radius: float) -> DataFrame:
    """Every point with each cell whose centre is at most ``radius`` away."""
    def span(lo: Column, hi: Column, size):
        first, last = F.ceil(lo), F.floor(hi)
        first = F.greatest(first, F.lit(0))
        last = last if size is None else F.least(last, F.lit(size - 1))
        return F.when(last >= first, F.sequence(first, last))
    u, v = (F.col("x") - grid.x0) / grid.cell - 0.5, (F.lit(grid.y0) - F.col("y")) / grid.cell - 0.5
    reach = radius / grid.cell
    near = (points.withColumn("col", F.explode(span(u - reach, u + reach, grid.ncols)))
            .withColumn("row", F.explode(span(v - reach, v + reach, grid.nrows))))
    dx = F.col("x") - (F.lit(grid.x0) + (F.col("col") + 0.5) * grid.cell)
    dy = F.col("y") - (F.lit(grid.y0) - (F.col("row") + 0.5) * grid.cell)
    return (near.withColumn("d", F.sqrt(dx * dx + dy * dy)).filter(F.col("d") <= radius)
            .withColumn("row", F.col("row").cast("int")).withColumn("col", F.col("col").cast("int")))


def grid_max(points: DataFrame, grid: Grid, radius: float = DSM_RADIUS_M) -> DataFrame:
    """Highest z within the radius of each cell centre (surface model)."""
    return (_reached_cells(points.select("x", "y", "z"), grid, radius)
            .groupBy("row", "col").agg(F.max("z").alias("value")))


def grid_idw(points: DataFrame, grid: Grid, radius: float = DTM_RADIUS_M) -> DataFrame:
    """Inverse-distance mean of z within the radius (terrain model).

    A point on the cell centre decides alone (the lowest of several).
    """
    near = _reached_cells(points.select("x", "y", "z"), grid, radius)
    apart = F.col("d") > 0
    return (near.groupBy("row", "col").agg(
        F.min(F.when(~apart, F.col("z"))).alias("_hit"),
        F.sum(F.when(apart, F.col("z") / F.col("d"))).alias("_num"),
        F.sum(F.when(apart, F.lit(1.0) / F.col("d"))).alias("_den"))
        .select("row", "col", F.coalesce("_hit", F.col("_num") / F.col("_den")).alias("value")))


def surface_model(points: DataFrame, grid: Grid) -> DataFrame:
    return grid_max(in_range(points, "return_number", 1, 1), grid)


def terrain_model(points: DataFrame, grid: Grid) -> DataFrame:
    return grid_idw(in_range(points, "classification", GROUND_CLASS, GROUND_CLASS), grid)


RIM_CELLS = 96      # rims of the openings that one exchange of tiles covers, added up


def _batches(steps: int, rim: int = RIM_CELLS) -> list[list[int]]:
    """Radii 1 to ``steps`` in runs whose rims (twice the radius each) add up to ``rim`` at most, one radius at least."""
    out: list[list[int]] = []
    for radius in range(1, steps + 1):
        if out and sum(2 * r for r in out[-1]) + 2 * radius <= rim:
            out[-1].append(radius)
        else:
            out.append([radius])
    return out


def object_cells(surface: DataFrame, cell: float, slope: float, window: float, tile: int = 256, rim: int = RIM_CELLS) -> DataFrame:
    """(row, col, is_object): cells that stand above a surface opened with ever larger windows.

    Each opening works on the last one's result. Tiles exchange their rims anew for every few
    openings, so a rim is as wide as those reach and not as the whole progression, and the result does
    not depend on the tiles.
    """
    state, flagged = surface.select("row", "col", "value"), []
    for radii in _batches(int(np.ceil(window / cell)), rim):
        def progressive(v, present, radii=radii):
            high, last = np.zeros(v.shape, bool), v
            for radius in radii:
                now = raster.opened(last, present, radius)
                with np.errstate(invalid="ignore"):
                    high |= (last - now) > slope * cell * radius
                last = now
            return last, high
        both = stored(raster.focal(state, sum(2 * r for r in radii), progressive, ["value", "is_object"], tile), "opened")
        state = both.select("row", "col", "value")
        flagged.append(both.filter("is_object").select("row", "col"))
    objects = reduce(DataFrame.unionByName, flagged).distinct().withColumn("is_object", F.lit(True))
    return surface.select("row", "col").join(objects, ["row", "col"], "left").withColumn("is_object", F.coalesce("is_object", F.lit(False)))


def classify_ground(points: DataFrame, grid: Grid, scalar: float = SMRF["scalar"], slope: float = SMRF["slope"],
                    threshold: float = SMRF["threshold"], window: float = SMRF["window"], reach: int = 10,
                    tile: int = 256) -> DataFrame:
    """Simple morphological ground filter: class 2 for ground, 1 for the rest.

    Lowest surface, progressive opening, holes under the objects filled, then
    each point is compared with the filled surface, more loosely where it is
    steep.
    """
    surface = stored(lowest_surface(points, grid), "lowest")
    flags = object_cells(surface, grid.cell, slope, window, tile)
    bare = surface.join(flags, ["row", "col"]).select(
        "row", "col", F.when(~F.col("is_object"), F.col("value")).alias("value"))
    ground = stored(raster.fill_nodata(bare, reach), "ground")
    tilt = raster.gradients(ground, grid.cell).select("row", "col", F.coalesce(
        F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")), F.lit(0.0)).alias("tilt"))
    model = ground.withColumnRenamed("value", "ground_z").join(tilt, ["row", "col"])
    near = F.abs(F.col("z") - F.col("ground_z")) <= F.lit(threshold) + F.col("tilt") * scalar
    return (raster.on_grid(points, F.col("x"), F.col("y"), grid).join(model, ["row", "col"], "left")
            .withColumn("classification", F.when(near, GROUND_CLASS).otherwise(OTHER_CLASS))
            .drop("row", "col", "ground_z", "tilt"))
