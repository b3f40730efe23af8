"""Raster operators on (row, col, value) cells; a null value is nodata."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.operators.tiles import cell_of
from terrane.schema import TILE_CELLS, Grid

# ── fixed values: elevation colour stops (metres, red, green, blue) ─────────
ELEVATION_STOPS = [(1550.0, 68, 1, 84), (1650.0, 59, 82, 139), (1750.0, 33, 145, 140),
                   (1850.0, 94, 201, 98), (1950.0, 253, 231, 37), (2100.0, 255, 255, 255)]
NODATA_COLOUR = (0, 0, 0)
# ── end of fixed values ─────────────────────────────────────────────────────


# ── cells ───────────────────────────────────────────────────────────────────
def tile_constraints(grids: DataFrame) -> DataFrame:
    """Per raster: do all tiles share reference system, cell size and alignment?

    ``grids`` has one row per tile: ``raster, srid, cell, x0, y0``.
    """
    def offset(c):
        return F.pmod(F.col(c), F.col("cell"))
    marked = grids.withColumn("_ox", offset("x0")).withColumn("_oy", offset("y0"))
    return marked.groupBy("raster").agg(
        F.count(F.lit(1)).alias("tiles"),
        (F.min("srid") == F.max("srid")).alias("same_srid"),
        (F.min("cell") == F.max("cell")).alias("same_cell"),
        ((F.min("_ox") == F.max("_ox")) & (F.min("_oy") == F.max("_oy"))).alias("aligned"))


def on_grid(df: DataFrame, x: Column, y: Column, grid: Grid) -> DataFrame:
    """Add row and col; features off a grid of known size are dropped."""
    row, col = cell_of(x, y, grid)
    out = df.withColumn("row", row).withColumn("col", col)
    if grid.ncols is not None:
        out = out.filter((F.col("col") >= 0) & (F.col("col") < grid.ncols))
    if grid.nrows is not None:
        out = out.filter((F.col("row") >= 0) & (F.col("row") < grid.nrows))
    return out


def clip_to_bbox(cells: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    x = F.lit(grid.x0) + (F.col("col") + 0.5) * grid.cell
    y = F.lit(grid.y0) - (F.col("row") + 0.5) * grid.cell
    return cells.filter((x >= box[0]) & (x <= box[2]) & (y >= box[1]) & (y <= box[3]))


def statistics(cells: DataFrame, by: list[str] = ()) -> DataFrame:
    return cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), (F.max("row") - F.min("row") + 1).alias("nrows"),
        (F.max("col") - F.min("col") + 1).alias("ncols"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.avg("value").alias("mean"), F.count_if(F.col("value").isNull()).alias("nodata"))


def mask_nodata(cells: DataFrame, nodata: float | None) -> DataFrame:
    """Turn a declared nodata value into null; 0 is as good a value as any other."""
    return cells if nodata is None else cells.withColumn("value", F.nullif(F.col("value"), F.lit(nodata)))


def above_ground(dsm: DataFrame, dtm: DataFrame) -> DataFrame:
    """Surface minus terrain, not below 0; null where either is."""
    both = dsm.withColumnRenamed("value", "s").join(dtm.withColumnRenamed("value", "t"), ["row", "col"], "full")
    gap = F.col("s") - F.col("t")
    return both.select("row", "col", F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0))).alias("value"))


# ── focal operators ─────────────────────────────────────────────────────────
def focal(cells: DataFrame, halo: int, fn, outputs: list[str], tile: int = TILE_CELLS) -> DataFrame:
    """Run a neighbourhood function on tiles that overlap by ``halo`` cells.

    One shuffle brings each tile together with its rim, so a group never holds
    more than (tile + 2 * halo)^2 cells. ``fn(values, present)`` gets dense
    arrays (nodata and absent cells are NaN) and returns one array per output;
    cells inside the tile that exist come back.
    """
    def blocks(c):
        return F.sequence(F.floor((F.col(c) - halo) / tile), F.floor((F.col(c) + halo) / tile))
    keyed = (cells.select("row", "col", "value").withColumn("trow", F.explode(blocks("row")))
             .withColumn("tcol", F.explode(blocks("col"))))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cols = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        top, left = int(key[0]) * tile, int(key[1]) * tile
        core = (rows >= top) & (rows < top + tile) & (cols >= left) & (cols < left + tile)
        if not core.any():
            return pd.DataFrame({n: [] for n in ("row", "col", *outputs)})
        r0, c0 = int(rows.min()), int(cols.min())       # the array spans the cells that exist
        r, c = rows - r0, cols - c0
        values = np.full((int(r.max()) + 1, int(c.max()) + 1), np.nan)
        present = np.zeros(values.shape, bool)
        values[r, c] = pdf["value"].to_numpy(dtype=float)
        present[r, c] = True
        results = fn(values, present)
        out = {"row": (r[core] + r0).astype("int32"), "col": (c[core] + c0).astype("int32")}
        for name, array in zip(outputs, results):
            picked = array[r[core], c[core]]
            # a masked array becomes SQL null, a plain NaN would stay NaN
            out[name] = picked if picked.dtype == bool else pd.arrays.FloatingArray(picked.copy(), np.isnan(picked))
        return pd.DataFrame(out)
    schema = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType())]
                          + [T.StructField(n, T.BooleanType() if n.startswith("is_") else T.DoubleType())
                             for n in outputs])
    return keyed.groupBy("trow", "tcol").applyInPandas(run, schema)


def _shifted(a: np.ndarray, dr: int, dc: int, fill=np.nan) -> np.ndarray:
    """Array whose element (r, c) is a[r + dr, c + dc]."""
    out = np.full_like(a, fill)
    h, w = a.shape
    if abs(dr) < h and abs(dc) < w:
        out[max(0, -dr):h - max(0, dr), max(0, -dc):w - max(0, dc)] = (
            a[max(0, dr):h - max(0, -dr), max(0, dc):w - max(0, -dc)])
    return out


def gradients(cells: DataFrame, cell: float, tile: int = TILE_CELLS) -> DataFrame:
    """Horn's 3x3 gradients to the east and to the south; null unless all nine cells have values."""
    def horn(v, present):
        n = {(dr, dc): _shifted(v, dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)}
        east = (n[-1, 1] + 2 * n[0, 1] + n[1, 1]) - (n[-1, -1] + 2 * n[0, -1] + n[1, -1])
        south = (n[1, -1] + 2 * n[1, 0] + n[1, 1]) - (n[-1, -1] + 2 * n[-1, 0] + n[-1, 1])
        hole = np.isnan(v)
        return (np.where(hole, np.nan, east / (8 * cell)), np.where(hole | np.isnan(east), np.nan, south / (8 * cell)))
    both = focal(cells, 1, horn, ["gx", "gy"], tile)
    full = F.col("gx").isNotNull() & F.col("gy").isNotNull()
    return both.select("row", "col", F.when(full, F.col("gx")).alias("gx"), F.when(full, F.col("gy")).alias("gy"))


def slope_degrees(grad: DataFrame) -> DataFrame:
    steep = F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))
    return grad.select("row", "col", F.degrees(F.atan(steep)).alias("value"))


def aspect_degrees(grad: DataFrame) -> DataFrame:
    """Compass direction the slope faces; null on flat ground."""
    angle = F.degrees(F.atan2(F.col("gy"), -F.col("gx")))
    compass = F.when(angle > 90, F.lit(450.0) - angle).otherwise(F.lit(90.0) - angle)
    flat = (F.col("gx") == 0) & (F.col("gy") == 0)
    return grad.select("row", "col", F.when(~flat, F.when(compass == 360, 0.0).otherwise(compass)).alias("value"))


def hillshade(grad: DataFrame, azimuth: float = 315.0, altitude: float = 45.0, z: float = 1.0) -> DataFrame:
    """Illumination 1..255; null where the gradient is.

    The azimuth is that of the light, clockwise from north. Rows run south, so the
    northward gradient is -gy.
    """
    gx, gy = -F.col("gx") * z, -F.col("gy") * z
    steep2 = gx * gx + gy * gy
    alt, az = F.radians(F.lit(altitude)), F.radians(F.lit(azimuth))
    light = (F.sin(alt) - F.cos(alt) * F.sqrt(steep2) * F.sin(F.atan2(gy, gx) - az)) / F.sqrt(F.lit(1.0) + steep2)
    return grad.select("row", "col", F.when(light <= 0, 1.0).otherwise(F.lit(1.0) + light * 254).alias("value"))


def quadrant_offsets(reach: int) -> list[list[tuple[int, int]]]:
    """Offsets within ``reach`` by quadrant, nearest first."""
    inside = [(dr, dc) for dr in range(-reach, reach + 1) for dc in range(-reach, reach + 1)
              if 0 < dr * dr + dc * dc <= reach * reach]
    tests = [lambda r, c: r < 0 <= c, lambda r, c: r >= 0 and c > 0,
             lambda r, c: r > 0 >= c, lambda r, c: r <= 0 and c < 0]
    return [sorted((o for o in inside if t(*o)), key=lambda o: (o[0] ** 2 + o[1] ** 2, o)) for t in tests]


def fill_nodata(cells: DataFrame, reach: int = 10, tile: int = TILE_CELLS) -> DataFrame:
    """Fill null cells from the nearest value of each quadrant, weighted by 1/distance.

    Cells with no value within ``reach`` stay null.
    """
    quadrants = quadrant_offsets(reach)

    def fill(v, present):
        holes = np.flatnonzero(present & np.isnan(v))
        side = v.shape[1]
        hr, hc = holes // side, holes % side
        num, den = np.zeros(len(holes)), np.zeros(len(holes))
        for offsets in quadrants:
            open_ = np.ones(len(holes), bool)
            for dr, dc in offsets:
                r, c = hr + dr, hc + dc
                ok = open_ & (r >= 0) & (r < v.shape[0]) & (c >= 0) & (c < side)
                got = np.full(len(holes), np.nan)
                got[ok] = v[r[ok], c[ok]]
                ok = ~np.isnan(got)
                d = np.hypot(dr, dc)
                num[ok] += got[ok] / d
                den[ok] += 1 / d
                open_ &= ~ok
                if not open_.any():
                    break
        out = v.copy()
        with np.errstate(invalid="ignore", divide="ignore"):
            out[hr, hc] = np.where(den > 0, num / den, np.nan)
        return (out,)
    return focal(cells, reach, fill, ["value"], tile)


def _window(a: np.ndarray, radius: int, pick, fill: float) -> np.ndarray:
    """Running min or max over a square, by doubling the reach along each axis."""
    out = a
    for axis in (0, 1):
        shift = (lambda x, k: _shifted(x, k, 0, fill)) if axis == 0 else (lambda x, k: _shifted(x, 0, k, fill))
        right, left, done = out, out, 0
        while done < radius:
            step = min(done + 1, radius - done)
            right, left = pick(right, shift(right, step)), pick(left, shift(left, -step))
            done += step
        out = pick(right, left)
    return out


def opened(v: np.ndarray, present: np.ndarray, radius: int) -> np.ndarray:
    """Grey-scale opening with a square of 2 * radius + 1 cells; gaps do not count."""
    low = _window(np.where(np.isnan(v), np.inf, v), radius, np.minimum, np.inf)
    low = np.where(present & np.isfinite(low), low, -np.inf)
    high = _window(low, radius, np.maximum, -np.inf)
    return np.where(present & np.isfinite(high), high, np.nan)


def opening(cells: DataFrame, radius: int, tile: int = TILE_CELLS) -> DataFrame:
    return focal(cells, 2 * radius, lambda v, p: (opened(v, p, radius),), ["value"], tile)


# ── display ─────────────────────────────────────────────────────────────────
def ramp(value: Column, stops: list[tuple], nodata: tuple = NODATA_COLOUR) -> dict[str, Column]:
    """Piecewise-linear colours between stops, clamped at both ends."""
    out = {}
    for band, name in enumerate(("red", "green", "blue"), 1):
        colour = F.when(value.isNull(), F.lit(nodata[band - 1])).when(value <= stops[0][0], F.lit(stops[0][band]))
        for a, b in zip(stops, stops[1:]):
            mix = F.lit(float(a[band])) + (value - a[0]) / (b[0] - a[0]) * float(b[band] - a[band])
            colour = colour.when(value < b[0], F.floor(mix + 0.5).cast("int"))
        out[name] = colour.otherwise(F.lit(stops[-1][band])).cast("int")
    return out


def scale_to_byte(cells: DataFrame) -> DataFrame:
    """Stretch to 0..255 by the raster's own range; one row of statistics is attached."""
    span = cells.agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    wide = F.col("_hi") > F.col("_lo")
    byte = F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 255 + 0.5)
    return (cells.join(F.broadcast(span)).select("row", "col", F.when(wide, byte).otherwise(
        F.when(F.col("value").isNotNull(), 0)).cast("int").alias("byte")))


def share_of_total(value: Column, partition: list[str], scale: float = 100.0, digits: int = 1) -> Column:
    """Share in the total of the partition; a scale of 900 weighs by cell area instead of percent."""
    return F.round(value * scale / F.sum(value).over(Window.partitionBy(*partition)), digits)
