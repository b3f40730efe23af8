"""Scene selection, cloud masks, composites, vegetation index.

``scenes`` has one row per scene (scene_id, acquired, cloud_pct, bbox columns),
``pixels`` one row per scene, cell and band (scene_id, r, c, band, dn, qa60).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators.filters import in_bbox

# ── fixed values ────────────────────────────────────────────────────────────
CLOUD_BIT, CIRRUS_BIT = 10, 11
REFLECTANCE_SCALE = 10000
NDVI_RANGE = (-0.2, 0.8)
NDVI_PALETTE = [(-0.2, 0xD7, 0x30, 0x27), (0.3, 0xFF, 0xFF, 0xBF), (0.8, 0x1A, 0x96, 0x41)]
NDVI_BREAKS = [-1.0, 0.0, 0.2, 0.4, 1.0]
NDVI_CLASSES = ["Non-veg / Water", "Bare soil", "Sparse veg", "Dense veg"]
HISTOGRAM_BINS = 40
SAMPLE_PIXELS, SAMPLE_SCALE_M, SAMPLE_SEED = 500, 100.0, 42
STRETCHES = {"true colour": (["B4", "B3", "B2"], 0.0, 3000.0, 1.3),
             "false colour": (["B8", "B4", "B3"], 0.0, 4000.0, 1.2),
             "short-wave infrared": (["B11", "B8", "B4"], 0.0, 4000.0, 1.0),
             "reflectance": (["B4", "B3", "B2"], 0.0, 0.3, 1.0)}
COMPOSITE_BANDS = ["B2", "B3", "B4", "B8", "B11"]
# ── end of fixed values ─────────────────────────────────────────────────────


def select_scenes(scenes: DataFrame, start: str | None = None, end: str | None = None,
                  max_cloud: float | None = None, box: tuple | None = None) -> DataFrame:
    """Scenes acquired in [start, end) with less cloud than the limit."""
    out = scenes if box is None else in_bbox(scenes, *box)
    if start is not None:
        out = out.filter((F.col("acquired") >= F.lit(start).cast("date")) & (F.col("acquired") < F.lit(end).cast("date")))
    return out if max_cloud is None else out.filter(F.col("cloud_pct") < max_cloud)


def of_scenes(pixels: DataFrame, scenes: DataFrame, extra: list[str] = ()) -> DataFrame:
    return pixels.join(scenes.select("scene_id", *extra), "scene_id")


def is_clear(qa: Column) -> Column:
    """Neither the cloud nor the cirrus bit is set."""
    return (qa.bitwiseAND(1 << CLOUD_BIT) == 0) & (qa.bitwiseAND(1 << CIRRUS_BIT) == 0)


def clear_reflectance(pixels: DataFrame) -> DataFrame:
    return pixels.filter(is_clear(F.col("qa60"))).withColumn("value", F.col("dn") / REFLECTANCE_SCALE)


def composite(pixels: DataFrame, how: str = "median", value: str = "dn", by: list[str] = ()) -> DataFrame:
    """Per cell and band over time; the exact median averages the two middle values."""
    pick = F.median if how == "median" else F.avg
    return pixels.groupBy(*by, "r", "c", "band").agg(pick(F.col(value).cast("double")).alias("value"))


def bands_wide(cells: DataFrame, bands: list[str], by: list[str] = ()) -> DataFrame:
    """One column per band; a fixed band list needs no extra pass to find it."""
    return cells.filter(F.col("band").isin(bands)).groupBy(*by, "r", "c").agg(
        *[F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands])


def normalized_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null if an input is negative or both are zero."""
    return F.when((a >= 0) & (b >= 0) & (a + b != 0), F.try_divide(a - b, a + b))


def ndvi(cells: DataFrame, by: list[str] = ()) -> DataFrame:
    wide = bands_wide(cells, ["B8", "B4"], by)
    return wide.select(*by, "r", "c", normalized_difference(F.col("B8"), F.col("B4")).alias("ndvi"))


def thin(cells: DataFrame, cell: float, scale: float) -> DataFrame:
    """Keep the cell nearest to the centre of each coarser cell, as a reduction at ``scale`` samples it."""
    n = max(1, int(round(scale / cell)))
    return cells.filter((F.pmod(F.col("r"), F.lit(n)) == n // 2) & (F.pmod(F.col("c"), F.lit(n)) == n // 2))


def sample(cells: DataFrame, n: int = SAMPLE_PIXELS, seed: int = SAMPLE_SEED) -> DataFrame:
    """Repeatable sample: the n cells with the smallest seeded hash (a distributed top-n)."""
    key = F.md5(F.concat_ws(":", F.col("r").cast("string"), F.col("c").cast("string"), F.lit(str(seed))))
    return (cells.filter(F.col("ndvi").isNotNull()).withColumn("_key", key)
            .orderBy("_key", "r", "c").limit(n).drop("_key"))


def histogram(values: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed, with the mean."""
    span = values.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.avg(column).alias("mean"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(
        F.floor((F.col(column) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1))).otherwise(F.lit(bins // 2))
    return (values.filter(F.col(column).isNotNull()).join(F.broadcast(span))
            .groupBy(place.cast("int").alias("bin"), "lo", "hi", "mean").agg(F.count(F.lit(1)).alias("pixels")))


def ndvi_class(value: Column) -> Column:
    """Class by left-closed bins, the last one closed; null outside."""
    label = None
    for lo, hi, name in zip(NDVI_BREAKS, NDVI_BREAKS[1:], NDVI_CLASSES):
        hit = (value >= lo) & ((value <= hi) if hi == NDVI_BREAKS[-1] else (value < hi))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label


def class_shares(cells: DataFrame) -> DataFrame:
    counts = (cells.withColumn("cover", ndvi_class(F.col("ndvi"))).filter(F.col("cover").isNotNull())
              .groupBy("cover").agg(F.count(F.lit(1)).alias("pixels")))
    share = F.round(F.col("pixels") * 100.0 / F.sum("pixels").over(Window.partitionBy(F.lit(1))), 1)
    return counts.withColumn("pct", share)       # four rows at most


def monthly_ndvi(pixels: DataFrame, scenes: DataFrame, year: int = 2023, max_cloud: float = 20.0,
                 cell: float = 10.0, scale: float = 10.0) -> DataFrame:
    """Mean index of each month's median composite, all months in one job.

    Windows run from the first to the 28th, end exclusive. Months without
    scenes stay as null.
    """
    chosen = select_scenes(scenes, f"{year}-01-01", f"{year + 1}-01-01", max_cloud).filter(
        F.dayofmonth("acquired") < 28).withColumn("month", F.month("acquired"))
    red_nir = of_scenes(pixels.filter(F.col("band").isin("B8", "B4")), chosen, ["month"])
    index = thin(ndvi(composite(red_nir, by=["month"]), ["month"]), cell, scale)
    means = index.groupBy("month").agg(F.avg("ndvi").alias("mean_ndvi"))
    months = pixels.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return months.join(means, "month", "left")


def annual_mean(monthly: DataFrame) -> DataFrame:
    """Months with a value and their unweighted mean (at most twelve rows)."""
    kept = monthly.filter(F.col("mean_ndvi").isNotNull())
    return kept.withColumn("annual_mean", F.avg("mean_ndvi").over(Window.partitionBy(F.lit(1))))


def stretch(value: Column, lo: float, hi: float, gamma: float = 1.0) -> Column:
    """Display byte: clamp to [lo, hi], apply gamma."""
    unit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - lo) / (hi - lo)))
    return F.when(value.isNotNull(), F.floor(F.pow(unit, F.lit(1.0 / gamma)) * 255)).cast("int")
