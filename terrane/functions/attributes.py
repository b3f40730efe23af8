"""Scalar rules on attributes: parsing, bands, labels, scores, colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ── fixed values ────────────────────────────────────────────────────────────
# Plain numbers as they are recognised in a height tag.
PLAIN_NUMBER = "^[0-9.]+$"
# Java reads a trailing d or f as part of a number ("24d"); a height tag does not.
TYPE_SUFFIX = "[0-9.][dDfF]\\s*$"
METRES_PER_FLOOR = 3.0

HEIGHT_BANDS = [(3.0, "< 3m (single storey)"), (10.0, "3–10m (low rise)"), (30.0, "10–30m (mid rise)"),
                (60.0, "30–60m (high rise)")]
HEIGHT_BAND_REST = "> 60m (skyscraper)"
ROAD_BANDS = [(10.0, "< 10m"), (50.0, "10–50m"), (100.0, "50–100m"), (200.0, "100–200m")]
ROAD_BAND_REST = "> 200m"

HEIGHT_COLOURS = [(5.0, "#2166ac"), (15.0, "#74add1"), (30.0, "#fdae61")]
HEIGHT_COLOUR_REST = "#d73027"
HEIGHT_COLOUR_NONE = "#2166ac"
SCORE_COLOURS = [(25.0, "#d73027"), (50.0, "#fc8d59"), (75.0, "#91cf60")]
SCORE_COLOUR_REST = "#1a9641"
SCORE_COLOUR_NONE = "#888888"

# LAS classification codes (ASPRS standard).
POINT_CLASSES = [
    (0, "Never Classified"), (1, "Unassigned"), (2, "Ground"), (3, "Low Vegetation"),
    (4, "Medium Vegetation"), (5, "High Vegetation"), (6, "Building"), (7, "Low Noise"),
    (9, "Water"), (17, "Bridge Deck"), (18, "High Noise")]

# National land-cover codes with the long and the short label set.
LAND_COVER = [
    (11, "Open Water", "Open Water"), (21, "Developed - Open", "Developed Open"),
    (22, "Developed - Low", "Developed Low"), (23, "Developed - Medium", "Developed Medium"),
    (24, "Developed - High", "Developed High"), (31, "Barren Land", "Barren Land"),
    (41, "Deciduous Forest", "Deciduous Forest"), (42, "Evergreen Forest", "Evergreen Forest"),
    (43, "Mixed Forest", None), (52, "Shrub/Scrub", "Shrub/Scrub"),
    (71, "Grassland/Herbaceous", "Grassland"), (81, "Hay/Pasture", "Hay/Pasture"),
    (82, "Cultivated Crops", "Cultivated Crops"), (90, "Woody Wetlands", "Woody Wetlands")]
# ── end of fixed values ─────────────────────────────────────────────────────


def parse_height(text: Column, rule: str = "pattern") -> Column:
    """Metres from a free-text tag; never raises.

    ``pattern`` accepts digits and dots only, ``coerce`` anything that reads as
    a number (so ``1e3`` is 1000).
    """
    number = text.try_cast("double")
    if rule == "pattern":
        return F.when(text.rlike(PLAIN_NUMBER), number)
    return F.when(~F.isnan(number) & ~text.rlike(TYPE_SUFFIX), number)


def estimated_floors(height: Column, mode: str = "half_up") -> Column:
    rounding = F.round if mode == "half_up" else F.bround
    return rounding(height / METRES_PER_FLOOR, 0).cast("int")


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def first_tag(tags: Column, default: str = "unclassified") -> Column:
    """First value of a multi-valued tag."""
    return F.coalesce(F.get(tags, F.lit(0)), F.lit(default))


def band(value: Column, limits: list[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit above the value; nulls fall in ``rest``."""
    label = F.when(value < limits[0][0], limits[0][1])
    for limit, text in limits[1:]:
        label = label.when(value < limit, text)
    return label.otherwise(rest)


def height_colour(height: Column) -> Column:
    shade = band(height, HEIGHT_COLOURS, HEIGHT_COLOUR_REST)
    return F.when(height.isNull() | (height == 0), HEIGHT_COLOUR_NONE).otherwise(shade)


def score_colour(score: Column) -> Column:
    return F.when(score.isNull(), SCORE_COLOUR_NONE).otherwise(band(score, SCORE_COLOURS, SCORE_COLOUR_REST))


def first_present(df: DataFrame, names: list[str], kind: str = "double") -> Column:
    """First of several columns the frame has, nulls as 0."""
    for name in names:
        if name in df.columns:
            return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))
    return F.lit(None).cast(kind)


def suitability(slope: Column, area_m2: Column, road_distance: Column) -> Column:
    """Score 0..100: gentle slope, large footprint and a near road count for it."""
    raw = (F.lit(50.0) - F.coalesce(slope, F.lit(0.0)) * 2 + F.least(F.lit(30.0), area_m2 / 100.0)
           + F.when(F.coalesce(road_distance, F.lit(9999.0)) < 50, 20.0).otherwise(0.0))
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)), 0).cast("int")


def score_bucket(score: Column) -> Column:
    return (F.round(score / 10.0, 0) * 10).cast("int")


def point_class_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POINT_CLASSES, "classification int, label string")


def land_cover_labels(spark: SparkSession, label_set: str = "long") -> DataFrame:
    place = {"long": 1, "short": 2}[label_set]
    rows = [(r[0], r[place]) for r in LAND_COVER]
    return spark.createDataFrame([r for r in rows if r[1]], "nlcd_code int, nlcd_class string")


def with_point_class(df: DataFrame) -> DataFrame:
    """Attach the class name; unknown codes read ``Class <code>``."""
    labels = F.broadcast(point_class_labels(df.sparkSession))
    return (df.join(labels, "classification", "left")
            .withColumn("label", F.coalesce("label", F.concat(F.lit("Class "), F.col("classification").cast("string")))))


def with_land_cover(df: DataFrame, label_set: str = "long") -> DataFrame:
    """Attach the cover name; the long set prints unknown codes, the short one does not."""
    labels = F.broadcast(land_cover_labels(df.sparkSession, label_set))
    other = (F.concat(F.lit("Other ("), F.col("nlcd_code").cast("int").cast("string"), F.lit(")"))
             if label_set == "long" else F.lit("Other"))
    return df.join(labels, "nlcd_code", "left").withColumn("nlcd_class", F.coalesce("nlcd_class", other))
