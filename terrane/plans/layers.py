"""Recipes of the materialised layers."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import attributes as at
from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.functions.simplify import simplify
from terrane.operators import cluster, filters, joins, outlines, raster, tiles, zones
from terrane.schema import (AREAL_KINDS, BBOX_COLUMNS, BUILDING_MIN_M2, LANDUSE_MIN_M2, ROAD_BUFFER_M, SLIVER_M2,
                            UTM13N, Grid)
from terrane.sources.vector import read_layer, standardise

BOX = list(BBOX_COLUMNS)


def raw_buildings(features: DataFrame, rule: str = "coerce", floors: str = "half_even") -> DataFrame:
    """Valid building footprints above sliver size with area, height and floors."""
    height = at.parse_height(at.column_or_null(features, "height", "string"), rule)
    return (standardise(features)
            .filter(F.col("geom.kind").isin(AREAL_KINDS)).filter(pred.is_valid(F.col("geom")))
            .withColumn("area_m2", g.rounded_area(F.col("geom")))
            .withColumn("height_m", height)
            .withColumn("est_floors", at.estimated_floors(F.col("height_m"), floors))
            .filter(F.col("area_m2") > SLIVER_M2)
            .transform(g.with_bbox))


def raw_roads(features: DataFrame) -> DataFrame:
    """Valid roads with one highway class each."""
    return (standardise(features).filter(pred.is_valid(F.col("geom")))
            .withColumn("highway", at.first_tag(F.col("highway"))).transform(g.with_bbox))


def raw_landuse(features: DataFrame) -> DataFrame:
    return (standardise(features).filter(F.col("geom.kind").isin(AREAL_KINDS))
            .filter(pred.is_valid(F.col("geom")))
            .withColumn("area_m2", g.rounded_area(F.col("geom"))).transform(g.with_bbox))


def buildings_with_landuse(buildings: DataFrame, landuse: DataFrame) -> DataFrame:
    """Every building with the class of each land-use zone it lies in."""
    return joins.settle_collision(joins.within_join(buildings, landuse, ["landuse"]), "landuse")


def count_by_class(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows per class, largest first; rows without a class do not count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), column))


def first_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """First row of each key by an explicit order; combines before the shuffle, so hot keys stay cheap."""
    first = F.min_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, *[F.col("_first")[v].alias(v) for v in values])


def first_match_per_key(left: DataFrame, right: DataFrame, on: list[str], keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """First of the right rows that each key of the left meets; ``order`` and ``values`` are columns of the right.

    Of right rows that are equal in ``on`` only the first can be any key's first. So they are reduced before
    the join, and the pairs are no more than the left rows.
    """
    first = first_per_key(right, on, order, [*order, *values])
    return first_per_key(left.join(first, on), keys, order, values)


def processed_buildings(features: DataFrame) -> DataFrame:
    """Repaired footprints; area of the geometry as read and as repaired.

    The repair is marked as not deterministic (it is): Spark would otherwise push the filter
    below it and repair every footprint twice.
    """
    fixed = features.withColumn("_area", g.rounded_area(F.col("geom"))).withColumn(
        "geom", pred.make_valid_once(F.col("geom")))
    return (fixed.filter(pred.is_valid(F.col("geom")))
            .select("id", "name", "building",
                    at.parse_height(F.col("height")).alias("height_m"),
                    at.estimated_floors(at.parse_height(F.col("height"))).alias("est_floors"),
                    F.col("_area").alias("area_m2"), g.rounded_area(F.col("geom")).alias("area_repaired_m2"),
                    g.set_srid(F.col("geom"), UTM13N).alias("geom"))
            .transform(g.with_bbox))


def road_influence(roads: DataFrame, radius: float = ROAD_BUFFER_M, dy: float = zones.DEFAULT_DY) -> DataFrame:
    """Dissolved buffer of the major roads per class, as scan-line runs."""
    return zones.buffer_zones(filters.major_roads(roads), ["highway"], radius, dy)


def buildings_near_roads(buildings: DataFrame, roads: DataFrame, distinct: bool = False) -> DataFrame:
    """Buildings inside a road influence zone, once per class (or once if distinct)."""
    hits = zones.within_zones(buildings, filters.major_roads(roads))
    if distinct:
        return buildings.join(hits.select("id"), "id", "left_semi")
    return buildings.join(hits, "id")


def buildings_with_elevation(buildings: DataFrame, dem: DataFrame, grid: Grid) -> DataFrame:
    """Ground elevation under each centroid on the grid, one row per building."""
    return tiles.value_at_centroids(buildings, dem, grid, "inner", "ground_elevation_m")


def buildings_lidar_height(buildings: DataFrame, ndsm: DataFrame, grid: Grid) -> DataFrame:
    """Mean and highest above-ground value inside each footprint over 50 m2."""
    large = filters.larger_than(buildings, BUILDING_MIN_M2, rounded=False)
    return tiles.zonal_summary(large, ndsm, grid, ["id"]).withColumnsRenamed(
        {"mean": "lidar_height_m", "max": "lidar_max_m", "count": "pixel_count"})


def height_bands(heights: DataFrame) -> DataFrame:
    label = at.band(F.col("lidar_height_m"), at.HEIGHT_BANDS, at.HEIGHT_BAND_REST)
    return (heights.groupBy(label.alias("height_category"))
            .agg(F.count(F.lit(1)).alias("building_count"), F.min("lidar_height_m").alias("lowest"))
            .orderBy("lowest").drop("lowest"))


def height_discrepancy(buildings: DataFrame, heights: DataFrame, n: int = 20, both: bool = True) -> DataFrame:
    """Largest gaps between tagged and measured height."""
    gap = F.abs(F.col("height_m") - F.col("lidar_height_m"))
    joined = buildings.select("id", "height_m").join(heights.select("id", "lidar_height_m"), "id").filter(
        F.col("height_m").isNotNull())
    if both:
        joined = joined.filter(F.col("lidar_height_m").isNotNull())
    return (joined.select("id", F.round("height_m", 1).alias("osm_height_m"),
                          F.round("lidar_height_m", 1).alias("lidar_height_m"), F.round(gap, 1).alias("discrepancy_m"))
            .orderBy(F.desc_nulls_first("discrepancy_m"), "id").limit(n))


def land_cover(landuse: DataFrame, nlcd: DataFrame, grid: Grid, label_set: str = "long") -> DataFrame:
    """Cover classes of each land-use polygon over 1000 m2."""
    large = filters.larger_than(landuse, LANDUSE_MIN_M2, rounded=False).withColumn(
        "area_m2", g.rounded_area(F.col("geom")))
    counts = tiles.zonal_histogram(large, nlcd, grid, ["id", "landuse", "area_m2"]).select(
        F.col("id").alias("lu_id"), F.col("landuse").alias("osm_landuse"), "area_m2",
        F.col("value").cast("int").alias("nlcd_code"), "pixel_count")
    shares = counts.withColumn("coverage_pct", raster.share_of_total(F.col("pixel_count"), ["lu_id"], 900.0)).withColumn(
        "coverage_share_pct", raster.share_of_total(F.col("pixel_count"), ["lu_id"], 100.0))
    return at.with_land_cover(shares, label_set)


def land_cover_totals(cover: DataFrame) -> DataFrame:
    return (cover.groupBy("nlcd_class").agg(
        F.count_distinct("lu_id").alias("polygon_count"),
        F.round(F.sum(F.col("pixel_count") * 900.0) / 1e6, 2).alias("total_area_km2"))
        .orderBy(F.desc("total_area_km2"), "nlcd_class"))


def buildings_road_access(buildings: DataFrame, roads: DataFrame, how: str = "left") -> DataFrame:
    return joins.nearest_join(buildings, roads, how).select("id", F.col("dist").alias("dist_to_nearest_road_m"))


def road_access_bands(access: DataFrame, bands: list | None = None, rest: str = at.ROAD_BAND_REST) -> DataFrame:
    label = at.band(F.col("dist_to_nearest_road_m"), bands or at.ROAD_BANDS, rest)
    return (access.groupBy(label.alias("distance_band")).agg(
        F.count(F.lit(1)).alias("building_count"), F.min("dist_to_nearest_road_m").alias("nearest"))
        .orderBy("nearest").drop("nearest"))


def land_suitability(buildings: DataFrame, access: DataFrame, slope: DataFrame, grid: Grid) -> DataFrame:
    """Score of each building from slope, footprint and road distance."""
    sloped = tiles.value_at_centroids(buildings, slope, grid, "left", "slope")
    scored = sloped.join(access, "id", "left")
    return scored.withColumn("suitability_score", at.suitability(
        F.col("slope"), F.col("area_m2"), F.col("dist_to_nearest_road_m"))).drop("slope", "dist_to_nearest_road_m")


def score_histogram(scores: DataFrame) -> DataFrame:
    return (scores.groupBy(at.score_bucket(F.col("suitability_score")).alias("score_bucket"))
            .agg(F.count(F.lit(1)).alias("parcel_count")).orderBy("score_bucket"))


def buildings_map(buildings: DataFrame, heights: DataFrame, clusters: DataFrame, tolerance: float) -> DataFrame:
    """Export table of the buildings over 50 m2 with height, cluster and colour."""
    joined = (buildings.filter(F.col("area_m2") > BUILDING_MIN_M2)
              .join(heights.select("id", "lidar_height_m"), "id", "left").join(clusters, "id", "left"))
    return simplify(joined, tolerance).withColumn("colour", at.height_colour(F.col("lidar_height_m")))


def zones_map(runs: DataFrame, by: list[str]) -> DataFrame:
    """Export table of buffer zones: their polygons, exact on the scan lines."""
    return outlines.polygons(runs, by)


def suitability_map(scores: DataFrame, tolerance: float) -> DataFrame:
    return simplify(scores, tolerance).withColumn("colour", at.score_colour(F.col("suitability_score")))


def clustered_buildings(buildings: DataFrame) -> DataFrame:
    return cluster.dbscan(buildings)


def run_available(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Status row per wanted layer: counted if its directory is there, skipped if not."""
    rows = []
    for name in names:
        try:
            counted = read_layer(spark, root, name).agg(F.count(F.lit(1)).alias("features"))
            rows.append(counted.select(F.lit(name).alias("layer"), "features", F.lit("done").alias("outcome")))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows.append(spark.range(1).select(F.lit(name).alias("layer"), F.lit(None).cast("long").alias("features"),
                                              F.lit("skipped").alias("outcome")))
    return reduce(DataFrame.unionByName, rows)
