"""Raster cells, zonal statistics, terrain derivatives and the layers built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane import fixtures
from terrane.fixtures import POINT_GRID, SURFACE_GRID
from terrane.functions import attributes as at
from terrane.functions import geometry as g
from terrane.operators import pointcloud, raster, tiles, zones
from terrane.plans import layers
from terrane.schema import Grid
from terrane.session import stored
from workload import base, sqltext
from workload.base import query

B, R, L, G, P, K = "fx_buildings", "fx_roads", "fx_landuse", "fx_grid", "fx_points", "fx_roofs"
c = F.col

# cells under a rectangle by the centre rule; cell (r, c) centre = (490000+160(c+.5), 4405000-160(r+.5))
ON_SURFACE = ("490000 + 160*(g.c+0.5) >= z.x0 AND 490000 + 160*(g.c+0.5) < z.x0 + z.w AND "
              "4405000 - 160*(g.r+0.5) >= z.y0 AND 4405000 - 160*(g.r+0.5) < z.y0 + z.h")
CENTRED = """cb AS (SELECT *, CAST(floor((4405000 - (y0 + h/2.0)) / 160) AS INT) AS r, CAST(floor((x0 + w/2.0 - 490000) / 160) AS INT) AS c FROM fx_buildings)"""
NLCD_LABEL = ("CASE code " + " ".join(f"WHEN {k} THEN '{t}'" for k, t, _ in at.LAND_COVER)
              + " ELSE 'Other (' || code || ')' END")
NLCD_SHORT = "CASE code " + " ".join(f"WHEN {k} THEN '{t}'" for k, _, t in at.LAND_COVER if t) + " ELSE 'Other' END"
COVER = f"""hist AS (SELECT z.id, z.landuse, z.w * z.h AS area_m2, g.nlcd AS code, COUNT(*) AS n
  FROM fx_landuse z JOIN fx_grid g ON {ON_SURFACE} WHERE z.w * z.h > 1000 AND g.nlcd IS NOT NULL GROUP BY ALL)"""


@query("s7_tile_raster", """
SELECT CAST(floor(r / 16) AS INT) AS trow, CAST(floor(c / 16) AS INT) AS tcol, COUNT(*) AS cells, COUNT(dem) AS filled,
  SUM(dem) AS total FROM fx_grid GROUP BY 1, 2""", (G,))
def s7(spark, d):
    return tiles.counts(tiles.to_tiles(base.raster(spark, d, "dem"), 16)).drop("band")


@query("s8_untile_raster", "SELECT r AS row, c AS col, dem AS value FROM fx_grid", (G,))
def s8(spark, d):
    return tiles.to_cells(base.tiles(spark, d, "dem")).drop("band")


@query("f11_band_selection", """
SELECT scene_id, r, c, band, dn FROM fx_pixels WHERE band IN ('B4', 'B8')""", ("fx_pixels",))
def f11(spark, d):
    return fixtures.load(spark, d, "fx_pixels").filter(c("band").isin("B4", "B8")).select("scene_id", "r", "c", "band", "dn")


@query("f12_clip_to_region", """
SELECT r AS row, c AS col, dem AS value FROM fx_grid WHERE 490000 + 160*(c+0.5) BETWEEN 492000 AND 503000
  AND 4405000 - 160*(r+0.5) BETWEEN 4390000 AND 4400000""", (G,))
def f12(spark, d):
    return raster.clip_to_bbox(base.raster(spark, d, "dem"), SURFACE_GRID, (492000, 4390000, 503000, 4400000))


@query("j3_centroid_in_cell", f"WITH {CENTRED} SELECT id, g.dem AS value FROM cb JOIN fx_grid g USING (r, c)", (B, G))
def j3(spark, d):
    return tiles.value_at_centroids(base.buildings(spark, d, False).select("id", "geom"), base.tiles(spark, d, "dem"),
                                     SURFACE_GRID).select("id", "value")


@query("j4_polygon_cell_join", f"""
SELECT z.id, g.r AS row, g.c AS col, CAST(g.nlcd AS DOUBLE) AS value FROM fx_landuse z JOIN fx_grid g ON {ON_SURFACE}""", (L, G))
def j4(spark, d):
    return tiles.clip_to_polygons(base.landuse(spark, d), base.tiles(spark, d, "nlcd"), SURFACE_GRID, ["id"])


@query("j9_slope_at_centroid", f"WITH {CENTRED} SELECT id, g.slope FROM cb LEFT JOIN fx_grid g USING (r, c)", (B, G))
def j9(spark, d):
    return tiles.value_at_centroids(base.buildings(spark, d, False).select("id", "geom"), base.tiles(spark, d, "slope"),
                                     SURFACE_GRID, "left", "slope").select("id", "slope")


@query("j12_class_label_lookup", """
SELECT classification, COALESCE(t, 'Class ' || classification) AS label, COUNT(*) AS n FROM fx_points
LEFT JOIN (VALUES """ + ", ".join(f"({k}, '{t}')" for k, t in at.POINT_CLASSES) + """) AS v(k, t) ON k = classification
GROUP BY 1, 2""", (P,))
def j12(spark, d):
    return at.with_point_class(base.points(spark, d).select("classification")).groupBy("classification", "label").agg(
        F.count("*").alias("n"))


@query("a5_elevation_statistics", f"""WITH {CENTRED}
SELECT ROUND(MIN(g.dem), 1) AS elev_min, ROUND(MAX(g.dem), 1) AS elev_max, ROUND(AVG(g.dem), 1) AS elev_mean
FROM cb JOIN fx_grid g USING (r, c)""", (B, G))
def a5(spark, d):
    e = layers.buildings_with_elevation(base.buildings(spark, d, False), base.tiles(spark, d, "dem"), SURFACE_GRID)
    v = "ground_elevation_m"
    return e.agg(F.round(F.min(v), 1).alias("elev_min"), F.round(F.max(v), 1).alias("elev_max"),
                 F.round(F.avg(v), 1).alias("elev_mean"))


def _cover(spark, d, label_set="long"):
    return layers.land_cover(base.landuse(spark, d), base.tiles(spark, d, "nlcd"), SURFACE_GRID, label_set)


@query("a11_cover_totals", f"""WITH {COVER}
SELECT {NLCD_LABEL} AS nlcd_class, COUNT(DISTINCT id) AS polygon_count, ROUND(CAST(SUM(n * 900.0) / 1e6 AS DOUBLE), 2) AS total_area_km2
FROM hist GROUP BY 1""", (L, G))
def a11(spark, d):
    return layers.land_cover_totals(_cover(spark, d))


@query("a12_first_row_per_key", """
SELECT id, landuse FROM (SELECT b.id, l.landuse, ROW_NUMBER() OVER (PARTITION BY b.id ORDER BY l.id) AS k
  FROM fx_roofs b JOIN fx_landuse l ON l.id % 100 = b.id % 100) WHERE k = 1""", (K, L))
def a12(spark, d):
    zone = fixtures.load(spark, d, L).select(c("id").alias("zone"), "landuse", (c("id") % 100).alias("k"))
    roof = base.roofs(spark, d).select("id", (c("id") % 100).alias("k"))
    return layers.first_match_per_key(roof, zone, ["k"], ["id"], ["zone"], ["landuse"])


@query("a14_pair_totals", f"""WITH {COVER}
SELECT landuse AS osm_landuse, {NLCD_SHORT} AS nlcd_class, CAST(SUM(n) AS BIGINT) AS total_pixels FROM hist GROUP BY 1, 2
ORDER BY total_pixels DESC, 1 NULLS FIRST, 2 LIMIT 10""", (L, G))
def a14(spark, d):
    return (_cover(spark, d, "short").groupBy("osm_landuse", "nlcd_class").agg(F.sum("pixel_count").alias("total_pixels"))
            .orderBy(F.desc("total_pixels"), "osm_landuse", "nlcd_class").limit(10))


@query("w1_share_of_partition", f"""WITH {COVER}
SELECT id AS lu_id, code AS nlcd_code, ROUND(CAST(n * 900.0 / SUM(n) OVER (PARTITION BY id) AS DOUBLE), 1) AS coverage_pct,
  ROUND(CAST(n * 100.0 / SUM(n) OVER (PARTITION BY id) AS DOUBLE), 1) AS coverage_share_pct FROM hist""", (L, G))
def w1(spark, d):
    return _cover(spark, d).select("lu_id", "nlcd_code", "coverage_pct", "coverage_share_pct")


@query("t1_tallest_tops", f"""WITH {CENTRED}
SELECT id, ROUND(g.dem, 1) AS ground_m, ROUND({sqltext.HEIGHT}, 1) AS osm_height_m, ROUND(g.dem + {sqltext.HEIGHT}, 1) AS top_elevation_m
FROM cb JOIN fx_grid g USING (r, c) WHERE {sqltext.HEIGHT} IS NOT NULL ORDER BY top_elevation_m DESC NULLS FIRST, id LIMIT 10""", (B, G))
def t1(spark, d):
    b = base.buildings(spark, d, False).select("id", "geom", at.parse_height(c("height")).alias("height_m"))
    e = layers.buildings_with_elevation(b, base.tiles(spark, d, "dem"), SURFACE_GRID).filter(c("height_m").isNotNull())
    top = F.round(c("ground_elevation_m") + c("height_m"), 1)
    return (e.select("id", F.round("ground_elevation_m", 1).alias("ground_m"), F.round("height_m", 1).alias("osm_height_m"),
                     top.alias("top_elevation_m")).orderBy(F.desc_nulls_first("top_elevation_m"), "id").limit(10))


@query("t3_sorted_layer", f"""WITH {COVER}
SELECT id AS lu_id, code AS nlcd_code, n AS pixel_count FROM hist ORDER BY 1, 3 DESC""", (L, G))
def t3(spark, d):
    return _cover(spark, d).select("lu_id", "nlcd_code", "pixel_count").orderBy("lu_id", F.desc("pixel_count"), "nlcd_code")


# bilinear values of the target cells (band, row, col, u, v), u and v counted in source cells from the centre of cell (0, 0)
WEIGHED = """n AS (SELECT band, row, col, floor(v) + dr AS r, floor(u) + dc AS c,
  (CASE WHEN dr = 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE WHEN dc = 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w
  FROM p, (VALUES (0), (1)) a(dr), (VALUES (0), (1)) b(dc), (VALUES (1), (2)) k(band)),
source AS (SELECT r, c, 1 AS band, dem AS value FROM fx_grid UNION ALL SELECT r, c, 2, slope FROM fx_grid)
SELECT band, row, col, ROUND(SUM(w * value) / SUM(w), 3) AS value FROM n JOIN source USING (band, r, c)
WHERE value IS NOT NULL AND w > 0 GROUP BY 1, 2, 3"""
EXTENT = "e AS (SELECT MIN(r) AS r0, MAX(r) + 1 AS r1, MIN(c) AS c0, MAX(c) + 1 AS c1 FROM fx_grid)"
TARGET = """t AS (SELECT *, i // ncols AS row, i % ncols AS col, x1 + 100 * ((i % ncols) + 0.5) AS x0, y1 - 100 * ((i // ncols) + 0.5) AS y0
  FROM (SELECT *, UNNEST(range(nrows * ncols)) AS i FROM g))"""


def _bands(spark, d):
    return base.tiles(spark, d, "dem", "slope")


def _warped(spark, d, source, srid):
    """Both bands on a grid of 100 m that covers the whole raster."""
    rows = _bands(spark, d)
    target = tiles.target_grid(tiles.extent(rows, source), srid, 100.0)
    out = tiles.to_cells(tiles.reproject(rows, source, target)).filter(c("value").isNotNull())
    return out.select("band", c("row").cast("long").alias("row"), c("col").cast("long").alias("col"), F.round("value", 3).alias("value"))


@query("r2_resample_bilinear", f"""
WITH {EXTENT}, g AS (SELECT 490000 + 160.0 * c0 AS x1, 4405000 - 160.0 * r0 AS y1, CAST(ceil((r1 - r0) * 160 / 100.0) AS BIGINT) AS nrows,
  CAST(ceil((c1 - c0) * 160 / 100.0) AS BIGINT) AS ncols FROM e), {TARGET},
p AS (SELECT row, col, (CAST(x0 AS DOUBLE) - 490000) / 160 - 0.5 AS u, (4405000 - CAST(y0 AS DOUBLE)) / 160 - 0.5 AS v FROM t),
{WEIGHED}""", (G,))
def r2(spark, d):
    return _warped(spark, d, SURFACE_GRID, SURFACE_GRID.srid)


@query("r1_reproject_bilinear", f"""
WITH {EXTENT},
edge AS (SELECT -105.12::DOUBLE + c0 * 0.0018::DOUBLE + f * ((c1 - c0) * 0.0018::DOUBLE) AS lon, 39.80::DOUBLE - r0 * 0.0018::DOUBLE - h * ((r1 - r0) * 0.0018::DOUBLE) AS lat
  FROM e, (SELECT k / 64.0::DOUBLE AS f, h FROM range(65) a(k), (VALUES (0), (1)) b(h) UNION SELECT h, k / 64.0::DOUBLE FROM range(65) a(k), (VALUES (0), (1)) b(h))),
g AS (SELECT MIN(east) AS x1, MAX(north) AS y1, CAST(ceil((MAX(north) - MIN(north)) / 100) AS BIGINT) AS nrows,
  CAST(ceil((MAX(east) - MIN(east)) / 100) AS BIGINT) AS ncols FROM ({sqltext.forward_utm('edge')})), {TARGET},
p AS (SELECT row, col, ({sqltext.LON} + 105.12) / 0.0018 - 0.5 AS u, (39.80 - {sqltext.LAT}) / 0.0018 - 0.5 AS v FROM ({sqltext.inverse_utm('t')})),
{WEIGHED}""", (G,))
def r1(spark, d):
    """The surface read as a longitude/latitude raster and brought to the projected grid."""
    return _warped(spark, d, Grid(x0=-105.12, y0=39.80, cell=0.0018, srid=4326), SURFACE_GRID.srid)


@query("r3_nodata_mask", """
SELECT COUNT(*) AS cells, COUNT(*) FILTER (WHERE dem IS NULL) + COUNT(*) FILTER (WHERE dem = 1610.0) AS nodata FROM fx_grid""", (G,))
def r3(spark, d):
    masked = raster.mask_nodata(base.raster(spark, d, "dem"), 1610.0)
    return raster.statistics(masked).select("cells", "nodata")


@query("r4_fill_nodata", """
WITH hole AS (SELECT r, c FROM fx_grid WHERE dem IS NULL),
near AS (SELECT h.r, h.c, g.dem, g.r - h.r AS dr, g.c - h.c AS dc,
  CASE WHEN g.r < h.r AND g.c >= h.c THEN 0 WHEN g.r >= h.r AND g.c > h.c THEN 1 WHEN g.r > h.r AND g.c <= h.c THEN 2 ELSE 3 END AS q
  FROM hole h JOIN fx_grid g ON g.r BETWEEN h.r - 10 AND h.r + 10 AND g.c BETWEEN h.c - 10 AND h.c + 10
  WHERE g.dem IS NOT NULL AND (g.r - h.r)*(g.r - h.r) + (g.c - h.c)*(g.c - h.c) <= 100),
pick AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY r, c, q ORDER BY dr*dr + dc*dc, dr, dc) AS k FROM near),
fill AS (SELECT r, c, SUM(dem / sqrt(dr*dr + dc*dc)) / SUM(1 / sqrt(dr*dr + dc*dc)) AS v FROM pick WHERE k = 1 GROUP BY 1, 2)
SELECT g.r AS row, g.c AS col, ROUND(COALESCE(g.dem, f.v), 6) AS value FROM fx_grid g LEFT JOIN fill f USING (r, c)""", (G,))
def r4(spark, d):
    return raster.fill_nodata(base.raster(spark, d, "dem")).withColumn("value", F.round("value", 6))


@query("r5_raster_statistics", """
SELECT COUNT(*) AS cells, MAX(r) - MIN(r) + 1 AS nrows, MAX(c) - MIN(c) + 1 AS ncols, MIN(dem) AS min, MAX(dem) AS max,
  ROUND(AVG(dem), 6) AS mean, COUNT(*) FILTER (WHERE dem IS NULL) AS nodata FROM fx_grid""", (G,))
def r5(spark, d):
    return raster.statistics(base.raster(spark, d, "dem")).withColumn("mean", F.round("mean", 6))


HORN = """e AS (SELECT r, c,
  SUM(CASE dc WHEN 0 THEN 0 ELSE dc * (CASE dr WHEN 0 THEN 2 ELSE 1 END) * dem END) / 1280 AS gx,
  SUM(CASE dr WHEN 0 THEN 0 ELSE dr * (CASE dc WHEN 0 THEN 2 ELSE 1 END) * dem END) / 1280 AS gy, COUNT(dem) AS n
  FROM (SELECT a.r, a.c, b.r - a.r AS dr, b.c - a.c AS dc, b.dem FROM fx_grid a JOIN fx_grid b
    ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1) GROUP BY 1, 2),
grad AS (SELECT r AS row, c AS col, CASE WHEN n = 9 THEN gx END AS gx, CASE WHEN n = 9 THEN gy END AS gy FROM e)"""


def _grad(spark, d):
    return raster.gradients(base.raster(spark, d, "dem"), SURFACE_GRID.cell)


@query("r8_slope", f"WITH {HORN} SELECT row, col, ROUND(degrees(atan(sqrt(gx*gx + gy*gy))), 6) AS value FROM grad", (G,))
def r8(spark, d):
    return raster.slope_degrees(_grad(spark, d)).withColumn("value", F.round("value", 6))


@query("r9_hillshade_and_aspect", f"""WITH {HORN},
s AS (SELECT *, ((-gx) * sin(radians(315)) * cos(radians(45)) + gy * cos(radians(315)) * cos(radians(45)) + sin(radians(45)))
    / sqrt(gx*gx + gy*gy + 1) AS light,  -- surface normal (-dz/deast, -dz/dnorth, 1) times the unit vector to the light
  degrees(atan2(gy, -gx)) AS deg FROM grad)
SELECT row, col, ROUND(CASE WHEN light <= 0 THEN 1.0 ELSE 1.0 + 254 * light END, 4) AS shade,
  ROUND(CASE WHEN gx = 0 AND gy = 0 THEN NULL WHEN deg > 90 THEN 450 - deg ELSE 90 - deg END, 4) AS aspect FROM s""", (G,))
def r9(spark, d):
    grad = stored(_grad(spark, d))
    shade = raster.hillshade(grad).withColumnRenamed("value", "shade")
    aspect = raster.aspect_degrees(grad).withColumnRenamed("value", "aspect")
    return shade.join(aspect, ["row", "col"]).select("row", "col", F.round("shade", 4).alias("shade"), F.round("aspect", 4).alias("aspect"))


def _ramp_sql(value: str, stops, band: int) -> str:
    parts = [f"WHEN {value} IS NULL THEN 0", f"WHEN {value} <= {stops[0][0]} THEN {stops[0][band]}"]
    parts += [f"WHEN {value} < {b[0]} THEN CAST(floor({a[band]} + ({value} - {a[0]}) / ({b[0]} - {a[0]}) * ({b[band]} - {a[band]}) + 0.5) AS INT)"
              for a, b in zip(stops, stops[1:])]
    return "CASE " + " ".join(parts) + f" ELSE {stops[-1][band]} END"


@query("r10_colour_relief", "SELECT r AS row, c AS col, " + ", ".join(
    f"{_ramp_sql('dem', raster.ELEVATION_STOPS, k)} AS {n}" for k, n in ((1, "red"), (2, "green"), (3, "blue"))) + " FROM fx_grid", (G,))
def r10(spark, d):
    colours = raster.ramp(c("value"), raster.ELEVATION_STOPS)
    return base.raster(spark, d, "dem").select("row", "col", *[v.alias(k) for k, v in colours.items()])


@query("r11_polygon_cells", f"SELECT z.id, g.r AS row, g.c AS col FROM fx_landuse z JOIN (SELECT r, c FROM range(250) AS a(r), range(120) AS b(c)) g ON {ON_SURFACE}", (L,))
def r11(spark, d):
    grid = Grid(SURFACE_GRID.x0, SURFACE_GRID.y0, SURFACE_GRID.cell, nrows=250, ncols=120)
    return zones.polygon_cells(base.landuse(spark, d), grid, ["id"]).select(
        "id", c("row").cast("long").alias("row"), c("col").cast("long").alias("col"))


@query("r12_zonal_summary", f"""
SELECT z.id, ROUND(AVG(g.dem), 6) AS mean, MAX(g.dem) AS max, COUNT(g.dem) AS count
FROM fx_landuse z JOIN fx_grid g ON {ON_SURFACE} GROUP BY 1""", (L, G))
def r12(spark, d):
    return tiles.zonal_summary(base.landuse(spark, d), base.tiles(spark, d, "dem"), SURFACE_GRID, ["id"]).withColumn(
        "mean", F.round("mean", 6))


@query("r13_zonal_histogram", f"""
SELECT z.id, CAST(g.nlcd AS DOUBLE) AS value, COUNT(*) AS pixel_count FROM fx_landuse z JOIN fx_grid g ON {ON_SURFACE}
WHERE g.nlcd IS NOT NULL GROUP BY 1, 2""", (L, G))
def r13(spark, d):
    return tiles.zonal_histogram(base.landuse(spark, d), base.tiles(spark, d, "nlcd"), SURFACE_GRID, ["id"])


@query("r14_value_at_point", f"""WITH {CENTRED} SELECT id, g.dem AS value FROM cb LEFT JOIN fx_grid g USING (r, c)""", (B, G))
def r14(spark, d):
    pts = fixtures.load(spark, d, B).select("id", (c("x0") + c("w") / 2.0).alias("x"), (c("y0") + c("h") / 2.0).alias("y"))
    return tiles.value_at_points(pts, c("x"), c("y"), base.tiles(spark, d, "dem"), SURFACE_GRID, "left").select("id", "value")


@query("r15_land_cover_classes", f"""WITH {COVER}
SELECT id AS lu_id, landuse AS osm_landuse, CAST(area_m2 AS DOUBLE) AS area_m2, code AS nlcd_code, n AS pixel_count,
  ROUND(CAST(n * 900.0 / SUM(n) OVER (PARTITION BY id) AS DOUBLE), 1) AS coverage_pct, {NLCD_LABEL} AS nlcd_class FROM hist""", (L, G))
def r15(spark, d):
    return _cover(spark, d).select("lu_id", "osm_landuse", "area_m2", "nlcd_code", "pixel_count", "coverage_pct", "nlcd_class")


@query("x10_code_to_text", f"""
SELECT code AS nlcd_code, {NLCD_LABEL} AS nlcd_class, COUNT(*) AS n FROM (SELECT nlcd AS code FROM fx_grid WHERE nlcd IS NOT NULL) GROUP BY ALL""", (G,))
def x10(spark, d):
    codes = base.raster(spark, d, "nlcd").filter(c("value").isNotNull()).select(c("value").cast("int").alias("nlcd_code"))
    return at.with_land_cover(codes).groupBy("nlcd_code", "nlcd_class").agg(F.count("*").alias("n"))


@query("r16_buildings_with_elevation", f"""WITH {CENTRED}
SELECT id, {sqltext.HEIGHT} AS height_m, CAST(w * h AS DOUBLE) AS area_m2, g.dem AS ground_elevation_m FROM cb JOIN fx_grid g USING (r, c)""", (B, G))
def r16(spark, d):
    b = stored(layers.processed_buildings(base.buildings(spark, d, False)))
    return layers.buildings_with_elevation(b, base.tiles(spark, d, "dem"), SURFACE_GRID).select(
        "id", "height_m", "area_m2", "ground_elevation_m")


@query("r17_scale_to_byte", """
SELECT r AS row, c AS col, CAST(floor((dem - lo) / (hi - lo) * 255 + 0.5) AS INT) AS byte
FROM fx_grid, (SELECT MIN(dem) AS lo, MAX(dem) AS hi FROM fx_grid)""", (G,))
def r17(spark, d):
    return raster.scale_to_byte(base.raster(spark, d, "dem"))


@query("r18_tile_constraints", """
SELECT 'dem' AS raster, COUNT(*) AS tiles, TRUE AS same_srid, TRUE AS same_cell, TRUE AS aligned
FROM (SELECT DISTINCT floor(r / 16), floor(c / 16) FROM fx_grid)""", (G,))
def r18(spark, d):
    size = SURFACE_GRID.cell * 16
    grids = tiles.to_tiles(base.raster(spark, d, "dem"), 16).select(F.lit("dem").alias("raster"), F.lit(SURFACE_GRID.srid).alias("srid"), F.lit(SURFACE_GRID.cell).alias("cell"),
                         (F.lit(SURFACE_GRID.x0) + c("tcol") * size).alias("x0"), (F.lit(SURFACE_GRID.y0) - c("trow") * size).alias("y0"))
    return raster.tile_constraints(grids)


# ── suitability ─────────────────────────────────────────────────────────────
_SCORES = f"""{sqltext.NEAREST}, {CENTRED},
score AS (SELECT cb.id, CAST(ROUND_EVEN(GREATEST(0.0, LEAST(100.0, 50.0 - COALESCE(g.slope, 0) * 2 + LEAST(30.0, w * h / 100.0)
  + CASE WHEN COALESCE(dist, 9999) < 50 THEN 20 ELSE 0 END)), 0) AS INT) AS suitability_score
  FROM cb LEFT JOIN fx_grid g USING (r, c) LEFT JOIN near USING (id))"""


def _scores(spark, d):
    b = base.buildings(spark, d).withColumn("area_m2", g.rounded_area(c("geom")))
    access = layers.buildings_road_access(base.buildings(spark, d), base.roads(spark, d))
    return layers.land_suitability(b, access, base.tiles(spark, d, "slope"), SURFACE_GRID)


@query("l10_land_suitability", f"{_SCORES} SELECT id, suitability_score FROM score", (B, R, G))
def l10(spark, d):
    return _scores(spark, d).select("id", "suitability_score")


@query("a15_score_histogram", f"""{_SCORES}
SELECT CAST(ROUND(suitability_score / 10.0) * 10 AS INT) AS score_bucket, COUNT(*) AS parcel_count FROM score GROUP BY 1""", (B, R, G))
def a15(spark, d):
    return layers.score_histogram(_scores(spark, d))


# ── point cloud ─────────────────────────────────────────────────────────────
@query("s13_point_cloud_scan", "SELECT COUNT(*) AS n, SUM(classification) AS classes, MAX(z) AS top FROM fx_points", (P,))
def s13(spark, d):
    pts = stored(base.points(spark, d), "points")
    return pts.agg(F.count("*").alias("n"), F.sum("classification").alias("classes"), F.max("z").alias("top"))


@query("f8_point_attribute_range", """
SELECT classification, return_number, COUNT(*) AS n FROM fx_points WHERE classification BETWEEN 2 AND 6 AND return_number BETWEEN 1 AND 1 GROUP BY 1, 2""", (P,))
def f8(spark, d):
    kept = pointcloud.in_range(pointcloud.in_range(base.points(spark, d), "classification", 2, 6), "return_number", 1, 1)
    return kept.groupBy("classification", "return_number").agg(F.count("*").alias("n"))


_CLASSES = """hist AS (SELECT classification, COALESCE(t, 'Class ' || classification) AS label, COUNT(*) AS points,
  COUNT(*) * 100.0 / (SELECT COUNT(*) FROM fx_points) AS pct FROM fx_points LEFT JOIN (VALUES """ + ", ".join(
    f"({k}, '{t}')" for k, t in at.POINT_CLASSES) + """) AS v(k, t) ON k = classification GROUP BY 1, 2)"""


@query("a16_point_class_histogram", f"WITH {_CLASSES} SELECT classification, label, points, ROUND(pct, 6) AS pct FROM hist", (P,))
def a16(spark, d):
    return pointcloud.class_histogram(base.points(spark, d)).withColumn("pct", F.round("pct", 6))


_EXTENT = ("COUNT(*) AS point_count, MIN(x) AS x_min, MAX(x) AS x_max, MIN(y) AS y_min, MAX(y) AS y_max, MIN(z) AS z_min, MAX(z) AS z_max")


@query("a17_point_cloud_extent", f"SELECT {_EXTENT} FROM fx_points", (P,))
def a17(spark, d):
    return pointcloud.extent(base.points(spark, d))


@query("p6_inspect_point_cloud", f"""WITH {_CLASSES}
SELECT classification, label, points, ROUND(pct, 1) AS pct, e.* FROM hist, (SELECT {_EXTENT} FROM fx_points) e""", (P,))
def p6(spark, d):
    return pointcloud.inspect(base.points(spark, d)).withColumn("pct", F.round("pct", 1))


_LOWEST = """low AS (SELECT CAST(floor(4400240 - y) AS INT) AS r, CAST(floor(x - 500000) AS INT) AS c, MIN(z) AS z FROM fx_points GROUP BY 1, 2)"""


@query("p1_lowest_surface", f"WITH {_LOWEST} SELECT r AS row, c AS col, z AS value FROM low", (P,))
def p1(spark, d):
    return pointcloud.lowest_surface(base.points(spark, d), POINT_GRID)


def _opening_sql(source: str, name: str, r: int, keys: str = "r, c") -> str:
    """Opening on a dense grid: separable running minimum, then maximum; only cells with data count."""
    def over(fn, col, part, order):
        return f"{fn}({col}) OVER (PARTITION BY {part} ORDER BY {order} RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING)"
    return f"""{name}_a AS (SELECT *, {over('MIN', 'v', 'r', 'c')} AS m FROM {source}),
{name}_b AS (SELECT * EXCLUDE (m), CASE WHEN has THEN {over('MIN', 'm', 'c', 'r')} END AS m FROM {name}_a),
{name}_c AS (SELECT * EXCLUDE (m), {over('MAX', 'm', 'r', 'c')} AS m FROM {name}_b),
{name} AS (SELECT * EXCLUDE (m), CASE WHEN has THEN {over('MAX', 'm', 'c', 'r')} END AS o FROM {name}_c)"""


_DENSE = f"""{_LOWEST}, dense AS (SELECT a.r, b.c, low.z AS v, low.z IS NOT NULL AS has, FALSE AS flag
  FROM range(241) AS a(r) CROSS JOIN range(240) AS b(c) LEFT JOIN low ON low.r = a.r AND low.c = b.c)"""


@query("p2_morphological_opening", f"""WITH {_DENSE}, {_opening_sql('dense', 'op', 3)}
SELECT r AS row, c AS col, o AS value FROM op WHERE has""", (P,))
def p2(spark, d):
    out = raster.opening(pointcloud.lowest_surface(base.points(spark, d), POINT_GRID), 3, tile=64)   # 16 tiles
    return out.select(c("row").cast("long").alias("row"), c("col").cast("long").alias("col"), "value")


def _smrf_sql() -> str:
    steps, source = [], "dense"
    for r in range(1, 19):
        steps.append(_opening_sql(source, f"o{r}", r))
        steps.append(f"s{r} AS (SELECT r, c, o AS v, has, flag OR COALESCE(v - o > 0.2 * {r}, FALSE) AS flag FROM o{r})")
        source = f"s{r}"
    return f"""WITH {_DENSE}, {', '.join(steps)},
bare AS (SELECT s.r, s.c, CASE WHEN NOT s.flag THEN d.v END AS v FROM s18 s JOIN dense d ON d.r = s.r AND d.c = s.c WHERE s.has),
near AS (SELECT h.r, h.c, g.v, g.r - h.r AS dr, g.c - h.c AS dc,
  CASE WHEN g.r < h.r AND g.c >= h.c THEN 0 WHEN g.r >= h.r AND g.c > h.c THEN 1 WHEN g.r > h.r AND g.c <= h.c THEN 2 ELSE 3 END AS q
  FROM (SELECT * FROM bare WHERE v IS NULL) h JOIN bare g ON g.r BETWEEN h.r - 10 AND h.r + 10 AND g.c BETWEEN h.c - 10 AND h.c + 10
  WHERE g.v IS NOT NULL AND (g.r - h.r)*(g.r - h.r) + (g.c - h.c)*(g.c - h.c) <= 100),
pick AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY r, c, q ORDER BY dr*dr + dc*dc, dr, dc) AS k FROM near),
fill AS (SELECT r, c, SUM(v / sqrt(dr*dr + dc*dc)) / SUM(1 / sqrt(dr*dr + dc*dc)) AS v FROM pick WHERE k = 1 GROUP BY 1, 2),
ground AS (SELECT b.r, b.c, COALESCE(b.v, f.v) AS v FROM bare b LEFT JOIN fill f ON f.r = b.r AND f.c = b.c),
tilt AS (SELECT a.r, a.c, CASE WHEN COUNT(b.v) = 9 THEN sqrt(power(SUM((b.c - a.c) * (CASE b.r - a.r WHEN 0 THEN 2 ELSE 1 END) * b.v) / 8, 2)
    + power(SUM((b.r - a.r) * (CASE b.c - a.c WHEN 0 THEN 2 ELSE 1 END) * b.v) / 8, 2)) ELSE 0.0 END AS t
  FROM ground a JOIN ground b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2)
SELECT p.x, p.y, p.z, p.classification AS given, CASE WHEN abs(p.z - g.v) <= 0.45 + 1.2 * t.t THEN 2 ELSE 1 END AS found
FROM fx_points p LEFT JOIN ground g ON g.r = CAST(floor(4400240 - p.y) AS INT) AND g.c = CAST(floor(p.x - 500000) AS INT)
LEFT JOIN tilt t ON t.r = g.r AND t.c = g.c"""


@query("p3_ground_classification", _smrf_sql(), (P,))
def p3(spark, d):
    pts = base.points(spark, d).withColumnRenamed("classification", "given")
    return pointcloud.classify_ground(pts, POINT_GRID, tile=64).select("x", "y", "z", "given", c("classification").alias("found"))


_CELLS = """SELECT i // 240 AS r, i % 240 AS c, 500000 + (i % 240) + 0.5 AS cx, 4400240 - (i // 240) - 0.5 AS cy FROM range(241*240) AS q(i)"""


def _gridded(name: str, where: str, radius: float, value: str) -> str:
    """Points keyed by cell, joined to the cell centres around them."""
    n = int(radius + 1)
    return f"""{name}_k AS (SELECT *, CAST(floor(4400240 - y) AS INT) AS pr, CAST(floor(x - 500000) AS INT) AS pc FROM fx_points WHERE {where}),
{name}_o AS (SELECT pr + dr AS r, pc + dc AS c, x, y, z FROM {name}_k, range(-{n}, {n + 1}) AS a(dr), range(-{n}, {n + 1}) AS b(dc)),
{name}_d AS (SELECT r, c, z, sqrt(power(x - (500000 + c + 0.5), 2) + power(y - (4400240 - (r + 0.5)), 2)) AS d FROM {name}_o
  WHERE r BETWEEN 0 AND 240 AND c BETWEEN 0 AND 239),
{name} AS (SELECT r, c, {value} AS v FROM {name}_d WHERE d <= {radius} GROUP BY 1, 2)"""


_DSM = _gridded("dsm", "return_number BETWEEN 1 AND 1", 1.5, "MAX(z)")
_DTM = _gridded("dtm", "classification BETWEEN 2 AND 2", 2.0,
                "COALESCE(MIN(CASE WHEN d = 0 THEN z END), SUM(CASE WHEN d > 0 THEN z/d END) / SUM(CASE WHEN d > 0 THEN 1/d END))")
_NDSM = f"""WITH {_DSM}, {_DTM}, ndsm AS (SELECT r, c, CASE WHEN s.v IS NOT NULL AND t.v IS NOT NULL THEN GREATEST(s.v - t.v, 0.0) END AS v
  FROM dsm s FULL JOIN dtm t USING (r, c))"""


@query("p4_grid_maximum", f"WITH {_DSM} SELECT r AS row, c AS col, v AS value FROM dsm", (P,))
def p4(spark, d):
    out = pointcloud.surface_model(base.points(spark, d), POINT_GRID)
    return out.select(c("row").cast("long").alias("row"), c("col").cast("long").alias("col"), "value")


@query("p5_grid_inverse_distance", f"WITH {_DTM} SELECT r AS row, c AS col, ROUND(v, 6) AS value FROM dtm", (P,))
def p5(spark, d):
    out = pointcloud.terrain_model(base.points(spark, d), POINT_GRID)
    return out.select(c("row").cast("long").alias("row"), c("col").cast("long").alias("col"), F.round("value", 6).alias("value"))


def _ndsm(spark, d):
    pts = base.points(spark, d)
    return raster.above_ground(pointcloud.surface_model(pts, POINT_GRID), pointcloud.terrain_model(pts, POINT_GRID))


@query("j11_raster_raster_join", f"WITH {_DSM}, {_DTM} SELECT r AS row, c AS col, ROUND(dsm.v - dtm.v, 6) AS gap FROM dsm JOIN dtm USING (r, c)", (P,))
def j11(spark, d):
    pts = base.points(spark, d)
    s = pointcloud.surface_model(pts, POINT_GRID).withColumnRenamed("value", "s")
    t = pointcloud.terrain_model(pts, POINT_GRID).withColumnRenamed("value", "t")
    return s.join(t, ["row", "col"]).select(c("row").cast("long").alias("row"), c("col").cast("long").alias("col"),
                                            F.round(c("s") - c("t"), 6).alias("gap"))


@query("r6_above_ground", f"{_NDSM} SELECT r AS row, c AS col, ROUND(v, 6) AS value FROM ndsm", (P,))
def r6(spark, d):
    return _ndsm(spark, d).select(c("row").cast("long").alias("row"), c("col").cast("long").alias("col"), F.round("value", 6).alias("value"))


@query("r7_highest_above_ground", f"{_NDSM} SELECT ROUND(MAX(v), 1) AS highest FROM ndsm", (P,))
def r7(spark, d):
    return _ndsm(spark, d).agg(F.round(F.max("value"), 1).alias("highest"))


_LIDAR = f"""{_NDSM}, lidar AS (SELECT z.id, z.height_m, AVG(n.v) AS mean, MAX(n.v) AS top, COUNT(n.v) AS n
  FROM fx_roofs z JOIN ndsm n ON n.c BETWEEN CAST(ceil(z.x0 - 500000 - 0.5) AS INT) AND CAST(ceil(z.x0 + z.w - 500000 - 0.5) AS INT) - 1
   AND 4400240 - (n.r + 0.5) >= z.y0 AND 4400240 - (n.r + 0.5) < z.y0 + z.h WHERE z.w * z.h > 50 GROUP BY ALL)"""


def _lidar(spark, d):
    return layers.buildings_lidar_height(base.roofs(spark, d), stored(tiles.to_tiles(_ndsm(spark, d)), "ndsm"), POINT_GRID)


@query("l8_lidar_heights", f"{_LIDAR} SELECT id, ROUND(mean, 6) AS lidar_height_m, ROUND(top, 6) AS lidar_max_m, n AS pixel_count FROM lidar", (P, K))
def l8(spark, d):
    return _lidar(spark, d).select("id", F.round("lidar_height_m", 6).alias("lidar_height_m"),
                                   F.round("lidar_max_m", 6).alias("lidar_max_m"), "pixel_count")


@query("l8_height_bands", f"""{_LIDAR}
SELECT {sqltext.band('mean', at.HEIGHT_BANDS, at.HEIGHT_BAND_REST)} AS height_category, COUNT(*) AS building_count FROM lidar GROUP BY 1""", (P, K))
def l8_bands(spark, d):
    return layers.height_bands(_lidar(spark, d))


@query("t2_height_discrepancy", f"""{_LIDAR}
SELECT id, ROUND(height_m, 1) AS osm_height_m, ROUND(mean, 1) AS lidar_height_m, ROUND(ABS(height_m - mean), 1) AS discrepancy_m
FROM lidar WHERE height_m IS NOT NULL AND mean IS NOT NULL ORDER BY discrepancy_m DESC, id LIMIT 20""", (P, K))
def t2(spark, d):
    return layers.height_discrepancy(base.roofs(spark, d), _lidar(spark, d))
