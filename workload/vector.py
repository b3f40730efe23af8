"""Sources, filters, geometry expressions, attributes and vector joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane import fixtures
from terrane.functions import attributes as at
from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.functions import projection
from terrane.functions.simplify import simplify
from terrane.operators import filters, joins, zones
from terrane.plans import layers
from terrane.schema import UTM13N, WGS84
from terrane.session import scratch_path, stored
from terrane.sources import vector as src
from workload import base, sqltext
from workload.base import query

B, R, L = "fx_buildings", "fx_roads", "fx_landuse"
c = F.col


# ── sources and sinks ───────────────────────────────────────────────────────
def _features_on_disk(spark, d, label):
    """The building layer as GeoJSON text in plain projected numbers."""
    path = scratch_path(spark, label)
    base.buildings(spark, d, False).select(
        src.feature_text(["id", "height", "name", "building"]).alias("value")).write.text(path)
    return path


PROPS = "id long, height string, name string, building string"


@query("s1_read_geojson", """
SELECT id, height, name, building, 'Polygon' AS kind, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 + h AS DOUBLE) AS ymax,
  CAST(w * h AS DOUBLE) AS area FROM fx_buildings""", (B,))
def s1(spark, d):
    df = src.read_features(spark, _features_on_disk(spark, d, "geojson"), PROPS, default_srid=UTM13N)
    box = g.bbox(c("geom"))
    return df.select("id", "height", "name", "building", c("geom.kind").alias("kind"), box["xmin"].alias("xmin"),
                     box["ymax"].alias("ymax"), g.area(c("geom")).alias("area"))


@query("s1_read_collections", """
SELECT id, height, name, building, 32613 AS srid, CAST(x0 AS DOUBLE) AS xmin, CAST(w * h AS DOUBLE) AS area FROM fx_buildings""", (B,))
def s1_collections(spark, d):
    """The building layer in FeatureCollection documents of a thousand features that name their CRS."""
    path = scratch_path(spark, "collections")
    text = src.feature_text(["id", "height", "name", "building"])
    head = F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::32613"}},"features":[')
    docs = base.buildings(spark, d, False).groupBy(F.floor(c("id") / 1000)).agg(F.collect_list(text).alias("f"))
    docs.select(F.concat(head, F.concat_ws(",", "f"), F.lit("]}"))).write.text(path)
    df = src.read_features(spark, path, PROPS, "collection")
    return df.select("id", "height", "name", "building", c("geom.srid").alias("srid"), g.bbox(c("geom"))["xmin"].alias("xmin"), g.area(c("geom")).alias("area"))


@query("s2_read_named_layer", "SELECT landuse, COUNT(*) AS n FROM fx_landuse GROUP BY 1", (L,))
def s2(spark, d):
    root = scratch_path(spark, "store")
    src.write_layer(base.landuse(spark, d), root, "raw.landuse")
    return src.read_layer(spark, root, "raw.landuse").groupBy("landuse").agg(F.count("*").alias("n"))


@query("s3_default_crs", "SELECT 4326 AS srid, COUNT(*) AS n FROM fx_buildings", (B,))
def s3(spark, d):
    df = src.read_features(spark, _features_on_disk(spark, d, "geojson"), PROPS)
    return df.groupBy(c("geom.srid").alias("srid")).agg(F.count("*").alias("n"))


@query("s4_write_layer_overwrite", """
SELECT id, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin, CAST(w * h AS DOUBLE) AS area FROM fx_buildings""", (B,))
def s4(spark, d):
    root = scratch_path(spark, "store")
    df = base.buildings(spark, d)
    src.write_layer(df, root, "raw.buildings", block_level=6)
    src.write_layer(df, root, "raw.buildings", block_level=6)
    return src.read_layer(spark, root, "raw.buildings").select("id", "xmin", "ymin", g.area(c("geom")).alias("area"))


@query("s5_promote_to_multi", "SELECT 'MultiPolygon' AS kind, COUNT(*) AS n FROM fx_buildings", (B,))
def s5(spark, d):
    df = base.buildings(spark, d, False).select(g.promote_to_multi(c("geom")).alias("geom"))
    return df.groupBy(c("geom.kind").alias("kind")).agg(F.count("*").alias("n"))


@query("s6_assign_ids", """
SELECT id AS source_id, ROW_NUMBER() OVER (ORDER BY x0, y0, id) AS fid FROM fx_buildings""", (B,))
def s6(spark, d):
    df = fixtures.load(spark, d, B).select("id", "x0", "y0")
    return src.assign_ids(df, ["x0", "y0", "id"], "fid").select(c("id").alias("source_id"), "fid")


@query("s9_catalogue_first_item", """
SELECT url, 'https://data.example/' || page_id || '-a.tif' AS download_url FROM pages WHERE page_id % 3 = 0""")
def s9(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    link = F.concat(F.lit('{"items":[{"downloadURL":"https://data.example/'), c("page_id").cast("string"),
                    F.lit('-a.tif"},{"downloadURL":"https://data.example/'), c("page_id").cast("string"), F.lit('-b.tif"}]}'))
    body = F.when(c("page_id") % 3 == 0, link).when(c("page_id") % 3 == 1, '{"items":[]}').otherwise('{"total":0}')
    return src.first_download(pages.withColumn("body", body)).select("url", "download_url")


@query("s10_create_table_as", "SELECT id, CAST(w * h AS DOUBLE) AS area FROM fx_landuse", (L,))
def s10(spark, d):
    src.create_namespaces(spark, scratch_path(spark, "warehouse"))
    df = base.landuse(spark, d, False).select("id", g.area(c("geom")).alias("area"))
    name = "processed." + scratch_path(spark, "landuse").rsplit("/", 1)[1].replace("-", "_")
    src.create_table(df.limit(0), name)
    return src.create_table(df, name)


@query("s12_export_wgs84", """
SELECT id, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin, CAST(x0 + w AS DOUBLE) AS xmax,
  CAST(y0 + h AS DOUBLE) AS ymax FROM fx_landuse""", (L,))
def s12(spark, d):
    path = scratch_path(spark, "export")
    src.write_features(base.landuse(spark, d, False), path, ["id", "landuse"], digits=9)
    back = src.standardise(src.read_features(spark, path, "id long, landuse string"))
    box = g.bbox(c("geom"))
    return back.select("id", *[F.round(v, 1).alias(k) for k, v in box.items()])


@query("s14_create_namespaces", """
SELECT n AS namespace, COUNT(*) AS layers_expected FROM (SELECT UNNEST(['raw', 'processed', 'analysis']) AS n), region
GROUP BY 1""")
def s14(spark, d):
    src.create_namespaces(spark, scratch_path(spark, "warehouse"))
    have = spark.sql("SHOW DATABASES").select("namespace").filter(c("namespace").isin(src.NAMESPACES))
    rows = spark.read.parquet(f"{d}/region.parquet").agg(F.count("*").alias("layers_expected"))
    return have.join(F.broadcast(rows))


# ── filters ─────────────────────────────────────────────────────────────────
@query("f1_bbox_filter", """
SELECT id FROM fx_buildings WHERE x0 + w >= 495000 AND x0 <= 501000 AND y0 + h >= 4390000 AND y0 <= 4399000""", (B,))
def f1(spark, d):
    return filters.in_bbox(base.buildings(spark, d), 495000, 4390000, 501000, 4399000).select("id")


@query("f2_tag_present", "SELECT id, landuse FROM fx_landuse WHERE landuse IS NOT NULL", (L,))
def f2(spark, d):
    return filters.has_tag(base.landuse(spark, d, False), "landuse").select("id", "landuse")


@query("f3_geometry_kind", "SELECT 'Polygon' AS kind, COUNT(*) AS n FROM fx_buildings", (B,))
def f3(spark, d):
    mixed = base.buildings(spark, d, False).select("geom").unionByName(base.roads(spark, d, False).select("geom"))
    return filters.of_kind(mixed).groupBy(c("geom.kind").alias("kind")).agg(F.count("*").alias("n"))


def _bow_ties(spark, d):
    """Buildings, every fifth with two corners swapped so that its ring crosses itself."""
    k = fixtures.load(spark, d, B)
    x0, y0, x1, y1 = c("x0"), c("y0"), c("x0") + c("w"), c("y0") + c("h")
    swap = c("id") % 5 == 0
    ring = F.array(g.vertex(x0, y0), g.vertex(x1, F.when(swap, y1).otherwise(y0)),
                   g.vertex(x1, F.when(swap, y0).otherwise(y1)), g.vertex(x0, y1), g.vertex(x0, y0))
    return k.select("id", "height", "name", "building", g.geometry("Polygon", F.array(F.array(ring))).alias("geom"))


@query("f4_valid_only", "SELECT id FROM fx_buildings WHERE id % 5 <> 0", (B,))
def f4(spark, d):
    return filters.valid(_bow_ties(spark, d)).select("id")


@query("f5_sliver_filter", "SELECT id, CAST(w * h AS DOUBLE) AS area_m2 FROM fx_buildings WHERE w * h > 10", (B,))
def f5(spark, d):
    return filters.larger_than(base.buildings(spark, d, False)).select("id", g.rounded_area(c("geom")).alias("area_m2"))


@query("f6_minimum_area", """
SELECT 'buildings' AS layer, COUNT(*) AS n FROM fx_buildings WHERE w * h > 50
UNION ALL SELECT 'landuse', COUNT(*) FROM fx_landuse WHERE w * h > 1000""", (B, L))
def f6(spark, d):
    parts = [filters.larger_than(df, m, rounded=False).agg(F.count("*").alias("n")).select(F.lit(n).alias("layer"), "n")
             for n, df, m in (("buildings", base.buildings(spark, d, False), 50.0),
                              ("landuse", base.landuse(spark, d, False), 1000.0))]
    return parts[0].unionByName(parts[1])


@query("f7_major_roads", f"""
WITH r AS (SELECT id, {sqltext.HIGHWAY} AS highway FROM fx_roads)
SELECT id, highway FROM r WHERE highway IN ('motorway','trunk','primary','secondary','tertiary')""", (R,))
def f7(spark, d):
    tagged = base.roads(spark, d, False).withColumn("highway", at.first_tag(c("highway")))
    return filters.major_roads(tagged).select("id", "highway")


@query("f13_join_name_collision", f"""
SELECT b.id, l.landuse FROM fx_buildings b LEFT JOIN fx_landuse l ON {sqltext.WITHIN}""", (B, L))
def f13(spark, d):
    left = base.buildings(spark, d).withColumn("landuse", c("building"))
    return layers.buildings_with_landuse(left, base.landuse(spark, d)).select("id", "landuse")


@query("f14_not_null_filters", f"""
SELECT COUNT(*) AS with_height, AVG({sqltext.HEIGHT}) AS mean_height FROM fx_buildings WHERE {sqltext.HEIGHT} IS NOT NULL""", (B,))
def f14(spark, d):
    h = at.parse_height(c("height"))
    df = fixtures.load(spark, d, B).select(h.alias("h")).filter(c("h").isNotNull())
    return df.agg(F.count("*").alias("with_height"), F.avg("h").alias("mean_height"))


# ── geometry expressions ────────────────────────────────────────────────────
@query("g1_to_utm_round_trip", """
SELECT id, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin, CAST(x0 + w AS DOUBLE) AS xmax,
  CAST(y0 + h AS DOUBLE) AS ymax, 32613 AS srid FROM fx_buildings""", (B,))
def g1(spark, d):
    lonlat = stored(base.buildings(spark, d, False).select("id", projection.reproject(c("geom"), WGS84).alias("geom")))
    back = lonlat.select("id", projection.reproject(c("geom"), UTM13N).alias("geom"))
    return back.select("id", c("geom.srid").alias("srid"), *[F.round(v, 3).alias(k) for k, v in g.bbox(c("geom")).items()])


@query("g2_to_lonlat", f"""
SELECT id, ROUND({sqltext.LON}, 8) AS lon, ROUND({sqltext.LAT}, 8) AS lat FROM ({sqltext.inverse_utm('fx_buildings')})""", (B,))
def g2(spark, d):
    v = g.first_vertex(projection.reproject(c("geom"), WGS84))
    return base.buildings(spark, d, False).select("id", v.alias("v")).select(
        "id", F.round("v.x", 8).alias("lon"), F.round("v.y", 8).alias("lat"))


@query("g3_area", "SELECT id, CAST(w * h AS DOUBLE) AS area_m2 FROM fx_buildings", (B,))
def g3(spark, d):
    return base.buildings(spark, d, False).select("id", g.rounded_area(c("geom")).alias("area_m2"))


@query("g4_centroid", "SELECT id, x0 + w / 2.0 AS x, y0 + h / 2.0 AS y FROM fx_buildings", (B,))
def g4(spark, d):
    return base.buildings(spark, d, False).select("id", g.centroid(c("geom")).alias("p")).select("id", "p.x", "p.y")


@query("g5_distance", f"""
WITH {sqltext.SEGMENTS}, n AS (SELECT MAX(id) AS n FROM fx_roads),
pair AS (SELECT b.*, s.* EXCLUDE (id), b.id % n.n + 1 AS road FROM fx_buildings b, n, seg s WHERE s.id = b.id % n.n + 1)
SELECT id, road, ROUND(MIN({sqltext.RECT_SEGMENT}), 6) AS dist FROM pair GROUP BY 1, 2""", (B, R))
def g5(spark, d):
    roads = base.roads(spark, d, False).select(c("id").alias("road"), c("geom").alias("line"))
    top = roads.agg(F.max("road").alias("n"))
    pairs = base.buildings(spark, d, False).join(F.broadcast(top)).withColumn("road", c("id") % c("n") + 1)
    return pairs.join(roads, "road").select("id", "road", F.round(pred.distance(c("geom"), c("line")), 6).alias("dist"))


@query("g6_bounding_box", """
SELECT id, CAST(LEAST(x0, x1, x2) AS DOUBLE) AS xmin, CAST(LEAST(y0, y1, y2) AS DOUBLE) AS ymin,
  CAST(GREATEST(x0, x1, x2) AS DOUBLE) AS xmax, CAST(GREATEST(y0, y1, y2) AS DOUBLE) AS ymax FROM fx_roads""", (R,))
def g6(spark, d):
    return base.roads(spark, d).select("id", "xmin", "ymin", "xmax", "ymax")


@query("g7_validity", """
SELECT CASE WHEN id % 5 = 0 THEN 'self-intersection' END AS reason, COUNT(*) AS n FROM fx_buildings GROUP BY 1""", (B,))
def g7(spark, d):
    return _bow_ties(spark, d).select(pred.invalid_reason(c("geom")).alias("reason")).groupBy("reason").agg(
        F.count("*").alias("n"))


@query("g8_make_valid", """
SELECT id, CASE WHEN id % 5 = 0 THEN w * h / 2.0 ELSE w * h END AS area,
  CASE WHEN id % 5 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind FROM fx_buildings""", (B,))
def g8(spark, d):
    return _bow_ties(spark, d).select("id", pred.make_valid(c("geom")).alias("geom")).select(
        "id", F.round(g.area(c("geom")), 6).alias("area"), c("geom.kind").alias("kind"))


@query("g9_is_simple", """
SELECT id, x2 IS NULL OR NOT ((x1-x0)*(y2-y1) = (y1-y0)*(x2-x1) AND (x1-x0)*(x2-x1) + (y1-y0)*(y2-y1) < 0) AS simple
FROM fx_roads""", (R,))
def g9(spark, d):
    return base.roads(spark, d, False).select("id", pred.is_simple(c("geom")).alias("simple"))


@query("g10_set_srid", """
SELECT 'buildings' AS layer, 32613 AS srid, COUNT(*) AS n FROM fx_buildings
UNION ALL SELECT 'roads', 32613, COUNT(*) FROM fx_roads""", (B, R))
def g10(spark, d):
    parts = [df.select(F.lit(n).alias("layer"), g.set_srid(c("geom"), UTM13N)["srid"].alias("srid"))
             for n, df in (("buildings", base.buildings(spark, d, False)), ("roads", base.roads(spark, d, False)))]
    return parts[0].unionByName(parts[1]).groupBy("layer", "srid").agg(F.count("*").alias("n"))


@query("g11_to_wkt", """
SELECT id, printf('POLYGON((%d.00 %d.00, %d.00 %d.00, %d.00 %d.00, %d.00 %d.00, %d.00 %d.00))',
  x0, y0, x0 + w, y0, x0 + w, y0 + h, x0, y0 + h, x0, y0) AS wkt FROM fx_landuse""", (L,))
def g11(spark, d):
    return base.landuse(spark, d, False).select("id", g.to_wkt(c("geom")).alias("wkt"))


@query("g12_simplify", f"""
WITH q AS (SELECT *, {sqltext.point_segment('x1', 'y1', 'x0', 'y0', 'x2', 'y2')} AS gap FROM fx_roads)
SELECT id, CASE WHEN x2 IS NOT NULL AND gap > 100 THEN 3 ELSE 2 END AS vertices,
  CAST(COALESCE(x2, x1) AS DOUBLE) AS last_x FROM q""", (R,))
def g12(spark, d):
    v = g.vertices(c("geom"))
    return simplify(base.roads(spark, d, False), 100.0).select(
        "id", F.size(v).alias("vertices"), F.element_at(v, -1)["x"].alias("last_x"))


@query("g13_buffer_polygons", f"""
WITH {sqltext.SEGMENTS}
SELECT id, COUNT(*) AS rings, ROUND(SUM(100 * sqrt((ex-ax)*(ex-ax) + (ey-ay)*(ey-ay)) + 2500 * 16 * sin(pi() / 16)), 3) AS area
FROM seg WHERE ax <> ex OR ay <> ey GROUP BY 1""", (R,))
def g13(spark, d):
    rings = zones.buffer_polygons(base.roads(spark, d, False), ["id"], 50.0)
    return rings.filter(g.area(c("geom")) > 0).groupBy("id").agg(
        F.count("*").alias("rings"), F.round(F.sum(g.area(c("geom"))), 3).alias("area"))


# ── attributes ──────────────────────────────────────────────────────────────
@query("x1_parse_height", f"""
SELECT id, {sqltext.HEIGHT} AS by_pattern, TRY_CAST(height AS DOUBLE) AS by_coercion FROM fx_buildings""", (B,))
def x1(spark, d):
    return fixtures.load(spark, d, B).select("id", at.parse_height(c("height")).alias("by_pattern"),
                                             at.parse_height(c("height"), "coerce").alias("by_coercion"))


@query("x2_estimated_floors", f"""
SELECT id, CAST(ROUND({sqltext.HEIGHT} / 3.0) AS INT) AS floors, CAST(ROUND_EVEN({sqltext.HEIGHT} / 3.0, 0) AS INT) AS floors_even
FROM fx_buildings""", (B,))
def x2(spark, d):
    h = at.parse_height(c("height"))
    return fixtures.load(spark, d, B).select("id", at.estimated_floors(h).alias("floors"),
                                             at.estimated_floors(h, "half_even").alias("floors_even"))


@query("x3_missing_column", """
SELECT id, height, CAST(NULL AS DOUBLE) AS levels FROM fx_buildings""", (B,))
def x3(spark, d):
    df = fixtures.load(spark, d, B)
    return df.select("id", at.column_or_null(df, "height", "string").alias("height"),
                     at.column_or_null(df, "levels", "double").alias("levels"))


@query("x4_first_tag", f"SELECT id, {sqltext.HIGHWAY} AS highway FROM fx_roads", (R,))
def x4(spark, d):
    return base.roads(spark, d, False).select("id", at.first_tag(c("highway")).alias("highway"))


@query("x5_band_labels", f"""
SELECT id, {sqltext.band('h', at.HEIGHT_BANDS, at.HEIGHT_BAND_REST)} AS band
FROM (SELECT id, {sqltext.HEIGHT} AS h FROM fx_buildings)""", (B,))
def x5(spark, d):
    return fixtures.load(spark, d, B).select("id", at.band(
        at.parse_height(c("height")), at.HEIGHT_BANDS, at.HEIGHT_BAND_REST).alias("band"))


@query("x6_suitability_score", """
SELECT id, CAST(ROUND_EVEN(GREATEST(0.0, LEAST(100.0, 50.0 - COALESCE(slope, 0) * 2 + LEAST(30.0, area / 100.0)
  + CASE WHEN COALESCE(dist, 9999) < 50 THEN 20 ELSE 0 END)), 0) AS INT) AS score
FROM (SELECT id, CASE WHEN id % 4 > 0 THEN CAST(id % 46 AS DOUBLE) END AS slope, CAST(w * h AS DOUBLE) AS area,
  CASE WHEN id % 5 > 0 THEN CAST(id % 300 AS DOUBLE) END AS dist FROM fx_buildings)""", (B,))
def x6(spark, d):
    slope = F.when(c("id") % 4 > 0, (c("id") % 46).cast("double"))
    dist = F.when(c("id") % 5 > 0, (c("id") % 300).cast("double"))
    return fixtures.load(spark, d, B).select("id", at.suitability(
        slope, (c("w") * c("h")).cast("double"), dist).alias("score"))


@query("x7_height_colour", f"""
SELECT id, CASE WHEN h IS NULL OR h = 0 THEN '#2166ac' WHEN h < 5 THEN '#2166ac' WHEN h < 15 THEN '#74add1'
  WHEN h < 30 THEN '#fdae61' ELSE '#d73027' END AS colour
FROM (SELECT id, {sqltext.HEIGHT} AS h FROM fx_buildings)""", (B,))
def x7(spark, d):
    return fixtures.load(spark, d, B).select("id", at.height_colour(at.parse_height(c("height"))).alias("colour"))


@query("x8_score_colour", """
SELECT id, CASE WHEN s IS NULL THEN '#888888' WHEN s < 25 THEN '#d73027' WHEN s < 50 THEN '#fc8d59'
  WHEN s < 75 THEN '#91cf60' ELSE '#1a9641' END AS colour
FROM (SELECT id, CASE WHEN id % 6 > 0 THEN id % 101 END AS s FROM fx_buildings)""", (B,))
def x8(spark, d):
    score = F.when(c("id") % 6 > 0, c("id") % 101)
    return fixtures.load(spark, d, B).select("id", at.score_colour(score).alias("colour"))


@query("x9_arithmetic", f"""
SELECT id, ROUND(w * h / 1e6, 6) AS km2, ABS({sqltext.HEIGHT} - w) AS gap, 1600.5 + {sqltext.HEIGHT} AS top FROM fx_buildings""", (B,))
def x9(spark, d):
    h = at.parse_height(c("height"))
    return fixtures.load(spark, d, B).select("id", F.round(c("w") * c("h") / 1e6, 6).alias("km2"),
                                             F.abs(h - c("w")).alias("gap"), (h + 1600.5).alias("top"))


@query("x11_coalesce_defaults", f"""{sqltext.NEAREST}
SELECT b.id, COALESCE(n.dist, 9999.0) AS dist, CASE WHEN COALESCE(n.dist, 9999.0) < 50 THEN 20 ELSE 0 END AS bonus
FROM fx_buildings b LEFT JOIN near n ON n.id = b.id AND n.dist < 500""", (B, R))
def x11(spark, d):
    buildings = base.buildings(spark, d)
    near = joins.nearest_join(buildings, base.roads(spark, d)).filter("dist < 500").select("id", c("dist").alias("road"))
    dist = F.coalesce("road", F.lit(9999.0))
    return buildings.select("id").join(near, "id", "left").select("id", dist.alias("dist"), F.when(dist < 50, 20).otherwise(0).alias("bonus"))


@query("x12_first_present_column", f"SELECT id, COALESCE({sqltext.HEIGHT}, 0) AS height FROM fx_buildings", (B,))
def x12(spark, d):
    df = fixtures.load(spark, d, B).select("id", at.parse_height(c("height")).alias("height_m"))
    return df.select("id", at.first_present(df, ["lidar_height_m", "height_m", "height"]).alias("height"))


# ── joins ───────────────────────────────────────────────────────────────────
@query("j1_within_left_join", f"""
SELECT b.id, l.id AS zone_id, l.landuse FROM fx_buildings b LEFT JOIN fx_landuse l ON {sqltext.WITHIN}""", (B, L))
def j1(spark, d):
    return joins.within_join(base.buildings(spark, d), base.landuse(spark, d), ["landuse"]).select(
        "id", "zone_id", "landuse")


def _tagged_roads(spark, d):
    return base.roads(spark, d).withColumn("highway", at.first_tag(c("highway")))


@query("j2_within_buffer_zone", f"{sqltext.IN_ZONE} SELECT id, highway FROM inside", (B, R))
def j2(spark, d):
    return zones.within_zones(base.buildings(spark, d), filters.major_roads(_tagged_roads(spark, d)))


@query("j5_inner_join_on_id", f"""
SELECT b.id, CAST(b.w * b.h AS DOUBLE) AS area, {sqltext.HEIGHT} AS height_m FROM fx_buildings b JOIN fx_buildings k USING (id)""".replace(
    "(height", "(b.height"), (B,))
def j5(spark, d):
    areas = base.buildings(spark, d, False).select("id", g.area(c("geom")).alias("area"))
    heights = fixtures.load(spark, d, B).select("id", at.parse_height(c("height")).alias("height_m"))
    return areas.join(heights, "id")


@query("j6_left_join_chain", """
SELECT b.id, l.landuse, r.tag1 AS tag FROM fx_buildings b LEFT JOIN fx_landuse l USING (id) LEFT JOIN fx_roads r USING (id)""", (B, L, R))
def j6(spark, d):
    zones_ = base.landuse(spark, d, False).select("id", "landuse")
    tags = fixtures.load(spark, d, R).select("id", c("tag1").alias("tag"))
    return fixtures.load(spark, d, B).select("id").join(zones_, "id", "left").join(tags, "id", "left")


@query("j7_nearest_road", f"{sqltext.NEAREST} SELECT id, nearest_id, dist FROM near", (B, R))
def j7(spark, d):
    return joins.nearest_join(base.buildings(spark, d), base.roads(spark, d))


@query("j8_nearest_without_candidates", """
SELECT 'left' AS how, COUNT(*) AS n, 0 AS matched FROM fx_buildings UNION ALL SELECT 'inner', 0, 0""", (B,))
def j8(spark, d):
    none, b = base.roads(spark, d).filter(F.lit(False)), base.buildings(spark, d)
    parts = [joins.nearest_join(b, none, how).agg(F.count("*").alias("n"), F.count("dist").alias("matched")).select(
        F.lit(how).alias("how"), "n", "matched") for how in ("left", "inner")]
    return parts[0].unionByName(parts[1])


@query("j10_within_distance_self_join", f"""
WITH {sqltext.NEIGHBOURS} SELECT a, b, ROUND(dist, 6) AS dist FROM nb""", (B,))
def j10(spark, d):
    b = base.buildings(spark, d).select("id", "geom", "xmin", "ymin", "xmax", "ymax")
    return joins.distance_pairs(b, b, 100.0).select(c("l_id").alias("a"), c("r_id").alias("b"), g.rounded(c("dist"), 6).alias("dist"))


# ── aggregations ────────────────────────────────────────────────────────────
@query("a1_group_count_without_nulls", """
SELECT landuse, COUNT(*) AS n FROM fx_landuse WHERE landuse IS NOT NULL GROUP BY 1""", (L,))
def a1(spark, d):
    return layers.count_by_class(fixtures.load(spark, d, L), "landuse", "n")


@query("a2_top_values", f"""
SELECT {sqltext.HIGHWAY} AS highway, COUNT(*) AS n FROM fx_roads GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""", (R,))
def a2(spark, d):
    return layers.count_by_class(base.roads(spark, d, False).withColumn("highway", at.first_tag(c("highway"))),
                                 "highway", "n").limit(10)


@query("a3_layer_statistics", """
SELECT CAST(MIN(w*h) AS DOUBLE) AS area_min, CAST(MAX(w*h) AS DOUBLE) AS area_max, ROUND(AVG(w*h), 6) AS area_mean,
  COUNT(TRY_CAST(height AS DOUBLE)) AS tagged, ROUND(AVG(TRY_CAST(height AS DOUBLE)), 6) AS height_mean,
  MAX(TRY_CAST(height AS DOUBLE)) AS height_max FROM fx_buildings WHERE w * h > 10""", (B,))
def a3(spark, d):
    df = layers.raw_buildings(base.buildings(spark, d, False))
    return df.agg(F.min("area_m2").alias("area_min"), F.max("area_m2").alias("area_max"),
                  F.round(F.avg("area_m2"), 6).alias("area_mean"), F.count("height_m").alias("tagged"),
                  F.round(F.avg("height_m"), 6).alias("height_mean"), F.max("height_m").alias("height_max"))


@query("a4_global_rounded", f"""
SELECT COUNT(*) AS buildings, ROUND(AVG({sqltext.HEIGHT}), 1) AS avg_height_m, ROUND(CAST(SUM(w * h) AS DOUBLE)) AS total_footprint_m2
FROM fx_buildings""", (B,))
def a4(spark, d):
    df = base.buildings(spark, d, False).select(at.parse_height(c("height")).alias("h"), g.rounded_area(c("geom")).alias("a"))
    return df.agg(F.count("*").alias("buildings"), F.round(F.avg("h"), 1).alias("avg_height_m"),
                  F.round(F.sum("a"), 0).alias("total_footprint_m2"))


@query("a6_buffer_dissolve", f"""{sqltext.ZONE_RUNS}
SELECT highway, k, ROUND(SUM(hi - lo), 2) AS covered_m FROM runs GROUP BY 1, 2""", (R,))
def a6(spark, d):
    runs = layers.road_influence(_tagged_roads(spark, d))
    return runs.groupBy("highway", "k").agg(F.round(F.sum(c("hi") - c("lo")), 2).alias("covered_m"))


@query("a7_zone_area", f"""{sqltext.ZONE_RUNS}
SELECT highway, ROUND(SUM(hi - lo) * 5.0 / 1e6, 3) AS area_km2, 5.0 AS dy_m FROM runs GROUP BY 1
UNION ALL SELECT 'all', ROUND(SUM(hi - lo) * 5.0 / 1e6, 3), 5.0 FROM runs_all""", (R,))
def a7(spark, d):
    major = filters.major_roads(_tagged_roads(spark, d))
    per_class = zones.zone_area(zones.buffer_zones(major, ["highway"]), ["highway"])
    union = zones.zone_area(zones.buffer_zones(major, []), []).select(F.lit("all").alias("highway"), "area_km2", "dy_m")
    return per_class.unionByName(union)


@query("a13_bands_by_lowest", f"""{sqltext.NEAREST}
SELECT {sqltext.band('dist', at.ROAD_BANDS, at.ROAD_BAND_REST)} AS distance_band, COUNT(*) AS building_count,
  MIN(dist) AS nearest FROM near GROUP BY 1""", (B, R))
def a13(spark, d):
    near = joins.nearest_join(base.buildings(spark, d), base.roads(spark, d))
    return (near.groupBy(at.band(c("dist"), at.ROAD_BANDS, at.ROAD_BAND_REST).alias("distance_band"))
            .agg(F.count("*").alias("building_count"), F.min("dist").alias("nearest")).orderBy("nearest"))


@query("a18_layer_count_and_srid", "SELECT 32613 AS srid, COUNT(*) AS features FROM fx_roads", (R,))
def a18(spark, d):
    return base.roads(spark, d, False).groupBy(c("geom.srid").alias("srid")).agg(F.count("*").alias("features"))


# ── recipes ─────────────────────────────────────────────────────────────────
@query("l1_raw_buildings", """
SELECT id, CAST(w * h AS DOUBLE) AS area_m2, TRY_CAST(height AS DOUBLE) AS height_m,
  CAST(ROUND_EVEN(TRY_CAST(height AS DOUBLE) / 3.0, 0) AS INT) AS est_floors FROM fx_buildings WHERE w * h > 10""", (B,))
def l1(spark, d):
    return layers.raw_buildings(base.buildings(spark, d, False)).select("id", "area_m2", "height_m", "est_floors")


@query("l2_raw_roads", f"""
SELECT id, {sqltext.HIGHWAY} AS highway, CAST(LEAST(x0, x1, x2) AS DOUBLE) AS xmin FROM fx_roads
WHERE x0 <> x1 OR y0 <> y1 OR x2 IS NOT NULL""", (R,))
def l2(spark, d):
    return layers.raw_roads(base.roads(spark, d, False)).select("id", "highway", "xmin")


@query("l3_raw_landuse", "SELECT id, landuse, CAST(w * h AS DOUBLE) AS area_m2 FROM fx_landuse", (L,))
def l3(spark, d):
    return layers.raw_landuse(base.landuse(spark, d, False)).select("id", "landuse", "area_m2")


@query("l4_buildings_per_landuse", f"""
SELECT l.landuse, COUNT(*) AS building_count FROM fx_buildings b JOIN fx_landuse l ON {sqltext.WITHIN}
WHERE b.w * b.h > 10 AND l.landuse IS NOT NULL GROUP BY 1""", (B, L))
def l4(spark, d):
    buildings = stored(layers.raw_buildings(base.buildings(spark, d, False)))
    landuse = stored(layers.raw_landuse(base.landuse(spark, d, False)))
    return layers.count_by_class(layers.buildings_with_landuse(buildings, landuse), "landuse", "building_count")


@query("l5_processed_buildings", f"""
SELECT id, name, building, {sqltext.HEIGHT} AS height_m, CAST(ROUND({sqltext.HEIGHT} / 3.0) AS INT) AS est_floors,
  CASE WHEN id % 5 = 0 THEN 0.0 ELSE w * h END AS area_m2,
  CASE WHEN id % 5 = 0 THEN ROUND(w * h / 2.0, 1) ELSE w * h END AS area_repaired_m2 FROM fx_buildings""", (B,))
def l5(spark, d):
    return layers.processed_buildings(_bow_ties(spark, d)).select(
        "id", "name", "building", "height_m", "est_floors", "area_m2", "area_repaired_m2")


@query("l6_road_influence", f"""{sqltext.ZONE_RUNS}
SELECT highway, ROUND(SUM(hi - lo) * 5.0 / 1e6, 3) AS area_km2 FROM runs GROUP BY 1""", (R,))
def l6(spark, d):
    runs = layers.road_influence(stored(layers.raw_roads(base.roads(spark, d, False))))
    return zones.zone_area(runs, ["highway"]).select("highway", "area_km2").orderBy(F.desc("area_km2"))


# boxes less the overlaps of neighbouring lines: shells less holes
@query("l11_zones_map", f"""{sqltext.ZONE_RUNS},
box AS (SELECT highway, COUNT(*) AS n, ROUND(SUM(hi - lo) * 5.0 / 1e6, 3) AS area_km2 FROM runs GROUP BY 1),
overlap AS (SELECT a.highway, COUNT(*) AS n FROM runs a JOIN runs b ON a.highway = b.highway AND b.k = a.k + 1 AND a.lo < b.hi AND b.lo < a.hi GROUP BY 1)
SELECT highway, area_km2, CAST(box.n - COALESCE(overlap.n, 0) AS BIGINT) AS shells_less_holes FROM box LEFT JOIN overlap USING (highway)""", (R,))
def l11_zones(spark, d):
    """Zone polygons written as GeoJSON and read back."""
    runs = stored(layers.road_influence(stored(layers.raw_roads(base.roads(spark, d, False)))))
    path = scratch_path(spark, "zones")
    src.write_features(layers.zones_map(runs, ["highway"]), path, ["highway"], digits=11)
    back = src.standardise(src.read_features(spark, path, "highway string"))
    rings = back.select("highway", g.area(c("geom")).alias("a"), F.size(g.paths(c("geom"))).alias("rings"))
    return rings.groupBy("highway").agg(F.round(F.sum("a") / 1e6, 3).alias("area_km2"), F.sum(F.lit(2) - c("rings")).cast("long").alias("shells_less_holes"))


@query("l7_buildings_near_roads", f"""{sqltext.IN_ZONE}
SELECT COUNT(*) AS buildings_near_roads, ROUND(AVG({sqltext.HEIGHT}), 1) AS avg_height_m,
  ROUND(CAST(SUM(w * h) AS DOUBLE)) AS total_footprint_m2, COUNT(DISTINCT id) AS distinct_buildings
FROM inside JOIN fx_buildings USING (id)""", (B, R))
def l7(spark, d):
    b = stored(layers.processed_buildings(base.buildings(spark, d, False)))
    near = layers.buildings_near_roads(b, _tagged_roads(spark, d))
    return near.agg(F.count("*").alias("buildings_near_roads"), F.round(F.avg("height_m"), 1).alias("avg_height_m"),
                    F.round(F.sum("area_m2"), 0).alias("total_footprint_m2"),
                    F.count_distinct("id").alias("distinct_buildings"))


@query("l9_road_access_bands", f"""{sqltext.NEAREST}
SELECT {sqltext.band('dist', at.ROAD_BANDS, at.ROAD_BAND_REST)} AS distance_band, COUNT(*) AS building_count FROM near GROUP BY 1""", (B, R))
def l9(spark, d):
    return layers.road_access_bands(layers.buildings_road_access(base.buildings(spark, d), base.roads(spark, d)))
