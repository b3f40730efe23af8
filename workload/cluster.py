"""Clusters, components, quality control, map exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane import fixtures
from terrane.fixtures import POINT_GRID, SURFACE_GRID
from terrane.functions import attributes as at
from terrane.functions import geometry as g
from terrane.operators import cluster, qc
from terrane.plans import layers
from terrane.schema import UTM13N, WGS84
from terrane.session import scratch_path, stored
from terrane.sources import vector as src
from workload import base, sqltext
from workload.base import query
from workload.raster import _NDSM, _SCORES, _ndsm, _scores
from workload.vector import _bow_ties

B, R, L, G, P, K = "fx_buildings", "fx_roads", "fx_landuse", "fx_grid", "fx_points", "fx_roofs"
c = F.col

CLUSTERS = f"""{sqltext.NEIGHBOURS},
core AS (SELECT a AS id FROM nb GROUP BY 1 HAVING COUNT(*) >= 5),
edge AS (SELECT a, b FROM nb WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, label) AS (SELECT id, id FROM core UNION SELECT e.b, r.label FROM reach r JOIN edge e ON e.a = r.id WHERE r.label < e.b),
lab AS (SELECT id, MIN(label) AS label FROM reach GROUP BY 1),
border AS (SELECT nb.a AS id, MIN(lab.label) AS label FROM nb JOIN lab ON lab.id = nb.b WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY 1),
member AS (SELECT * FROM lab UNION ALL SELECT * FROM border),
clusters AS (SELECT f.id, DENSE_RANK() OVER (ORDER BY m.label) - 1 AS cluster_id FROM fx_buildings f JOIN member m USING (id)),
labelled AS (SELECT f.*, k.cluster_id FROM fx_buildings f LEFT JOIN clusters k USING (id))"""


def _clusters(spark, d):
    return cluster.dbscan(base.buildings(spark, d))


@query("c1_density_clusters", f"WITH {CLUSTERS} SELECT id, cluster_id FROM labelled", (B,))
def c1(spark, d):
    return _clusters(spark, d)


@query("w2_whole_table_clustering", f"WITH {CLUSTERS} SELECT COUNT(DISTINCT cluster_id) AS clusters, COUNT(*) AS features FROM labelled", (B,))
def w2(spark, d):
    return _clusters(spark, d).agg(F.count_distinct("cluster_id").alias("clusters"), F.count("*").alias("features"))


def _with_area(spark, d):
    return base.buildings(spark, d).withColumn("area_m2", g.rounded_area(c("geom")))


@query("a8_cluster_summary", f"""WITH {CLUSTERS}
SELECT cluster_id, COUNT(*) AS building_count, ROUND(CAST(SUM(w * h) AS DOUBLE)) AS total_footprint_m2 FROM labelled
WHERE cluster_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", (B,))
def a8(spark, d):
    out = cluster.cluster_summary(_with_area(spark, d), _clusters(spark, d))
    return out.select("cluster_id", "building_count", "total_footprint_m2").orderBy(F.desc("building_count"), "cluster_id").limit(10)


@query("a9_cluster_centroid", f"""WITH {CLUSTERS},
box AS (SELECT cluster_id, x0, x0 + w AS x1, y0, y0 + h AS y1 FROM labelled WHERE cluster_id IS NOT NULL),
cut AS (SELECT DISTINCT cluster_id, UNNEST([x0, x1]) AS x FROM box),
slab AS (SELECT cluster_id, x AS xa, LEAD(x) OVER (PARTITION BY cluster_id ORDER BY x) AS xb FROM cut),
run AS (SELECT s.cluster_id, xa, xb, y0, y1, MAX(y1) OVER (PARTITION BY s.cluster_id, xa ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM slab s JOIN box b ON b.cluster_id = s.cluster_id AND b.x0 <= xa AND b.x1 >= xb),
piece AS (SELECT cluster_id, (xb - xa) * (y1 - GREATEST(y0, COALESCE(reach, y0))) AS a, (xa + xb) / 2.0 AS x, (y1 + GREATEST(y0, COALESCE(reach, y0))) / 2.0 AS y
  FROM run WHERE reach IS NULL OR y1 > reach)
SELECT cluster_id, CAST(SUM(a) AS DOUBLE) AS union_m2, ROUND(SUM(a * x) / SUM(a), 3) AS x, ROUND(SUM(a * y) / SUM(a), 3) AS y FROM piece GROUP BY 1""", (B,))
def a9(spark, d):
    out = cluster.cluster_summary(_with_area(spark, d), _clusters(spark, d))
    return out.select("cluster_id", F.round("union_m2", 3).alias("union_m2"), F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query("a10_clustered_share", f"""WITH {CLUSTERS}
SELECT COUNT(cluster_id) AS in_cluster, COUNT(*) AS total, ROUND(COUNT(cluster_id) * 100.0 / COUNT(*), 1) AS pct_in_cluster FROM labelled""", (B,))
def a10(spark, d):
    return cluster.clustered_share(_clusters(spark, d))


COMPONENTS = """edge AS (SELECT u AS a, v AS b FROM fx_roads UNION SELECT v, u FROM fx_roads),
reach(node, label) AS (SELECT a, a FROM edge UNION SELECT e.b, r.label FROM reach r JOIN edge e ON e.a = r.node WHERE r.label < e.b),
comp AS (SELECT node, MIN(label) AS component FROM reach GROUP BY 1)"""


@query("c2_connected_components", f"WITH {COMPONENTS} SELECT node, component FROM comp", (R,))
def c2(spark, d):
    return cluster.connected_components(fixtures.load(spark, d, R).select("u", "v"))


@query("c3_largest_road_component", f"""WITH {COMPONENTS},
big AS (SELECT component FROM comp GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
SELECT id, u, v FROM fx_roads WHERE u IN (SELECT node FROM comp JOIN big USING (component))""", (R,))
def c3(spark, d):
    return cluster.largest_component(fixtures.load(spark, d, R).select("id", "u", "v"))


# ── quality control ─────────────────────────────────────────────────────────
def _layers(spark, d):
    """Three layers in the target system and one left in longitude/latitude."""
    foreign = base.landuse(spark, d, False).select("id", "landuse", g.set_srid(c("geom"), WGS84).alias("geom"))
    return {"raw.buildings": base.buildings(spark, d, False), "raw.roads": base.roads(spark, d, False),
            "raw.landuse": base.landuse(spark, d, False), "raw.landuse_lonlat": foreign}


@query("q1_crs_consistency", """
SELECT 'raw.buildings' AS layer, 32613 AS srid, COUNT(*) AS features, 'OK' AS status FROM fx_buildings
UNION ALL SELECT 'raw.roads', 32613, COUNT(*), 'OK' FROM fx_roads UNION ALL SELECT 'raw.landuse', 32613, COUNT(*), 'OK' FROM fx_landuse
UNION ALL SELECT 'raw.landuse_lonlat', 4326, COUNT(*), 'FAIL' FROM fx_landuse""", (B, R, L))
def q1(spark, d):
    return qc.crs_consistency(_layers(spark, d))


VALIDITY = """validity AS (
SELECT 'raw.buildings' AS layer, COUNT(*) FILTER (WHERE id % 5 = 0) AS invalid, COUNT(*) AS total FROM fx_buildings
UNION ALL SELECT 'raw.roads', COUNT(*) FILTER (WHERE x2 IS NOT NULL AND (x1-x0)*(y2-y1) = (y1-y0)*(x2-x1) AND (x1-x0)*(x2-x1) + (y1-y0)*(y2-y1) < 0), COUNT(*) FROM fx_roads
UNION ALL SELECT 'raw.landuse', 0, COUNT(*) FROM fx_landuse)"""


def _validity(spark, d):
    return qc.geometry_validity({"raw.buildings": (_bow_ties(spark, d), "valid"), "raw.roads": (base.roads(spark, d, False), "simple"),
                                 "raw.landuse": (base.landuse(spark, d, False), "valid")})


@query("q2_geometry_validity", f"""WITH {VALIDITY}
SELECT layer, invalid, total, ROUND(invalid * 100.0 / total, 2) AS pct, CASE WHEN invalid * 100.0 / total < 1 THEN 'OK' ELSE 'WARN' END AS status FROM validity""", (B, R, L))
def q2(spark, d):
    return _validity(spark, d)


def _ranges(spark, d):
    return qc.raster_ranges({"dem": base.raster(spark, d, "dem"), "slope": base.raster(spark, d, "slope")}, spark)


@query("q3_raster_ranges", """
WITH s AS (SELECT 'dem' AS raster, 1500.0 AS lo, 2200.0 AS hi, MIN(dem) AS min, MAX(dem) AS max, AVG(dem) AS mean, COUNT(*) - COUNT(dem) AS gaps, COUNT(*) AS n FROM fx_grid
UNION ALL SELECT 'slope', 0.0, 90.0, MIN(slope), MAX(slope), AVG(slope), COUNT(*) - COUNT(slope), COUNT(*) FROM fx_grid)
SELECT raster, lo, hi, min, max, ROUND(mean, 6) AS mean, ROUND(gaps * 100.0 / n, 6) AS nodata_pct, CASE WHEN min >= lo AND max <= hi * 1.2 THEN 'OK' ELSE 'WARN' END AS status FROM s
UNION ALL SELECT 'ndsm', 0.0, 250.0, NULL, NULL, NULL, NULL, 'SKIP'""", (G,))
def q3(spark, d):
    return _ranges(spark, d).select("raster", "lo", "hi", "min", "max", F.round("mean", 6).alias("mean"),
                                    F.round("nodata_pct", 6).alias("nodata_pct"), "status")


@query("q4_attribute_completeness", f"""
WITH k AS (SELECT COUNT(*) AS n, COUNT({sqltext.HEIGHT}) AS h, COUNT(name) AS m FROM fx_buildings)
SELECT 'processed.buildings' AS layer, 'height_m' AS attribute, n AS total, h AS filled, ROUND(h * 100.0 / n, 1) AS pct FROM k
UNION ALL SELECT 'processed.buildings', 'name', n, m, ROUND(m * 100.0 / n, 1) FROM k
UNION ALL SELECT 'raw.landuse', 'landuse', COUNT(*), COUNT(landuse), ROUND(COUNT(landuse) * 100.0 / COUNT(*), 1) FROM fx_landuse""", (B, L))
def q4(spark, d):
    b = fixtures.load(spark, d, B).select("name", at.parse_height(c("height")).alias("height_m"))
    return qc.completeness(b, "processed.buildings", ["height_m", "name"]).unionByName(
        qc.completeness(fixtures.load(spark, d, L), "raw.landuse", ["landuse"]))


_TILED = "SELECT COUNT(*) AS n FROM (SELECT DISTINCT r // 256, c // 256 FROM fx_grid)"


def _catalogue(spark, d):
    return qc.raster_catalogue({"raw." + n: (base.tiles(spark, d, n), SURFACE_GRID) for n in ("dem", "nlcd")})


@query("q5_load_report", f"""
SELECT 'raw.buildings' AS layer, COUNT(*) AS features, CAST(NULL AS BIGINT) AS tiles, '32613' AS srids, 'LOADED' AS status FROM fx_buildings
UNION ALL SELECT 'raw.roads', COUNT(*), NULL, '32613', 'LOADED' FROM fx_roads UNION ALL SELECT 'raw.landuse', COUNT(*), NULL, '32613', 'LOADED' FROM fx_landuse
UNION ALL SELECT 'processed.buildings', NULL, NULL, NULL, 'NOT LOADED' UNION ALL SELECT 'raw.ndsm', NULL, NULL, NULL, 'NOT LOADED'
UNION ALL SELECT 'raw.' || name, NULL, n, '32613', 'LOADED' FROM ({_TILED}), (VALUES ('dem'), ('nlcd')) v(name)""", (B, R, L, G))
def q5(spark, d):
    expected = ["raw.buildings", "raw.roads", "raw.landuse", "processed.buildings", "raw.dem", "raw.ndsm", "raw.nlcd"]
    return qc.load_report(expected, _layers(spark, d), spark, _catalogue(spark, d))


@query("q5_raster_catalogue", f"""
SELECT 'raw.' || name AS layer, 32613 AS srid, 160.0 AS resolution_m, n AS tiles, cells, filled, ROUND((1 - filled / cells) * 100, 2) AS nodata_pct, ROUND(mean, 6) AS mean,
  CAST(lr AS INT) AS last_trow FROM ({_TILED}), (SELECT 'dem' AS name, COUNT(*) AS cells, COUNT(dem) AS filled, AVG(dem) AS mean, MAX(r) // 256 AS lr FROM fx_grid
  UNION ALL SELECT 'nlcd', COUNT(*), COUNT(nlcd), AVG(nlcd), MAX(r) // 256 FROM fx_grid)""", (G,))
def q5_rasters(spark, d):
    return _catalogue(spark, d).select("layer", "srid", "resolution_m", "tiles", "cells", "filled", "nodata_pct", F.round("mean", 6).alias("mean"), "last_trow")


@query("s15_skip_missing_layer", """
SELECT 'raw.buildings' AS layer, COUNT(*) AS features, 'done' AS outcome FROM fx_buildings
UNION ALL SELECT 'raw.dem', NULL, 'skipped'""", (B,))
def s15(spark, d):
    root = scratch_path(spark, "store")
    src.write_layer(base.buildings(spark, d, False), root, "raw.buildings")
    return layers.run_available(spark, root, ["raw.buildings", "raw.dem"])


# fixed values: what the registry says of each layer
_OSM = ("OpenStreetMap", "2024-01-01", None, "osmnx download → ogr2ogr → PostGIS")
_DESCRIBED = [("raw", n, "vector", *_OSM) for n in ("buildings", "roads", "landuse")] + [
    ("raw", "dem", "raster", "USGS 3DEP 1/3 arc-sec", "2023-01-01", 10.0, "gdalwarp UTM → gdal_fillnodata → raster2pgsql")]


def _registry(spark, d):
    """Layer descriptions with counted features or tiles, appended twice as two runs would."""
    described = spark.createDataFrame(_DESCRIBED, "schema_name string, layer_name string, data_type string, source string, source_date string, resolution_m double, lineage string")
    counts = qc.layer_counts({k: v for k, v in _layers(spark, d).items() if k != "raw.landuse_lonlat"}).select("layer", "features")
    counts = counts.unionByName(_catalogue(spark, d).select("layer", F.col("tiles").alias("features"))).select(
        F.split("layer", "[.]")[0].alias("schema_name"), F.split("layer", "[.]")[1].alias("layer_name"), F.col("features").alias("feature_count"))
    path = scratch_path(spark, "registry")
    for _ in range(2):
        qc.append_metadata(qc.metadata_rows(described.withColumn("source_date", F.col("source_date").cast("date")), counts), path)
    return spark.read.parquet(path)


_META = f"""m AS (SELECT 'raw' AS schema_name, 'buildings' AS layer_name, COUNT(*) AS feature_count FROM fx_buildings
UNION ALL SELECT 'raw', 'roads', COUNT(*) FROM fx_roads UNION ALL SELECT 'raw', 'landuse', COUNT(*) FROM fx_landuse
UNION ALL SELECT 'raw', 'dem', n FROM ({_TILED})),
about(layer_name, data_type, source, source_date, resolution_m, lineage) AS (VALUES """ + ", ".join(
    f"('{n}', '{kind}', '{source}', '{day}', {'NULL' if res is None else res}::DOUBLE, '{lineage}')" for _, n, kind, source, day, res, lineage in _DESCRIBED) + ")"


@query("s11_append_metadata", f"WITH {_META} SELECT m.*, 'EPSG:32613' AS crs FROM m, range(2)", (B, R, L, G))
def s11(spark, d):
    return _registry(spark, d).select("schema_name", "layer_name", "feature_count", "crs")


@query("q6_metadata_registry", f"WITH {_META} SELECT schema_name, layer_name, feature_count, data_type, source, source_date, resolution_m, lineage FROM m JOIN about USING (layer_name)", (B, R, L, G))
def q6(spark, d):
    return qc.latest_metadata(_registry(spark, d)).select("schema_name", "layer_name", "feature_count", "data_type", "source",
                                                          F.col("source_date").cast("string").alias("source_date"), "resolution_m", "lineage")


@query("q7_summary", f"""WITH {VALIDITY}
SELECT 1 AS crs_mismatches, CAST(SUM(invalid) AS BIGINT) AS geometry_issues, 0 AS raster_warnings,
  (1 + SUM(invalid)) || ' issue(s) found' AS status FROM validity""", (B, R, L))
def q7(spark, d):
    return qc.summary(qc.crs_consistency(_layers(spark, d)), _validity(spark, d), _ranges(spark, d))


# ── map export tables ───────────────────────────────────────────────────────
@query("l11_suitability_map", f"""{_SCORES}
SELECT id, suitability_score, CASE WHEN suitability_score < 25 THEN '#d73027' WHEN suitability_score < 50 THEN '#fc8d59'
  WHEN suitability_score < 75 THEN '#91cf60' ELSE '#1a9641' END AS colour, 5 AS vertices FROM score""", (B, R, G))
def l11_suitability(spark, d):
    out = layers.suitability_map(_scores(spark, d).select("id", "geom", "suitability_score"), 0.0001)
    return out.select("id", "suitability_score", "colour", F.size(g.vertices(c("geom"))).alias("vertices"))


@query("l11_buildings_map", f"""WITH {CLUSTERS}
SELECT l.id, CAST(l.w * l.h AS DOUBLE) AS area_m2, cluster_id, CASE WHEN k.height_m IS NULL OR k.height_m = 0 THEN '#2166ac'
  WHEN k.height_m < 5 THEN '#2166ac' WHEN k.height_m < 15 THEN '#74add1' WHEN k.height_m < 30 THEN '#fdae61' ELSE '#d73027' END AS colour
FROM labelled l LEFT JOIN fx_roofs k ON k.id = l.id WHERE l.w * l.h > 50""", (B, K))
def l11_buildings(spark, d):
    heights = fixtures.load(spark, d, K).select("id", c("height_m").alias("lidar_height_m"))
    return layers.buildings_map(_with_area(spark, d), heights, _clusters(spark, d), 0.00005).select("id", "area_m2", "cluster_id", "colour")
