"""Scenes, composites and the vegetation index."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane import fixtures
from terrane.fixtures import IMAGE_GRID
from terrane.operators import imagery, raster
from workload.base import query
from workload.raster import _ramp_sql

S, X = "fx_scenes", "fx_pixels"
c = F.col
CLEAR = "(qa60 & 1024) = 0 AND (qa60 & 2048) = 0"


def _scenes(spark, d):
    """Every scene covers the whole image."""
    size = IMAGE_GRID.cell * IMAGE_GRID.ncols
    return fixtures.load(spark, d, S).withColumns({
        "xmin": F.lit(IMAGE_GRID.x0), "xmax": F.lit(IMAGE_GRID.x0 + size),
        "ymin": F.lit(IMAGE_GRID.y0 - size), "ymax": F.lit(IMAGE_GRID.y0)})


def _pixels(spark, d):
    return fixtures.load(spark, d, X)


@query("f9_date_range", "SELECT scene_id, CAST(acquired AS VARCHAR) AS acquired FROM fx_scenes WHERE acquired >= DATE '2023-06-01' AND acquired < DATE '2023-09-01'", (S,))
def f9(spark, d):
    return imagery.select_scenes(_scenes(spark, d), "2023-06-01", "2023-09-01").select("scene_id", c("acquired").cast("string").alias("acquired"))


@query("f10_cloud_filter", "SELECT scene_id, cloud_pct FROM fx_scenes WHERE cloud_pct < 20", (S,))
def f10(spark, d):
    return imagery.select_scenes(_scenes(spark, d), max_cloud=20.0).select("scene_id", "cloud_pct")


CHOSEN = "SELECT * FROM fx_scenes WHERE acquired >= DATE '2023-06-01' AND acquired < DATE '2023-09-01' AND cloud_pct < 10"


def _summer(spark, d):
    return imagery.select_scenes(_scenes(spark, d), "2023-06-01", "2023-09-01", 10.0, (499000, 4390000, 510000, 4410000))


@query("i1_scene_selection", f"SELECT COUNT(*) AS scenes, MIN(cloud_pct) AS clearest, COUNT(*) = 0 AS empty FROM ({CHOSEN})", (S,))
def i1(spark, d):
    return _summer(spark, d).agg(F.count("*").alias("scenes"), F.min("cloud_pct").alias("clearest"),
                                 (F.count("*") == 0).alias("empty"))


@query("i2_cloud_mask", f"SELECT scene_id, r, c, band, dn FROM fx_pixels WHERE {CLEAR}", (X,))
def i2(spark, d):
    return _pixels(spark, d).filter(imagery.is_clear(c("qa60"))).select("scene_id", "r", "c", "band", "dn")


@query("i3_reflectance", f"SELECT scene_id, r, c, band, dn / 10000.0 AS value FROM fx_pixels WHERE {CLEAR}", (X,))
def i3(spark, d):
    return imagery.clear_reflectance(_pixels(spark, d)).select("scene_id", "r", "c", "band", "value")


@query("i4_median_composite", f"SELECT r, c, band, median(dn) AS value FROM fx_pixels JOIN ({CHOSEN}) USING (scene_id) GROUP BY 1, 2, 3", (S, X))
def i4(spark, d):
    return imagery.composite(imagery.of_scenes(_pixels(spark, d), _summer(spark, d)))


@query("i5_mean_composite", f"SELECT r, c, band, ROUND(AVG(dn / 10000.0), 12) AS value FROM fx_pixels WHERE {CLEAR} GROUP BY 1, 2, 3", (X,))
def i5(spark, d):
    out = imagery.composite(imagery.clear_reflectance(_pixels(spark, d)), "mean", "value")
    return out.withColumn("value", F.round("value", 12))


NDVI = f"""comp AS (SELECT r, c, band, median(dn) AS v FROM fx_pixels JOIN ({CHOSEN}) USING (scene_id) GROUP BY 1, 2, 3),
wide AS (SELECT r, c, MAX(v) FILTER (WHERE band = 'B8') AS b8, MAX(v) FILTER (WHERE band = 'B4') AS b4 FROM comp WHERE band IN ('B4', 'B8') GROUP BY 1, 2),
nd AS (SELECT r, c, CASE WHEN b8 >= 0 AND b4 >= 0 AND b8 + b4 <> 0 THEN (b8 - b4) / (b8 + b4) END AS ndvi FROM wide)"""


def _ndvi(spark, d):
    return imagery.ndvi(imagery.composite(imagery.of_scenes(_pixels(spark, d), _summer(spark, d))))


@query("i6_normalized_difference", f"WITH {NDVI} SELECT r, c, ROUND(ndvi, 9) AS ndvi FROM nd", (S, X))
def i6(spark, d):
    return _ndvi(spark, d).withColumn("ndvi", F.round("ndvi", 9))


SAMPLE = f"""{NDVI}, pick AS (SELECT * FROM nd WHERE r % 2 = 1 AND c % 2 = 1 AND ndvi IS NOT NULL
  ORDER BY md5(concat_ws(':', CAST(r AS VARCHAR), CAST(c AS VARCHAR), '42')), r, c LIMIT 500)"""


def _sample(spark, d):
    return imagery.sample(imagery.thin(_ndvi(spark, d), IMAGE_GRID.cell, imagery.SAMPLE_SCALE_M))


@query("i7_seeded_sample", f"WITH {SAMPLE} SELECT r, c, ROUND(ndvi, 9) AS ndvi FROM pick", (S, X))
def i7(spark, d):
    return _sample(spark, d).withColumn("ndvi", F.round("ndvi", 9))


@query("i8_histogram", f"""WITH {NDVI}, span AS (SELECT MIN(ndvi) AS lo, MAX(ndvi) AS hi, AVG(ndvi) AS mean FROM nd)
SELECT CAST(CASE WHEN hi > lo THEN LEAST(floor((ndvi - lo) / ((hi - lo) / 40)), 39) ELSE 20 END AS INT) AS bin,
  ROUND(lo, 9) AS lo, ROUND(hi, 9) AS hi, ROUND(mean, 9) AS mean, COUNT(*) AS pixels FROM nd, span WHERE ndvi IS NOT NULL GROUP BY ALL""", (S, X))
def i8(spark, d):
    return imagery.histogram(_ndvi(spark, d), "ndvi").withColumns({k: F.round(k, 9) for k in ("lo", "hi", "mean")})


@query("i9_cover_classes", f"""WITH {NDVI}, k AS (SELECT CASE WHEN ndvi >= -1 AND ndvi < 0 THEN 'Non-veg / Water' WHEN ndvi >= 0 AND ndvi < 0.2 THEN 'Bare soil'
  WHEN ndvi >= 0.2 AND ndvi < 0.4 THEN 'Sparse veg' WHEN ndvi >= 0.4 AND ndvi <= 1 THEN 'Dense veg' END AS cover FROM nd)
SELECT cover, COUNT(*) AS pixels, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 1) AS pct FROM k WHERE cover IS NOT NULL GROUP BY 1""", (S, X))
def i9(spark, d):
    return imagery.class_shares(_ndvi(spark, d))


MONTHLY = """comp AS (SELECT month(acquired) AS m, r, c, band, median(dn) AS v FROM fx_pixels JOIN fx_scenes USING (scene_id)
  WHERE cloud_pct < 20 AND day(acquired) < 28 AND band IN ('B4', 'B8') GROUP BY 1, 2, 3, 4),
wide AS (SELECT m, r, c, MAX(v) FILTER (WHERE band = 'B8') AS b8, MAX(v) FILTER (WHERE band = 'B4') AS b4 FROM comp GROUP BY 1, 2, 3),
mon AS (SELECT m, AVG(CASE WHEN b8 >= 0 AND b4 >= 0 AND b8 + b4 <> 0 THEN (b8 - b4) / (b8 + b4) END) AS v FROM wide
  WHERE r % 2 = 1 AND c % 2 = 1 GROUP BY 1)"""


def _monthly(spark, d):
    return imagery.monthly_ndvi(_pixels(spark, d), _scenes(spark, d), cell=IMAGE_GRID.cell, scale=imagery.SAMPLE_SCALE_M)


@query("i10_monthly_ndvi", f"WITH {MONTHLY} SELECT CAST(t.i AS INT) AS month, ROUND(v, 9) AS mean_ndvi FROM range(1, 13) AS t(i) LEFT JOIN mon ON m = t.i", (S, X))
def i10(spark, d):
    return _monthly(spark, d).withColumn("mean_ndvi", F.round("mean_ndvi", 9))


@query("i11_annual_mean", f"WITH {MONTHLY} SELECT CAST(m AS INT) AS month, ROUND(v, 9) AS mean_ndvi, ROUND(AVG(v) OVER (), 9) AS annual_mean FROM mon WHERE v IS NOT NULL", (S, X))
def i11(spark, d):
    return imagery.annual_mean(_monthly(spark, d)).withColumns({k: F.round(k, 9) for k in ("mean_ndvi", "annual_mean")})


def _byte(band: str, lo: float, hi: float, gamma: float) -> str:
    return (f"CAST(floor(power(GREATEST(0.0, LEAST(1.0, (MAX(v) FILTER (WHERE band = '{band}') - {lo}) / {hi - lo})), {1.0 / gamma!r}) * 255) AS INT)")


@query("i12_display_stretch", f"WITH {NDVI} SELECT r, c, " + ", ".join(
    f"{_byte(b, lo, hi, gm)} AS {name.split()[0].replace('-', '_')}_{b}" for name, (bands, lo, hi, gm) in imagery.STRETCHES.items() if name != "reflectance"
    for b in bands) + " FROM comp GROUP BY 1, 2", (S, X))
def i12(spark, d):
    wide = imagery.bands_wide(imagery.composite(imagery.of_scenes(_pixels(spark, d), _summer(spark, d))), imagery.COMPOSITE_BANDS)
    return wide.select("r", "c", *[imagery.stretch(c(b), lo, hi, gm).alias(f"{name.split()[0].replace('-', '_')}_{b}")
                                   for name, (bands, lo, hi, gm) in imagery.STRETCHES.items() if name != "reflectance" for b in bands])


@query("i13_palette_ramp", f"WITH {NDVI} SELECT r, c, " + ", ".join(
    f"{_ramp_sql('ndvi', imagery.NDVI_PALETTE, k)} AS {n}" for k, n in ((1, "red"), (2, "green"), (3, "blue"))) + " FROM nd", (S, X))
def i13(spark, d):
    colours = raster.ramp(c("ndvi"), imagery.NDVI_PALETTE)
    return _ndvi(spark, d).select("r", "c", *[v.alias(k) for k, v in colours.items()])
