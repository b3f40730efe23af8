"""Spatial stand-in layers, each one SELECT over the given tables.

The text is in the dialect Spark SQL and ANSI engines share, so the same SELECT
feeds the Spark queries (as a DataFrame) and the SQL checks (as a CTE).
Coordinates are integers or binary fractions, so no rounding tie depends on the
engine. Every fixture reads all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrane.schema import Grid

FIXTURES = {
    "fx_buildings": ("orders", """
SELECT o_orderkey AS id,
  490000 + (o_orderkey*7919 + o_custkey*13) % 20000 AS x0,
  4385000 + (o_orderkey*104729 + o_custkey*31) % 20000 AS y0,
  2 + o_custkey % 29 AS w, 2 + o_orderkey % 23 AS h,
  CASE WHEN o_orderkey % 77 = 5 THEN '1e3'
       WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '24m'
       WHEN o_orderkey % 7 = 2 THEN '3 floors' WHEN o_orderkey % 7 = 3 THEN '1.2.3'
       ELSE CONCAT(CAST(3 + o_orderkey % 60 AS STRING), '.5') END AS height,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS name,
  CASE WHEN o_orderkey % 4 = 0 THEN 'residential' ELSE 'yes' END AS building
FROM orders"""),
    "fx_roads": ("customer", """
SELECT c_custkey AS id,
  490000 + (c_custkey*6151) % 20000 AS x0, 4385000 + (c_custkey*30011) % 20000 AS y0,
  490000 + (c_custkey*6151) % 20000 + (c_custkey*37) % 801 - 400 AS x1,
  4385000 + (c_custkey*30011) % 20000 + (c_custkey*53) % 801 - 400 AS y1,
  CASE WHEN c_custkey % 3 = 0 THEN 490000 + (c_custkey*6151) % 20000 + (c_custkey*37) % 801 - 100 END AS x2,
  CASE WHEN c_custkey % 3 = 0 THEN 4385000 + (c_custkey*30011) % 20000 + (c_custkey*53) % 801 - 250 END AS y2,
  CASE c_custkey % 8 WHEN 0 THEN 'motorway' WHEN 1 THEN 'trunk' WHEN 2 THEN 'primary' WHEN 3 THEN 'secondary'
       WHEN 4 THEN 'tertiary' WHEN 5 THEN 'residential' WHEN 6 THEN 'service' END AS tag1,
  CASE WHEN c_custkey % 8 < 7 AND c_custkey % 5 = 0 THEN 'bus_guideway' END AS tag2,
  c_custkey AS u,
  CASE WHEN c_custkey % 100 < 60 THEN CAST(FLOOR(c_custkey / 2) AS BIGINT)
       WHEN c_custkey % 10 < 9 THEN c_custkey + 1 ELSE c_custkey - 1 END AS v
FROM customer"""),
    "fx_landuse": ("supplier", """
SELECT s_suppkey AS id,
  490000 + (s_suppkey*4099) % 19000 AS x0, 4385000 + (s_suppkey*8191) % 19000 AS y0,
  20 + (s_suppkey*97) % 1480 AS w, 20 + (s_suppkey*61) % 1480 AS h,
  CASE s_nationkey % 7 WHEN 0 THEN 'residential' WHEN 1 THEN 'commercial' WHEN 2 THEN 'industrial'
       WHEN 3 THEN 'park' WHEN 4 THEN 'farmland' WHEN 5 THEN 'retail' END AS landuse
FROM supplier"""),
    "fx_grid": ("orders", """
SELECT CAST(FLOOR(o_orderkey / 120) AS INT) AS r, CAST(o_orderkey % 120 AS INT) AS c,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL
       ELSE 1600 + 0.5E0*FLOOR(o_orderkey / 120) + 0.25E0*(o_orderkey % 120) + o_custkey % 7 END AS dem,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey*13) % 46 AS DOUBLE) END AS slope,
  CASE o_custkey % 16 WHEN 0 THEN 11 WHEN 1 THEN 21 WHEN 2 THEN 22 WHEN 3 THEN 23 WHEN 4 THEN 24 WHEN 5 THEN 31
       WHEN 6 THEN 41 WHEN 7 THEN 42 WHEN 8 THEN 43 WHEN 9 THEN 52 WHEN 10 THEN 71 WHEN 11 THEN 81
       WHEN 12 THEN 82 WHEN 13 THEN 90 WHEN 14 THEN 95 END AS nlcd
FROM orders"""),
    "fx_points": ("lineitem", """
SELECT 500000 + ((l_orderkey*131 + l_linenumber*29) % 960) / 4E0 AS x,
  4400000 + ((l_partkey*17 + l_suppkey*7) % 960) / 4E0 AS y,
  1600 + ((l_orderkey*131 + l_linenumber*29) % 960) / 64E0
       + CASE WHEN l_orderkey % 5 = 0 THEN CAST(l_quantity AS INT) % 20 * 0.5E0 ELSE 0E0 END AS z,
  CASE WHEN l_orderkey % 5 <> 0 THEN 2 WHEN l_orderkey % 50 = 0 THEN 7 WHEN l_orderkey % 35 = 0 THEN 18
       WHEN l_orderkey % 15 = 0 THEN 5 WHEN l_orderkey % 20 = 0 THEN 64 ELSE 6 END AS classification,
  1 + l_linenumber % 3 AS return_number
FROM lineitem"""),
    "fx_roofs": ("part", """
SELECT p_partkey AS id,
  500000 + (p_partkey*53) % 215 AS x0, 4400000 + (p_partkey*101) % 215 AS y0,
  5 + p_partkey % 16 AS w, 5 + p_size % 17 AS h,
  CASE WHEN p_partkey % 4 > 0 THEN CAST(p_size % 12 AS DOUBLE) END AS height_m
FROM part"""),
    "fx_scenes": ("orders", """
SELECT DISTINCT CAST(o_orderkey % 60 AS INT) AS scene_id,
  DATE '2023-01-01' + CAST((o_orderkey % 60)*5 + 3 AS INT) AS acquired,
  CAST(((o_orderkey % 60)*7) % 31 AS DOUBLE) AS cloud_pct
FROM orders"""),
    "fx_pixels": ("lineitem", """
SELECT CAST(l_orderkey % 60 AS INT) AS scene_id, CAST(l_partkey % 10 AS INT) AS r, CAST(l_suppkey % 10 AS INT) AS c,
  CASE l_linenumber WHEN 1 THEN 'B2' WHEN 2 THEN 'B3' WHEN 3 THEN 'B4' WHEN 4 THEN 'B8' WHEN 5 THEN 'B11' WHEN 6 THEN 'B4' ELSE 'B8' END AS band,
  MIN(CAST(FLOOR(l_extendedprice) AS INT) % 10000) AS dn,
  MIN(CAST(CASE WHEN (l_orderkey % 60 + l_partkey % 10) % 9 = 0 THEN 1024
       WHEN (l_orderkey % 60 + l_suppkey % 10) % 11 = 0 THEN 2048 ELSE 0 END AS INT)) AS qa60
FROM lineitem GROUP BY 1, 2, 3, 4"""),
}

SURFACE_GRID = Grid(x0=490000.0, y0=4405000.0, cell=160.0, ncols=120)
POINT_GRID = Grid(x0=500000.0, y0=4400240.0, cell=1.0, nrows=241, ncols=240)
IMAGE_GRID = Grid(x0=500000.0, y0=4400000.0, cell=50.0, nrows=10, ncols=10)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture as a DataFrame; only the columns its SELECT names are scanned."""
    table, text = FIXTURES[name]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    df = spark.sql(text.replace(f"FROM {table}", "FROM {source}"), source=source)
    # the test tables are one row group each, which no split size cuts: few files are dealt over the cores
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(source.inputFiles()) < cores else df


def ctes(*names: str) -> str:
    """The same fixtures as leading CTEs for a SQL check (ends without a comma)."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({FIXTURES[n][1]})" for n in names)
