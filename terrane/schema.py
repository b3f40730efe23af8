"""Data model: geometry struct, raster grid, fixed workload constants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PATH = T.ArrayType(VERTEX)
GEOMETRY = T.StructType([
    T.StructField("srid", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("parts", T.ArrayType(T.ArrayType(PATH))),
])
GEOMETRY_DDL = ("struct<srid:int,kind:string,"
                "parts:array<array<array<struct<x:double,y:double>>>>>")
BBOX_COLUMNS = ("xmin", "ymin", "xmax", "ymax")

# Fixed values of the workload.
WGS84 = 4326
UTM13N = 32613
STUDY_BBOX = (-105.05, 39.60, -104.85, 39.80)
MAJOR_ROADS = ["motorway", "trunk", "primary", "secondary", "tertiary"]
AREAL_KINDS = ["Polygon", "MultiPolygon"]
ROAD_BUFFER_M = 50.0
SLIVER_M2 = 10.0
BUILDING_MIN_M2 = 50.0
LANDUSE_MIN_M2 = 1000.0
DBSCAN_EPS_M = 100.0
DBSCAN_MIN_POINTS = 5
TILE_CELLS = 256


@dataclass(frozen=True)
class Grid:
    """A north-up raster grid: top-left corner, square cells, row 0 on top."""

    x0: float
    y0: float
    cell: float
    nrows: int | None = None
    ncols: int | None = None
    srid: int = UTM13N
