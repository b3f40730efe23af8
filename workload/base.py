"""Registry of the checked queries and the layers they start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane import fixtures
from terrane.functions import geometry as g
from terrane.operators.tiles import to_tiles
from terrane.schema import UTM13N
from terrane.session import stored

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, fx: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its check, preceded by the fixtures it names."""
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = check(sql, *fx)
        return fn
    return register


def check(sql: str, *fx: str) -> str:
    body = sql.strip()
    if not fx:
        return body
    return fixtures.ctes(*fx) + (", " + body[5:] if body.startswith("WITH ") else "\n" + body)


def buildings(spark: SparkSession, d: str, boxed: bool = True) -> DataFrame:
    df = fixtures.load(spark, d, "fx_buildings").select(
        "id", "height", "name", "building",
        g.rectangle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h")).alias("geom"))
    return g.with_bbox(df) if boxed else df


def landuse(spark: SparkSession, d: str, boxed: bool = True) -> DataFrame:
    df = fixtures.load(spark, d, "fx_landuse").select(
        "id", "landuse", g.rectangle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h")).alias("geom"))
    return g.with_bbox(df) if boxed else df


def roofs(spark: SparkSession, d: str) -> DataFrame:
    return g.with_bbox(fixtures.load(spark, d, "fx_roofs").select(
        "id", "height_m", g.rectangle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h")).alias("geom")))


def roads(spark: SparkSession, d: str, boxed: bool = True) -> DataFrame:
    """Roads as read: ``highway`` is still the tag array."""
    c = F.col
    ends = F.array(g.vertex(c("x0"), c("y0")), g.vertex(c("x1"), c("y1")))
    line = F.when(c("x2").isNotNull(), F.concat(ends, F.array(g.vertex(c("x2"), c("y2"))))).otherwise(ends)
    df = fixtures.load(spark, d, "fx_roads").select(
        "id", F.array_compact(F.array("tag1", "tag2")).alias("highway"), "u", "v",
        g.linestring(line, UTM13N).alias("geom"))
    return g.with_bbox(df) if boxed else df


def raster(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One raster of the surface grid as (row, col, value) cells."""
    return fixtures.load(spark, d, "fx_grid").select(
        F.col("r").alias("row"), F.col("c").alias("col"), F.col(name).cast("double").alias("value"))


def tiles(spark: SparkSession, d: str, *names: str) -> DataFrame:
    """Rasters of the surface grid as a stored layer of dense tiles, one band each."""
    grid = fixtures.load(spark, d, "fx_grid")
    bands = F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.col(n).cast("double").alias("value")) for i, n in enumerate(names, 1)]))
    cells = grid.select(F.col("r").alias("row"), F.col("c").alias("col"), bands.alias("b")).select("row", "col", "b.*")
    return stored(to_tiles(cells), "tiles")


def points(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.load(spark, d, "fx_points")
