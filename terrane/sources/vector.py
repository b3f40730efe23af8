"""Vector layers: GeoJSON in and out, Parquet layer stores, tables, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions.projection import reproject
from terrane.operators.grid import cell_width
from terrane.schema import GEOMETRY_DDL, UTM13N, WGS84
from terrane.session import cut_lineage, stored
from terrane.sources.collection import read_collection

_XY = "array<double>"


def _vertices_of(pairs: Column) -> Column:
    return F.transform(pairs, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))


def geometry_from_json(kind: Column, coordinates: Column, srid: Column | None = None) -> Column:
    """Geometry struct from the type and the raw ``coordinates`` text of a feature."""
    def nested(depth):
        return F.from_json(coordinates, "array<" * depth + _XY + ">" * depth)
    parts = (
        F.when(kind == "Polygon", F.array(F.transform(nested(2), _vertices_of)))
        .when(kind == "MultiPolygon", F.transform(nested(3), lambda p: F.transform(p, _vertices_of)))
        .when(kind == "LineString", F.array(F.array(_vertices_of(nested(1)))))
        .when(kind == "MultiLineString", F.transform(nested(2), lambda line: F.array(_vertices_of(line))))
        .when(kind == "MultiPoint", F.transform(_vertices_of(nested(1)), lambda p: F.array(F.array(p))))
        .when(kind == "Point", F.array(F.array(_vertices_of(F.array(F.from_json(coordinates, _XY)))))))
    srid = F.lit(None) if srid is None else srid
    return F.when(kind.isNotNull(), F.struct(srid.cast("int").alias("srid"), kind.alias("kind"),
                                             parts.alias("parts")).cast(GEOMETRY_DDL))


def read_features(spark: SparkSession, path: str, properties: str, layout: str = "lines",
                  default_srid: int = WGS84) -> DataFrame:
    """Read GeoJSON features with declared property columns.

    ``lines`` has one feature per line; ``collection`` reads FeatureCollection documents, one or more
    in a file, which are cut at feature boundaries. Both split over tasks. Features of a
    document that names no CRS get ``default_srid``; a file has one CRS.
    """
    feature = f"type string, properties struct<{properties}>, geometry struct<type:string, coordinates:string>"
    if layout == "collection":
        objects, _ = read_collection(spark, path)
        parsed = objects.select("file", F.from_json("feature", feature).alias("f"))
        # of what stands as deep as a feature only the CRS has a name of its own
        named = F.regexp_extract("feature", '^\\{\\s*"name"\\s*:\\s*"[^"]*?([0-9]+)"', 1).try_cast("int")
        crs = objects.select("file", "feature", named.alias("srid")).filter("srid is not null").filter(F.from_json("feature", "type string")["type"].isNull())
        crs = stored(crs.groupBy("file").agg(F.max("srid").alias("srid")), "collection-crs")
        raw = parsed.filter("f.type = 'Feature'").join(crs, "file", "left").select("srid", "f.*")
    else:
        raw = spark.read.schema(feature).json(path).filter(F.col("type") == "Feature").withColumn(
            "srid", F.lit(None).cast("int"))
    # the default goes in first: set on the geometry, it would have the coordinates parsed several times
    geom = geometry_from_json(F.col("geometry.type"), F.col("geometry.coordinates"), F.coalesce("srid", F.lit(default_srid)))
    return raw.select("properties.*", geom.alias("geom"))


def feature_text(properties: list[str], geom: str = "geom", digits: int | None = None) -> Column:
    """One GeoJSON feature as text."""
    gcol = F.col(geom)

    def number(v):
        return v if digits is None else F.round(v, digits)

    def pairs(path):
        return F.transform(path, lambda p: F.array(number(p["x"]), number(p["y"])))
    lone = F.get(gcol["parts"], F.lit(0))
    kind = gcol["kind"]
    coords = (
        F.when(kind == "Polygon", F.to_json(F.transform(lone, pairs)))
        .when(kind == "MultiPolygon", F.to_json(F.transform(gcol["parts"], lambda p: F.transform(p, pairs))))
        .when(kind == "LineString", F.to_json(pairs(F.get(lone, F.lit(0)))))
        .when(kind == "MultiLineString", F.to_json(F.transform(g.paths(gcol), pairs)))
        .when(kind == "MultiPoint", F.to_json(pairs(g.vertices(gcol))))
        .otherwise(F.to_json(F.get(pairs(g.vertices(gcol)), F.lit(0)))))
    props = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type":"Feature","properties":'), props,
                    F.lit(',"geometry":{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}}"))


def write_features(df: DataFrame, path: str, properties: list[str], digits: int = 7) -> None:
    """Export in longitude/latitude, one feature per line."""
    out = df.withColumn("geom", reproject(F.col("geom"), WGS84))
    out.select(feature_text(properties, digits=digits).alias("value")).write.mode("overwrite").text(path)


BLOCK_ROWS = 1_000_000  # rows of a map block that one task writes


# ── layer store: one Parquet directory per layer ────────────────────────────
def layer_path(root: str, layer: str) -> str:
    return f"{root}/{layer.replace('.', '/')}"


def write_layer(df: DataFrame, root: str, layer: str, block_level: int | None = None) -> None:
    """Overwrite a layer; with ``block_level`` it is laid out by coarse map blocks.

    Block columns prune whole directories, the bbox columns prune row groups.
    """
    writer = df.write.mode("overwrite")
    if block_level is not None:
        width = cell_width(F.lit(block_level))
        df = (df.withColumn("block_x", F.floor(F.col("xmin") / width))
              .withColumn("block_y", F.floor(F.col("ymin") / width)))
        # a block has one writer for every BLOCK_ROWS rows it holds
        counts = df.groupBy("block_x", "block_y").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("block_writers"))
        df = df.join(counts, ["block_x", "block_y"]).withColumn("block_writer", F.pmod(F.xxhash64("xmin", "ymin"), F.col("block_writers")))
        writer = (df.repartition("block_x", "block_y", "block_writer").drop("block_writers", "block_writer").sortWithinPartitions("block_x", "block_y", "xmin")
                  .write.mode("overwrite").partitionBy("block_x", "block_y"))
    writer.parquet(layer_path(root, layer))


def read_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer))


def standardise(df: DataFrame, srid: int = UTM13N) -> DataFrame:
    """Assume longitude/latitude where no CRS is given, then go to ``srid``."""
    return df.withColumn("geom", reproject(g.default_srid(F.col("geom"), WGS84), srid))


def create_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a managed table from a query and read it back."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


NAMESPACES = ["raw", "processed", "analysis"]


def create_namespaces(spark: SparkSession, root: str) -> None:
    for name in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}.db'")


def assign_ids(df: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """Dense ids from 1 in the order of a unique key, without one global sort task.

    Rows are range-partitioned by the key; a partition's ids start after the
    rows of the partitions before it. Only one count per partition is combined
    in a single task.
    """
    placed = cut_lineage(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return (placed.withColumn("_rank", rank).join(F.broadcast(starts), "_part")
            .withColumn(name, (F.col("_start") + F.col("_rank")).cast("long"))
            .drop("_part", "_rank", "_start"))


def first_download(catalogue: DataFrame, body: str = "body") -> DataFrame:
    """URL of the first item of each catalogue answer; an answer without items gives no row."""
    parsed = F.from_json(F.col(body), "items array<struct<downloadURL:string>>")
    return (catalogue.withColumn("items", parsed["items"]).filter(F.size("items") > 0)
            .withColumn("download_url", F.get("items", F.lit(0))["downloadURL"]).drop("items"))
