"""Quality control: every check is a small table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import predicates as pred
from terrane.operators import tiles
from terrane.schema import TILE_CELLS, UTM13N, Grid

# ── fixed values ────────────────────────────────────────────────────────────
WARN_INVALID_PCT = 1.0
RANGE_SLACK = 1.2
RASTER_RANGES = [("dem", 1500.0, 2200.0), ("ndsm", 0.0, 250.0), ("slope", 0.0, 90.0)]
METADATA_CRS = "EPSG:32613"
# ── end of fixed values ─────────────────────────────────────────────────────


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, srid, features): a row per reference system found in each layer."""
    return _stack([df.groupBy(F.col("geom.srid").alias("srid")).agg(F.count(F.lit(1)).alias("features"))
                   .select(F.lit(name).alias("layer"), "srid", "features") for name, df in layers.items()])


def crs_consistency(layers: dict[str, DataFrame], expected: int = UTM13N) -> DataFrame:
    status = F.when(F.col("srid") == expected, "OK").otherwise("FAIL")
    return layer_counts(layers).withColumn("status", status)


def geometry_validity(layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Invalid features per layer; the rule is ``valid`` or ``simple``. An empty layer has 0 %."""
    tests = {"valid": pred.is_valid, "simple": pred.is_simple}
    counts = _stack([df.select(tests[rule](F.col("geom")).alias("good")).agg(
        F.count_if(~F.col("good")).alias("invalid"), F.count(F.lit(1)).alias("total")).select(
        F.lit(name).alias("layer"), "invalid", "total") for name, (df, rule) in layers.items()])
    pct = F.when(F.col("total") > 0, F.col("invalid") / F.col("total") * 100).otherwise(0.0)
    return counts.withColumn("pct", F.round(pct, 2)).withColumn(
        "status", F.when(pct < WARN_INVALID_PCT, "OK").otherwise("WARN"))


def raster_ranges(rasters: dict[str, DataFrame], spark: SparkSession, expected: list = RASTER_RANGES) -> DataFrame:
    """Range and nodata share of each expected raster; absent rasters are skipped, not failed."""
    want = spark.createDataFrame(expected, "raster string, lo double, hi double")
    stats = _stack([df.agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
                           (F.count_if(F.col("value").isNull()) / F.count(F.lit(1)) * 100).alias("nodata_pct"),
                           F.count(F.lit(1)).alias("cells")).select(F.lit(name).alias("raster"), "*")
                    for name, df in rasters.items()])
    fits = (F.col("min") >= F.col("lo")) & (F.col("max") <= F.col("hi") * RANGE_SLACK)
    return F.broadcast(want).join(stats, "raster", "left").withColumn(
        "status", F.when(F.col("cells").isNull(), "SKIP").when(fits, "OK").otherwise("WARN"))


def completeness(df: DataFrame, layer: str, columns: list[str]) -> DataFrame:
    """Filled values per column in one pass, a row per column."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    tidy = counts.selectExpr("total", f"stack({len(columns)}, {pairs}) as (attribute, filled)")
    pct = F.when(F.col("total") > 0, F.round(F.col("filled") * 100.0 / F.col("total"), 1))
    return tidy.select(F.lit(layer).alias("layer"), "attribute", "total", "filled", pct.alias("pct"))


def raster_catalogue(rasters: dict[str, tuple[DataFrame, Grid]], size: int = TILE_CELLS) -> DataFrame:
    """A row per raster layer and band: reference system, resolution, tiles, cells, nodata share and the outer tile keys.

    ``rasters`` names dense tiles and their grid.
    """
    frames = []
    for name, (rows, grid) in rasters.items():
        band = tiles.counts(rows).groupBy("band").agg(
            F.count(F.lit(1)).alias("tiles"), F.sum("cells").alias("cells"), F.sum("filled").alias("filled"), F.sum("total").alias("total"),
            *[fn(key).alias(f"{end}_{key}") for key in ("trow", "tcol") for end, fn in (("first", F.min), ("last", F.max))])
        share = F.when(F.col("cells") > 0, F.round((1 - F.col("filled") / F.col("cells")) * 100, 2))
        frames.append(band.select(F.lit(name).alias("layer"), F.lit(grid.srid).alias("srid"), F.lit(float(grid.cell)).alias("resolution_m"), "band", "tiles", "cells",
                                  "filled", share.alias("nodata_pct"), (F.col("total") / F.nullif(F.col("filled"), F.lit(0))).alias("mean"),
                                  "first_trow", "last_trow", "first_tcol", "last_tcol"))
    return _stack(frames)


def load_report(expected: list[str], layers: dict[str, DataFrame], spark: SparkSession, rasters: DataFrame | None = None) -> DataFrame:
    """Every expected layer with its features (vector) or tiles (raster) and reference systems, or NOT LOADED.

    ``rasters`` is a :func:`raster_catalogue`.
    """
    want = spark.createDataFrame([(n,) for n in expected], "layer string")
    found = layer_counts(layers).groupBy("layer").agg(
        F.sum("features").alias("features"), F.lit(None).cast("long").alias("tiles"), F.concat_ws(",", F.sort_array(F.collect_set(
            F.col("srid").cast("string")))).alias("srids"))
    if rasters is not None:
        found = found.unionByName(rasters.groupBy("layer").agg(F.lit(None).cast("long").alias("features"), F.sum("tiles").alias("tiles"),
                                                               F.max(F.col("srid").cast("string")).alias("srids")))
    missing = F.col("features").isNull() & F.col("tiles").isNull()
    return F.broadcast(want).join(found, "layer", "left").withColumn("status", F.when(missing, "NOT LOADED").otherwise("LOADED"))


def metadata_rows(described: DataFrame, counts: DataFrame) -> DataFrame:
    """Registry rows: descriptions (with source_date and lineage) with the counted features or tiles and the defaults."""
    return described.join(counts, ["schema_name", "layer_name"]).withColumn(
        "crs", F.lit(METADATA_CRS)).withColumn("loaded_at", F.current_timestamp())


def append_metadata(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def latest_metadata(registry: DataFrame) -> DataFrame:
    """Newest row of each layer; reruns append, so there may be several."""
    newest = F.max_by(F.struct(*[F.col(c) for c in registry.columns]), F.col("loaded_at"))
    return registry.groupBy("schema_name", "layer_name").agg(newest.alias("r")).select("r.*")


def summary(crs: DataFrame, geometry: DataFrame, rasters: DataFrame) -> DataFrame:
    """One row: the three totals and the verdict."""
    def total(value: Column, df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name))
    one = (total(F.when(F.col("status") == "FAIL", 1).otherwise(0), crs, "crs_mismatches")
           .join(total(F.col("invalid"), geometry, "geometry_issues"))
           .join(total(F.when(F.col("status") == "WARN", 1).otherwise(0), rasters, "raster_warnings")))
    issues = F.col("crs_mismatches") + F.col("geometry_issues") + F.col("raster_warnings")
    return one.withColumn("status", F.when(issues == 0, "ALL CHECKS PASSED").otherwise(
        F.concat(issues.cast("string"), F.lit(" issue(s) found"))))
