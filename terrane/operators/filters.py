"""Row filters on layers; all of them are plain column predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.schema import AREAL_KINDS, MAJOR_ROADS, SLIVER_M2


def in_bbox(df: DataFrame, west, south, east, north) -> DataFrame:
    """Boxes that meet the given one; comparisons the Parquet scan can prune by."""
    return df.filter((F.col("xmax") >= west) & (F.col("xmin") <= east)
                     & (F.col("ymax") >= south) & (F.col("ymin") <= north))


def has_tag(df: DataFrame, tag: str) -> DataFrame:
    return df.filter(F.col(tag).isNotNull())


def of_kind(df: DataFrame, kinds: list[str] = AREAL_KINDS) -> DataFrame:
    return df.filter(F.col("geom.kind").isin(kinds))


def valid(df: DataFrame) -> DataFrame:
    return df.filter(pred.is_valid(F.col("geom")))


def larger_than(df: DataFrame, square_metres: float = SLIVER_M2, rounded: bool = True) -> DataFrame:
    """Strictly above a minimum area; slivers are judged on the rounded area."""
    size = g.rounded_area(F.col("geom")) if rounded else g.area(F.col("geom"))
    return df.filter(size > square_metres)


def major_roads(df: DataFrame) -> DataFrame:
    return df.filter(F.col("highway").isin(MAJOR_ROADS))
