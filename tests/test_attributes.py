"""Scalar rules at their edges."""

import pytest
from pyspark.sql import functions as F

from terrane.functions import attributes as at
from terrane.operators import imagery


def test_height_rules(spark):
    rows = [("12.5", 12.5, 12.5), ("1e3", None, 1000.0), ("24m", None, None), ("24d", None, None), ("1.2.3", None, None),
            ("nan", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, a double, b double")
    for r in df.select("t", "a", "b", at.parse_height(F.col("t")).alias("x"), at.parse_height(F.col("t"), "coerce").alias("y")).collect():
        assert (r.x, r.y) == (r.a, r.b), r.t


def test_suitability(spark):
    df = spark.createDataFrame([(None, 5000.0, None, 80), (40.0, 100.0, 10.0, 0)], "s double, a double, d double, want int")
    for r in df.select("want", at.suitability(F.col("s"), F.col("a"), F.col("d")).alias("got")).collect():
        assert r.got == r.want


def test_vegetation_classes_and_median(spark):
    names = imagery.NDVI_CLASSES
    rows = [(-1.0, names[0]), (0.0, names[1]), (0.2, names[2]), (0.4, names[3]), (1.0, names[3]), (1.1, None)]
    df = spark.createDataFrame(rows, "v double, want string")
    assert all(r.got == r.want for r in df.select("want", imagery.ndvi_class(F.col("v")).alias("got")).collect())
    px = spark.createDataFrame([(1, 1, "B4", v) for v in (1, 2, 3, 10)], "r int, c int, band string, dn int")
    assert imagery.composite(px).first()["value"] == pytest.approx(2.5)
