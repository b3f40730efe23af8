"""Known-answer shapes for the geometry expressions."""

import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.functions import projection
from terrane.schema import GEOMETRY, UTM13N


def sq(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


SHAPES = {
    1: ("Polygon", [[sq(0, 0, 10, 10)]]),
    2: ("Polygon", [[[(0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20), (0, 0)]]]),
    3: ("Polygon", [[sq(0, 0, 20, 20), sq(5, 5, 15, 15)]]),
    4: ("Polygon", [[[(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]]]),
    5: ("Polygon", [[[(0, 0), (10, 0), (10, 10)]]]),
    6: ("Polygon", [[[(0, 0), (5, 0), (10, 0), (0, 0)]]]),
    7: ("MultiPolygon", [[sq(0, 0, 10, 10)], [sq(20, 0, 30, 10)]]),
    8: ("Polygon", [[[(0, 0), (12, 0), (0, 9), (0, 0)]]]),
    9: ("LineString", [[[(0, 0), (10, 0), (10, 10)]]]),
    10: ("LineString", [[[(0, 0), (10, 10), (10, 0), (0, 10)]]]),
    11: ("LineString", [[[(0, 0), (10, 0), (10, 10), (0, 0)]]]),
    20: ("Polygon", [[sq(2, 2, 4, 4)]]),
    21: ("Polygon", [[sq(8, 8, 12, 12)]]),
    22: ("Polygon", [[sq(7, 7, 9, 9)]]),
    23: ("Polygon", [[sq(2, 2, 18, 18)]]),
    24: ("Polygon", [[sq(13, 0, 15, 1)]]),
    25: ("Polygon", [[sq(13, 14, 15, 16)]]),
    26: ("LineString", [[[(10, -5), (10, 20)]]]),
    27: ("LineString", [[[(2, 2), (4, 4)]]]),
    28: ("Polygon", [[sq(5, 5, 15, 15)]]),
    29: ("Polygon", [[[(10, 0), (20, 0), (20, 10), (10, 10), (10, 0)]]]),
}


def row(kind, parts, srid=UTM13N):
    return (srid, kind, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts])


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([(i, row(*s)) for i, s in SHAPES.items()],
                                 "id int, geom " + GEOMETRY.simpleString()).cache()


def values(df, expr):
    return {r["id"]: r["v"] for r in df.select("id", expr.alias("v")).collect()}


def test_area(shapes):
    got = values(shapes, g.area(F.col("geom")))
    assert {k: got[k] for k in (1, 2, 3, 7, 8, 9)} == {1: 100, 2: 300, 3: 300, 7: 200, 8: 54, 9: 0}


def test_centroid(shapes):
    got = values(shapes, g.centroid(F.col("geom")))
    want = {1: (5, 5), 2: (25 / 3, 25 / 3), 3: (10, 10), 7: (15, 5), 8: (4, 3)}
    for k, (x, y) in want.items():
        assert (got[k]["x"], got[k]["y"]) == (pytest.approx(x), pytest.approx(y))


def test_validity_and_repair(shapes):
    got = values(shapes, pred.is_valid(F.col("geom")))
    why = values(shapes, pred.invalid_reason(F.col("geom")))
    assert {k: got[k] for k in range(1, 12)} == {
        1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: True, 8: True, 9: True, 10: True, 11: True}
    assert (why[4], why[5], why[6]) == (
        "self-intersection", "ring not closed", "zero area")
    fixed = shapes.select("id", pred.make_valid(F.col("geom")).alias("geom"))
    areas, valid = values(fixed, g.area(F.col("geom"))), values(fixed, pred.is_valid(F.col("geom")))
    assert (areas[4], areas[5], areas[1], areas[3]) == (50, 50, 100, 300)
    assert valid[4] and valid[5] and not valid[6] and valid[3]


def test_simple(shapes):
    got = values(shapes, pred.is_simple(F.col("geom")))
    assert (got[9], got[10], got[11]) == (True, False, True)


def pairs(shapes, wanted):
    a, b = shapes.select(F.col("id").alias("ia"), F.col("geom").alias("ga")), shapes.select(
        F.col("id").alias("ib"), F.col("geom").alias("gb"))
    keys = shapes.sparkSession.createDataFrame(wanted, "ia int, ib int")
    return keys.join(a, "ia").join(b, "ib")


def test_within(shapes):
    want = {(1, 1): True, (20, 1): True, (21, 1): False, (22, 3): False, (23, 3): False, (28, 3): False,
            (20, 3): True, (20, 7): True, (29, 2): True, (1, 2): True, (3, 1): False, (28, 2): False}
    got = pairs(shapes, list(want)).select("ia", "ib", pred.within(F.col("ga"), F.col("gb")).alias("v")).collect()
    assert {(r.ia, r.ib): r.v for r in got} == want


def test_distance(shapes):
    want = {(1, 24): 3, (1, 25): 5, (1, 26): 0, (1, 27): 0, (20, 1): 0, (22, 3): 2, (24, 25): 13, (9, 27): 2}
    got = pairs(shapes, list(want)).select("ia", "ib", pred.distance(F.col("ga"), F.col("gb")).alias("v")).collect()
    assert {(r.ia, r.ib): pytest.approx(r.v) for r in got} == want


def test_wkt(shapes):
    got = values(shapes, g.to_wkt(F.col("geom"), 0))
    assert got[8] == "POLYGON((0 0, 12 0, 0 9, 0 0))"
    assert got[9] == "LINESTRING(0 0, 10 0, 10 10)"
    assert got[7].startswith("MULTIPOLYGON(((0 0, 10 0")


def test_reprojection_of_a_batch_keeps_its_shape(spark):
    """Zones mixed in a batch, several parts, empty and missing ones; vertices as by the column arithmetic, outside of the JVM's lambdas."""
    parts = [[[(480000.0 + 7 * i, 4400000.0 + 3 * i) for i in range(4)], []], [], [[(510000.0, 4410000.0), (None, 5.0), None]]]
    rows = [(0, (32613, "MultiPolygon", parts)), (1, (32755, "MultiPolygon", parts)), (2, (32613, "Polygon", [])), (3, (32613, "Point", None)),
            (4, None), (5, (None, "Point", parts)), (6, (4326, "LineString", [[[(-105.0, 39.7), (-104.9, 39.8)]]]))]
    df = spark.createDataFrame(rows, "id int, geom " + GEOMETRY.simpleString()).coalesce(1)
    for to in (4326, 32613, 32612):
        out = df.select("id", projection.reproject(F.col("geom"), to).alias("geom"))
        assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r.id: r.geom for r in out.collect()}
        assert got[4] is None and got[5].srid is None and got[3].srid == to and got[3].parts is None and got[2].parts == []
        assert got[0].srid == got[1].srid == got[6].srid == to and got[1].kind == "MultiPolygon"
        assert [[len(path) for path in part] for part in got[1].parts] == [[4, 0], [], [3]]
        if to != 32613:
            assert tuple(got[0].parts[2][0][1]) == (None, None)
    x, y = projection.from_utm(F.lit(480021.0), F.lit(4400009.0), 32755)
    want = spark.range(1).select(*projection.to_utm(x, y, 32612)).first()
    assert tuple(got[1].parts[0][0][3]) == pytest.approx(tuple(want), rel=1e-12)
