"""Operators against brute force and closed forms on small, skewed inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import projection
from terrane.operators import cluster, joins, raster, zones
from terrane.operators.grid import candidate_pairs
from terrane.sources import vector as src


def boxes(spark, rows):
    df = spark.createDataFrame(rows, "id long, x0 double, y0 double, w double, h double")
    c = F.col
    return g.with_bbox(df.select("id", g.rectangle(c("x0"), c("y0"), c("w"), c("h")).alias("geom")))


def crowded(n, seed, size=6.0):
    """A third of the boxes in one spot, the rest spread, a few huge ones."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = (rnd.uniform(0, 60), rnd.uniform(0, 60)) if i % 3 == 0 else (rnd.uniform(0, 3000), rnd.uniform(0, 3000))
        s = 900.0 if i % 50 == 1 else rnd.uniform(1, size)
        rows.append((i, x, y, s, s / 2))
    return rows


def gap(a, b):
    dx = max(0, a[1] - (b[1] + b[3]), b[1] - (a[1] + a[3]))
    dy = max(0, a[2] - (b[2] + b[4]), b[2] - (a[2] + a[4]))
    return math.hypot(dx, dy)


@pytest.mark.parametrize("hot_rows", [10, 500_000])
def test_candidate_pairs_each_once(spark, hot_rows):
    a, b = crowded(120, 1), crowded(90, 2)
    out = candidate_pairs(boxes(spark, a), boxes(spark, b), hot_rows=hot_rows).select("l_id", "r_id").collect()
    got = [(r.l_id, r.r_id) for r in out]
    assert len(got) == len(set(got))
    assert set(got) == {(p[0], q[0]) for p in a for q in b if gap(p, q) == 0}


def test_nearest_matches_brute_force(spark):
    a, b = crowded(80, 3), crowded(70, 4)
    got = {r.id: (r.nearest_id, r.dist) for r in joins.nearest_join(boxes(spark, a), boxes(spark, b), digits=None).collect()}
    for p in a:
        best = min((gap(p, q), q[0]) for q in b)
        assert got[p[0]][1] == pytest.approx(best[0], abs=1e-6)
        assert got[p[0]][0] == best[1]


def brute_dbscan(rows, eps, k):
    near = {p[0]: {q[0] for q in rows if gap(p, q) <= eps} for p in rows}
    core = {i for i, s in near.items() if len(s) >= k}
    label, left = {}, set(core)
    while left:
        start = min(left)
        todo = [start]
        while todo:
            i = todo.pop()
            if i in left:
                left.discard(i)
                label[i] = start
                todo += [j for j in near[i] if j in left]
    out = dict(label)
    for i in near:
        if i not in core and near[i] & core:
            out[i] = min(label[j] for j in near[i] & core)
    order = {v: n for n, v in enumerate(sorted(set(label.values())))}
    return {i: order[out[i]] if i in out else None for i in near}


@pytest.mark.parametrize("seed", [5, 6])
def test_dbscan_with_dense_cells(spark, seed):
    rnd = random.Random(seed)
    spots = [(rnd.uniform(0, 1500), rnd.uniform(0, 1500)) for _ in range(12)]
    rows = [(i, *(v + rnd.gauss(0, 25) for v in spots[min(i % 20, 11)]), rnd.uniform(1, 9), rnd.uniform(1, 9)) for i in range(220)]
    rows += [(1000 + i, rnd.uniform(0, 1500), rnd.uniform(0, 1500), 3.0, 3.0) for i in range(30)]
    got = {r.id: r.cluster_id for r in cluster.dbscan(boxes(spark, rows), 60.0, 5).collect()}
    assert got == brute_dbscan(rows, 60.0, 5)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in cluster.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200}


def test_zone_area_of_one_segment(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 300.0, 400.0)], "id int, x1 double, y1 double, x2 double, y2 double")
    line = g.linestring(F.array(g.vertex(F.col("x1"), F.col("y1")), g.vertex(F.col("x2"), F.col("y2"))))
    runs = zones.buffer_zones(df.select("id", line.alias("geom")), ["id"], 50.0, 1.0)
    area = runs.agg(F.sum(F.col("hi") - F.col("lo"))).first()[0]
    assert area == pytest.approx(2 * 50 * 500 + math.pi * 2500, rel=1e-4)


def test_projection_reference_points(spark):
    rows = [(-105.0, 0.0, 0.0), (-105.0, 39.6, 4383362.6667), (-105.0, 39.7, 4394461.0170), (-105.0, 39.8, 4405559.5590)]
    df = spark.createDataFrame(rows, "lon double, lat double, want double")
    x, y = projection.to_utm(F.col("lon"), F.col("lat"))
    for r in df.select(x.alias("x"), y.alias("y"), "want").collect():
        assert r.x == pytest.approx(500000, abs=1e-6) and r.y == pytest.approx(r.want, abs=1e-3)


def test_slope_of_a_plane_and_tiling(spark):
    cells = spark.range(400).select(F.floor(F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"))
    cells = cells.withColumn("value", (F.col("col") * 3 + F.col("row") * 4).cast("double"))
    for tile in (7, 256):
        got = {(r.row, r.col): r.value for r in raster.slope_degrees(raster.gradients(cells, 10.0, tile)).collect()}
        for (r, c), v in got.items():
            if 0 < r < 19 and 0 < c < 19:
                assert v == pytest.approx(26.565051, abs=1e-6)
            else:
                assert v is None


def test_opening_does_not_depend_on_tiles(spark):
    rnd = np.random.default_rng(7)
    rows = [(int(r), int(c), float(rnd.integers(0, 50))) for r in range(30) for c in range(30) if rnd.random() > 0.3]
    cells = spark.createDataFrame(rows, "row int, col int, value double")
    a, b = (sorted(map(tuple, raster.opening(cells, 2, t).collect())) for t in (5, 64))
    assert a == b and len(a) == len(rows)


def test_far_hole_stays_null(spark):
    rows = [(0, c, 5.0 if c == 0 else None) for c in range(13)]
    cells = spark.createDataFrame(rows, "row int, col int, value double")
    got = {r.col: r.value for r in raster.fill_nodata(cells, 10).collect()}
    assert got[10] == 5.0 and got[11] is None


def test_feature_collection_round_trip(spark, tmp_path):
    text = ('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::32613"}},'
            '"features":[{"type":"Feature","properties":{"id":1},"geometry":{"type":"MultiPolygon","coordinates":'
            '[[[[0,0],[10,0],[10,10],[0,10],[0,0]]],[[[20,0],[30,0],[30,10],[20,10],[20,0]]]]}},'
            '{"type":"Feature","properties":{"id":2},"geometry":{"type":"Point","coordinates":[3,4]}}]}')
    (tmp_path / "c.json").write_text(text)
    df = src.read_features(spark, str(tmp_path), "id long", "collection")
    got = {r.id: (r.srid, r.kind, r.area) for r in df.select(
        "id", "geom.srid", "geom.kind", g.area(F.col("geom")).alias("area")).collect()}
    assert got == {1: (32613, "MultiPolygon", 200.0), 2: (32613, "Point", 0.0)}


def test_hillshade_faces_the_light(spark):
    """Planes of one steepness facing eight directions, light from the north-west."""
    shade = {}
    for name, angle in zip(("N", "NE", "E", "SE", "S", "SW", "W", "NW"), range(0, 360, 45)):
        # a plane facing angle falls in that direction: dz/deast = -sin, dz/dnorth = -cos, and rows run south
        a = math.radians(angle)
        grad = spark.createDataFrame([(0, 0, -math.sin(a) * 0.5, math.cos(a) * 0.5)], "row int, col int, gx double, gy double")
        shade[name] = raster.hillshade(grad).first().value
        assert raster.aspect_degrees(grad).first().value == pytest.approx(angle, abs=1e-9)
    assert max(shade, key=shade.get) == "NW" and min(shade, key=shade.get) == "SE"
    assert shade["N"] == pytest.approx(shade["W"]) and shade["NE"] == pytest.approx(shade["SW"]) and shade["S"] == pytest.approx(shade["E"])


def test_reprojection_knows_all_zones(spark):
    def moved(srid, x, y, to):
        point = F.struct(F.lit(srid).alias("srid"), F.lit("Point").alias("kind"),
                         F.array(F.array(F.array(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))))).alias("parts"))
        r = spark.range(1).select(projection.reproject(point, to).alias("g")).first().g
        return r.srid, r.parts[0][0][0].x, r.parts[0][0][0].y
    # published coordinates: the CN Tower and the southern edge of the Sydney Opera House
    assert moved(4326, -79.387139, 43.642566, 32617) == (32617, pytest.approx(630084, abs=1), pytest.approx(4833439, abs=1))
    srid, x, y = moved(32613, 480000.0, 4400000.0, 32612)
    assert srid == 32612 and moved(32612, x, y, 32613) == (32613, pytest.approx(480000, abs=1e-3), pytest.approx(4400000, abs=1e-3))
    lonlat = moved(32756, 334900.0, 6252300.0, 4326)
    assert lonlat == (4326, pytest.approx(151.215, abs=2e-3), pytest.approx(-33.857, abs=2e-3))
    assert moved(4326, *lonlat[1:], 32756) == (32756, pytest.approx(334900, abs=1e-3), pytest.approx(6252300, abs=1e-3))
    with pytest.raises(Exception, match="no transformation from SRID 5514"):
        moved(5514, 1.0, 2.0, 32613)


def test_every_crowded_cell_is_split(spark):
    from terrane.operators import grid
    rows = [(i, float(i // 4 * 10), 0.0, 0.5, 0.5) for i in range(8000)]  # 2,000 cells of four
    left, right = boxes(spark, rows), boxes(spark, rows)
    lk = grid._keyed(left, "l_", 0, [0], 1, False, False)
    rk = grid._keyed(right, "r_", 1, [0], 0, True, False)
    a, b = grid._split(lk, rk, 2)
    assert a.select(*grid.KEYS, "_kl").distinct().groupBy(*grid.KEYS).count().filter("count > 1").count() > 1024
    got = candidate_pairs(left, right, hot_rows=2)
    assert got.count() == got.select("l_id", "r_id").distinct().count() == 2000 * 16
