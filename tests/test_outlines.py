"""Zone polygons against flood fill on random cells, with rings that cross tiles and blocks."""

import random

import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.operators import joins, outlines

W, H, TILE = 17, 14, 4


def runs_of(occupied, zone):
    rows = []
    for k in range(H):
        for t in range(-(-W // TILE)):
            i, end = t * TILE, min(W, (t + 1) * TILE)
            while i < end:
                j = i
                while j < end and (k, j) in occupied:
                    j += 1
                if j > i:
                    rows.append((zone, k, t, float(i), float(j)))
                i = max(j, i + 1)
    return rows


def regions(cells, steps):
    left, n = set(cells), 0
    while left:
        n, stack = n + 1, [left.pop()]
        while stack:
            k, i = stack.pop()
            for dk, di in steps:
                if (k + dk, i + di) in left:
                    left.remove((k + dk, i + di))
                    stack.append((k + dk, i + di))
    return n


@pytest.fixture(scope="module")
def zoned():
    rng = random.Random(3)
    zones = {z: {(k, i) for k in range(H) for i in range(W) if rng.random() < share} for z, share in (("thin", 0.5), ("thick", 0.78), (None, 0.65))}
    ring = {(k, i) for k in range(H) for i in range(W) if k in (1, 12) and 1 <= i <= 15 or i in (1, 15) and 1 <= k <= 12 or (k in (4, 9) and 4 <= i <= 12) or (i in (4, 12) and 4 <= k <= 9)}
    return zones | {"rings": ring}   # a ring within the hole of a ring


@pytest.mark.parametrize("width,lines", [(1024.0, 128), (3.0, 2)])
def test_polygons_are_the_regions(spark, zoned, width, lines):
    rows = [r for z, cells in zoned.items() for r in runs_of(cells, z)]
    runs = spark.createDataFrame(rows, "highway string, k long, tile long, lo double, hi double")
    out = outlines.polygons(runs, ["highway"], 2.0, tile=float(TILE), width=width, lines=lines)
    got = out.select("highway", F.size(g.paths(F.col("geom"))).alias("rings"), g.area(F.col("geom")).alias("area"), pred.is_valid(F.col("geom")).alias("ok")).collect()
    near = [(0, 1), (1, 0), (0, -1), (-1, 0)]
    for zone, cells in zoned.items():
        own = [r for r in got if r.highway == zone]
        outside = {(k, i) for k in range(-1, H + 1) for i in range(-1, W + 1)} - cells
        assert len(own) == regions(cells, near)
        assert sum(r.rings - 1 for r in own) == regions(outside, near + [(1, 1), (1, -1), (-1, 1), (-1, -1)]) - 1
        assert sum(r.area for r in own) == 2.0 * len(cells)


def test_a_whole_zone_and_none(spark, zoned):
    runs = spark.createDataFrame(runs_of(zoned["rings"], "x"), "highway string, k long, tile long, lo double, hi double")
    out = outlines.polygons(runs, [], 1.0, tile=float(TILE)).collect()
    assert sorted(len(r.geom.parts[0]) for r in out) == [2, 2]
    assert outlines.polygons(runs.limit(0), ["highway"], 1.0).collect() == []


def test_holes_come_to_their_shell_without_meeting_shells(spark, monkeypatch):
    """Holes one behind the other in two zone parts: each is named by the run to its left, no ring is held against another."""
    once = joins._within

    def slab(x0, holes):
        rows = [("z", k, 0, x0, x0 + 10.0 * holes + 5) for k in (0, 2)]
        return rows + [("z", 1, 0, x0 + 10.0 * i, x0 + 10.0 * i + 5) for i in range(holes + 1)]
    runs = spark.createDataFrame(slab(0.0, 11) + slab(500.0, 3), "highway string, k long, tile long, lo double, hi double")
    met = []
    monkeypatch.setattr(joins, "_within", lambda *sides: met.append(sides) or once(*sides))
    out = outlines.polygons(runs, ["highway"], 2.0, tile=4096.0)
    assert not met
    rows = [r.geom.parts[0] for r in out.collect()]
    assert sorted(len(p) for p in rows) == [4, 12]
    for shell, *holes in rows:
        lo, hi = min(v.x for v in shell), max(v.x for v in shell)
        assert all(lo < v.x < hi for h in holes for v in h)
