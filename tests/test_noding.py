"""Rebuilt polygons against the even-odd rule at points, and holes that nest wrongly."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import noding
from terrane.functions import predicates as pred
from tests.test_simplify import crosses


def odd(v, rings):
    return sum(noding.side(v, r) > 0 for r in rings) % 2 == 1


def tangle(rng, n, size=10.0):
    p = [(rng.uniform(0, size), rng.uniform(0, size)) for _ in range(n)]
    return [*p, p[0]]


@pytest.mark.parametrize("whole", [False, True])
def test_parts_cover_what_an_odd_number_of_rings_covers(whole):
    rng = random.Random(1)
    for _ in range(120):
        rings = [tangle(rng, rng.randint(3, 9)) for _ in range(rng.randint(1, 3))]
        if whole:     # corners on each other, edges along each other
            rings = [[(round(x), round(y)) for x, y in r] for r in rings]
            rings = [r for r in rings if noding.area(r) != 0 or len(set(r)) > 3]
        parts = noding.rebuilt(rings)
        for _ in range(60):
            v = (rng.uniform(-1, 11), rng.uniform(-1, 11))
            # crossings counted along one ray over all rings, crossing rings included
            by_rule = sum((a[1] > v[1]) != (b[1] > v[1]) and v[0] < (b[0] - a[0]) * (v[1] - a[1]) / (b[1] - a[1]) + a[0] for r in rings for a, b in zip(r, r[1:])) % 2
            covered = sum(noding.side(v, part[0]) > 0 and not any(noding.side(v, h) > 0 for h in part[1:]) for part in parts)
            assert covered == by_rule
        assert not crosses([r for part in parts for r in part])
        assert all(noding.area(part[0]) > 0 and all(noding.area(h) < 0 for h in part[1:]) for part in parts)


def test_known_shapes():
    star = [(math.cos(a), math.sin(a)) for a in np.arange(6) * 4 * math.pi / 5]
    parts = noding.rebuilt([star])
    assert len(parts) == 5 and all(len(p) == 1 and len(p[0]) == 4 for p in parts)      # five tips round an open middle
    big, small, apart = ([(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)] for x, y, s in ((0, 0, 10), (2, 2, 4), (20, 0, 5)))
    assert noding.rebuilt([big, big]) == [] and sorted(len(p) for p in noding.rebuilt([big, small, apart])) == [1, 2]
    assert sum(noding.area(r) for p in noding.rebuilt([big, [(x + 5, y + 5) for x, y in big]]) for r in p) == pytest.approx(150)


def geoms(spark, rows):
    rows = [(i, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in part] for part in parts]) for i, parts in rows]
    return spark.createDataFrame(rows, "id long, parts array<array<array<struct<x:double,y:double>>>>").select(
        "id", g.geometry(F.when(F.size("parts") > 1, "MultiPolygon").otherwise("Polygon"), F.col("parts")).alias("geom"))


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def test_repair_and_reasons(spark):
    rng = random.Random(2)
    known = {1: ([[square(0, 0, 20), square(2, 2, 4), square(10, 10, 4)]], None), 2: ([[square(0, 0, 20), square(2, 2, 10), square(4, 4, 2)]], "nested holes"),
             3: ([[square(0, 0, 20), square(2, 2, 10), square(8, 8, 6)]], "self-intersection"), 4: ([[square(0, 0, 20), square(30, 0, 5)]], "hole outside shell"),
             5: ([[square(0, 0, 20), square(2, 2, 4), square(2, 2, 4)]], "nested holes"), 6: ([[square(0, 0, 20), square(15, 15, 10)]], "self-intersection")}
    tangled = [(100 + i, [[tangle(rng, rng.randint(4, 8)) for _ in range(rng.randint(1, 2))]]) for i in range(40)]
    df = geoms(spark, [(i, p) for i, (p, _) in known.items()] + tangled)
    why = {r.id: r.why for r in df.select("id", pred.invalid_reason(F.col("geom")).alias("why")).collect()}
    assert all(why[i] == reason for i, (_, reason) in known.items())
    fixed = {r.id: r.geom for r in df.select("id", pred.make_valid(F.col("geom")).alias("geom")).collect()}
    back = spark.createDataFrame([(i, v) for i, v in fixed.items()], df.schema)
    out = {r.id: (r.ok, r.area) for r in back.select("id", pred.is_valid(F.col("geom")).alias("ok"), g.area(F.col("geom")).alias("area")).collect()}
    assert all(ok for ok, _ in out.values())
    assert [out[i][1] for i in (1, 2, 3, 4, 5, 6)] == pytest.approx([400 - 16 - 16, 400 - 100 + 4, 400 - 100 - 36 + 2 * 16, 425, 400, 400 + 100 - 2 * 25])


def test_few_edges_in_plain_numbers_as_in_arrays(monkeypatch):
    rnd = random.Random(8)
    shapes = []
    for k in range(400):
        ring = [(float(rnd.randrange(12)), 4385000.0 + rnd.randrange(12)) if k % 2 else (rnd.uniform(0, 50), rnd.uniform(0, 50)) for _ in range(rnd.randrange(4, 12))]
        shapes.append([ring + ring[:1]])
    plain = [noding.rebuilt(rings) for rings in shapes]
    monkeypatch.setattr(noding, "FEW", 0)
    assert plain == [noding.rebuilt(rings) for rings in shapes]
