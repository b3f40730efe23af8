"""Simplification keeps rings apart from each other and from themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.functions.simplify import kept_together, kept_vertices, simplify
from terrane.session import stored


def star(rng, cx, cy, low, high, n, turn=1):
    at = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    p = [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in ((a, rng.uniform(low, high)) for a in at)][::turn]
    return [*p, p[0]]


def crosses(rings):
    segments = [(r[i], r[i + 1], n, i, len(r) - 1) for n, r in enumerate(rings) for i in range(len(r) - 1)]

    def side(a, b, v):
        return (b[0] - a[0]) * (v[1] - a[1]) - (b[1] - a[1]) * (v[0] - a[0])
    for k, (a, b, n, i, size) in enumerate(segments):
        for c, d, m, j, _ in segments[:k]:
            if n == m and (abs(i - j) == 1 or abs(i - j) == size - 1):
                continue
            if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
                return True
    return False


def inside(v, ring):
    return sum((a[1] > v[1]) != (b[1] > v[1]) and v[0] < (b[0] - a[0]) * (v[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:])) % 2 == 1


def thinned(rings, tolerance):
    arrays = [tuple(np.array([p[k] for p in r]) for k in (0, 1)) for r in rings]
    return [[p for p, k in zip(r, m) if k] for r, m in zip(rings, kept_together(arrays, tolerance, 4))]


def test_random_polygons_with_holes_stay_simple():
    rng, plain_crossed, removed = random.Random(1), 0, 0
    for _ in range(150):
        rings = [star(rng, 0, 0, 6.0, 10.0, 60)]
        for cx, cy in ((-2, -2), (2.4, 2), (2.5, -2.5)):
            rings.append(star(rng, cx, cy, 0.8, 2.0, 14, -1))
        if crosses(rings):
            continue
        tolerance = rng.choice([0.5, 2.0, 5.0])
        out = thinned(rings, tolerance)
        arrays = [tuple(np.array([p[k] for p in r]) for k in (0, 1)) for r in rings]
        plain = [[p for p, k in zip(r, kept_vertices(*a, tolerance, 4)) if k] for r, a in zip(rings, arrays)]
        plain_crossed += crosses(plain) or not all(inside(v, plain[0]) for h in plain[1:] for v in h)
        removed += sum(map(len, rings)) - sum(map(len, out))
        assert not crosses(out)
        assert all(inside(v, out[0]) for h in out[1:] for v in h)
        assert not any(inside(v, h) for i, h in enumerate(out[1:]) for j, o in enumerate(out[1:]) if i != j for v in o)
        assert all(len(r) >= 4 for r in out)
    assert plain_crossed >= 5 and removed > 1000     # the plain rule goes wrong on some of these


def test_a_hole_in_a_bulge_is_not_jumped_over():
    shell = [(0, 0), (10, 0), (10, 4), (5.5, 5), (5, 5.2), (4.5, 5), (0, 4), (0, 0)]
    hole = [(4.9, 4.6), (5.1, 4.6), (5.0, 4.9), (4.9, 4.6)]
    out = thinned([shell, hole], 1.5)
    assert all(inside(v, out[0]) for v in out[1]) and not crosses(out) and len(out[0]) < len(shell)


def test_without_conflicts_as_douglas_peucker():
    rng = random.Random(2)
    for _ in range(100):
        x = np.cumsum([rng.uniform(0.1, 1) for _ in range(40)])      # a line that only goes on cannot meet itself
        y = np.array([rng.uniform(0, 2) for _ in range(40)])
        (mask,) = kept_together([(x, y)], 0.7, 2)
        assert mask.tolist() == kept_vertices(x, y, 0.7, 2).tolist()


@pytest.mark.parametrize("tolerance", [1.0, 4.0])
def test_simplified_features_are_valid(spark, tolerance):
    rng, rows = random.Random(3), []
    for i in range(40):
        rings = [star(rng, 0, 0, 7.0, 10.0, 50), star(rng, 1, 1, 1.0, 4.0, 25, -1)]
        rows.append((i, [[[{"x": x, "y": y} for x, y in r] for r in rings]]))
    df = spark.createDataFrame(rows, "id long, parts array<array<array<struct<x:double,y:double>>>>").select(
        "id", g.geometry("Polygon", F.col("parts")).alias("geom")).filter(pred.is_valid(F.col("geom")))
    out = stored(simplify(df, tolerance)).select(pred.is_valid(F.col("geom")).alias("ok"), F.size(g.vertices(F.col("geom"))).alias("n")).collect()
    assert len(out) > 20 and all(r.ok for r in out) and np.mean([r.n for r in out]) < 70
