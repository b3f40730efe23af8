"""Searches that stop at bounds: results against brute force, and how much they look at."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.operators import cluster, joins
from tests.test_operators import boxes, brute_dbscan, crowded, gap


def nearest(p, rows):
    return min((gap(p, q), q[0]) for q in rows)


def scattered(n, seed, side=20_000.0):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(0, side), rnd.uniform(0, side), rnd.uniform(1, 30), rnd.uniform(1, 30)) for i in range(n)]


def test_nearest_of_queries_near_far_and_at_the_edge(spark):
    right, rnd = scattered(700, 1) + [(5000, 3000.0, 3000.0, 9000.0, 20.0)], random.Random(2)
    left = [(i, rnd.uniform(-90_000, 90_000), rnd.uniform(-90_000, 90_000), 5.0, 5.0) for i in range(60)]
    left += [(100 + i, rnd.uniform(-3000, 23_000), rnd.uniform(-3000, 23_000), 5.0, 5.0) for i in range(60)]
    got = {r.id: (r.nearest_id, r.dist) for r in joins.nearest_join(boxes(spark, left), boxes(spark, right), digits=None).collect()}
    for p in left:
        dist, rid = nearest(p, right)
        assert got[p[0]][1] == pytest.approx(dist, abs=1e-6) and got[p[0]][0] == rid


def test_far_queries_look_at_the_near_front_only(spark):
    right, rnd = scattered(5000, 3), random.Random(4)
    left = [(i, 10_000 + 60_000 * math.cos(a), 10_000 + 60_000 * math.sin(a), 5.0, 5.0) for i, a in ((i, rnd.uniform(0, 2 * math.pi)) for i in range(100))]
    r, q = boxes(spark, right), boxes(spark, left)
    points = r.select(g.first_vertex(F.col("geom")).alias("v")).select("v.x", "v.y")
    _, top = joins._span(points)
    fine = joins._fine_level(points, top)
    assert joins.search_radius(q, points, joins._span(points)[0], top).filter(F.col("level") <= fine + 1).isEmpty()
    pairs = joins._pairs_by_bounds(q, r, fine, top).select("l_id", "r_id").collect()
    assert len(pairs) <= 6000        # of 500,000
    assert {p[0] for p in left} == {x.l_id for x in pairs} and all((p[0], nearest(p, right)[1]) in {(x.l_id, x.r_id) for x in pairs} for p in left)


def test_nearest_of_one_and_of_equal_features(spark):
    left = [(1, 0.0, 0.0, 1.0, 1.0), (2, 5e5, 5e5, 1.0, 1.0)]
    got = joins.nearest_join(boxes(spark, left), boxes(spark, [(7, 10.0, 0.0, 1.0, 1.0)] * 3 + [(6, 10.0, 0.0, 1.0, 1.0)]), digits=None).collect()
    assert {(r.id, r.nearest_id) for r in got} == {(1, 6), (2, 6)}


def columns_of_wide_boxes(n, apart):
    """Two dense cells' worth of flat boxes on top of each other, all nearly ``apart`` from the other column."""
    rows = [(i, 0.0 + (i % 7) / 100, 30.0 * i / n, 40.0, 0.01) for i in range(n)]
    return rows + [(n + i, 40.06 + apart + (i % 5) / 100, 30.0 * i / n, 40.0, 0.01) for i in range(n)]


@pytest.mark.parametrize("few", [4, 256])
def test_links_of_crowded_cells(spark, monkeypatch, few):
    monkeypatch.setattr(cluster, "FEW_PAIRS", few)
    for rows in (columns_of_wide_boxes(120, 59.99), columns_of_wide_boxes(120, 60.2), [r for r in crowded(260, 9) if r[3] < 100]):
        got = {r.id: r.cluster_id for r in cluster.dbscan(boxes(spark, rows), 60.0, 5).collect()}
        assert got == brute_dbscan(rows, 60.0, 5)


def test_columns_of_wide_boxes_do_not_cost_their_product(spark, monkeypatch):
    looked, keep = [], cluster.stored

    def spy(df, label="layer"):
        out = keep(df, label)
        if label == "part-pairs":
            looked.append(out.count())
        return out
    monkeypatch.setattr(cluster, "stored", spy)
    monkeypatch.setattr(cluster, "FEW_PAIRS", 1)
    work = []
    for n in (150, 600):
        looked.clear()
        dense = boxes(spark, columns_of_wide_boxes(n, 60.2)).withColumns({"cell": F.when(F.col("id") < n, 0).otherwise(1), "x": F.col("xmin"), "y": F.col("ymin")})
        assert cluster._dense_links(dense, 60.0).collect() == []
        work.append(sum(looked))
    assert work[1] <= 8 * work[0] and work[1] < 600 * 600 / 10
