"""Dense tiles against single cells: any tile size, crowded tiles, several bands, other grids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions.projection import between_arrays, from_utm, to_utm
from terrane.operators import tiles
from terrane.schema import Grid

GRID = Grid(1000.0, 2000.0, 10.0)
CELLS = "row int, col int, value double"


def cells_of(seed, rows=40, cols=30):
    rng = random.Random(seed)
    return [(r, c, rng.choice([None, float("nan"), rng.randint(0, 9) * 1.0, r + c / 4])) for r in range(-3, rows) for c in range(cols) if rng.random() < 0.9]


def known(cells):
    return {(r, c): None if v is None or v != v else v for r, c, v in cells}


@pytest.mark.parametrize("size", [4, 7, 64])
def test_cells_come_back(spark, size):
    cells = cells_of(size)
    rows = tiles.to_tiles(spark.createDataFrame(cells, CELLS), size)
    assert {(r.row, r.col): r.value for r in tiles.to_cells(rows, size).collect()} == known(cells)
    assert sum(r.cells for r in tiles.counts(rows).collect()) == len(cells)
    assert tiles.to_tiles(spark.createDataFrame([], CELLS), size).count() == 0


@pytest.mark.parametrize("size,crowd", [(4, 2_000_000), (16, 30), (64, 50)])
def test_points_and_polygons_meet_tiles(spark, monkeypatch, size, crowd):
    monkeypatch.setattr(tiles, "CROWD", crowd)
    cells, rng = cells_of(5), random.Random(6)
    values = known(cells)
    layer = tiles.to_tiles(spark.createDataFrame(cells, CELLS), size)
    points = [(i, rng.uniform(900, 1400), rng.uniform(1500, 2100), "x") for i in range(150)] + [(900, None, 5.0, "x")] + [(901, 1015.0, 1995.0, "x")] * 60
    df = spark.createDataFrame(points, "id long, x double, y double, share string").withColumn("value", F.lit("own"))
    for how in ("left", "inner"):
        got = tiles.value_at_points(df, F.col("x"), F.col("y"), layer, GRID, how, "found", size=size).collect()
        want = []
        for i, x, y, _ in points:
            cell = None if x is None else (int((2000.0 - y) // 10), int((x - 1000.0) // 10))
            if how == "left" or cell in values:
                want.append((i, values.get(cell)))
        assert sorted(((r.id, r.found) for r in got), key=repr) == sorted(want, key=repr)
        assert all(r.share == "x" and r.value == "own" for r in got)
    boxes = [(i, x, y, x + rng.uniform(1, 150), y + rng.uniform(1, 150)) for i in range(40) for x, y in [(rng.uniform(950, 1300), rng.uniform(1550, 2000))]]
    poly = g.with_bbox(spark.createDataFrame(boxes, "id long, x0 double, y0 double, x1 double, y1 double")
                       .select("id", g.rectangle(F.col("x0"), F.col("y0"), F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("geom")))
    inside = {i: {k: v for k, v in values.items() if x0 <= 1005 + 10 * k[1] < x1 and y0 <= 1995 - 10 * k[0] < y1} for i, x0, y0, x1, y1 in boxes}
    got = {}
    for r in tiles.clip_to_polygons(poly, layer, GRID, ["id"], size=size).collect():
        got.setdefault(r.id, {})[r.row, r.col] = r.value
    assert got == {i: v for i, v in inside.items() if v}
    for r in tiles.zonal_summary(poly, layer, GRID, ["id"], size=size).collect():
        some = [v for v in inside.pop(r.id).values() if v is not None]
        assert (r["count"], r["max"]) == (len(some), max(some, default=None)) and (r["mean"] is None if not some else r["mean"] == pytest.approx(np.mean(some)))
    assert not any(inside.values())
    histogram = {(r.id, r.value): r.pixel_count for r in tiles.zonal_histogram(poly, layer, GRID, ["id"], size=size).collect()}
    assert histogram == {k: n for k, n in ((k, sum(v == k[1] for v in got.get(k[0], {}).values())) for k in {(i, v) for i, c in got.items() for v in c.values()})
                         if k[1] is not None}


def brute_bilinear(values, source, target):
    out = {}
    for r in range(target.nrows):
        for c in range(target.ncols):
            x, y = between_arrays(np.array([target.x0 + (c + 0.5) * target.cell]), np.array([target.y0 - (r + 0.5) * target.cell]), target.srid, source.srid)
            u, v = (x[0] - source.x0) / source.cell - 0.5, (source.y0 - y[0]) / source.cell - 0.5
            num = den = 0.0
            for i, wi in ((int(np.floor(v)), 1 - v % 1), (int(np.floor(v)) + 1, v % 1)):
                for j, wj in ((int(np.floor(u)), 1 - u % 1), (int(np.floor(u)) + 1, u % 1)):
                    if values.get((i, j)) is not None:
                        num, den = num + wi * wj * values[i, j], den + wi * wj
            out[r, c] = num / den if den > 0 else None
    return out


@pytest.mark.parametrize("resolution,size", [(7.0, 8), (25.0, 4), (25.0, 64), (200.0, 5)])
def test_reprojection_of_the_whole_raster(spark, resolution, size):
    cells = cells_of(8)
    both = spark.createDataFrame([(b, r, c, None if v is None else v * b) for r, c, v in cells for b in (1, 2)], "band int, row int, col int, value double")
    layer, source = tiles.to_tiles(both, size), Grid(-105.1, 39.7, 0.0002, srid=4326)
    sized = tiles.extent(layer, source, size)
    assert (sized.nrows, sized.ncols) == (43, 30) and sized.y0 == pytest.approx(39.7 + 3 * 0.0002)
    target = tiles.target_grid(sized, 32613, resolution)
    got = {b: {} for b in (1, 2)}
    for r in tiles.to_cells(tiles.reproject(layer, source, target, size), size).collect():
        got[r.band][r.row, r.col] = r.value
    want = brute_bilinear(known(cells), source, target)
    for b in (1, 2):
        seen = {k: v for k, v in got[b].items() if v is not None}
        assert seen == pytest.approx({k: v * b for k, v in want.items() if v is not None}) and set(got[b]) <= set(want)


def test_edges_of_the_source_lie_on_the_target(spark):
    source = Grid(-105.3, 39.9, 0.01, nrows=50, ncols=60, srid=4326)
    target = tiles.target_grid(source, 32613, 500.0)
    lon, lat = np.meshgrid(np.linspace(-105.3, -104.7, 200), np.linspace(39.4, 39.9, 200))
    x, y = between_arrays(lon.ravel(), lat.ravel(), 4326, 32613)
    c, r = (x - target.x0) / 500, (target.y0 - y) / 500
    assert c.min() > -0.02 and r.min() > -0.02 and c.max() < target.ncols + 0.02 and r.max() < target.nrows + 0.02


def test_arrays_and_columns_project_alike(spark):
    lon, lat = np.linspace(-108, -102, 50), np.linspace(-60, 70, 50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(lon, lat)], "lon double, lat double")
    rows = df.select(*to_utm(F.col("lon"), F.col("lat"))).collect()
    x, y = between_arrays(lon, lat, 4326, 32613)
    assert np.allclose([tuple(r) for r in rows], np.stack([x, y], 1), rtol=0, atol=1e-6)
    back = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").select(*from_utm(F.col("x"), F.col("y"))).collect()
    assert np.allclose([tuple(r) for r in back], np.stack(between_arrays(x, y, 32613, 4326), 1), atol=1e-10)
    assert np.allclose(between_arrays(x, y, 32613, 32614), between_arrays(lon, lat, 4326, 32614))
    with pytest.raises(ValueError):
        between_arrays(lon, lat, 4326, 2154)


def test_points_with_columns_of_their_own_are_lent_in_small_shares(spark, monkeypatch):
    kept, plain = {}, tiles.stored
    monkeypatch.setattr(tiles, "CROWD", 100)
    monkeypatch.setattr(tiles, "stored", lambda df, label="layer": kept.setdefault(label, plain(df, label)))
    cells = spark.range(16).select(F.floor(F.col("id") / 4).cast("int").alias("row"), (F.col("id") % 4).cast("int").alias("col"), F.col("id").cast("double").alias("value"))
    spots = spark.range(100).select("id", (F.col("id") % 4 + 0.5).cast("double").alias("x"), F.lit(3.5).alias("y"))
    got = tiles.value_at_points(spots, F.col("x"), F.col("y"), tiles.to_tiles(cells), Grid(0.0, 4.0, 1.0))
    assert sorted((r.id, r.value) for r in got.collect()) == [(i, float(i % 4)) for i in range(100)]
    assert kept["crowded-tiles"].first()["shares"] == tiles.POINT_CELLS
