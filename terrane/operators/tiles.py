"""Rasters as dense tiles: one row holds ``size`` x ``size`` cells of a band.

A tile row is (band, trow, tcol, values, present, valid): the values row by row,
and two bitmaps, one of the cells that belong to the raster and one of those
among them that have a value (NaN counts as nodata). Points and polygon runs meet
tiles by tile key, so what is exchanged are tiles, points and runs and never
single cells; tiles that more than ``CROWD`` cells ask for are lent to several
tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from terrane.functions import geometry as g
from terrane.functions.projection import between_arrays
from terrane.operators.zones import polygon_runs
from terrane.schema import TILE_CELLS, Grid
from terrane.session import chosen_broadcast, stored

_INT, _LONG, _REAL = T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


TILE = _struct(band=_INT, trow=_INT, tcol=_INT, values=T.ArrayType(_REAL), present=T.BinaryType(), valid=T.BinaryType())
_PART = _struct(band=_INT, trow=_INT, tcol=_INT, pos=T.ArrayType(_INT), num=T.ArrayType(_REAL), den=T.ArrayType(_REAL))
CROWD = 2_000_000     # cells asked of one tile by one task
POINT_CELLS = 8       # cells that a point counts for: it brings its own columns, often a geometry
CROWDED = 100_000     # crowded tiles that are broadcast at most
EDGE_POINTS = 65      # points along each edge that bound a reprojected raster
KEYS = ["trow", "tcol", "share"]


# ── tiles and cells ─────────────────────────────────────────────────────────
def _packed(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _mask(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).view(bool)


def _tile(band: int, trow: int, tcol: int, values: np.ndarray, present: np.ndarray) -> dict:
    valid = present & ~np.isnan(values)
    return {"band": band, "trow": trow, "tcol": tcol, "values": np.where(valid, values, 0.0), "present": _packed(present), "valid": _packed(valid)}


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist([r | {"values": r["values"].tolist()} for r in rows], schema=to_arrow_schema(TILE))


def _arrays(table: pa.Table | pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, present, valid) of one tile row."""
    values = table.column("values")[i].values.to_numpy(zero_copy_only=False)
    return values, *(_mask(table.column(c)[i].as_py(), len(values)) for c in ("present", "valid"))


def tile_key(row: Column, col: Column, size: int) -> tuple[Column, Column]:
    return F.floor(row / size).cast("int"), F.floor(col / size).cast("int")


def to_tiles(cells: DataFrame, size: int = TILE_CELLS) -> DataFrame:
    """Dense tiles of (row, col, value) cells, and band if there is one; a null value is nodata, an absent cell is none."""
    trow, tcol = tile_key(F.col("row"), F.col("col"), size)
    band = F.col("band").cast("int") if "band" in cells.columns else F.lit(1)
    pos = (F.pmod(F.col("row"), F.lit(size)) * size + F.pmod(F.col("col"), F.lit(size))).cast("int")

    def build(table: pa.Table) -> pa.Table:
        at, values, present = table["pos"].to_numpy(), np.full(size * size, np.nan), np.zeros(size * size, bool)
        values[at], present[at] = table["value"].to_numpy(), True
        return _table([_tile(*(table[k][0].as_py() for k in ("band", "trow", "tcol")), values, present)])
    keyed = cells.select(band.alias("band"), trow.alias("trow"), tcol.alias("tcol"), pos.alias("pos"), F.col("value").cast("double").alias("value"))
    return keyed.groupBy("band", "trow", "tcol").applyInArrow(build, TILE)


def to_cells(tiles: DataFrame, size: int = TILE_CELLS) -> DataFrame:
    """(band, row, col, value) of every cell of the raster."""
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values, present, valid = _arrays(batch, i)
                at = np.flatnonzero(present)
                band, trow, tcol = (batch.column(k)[i].as_py() for k in ("band", "trow", "tcol"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), band, np.int32)), pa.array((trow * size + at // size).astype(np.int32)),
                     pa.array((tcol * size + at % size).astype(np.int32)), pa.array(values[at], mask=~valid[at])], names=["band", "row", "col", "value"])
    return tiles.mapInArrow(flat, "band int, row int, col int, value double")


def counts(tiles: DataFrame) -> DataFrame:
    """(band, trow, tcol, cells, filled, total) of each tile."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p.sum(), k.sum(), v[k].sum()) for v, p, k in (_arrays(batch, i) for i in range(batch.num_rows))]
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("band", "trow", "tcol")),
                                              *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64())))],
                                             names=["band", "trow", "tcol", "cells", "filled", "total"])
    return tiles.mapInArrow(count, "band int, trow int, tcol int, cells long, filled long, total double")


# ── points and polygons on tiles ────────────────────────────────────────────
def _meet(parts: DataFrame, tiles: DataFrame, weight: Column, fn: Callable[[pa.Table, tuple | None], pa.Table], schema: T.StructType) -> DataFrame:
    """``fn(parts, (values, present, valid) or None)`` of each tile that parts ask for; ``weight`` is how many cells a part asks for."""
    shares = F.ceil(F.sum(weight) / CROWD).cast("int")
    crowded = stored(parts.groupBy("trow", "tcol").agg(shares.alias("shares")).filter("shares > 1"), "crowded-tiles")
    if crowded.isEmpty():
        parts, tiles = (df.withColumn("share", F.lit(0)) for df in (parts, tiles))
    else:
        known, one = chosen_broadcast(crowded, CROWDED), F.coalesce("shares", F.lit(1))
        parts = (stored(parts, "tile-parts").join(known, ["trow", "tcol"], "left")
                 .withColumn("share", (F.monotonically_increasing_id() % one).cast("int")).drop("shares"))
        tiles = (tiles.join(known, ["trow", "tcol"], "left").withColumn("share", F.explode(F.sequence(F.lit(0), one - 1))).drop("shares"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left, _arrays(right, 0) if right.num_rows else None).cast(arrow)
    arrow = to_arrow_schema(schema)
    return parts.groupBy(*KEYS).cogroup(tiles.groupBy(*KEYS)).applyInArrow(run, schema)


def _none(schema: T.StructType) -> pa.Table:
    return to_arrow_schema(schema).empty_table()


def cell_of(x: Column, y: Column, grid: Grid) -> tuple[Column, Column]:
    return (F.floor((F.lit(grid.y0) - y) / grid.cell).cast("int"),
            F.floor((x - grid.x0) / grid.cell).cast("int"))


def value_at_points(points: DataFrame, x: Column, y: Column, tiles: DataFrame, grid: Grid, how: str = "inner",
                    name: str = "value", band: int = 1, size: int = TILE_CELLS) -> DataFrame:
    """Raster value under each point; nodata gives null, a missing cell no row (or null if left)."""
    row, col = cell_of(x, y, grid)
    schema = T.StructType([*points.schema.fields, T.StructField(name, _REAL)])
    trow, tcol = tile_key(row, col, size)
    pos = (F.pmod(row, F.lit(size)) * size + F.pmod(col, F.lit(size))).cast("int")
    own = {c: f"_{i}" for i, c in enumerate(points.columns)}       # their names may clash with the keys
    parts = points.select(*[F.col(c).alias(n) for c, n in own.items()], trow.alias("trow"), tcol.alias("tcol"), pos.alias("pos"))

    def look(left: pa.Table, tile: tuple | None) -> pa.Table:
        at = left["pos"].to_numpy(zero_copy_only=False)
        known = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), bool)     # a point without coordinates is on no cell
        at = np.where(known, at, 0).astype(int)
        values, present, valid = tile or (np.zeros(size * size), *[np.zeros(size * size, bool)] * 2)
        got = left.select(list(own.values())).append_column(name, pa.array(values[at], mask=~(valid[at] & known))).rename_columns([*own, name])
        return got if how == "left" else got.filter(pa.array(present[at] & known))
    return _meet(parts, tiles.filter(F.col("band") == band), F.lit(POINT_CELLS), look, schema)


def value_at_centroids(features: DataFrame, tiles: DataFrame, grid: Grid, how: str = "inner", name: str = "value",
                       size: int = TILE_CELLS) -> DataFrame:
    centred = features.withColumn("_c", g.centroid(F.col("geom")))
    return value_at_points(centred, F.col("_c.x"), F.col("_c.y"), tiles, grid, how, name, size=size).drop("_c")


def _on_polygons(polygons: DataFrame, tiles: DataFrame, grid: Grid, keep: list[str], band: int, size: int,
                 fn: Callable, rest: T.StructType) -> DataFrame:
    """``fn(runs, flat start, flat end, values, present, valid)`` gives the columns of ``rest`` and which run each row is of."""
    runs = polygon_runs(polygons, grid, keep)
    own = {c: f"_{i}" for i, c in enumerate(keep)}
    left = F.col("tcol") * size
    parts = (runs.withColumn("trow", F.floor(F.col("row") / size).cast("int"))
             .withColumn("tcol", F.explode(F.sequence(F.floor(F.col("c0") / size).cast("int"), F.floor(F.col("c1") / size).cast("int"))))
             .select(*[F.col(c).alias(n) for c, n in own.items()], "trow", "tcol", F.pmod("row", F.lit(size)).alias("r"),
                     (F.greatest("c0", left) - left).alias("a"), (F.least(F.col("c1"), left + size - 1) - left + 1).alias("b")))
    schema = T.StructType([*[runs.schema[c] for c in keep], *rest.fields])

    def meet(table: pa.Table, tile: tuple | None) -> pa.Table:
        if tile is None:
            return _none(schema)
        base = table["r"].to_numpy() * size
        which, columns = fn(table, base + table["a"].to_numpy(), base + table["b"].to_numpy(), *tile)
        out = table.select(list(own.values())).take(pa.array(which)).rename_columns(keep)
        for f, c in zip(rest.fields, columns):
            out = out.append_column(f.name, c)
        return out
    return _meet(parts, tiles.filter(F.col("band") == band), F.col("b") - F.col("a"), meet, schema)


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, flat position) of every cell of the runs."""
    width = end - start
    run = np.repeat(np.arange(len(start)), width)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(width) - width, width) + start[run]


def clip_to_polygons(polygons: DataFrame, tiles: DataFrame, grid: Grid, keep: list[str], band: int = 1, size: int = TILE_CELLS) -> DataFrame:
    """Cells of each polygon (centre rule) with their values: keep, row, col, value."""
    def clip(table, start, end, values, present, valid):
        run, at = _spread(start, end)
        run, at = run[present[at]], at[present[at]]
        top, left = (table[k].to_numpy()[run] * size for k in ("trow", "tcol"))
        return run, [pa.array((top + at // size).astype(np.int32)), pa.array((left + at % size).astype(np.int32)), pa.array(values[at], mask=~valid[at])]
    return _on_polygons(polygons, tiles, grid, keep, band, size, clip, _struct(row=_INT, col=_INT, value=_REAL))


def zonal_summary(polygons: DataFrame, tiles: DataFrame, grid: Grid, keep: list[str], band: int = 1, size: int = TILE_CELLS) -> DataFrame:
    """Mean, max and count of the cells with a value in each polygon that meets the raster."""
    def part(table, start, end, values, present, valid):
        edges = np.stack([start, end], 1).ravel()

        def fold(op, cells):
            return op.reduceat(np.append(cells, cells[:1]), edges)[::2]
        n = fold(np.add, valid.astype(np.int64))
        some = np.flatnonzero(fold(np.add, present.astype(np.int64)))
        total, top = fold(np.add, np.where(valid, values, 0.0)), fold(np.maximum, np.where(valid, values, -np.inf))
        return some, [pa.array(total[some]), pa.array(top[some], mask=n[some] == 0), pa.array(n[some])]
    parts = _on_polygons(polygons, tiles, grid, keep, band, size, part, _struct(total=_REAL, top=_REAL, n=_LONG))
    return parts.groupBy(*keep).agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mean"), F.max("top").alias("max"), F.sum("n").alias("count"))


def zonal_histogram(polygons: DataFrame, tiles: DataFrame, grid: Grid, keep: list[str], band: int = 1, size: int = TILE_CELLS) -> DataFrame:
    """Cells of each value in each polygon; nodata does not count."""
    def part(table, start, end, values, present, valid):
        run, at = _spread(start, end)
        run, at = run[valid[at]], at[valid[at]]
        kinds, code = np.unique(values[at], return_inverse=True)
        pair, n = np.unique(run * max(1, len(kinds)) + code, return_counts=True)
        return pair // max(1, len(kinds)), [pa.array(kinds[pair % max(1, len(kinds))]), pa.array(n)]
    parts = _on_polygons(polygons, tiles, grid, keep, band, size, part, _struct(value=_REAL, n=_LONG))
    return parts.groupBy(*keep, "value").agg(F.sum("n").alias("pixel_count"))


# ── another grid or reference system ────────────────────────────────────────
def extent(tiles: DataFrame, grid: Grid, size: int = TILE_CELLS) -> Grid:
    """``grid`` moved and sized to the cells that the raster has."""
    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                at = np.flatnonzero(_arrays(batch, i)[1])
                if len(at):
                    r, c = at // size + batch.column("trow")[i].as_py() * size, at % size + batch.column("tcol")[i].as_py() * size
                    rows.append([int(v) for v in (r.min(), r.max(), c.min(), c.max())])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["r0", "r1", "c0", "c1"])
    e = tiles.mapInArrow(box, "r0 long, r1 long, c0 long, c1 long").agg(F.min("r0"), F.max("r1"), F.min("c0"), F.max("c1")).first()
    if e[0] is None:
        return Grid(grid.x0, grid.y0, grid.cell, nrows=0, ncols=0, srid=grid.srid)
    return Grid(grid.x0 + e[2] * grid.cell, grid.y0 - e[0] * grid.cell, grid.cell, nrows=e[1] - e[0] + 1, ncols=e[3] - e[2] + 1, srid=grid.srid)


def target_grid(source: Grid, srid: int, resolution: float) -> Grid:
    """The grid of ``resolution`` in ``srid`` that covers a sized source grid: its edges are brought over
    point by point, the top left corner of their bounds is the target's."""
    t = np.linspace(0.0, 1.0, EDGE_POINTS)
    width, height = source.ncols * source.cell, source.nrows * source.cell
    x = source.x0 + np.concatenate([t * width, t * width, 0 * t, 0 * t + width])
    y = source.y0 - np.concatenate([0 * t, 0 * t + height, t * height, t * height])
    x, y = between_arrays(x, y, source.srid, srid)
    return Grid(float(x.min()), float(y.max()), resolution, nrows=int(np.ceil((y.max() - y.min()) / resolution)),
                ncols=int(np.ceil((x.max() - x.min()) / resolution)), srid=srid)


def reproject(tiles: DataFrame, source: Grid, target: Grid, size: int = TILE_CELLS) -> DataFrame:
    """Tiles of all bands on ``target`` (sized), bilinear.

    Every target centre weighs its four source neighbours; those without a value drop out and the rest
    is renormalised, a centre without any is nodata. Each source tile adds what its own cells give to
    the target tiles it reaches; these sparse parts are exchanged and added up, at most four for a cell,
    whatever the two resolutions are.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values, _, valid = _arrays(batch, i)
                top, left = (batch.column(k)[i].as_py() * size for k in ("trow", "tcol"))
                for trow, tcol in _reached(top, left, size, source, target):
                    pos, num, den = _shares(values, valid, top, left, size, source, target, trow, tcol)
                    if len(pos):
                        yield pa.RecordBatch.from_pydict(
                            {"band": [batch.column("band")[i].as_py()], "trow": [trow], "tcol": [tcol], "pos": [pos], "num": [num], "den": [den]},
                            schema=to_arrow_schema(_PART))

    def merge(table: pa.Table) -> pa.Table:
        num, den = np.zeros(size * size), np.zeros(size * size)
        for i in range(table.num_rows):
            at = table["pos"][i].values.to_numpy(zero_copy_only=False)
            num[at] += table["num"][i].values.to_numpy(zero_copy_only=False)
            den[at] += table["den"][i].values.to_numpy(zero_copy_only=False)
        band, trow, tcol = (table[k][0].as_py() for k in ("band", "trow", "tcol"))
        at = np.arange(size * size)
        present = (trow * size + at // size < target.nrows) & (tcol * size + at % size < target.ncols)
        with np.errstate(invalid="ignore", divide="ignore"):
            return _table([_tile(band, trow, tcol, np.where(den > 0, num / den, np.nan), present)])
    return tiles.mapInArrow(add, _PART).groupBy("band", "trow", "tcol").applyInArrow(merge, TILE)


def _reached(top: int, left: int, size: int, source: Grid, target: Grid) -> list[tuple[int, int]]:
    """Keys of the target tiles that hold centres whose neighbours may be in a source tile."""
    t = np.arange(-1.0, size + 2)
    ends = np.full(len(t), -1.0), np.full(len(t), size + 1.0)
    c, r = np.concatenate([t, t, *ends]) + left, np.concatenate([*ends, t, t]) + top
    x, y = between_arrays(source.x0 + c * source.cell, source.y0 - r * source.cell, source.srid, target.srid)
    c, r = (x - target.x0) / target.cell, (target.y0 - y) / target.cell
    keep = np.isfinite(c) & np.isfinite(r)
    if not keep.any():
        return []
    (r0, r1), (c0, c1) = (((max(0, int(np.floor(v[keep].min())) - 1)) // size, min(n - 1, int(np.ceil(v[keep].max())) + 1) // size)
                          for v, n in ((r, target.nrows), (c, target.ncols)))
    return [(i, j) for i in range(r0, r1 + 1) for j in range(c0, c1 + 1)]


def _shares(values, valid, top, left, size, source, target, trow, tcol) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, weighted sum, weight) that a source tile gives to the centres of a target tile."""
    rows = np.arange(trow * size, min((trow + 1) * size, target.nrows))
    cols = np.arange(tcol * size, min((tcol + 1) * size, target.ncols))
    r, c = (a.ravel() for a in np.meshgrid(rows, cols, indexing="ij"))
    x, y = between_arrays(target.x0 + (c + 0.5) * target.cell, target.y0 - (r + 0.5) * target.cell, target.srid, source.srid)
    u, v = (x - source.x0) / source.cell - 0.5 - left, (source.y0 - y) / source.cell - 0.5 - top
    near = (u >= -1) & (u < size) & (v >= -1) & (v < size)
    u, v, pos = u[near], v[near], ((r - trow * size) * size + c - tcol * size)[near]
    fu, fv = u - np.floor(u), v - np.floor(v)
    num, den = np.zeros(len(u)), np.zeros(len(u))
    for dr in (0, 1):
        for dc in (0, 1):
            i, j = np.floor(v).astype(int) + dr, np.floor(u).astype(int) + dc
            inside = (i >= 0) & (i < size) & (j >= 0) & (j < size)
            at = np.where(inside, i * size + j, 0)
            w = np.where(inside & valid[at], (fv if dr else 1 - fv) * (fu if dc else 1 - fu), 0.0)
            num += w * values[at]
            den += w
    some = den > 0
    return pos[some].astype(np.int32), num[some], den[some]
