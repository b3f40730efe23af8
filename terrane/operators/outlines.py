"""Zone polygons: the runs of scan lines traced into rings, with holes.

A run is a box as high as the lines are apart, so a zone's outline consists of
upright edges at the ends of its runs and of level edges where one of two
neighbouring lines is covered and the other is not. Every edge has the zone on
its left and names the edge that follows it: where two zones' corners touch, the
outline turns left, so rings touch and never cross. Shells run counter-clockwise,
holes clockwise.

Edges are chained block by block, each in a task of its own. Rings that cross
blocks are put together from these chains: the chains of a ring find their least
member by pointer doubling and then their distance from it, in rounds that grow
with the logarithm of the longest ring. No step holds more than a block or one
ring, which is a row of the result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.operators.zones import DEFAULT_DY, TILE_M
from terrane.session import stored

BLOCK_M = 1024.0      # blocks in which edges are chained: width in metres ...
BLOCK_LINES = 128     # ... and height in lines
EAST, NORTH, WEST, SOUTH = range(4)
_EDGE = "zone string, x double, l long, d int, x1 double, l1 long"
_CHAIN = "zone string, x double, l long, d int, tx double, tl long, td int, closed boolean, xs array<double>, ls array<long>"


def edges(runs: DataFrame, tile: float = TILE_M) -> DataFrame:
    """(zone, x, l, d, x1, l1): the outline's edges from (x, line border l) in direction d; ``runs``: zone, k, tile, lo, hi."""
    ends = runs.select("zone", "k", F.explode(F.array(F.struct(F.col("hi").alias("x"), F.lit(1).alias("s")),
                                                      F.struct(F.col("lo").alias("x"), F.lit(-1).alias("s")))).alias("e"))
    ends = ends.groupBy("zone", "k", F.col("e.x").alias("x")).agg(F.sum("e.s").alias("s")).filter("s != 0")   # runs cut at a tile's border go on
    right = F.col("s") > 0
    upright = ends.select("zone", "x", F.when(right, F.col("k")).otherwise(F.col("k") + 1).alias("l"), F.when(right, NORTH).otherwise(SOUTH).alias("d"),
                          F.col("x").alias("x1"), F.when(right, F.col("k") + 1).otherwise(F.col("k")).alias("l1"))

    def event(border: Column, x: str, above: int, below: int) -> Column:
        return F.struct(border.alias("l"), F.col(x).alias("x"), F.lit(above).alias("above"), F.lit(below).alias("below"))
    k = F.col("k")
    events = runs.select("zone", "tile", F.explode(F.array(event(k, "lo", 1, 0), event(k, "hi", -1, 0),
                                                          event(k + 1, "lo", 0, 1), event(k + 1, "hi", 0, -1))).alias("e"))
    events = events.groupBy("zone", "tile", F.col("e.l").alias("l"), F.col("e.x").alias("x")).agg(F.sum("e.above").alias("above"), F.sum("e.below").alias("below"))
    along = Window.partitionBy("zone", "tile", "l").orderBy("x")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select("zone", "l", "x", F.lead("x").over(along).alias("x1"), F.sum("above").over(so_far).alias("above"), F.sum("below").over(so_far).alias("below"))
    over = F.col("above") > F.col("below")
    level = swept.filter("above != below").select(
        "zone", F.when(over, F.col("x")).otherwise(F.col("x1")).alias("x"), "l", F.when(over, EAST).otherwise(WEST).alias("d"),
        F.when(over, F.col("x1")).otherwise(F.col("x")).alias("x1"), F.col("l").alias("l1"))
    return upright.unionByName(level)


def _followed(e: DataFrame) -> DataFrame:
    """Edges with the direction ``td`` of the one that follows at (x1, l1): to the left, straight on or to the right."""
    outs = e.groupBy("zone", F.col("x").alias("x1"), F.col("l").alias("l1")).agg(F.collect_set("d").alias("outs"))  # at most two
    turns = [F.when(F.array_contains("outs", (F.col("d") + turn) % 4), (F.col("d") + turn) % 4) for turn in (1, 0, 3)]
    return e.join(outs, ["zone", "x1", "l1"]).select("zone", "x", "l", "d", "x1", "l1", F.coalesce(*turns).cast("int").alias("td"))


def _chained(table: pa.Table) -> pa.Table:
    """The edges of one block as chains; a closed one is a whole ring."""
    x, l, d, x1, l1, td = (table[c].to_pylist() for c in ("x", "l", "d", "x1", "l1", "td"))
    at = {key: i for i, key in enumerate(zip(x, l, d))}
    follows = [at.get(key) for key in zip(x1, l1, td)]
    inner = {j for j in follows if j is not None}
    heads, left, rows = [i for i in range(len(x)) if i not in inner], set(inner), []
    while heads or left:
        start = heads.pop() if heads else left.pop()
        i, path = start, []
        while i is not None:
            path.append(i)
            left.discard(i)
            last, i = i, follows[i]
            if i == start:
                break
        rows.append({"zone": table["zone"][0].as_py(), "x": x[start], "l": l[start], "d": d[start], "tx": x1[last], "tl": l1[last], "td": td[last],
                     "closed": i is not None, "xs": [x[j] for j in path], "ls": [l[j] for j in path]})
    kinds = {"float": pa.float64(), "int": pa.int64()}
    return pa.Table.from_pylist(rows, schema=pa.schema([
        ("zone", pa.string()), ("x", kinds["float"]), ("l", kinds["int"]), ("d", pa.int32()), ("tx", kinds["float"]), ("tl", kinds["int"]), ("td", pa.int32()),
        ("closed", pa.bool_()), ("xs", pa.list_(kinds["float"])), ("ls", pa.list_(kinds["int"]))]))


def chains(e: DataFrame, width: float = BLOCK_M, lines: int = BLOCK_LINES) -> DataFrame:
    """The outline's edges chained within blocks."""
    blocked = _followed(e).withColumns({"bx": F.floor(F.col("x") / width), "bl": F.floor(F.col("l") / lines)})
    return blocked.groupBy("zone", "bx", "bl").applyInArrow(_chained, _CHAIN)


def _linked(open_: DataFrame) -> DataFrame:
    """(zone, key, ring, place): each open chain's ring, named by its least chain, and its place from there on."""
    state = stored(open_.select("zone", "key", F.col("follows").alias("ptr"), F.least("key", "follows").alias("low")), "ring-leaders")
    while True:
        ahead = state.select("zone", F.col("key").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("low").alias("low2"))
        step = state.join(ahead, ["zone", "ptr"]).select("zone", "key", F.col("ptr2").alias("ptr"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("less"))
        state = stored(step, "ring-leaders")
        if state.filter("less").isEmpty():      # twice the reach brings no smaller member: the whole ring is seen
            break
    rank = open_.join(state.select("zone", "key", "low"), ["zone", "key"]).select(
        "zone", "key", F.col("low").alias("ring"), F.when(F.col("follows") != F.col("low"), F.col("follows")).alias("ptr"), F.lit(1).cast("long").alias("n"))
    rank = stored(rank, "ring-places")
    while not rank.filter("ptr is not null").isEmpty():
        ahead = rank.select("zone", F.col("key").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("n").alias("n2"))
        rank = stored(rank.join(ahead, ["zone", "ptr"], "left").select("zone", "key", "ring", F.col("ptr2").alias("ptr"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n")),
                      "ring-places")
    return rank.select("zone", "key", "ring", (-F.col("n")).alias("place"))


def rings(runs: DataFrame, dy: float = DEFAULT_DY, tile: float = TILE_M, width: float = BLOCK_M, lines: int = BLOCK_LINES) -> DataFrame:
    """(zone, ring, a2): closed vertex lists without straight corners, and twice their area, negative for holes."""
    parts = stored(chains(edges(runs, tile), width, lines), "chains")
    key = F.struct("x", "l", "d")
    follows = F.struct(F.col("tx").alias("x"), F.col("tl").alias("l"), F.col("td").alias("d"))
    open_ = stored(parts.filter("not closed").select("zone", key.alias("key"), follows.alias("follows"), "xs", "ls"), "open-chains")
    whole = parts.filter("closed").select("zone", "xs", "ls")
    if not open_.isEmpty():
        members = open_.select("zone", "key", "xs", "ls").join(_linked(open_.select("zone", "key", "follows")), ["zone", "key"])
        joined = members.groupBy("zone", "ring").agg(F.sort_array(F.collect_list(F.struct("place", "xs", "ls"))).alias("c"))
        whole = whole.unionByName(joined.select("zone", F.flatten("c.xs").alias("xs"), F.flatten("c.ls").alias("ls")))
    path = F.zip_with("xs", "ls", lambda x, l: g.vertex(x, l * dy))

    def corners(p: Column) -> Column:
        def turned(v, i):
            before, after = (F.element_at(p, (F.pmod(i + step, F.size(p)) + 1).cast("int")) for step in (-1, 1))
            return ~(((before["x"] == v["x"]) & (after["x"] == v["x"])) | ((before["y"] == v["y"]) & (after["y"] == v["y"])))
        return g.let(F.filter(p, turned), lambda r: F.concat(r, F.slice(r, 1, 1)))
    return whole.select("zone", g.let(path, corners).alias("ring")).withColumn("a2", g.ring_moments(F.col("ring"))["a2"])


def _shells(every: DataFrame, dy: float) -> DataFrame:
    """(id, shell): the shell that each hole belongs to; ``every``: zone, ring, a2, id.

    The leftmost upright edge of a hole ends a run, and the run begins at an edge of the same part of the zone: its
    shell's, or that of a hole further left. So every hole names a ring, and holes come to their shell by pointer
    doubling. No ring is held against another one.
    """
    def side(p: Column, q: Column) -> Column:
        l0, l1 = (F.round(v["y"] / dy).cast("long") for v in (p, q))
        return F.when((p["x"] == q["x"]) & (l0 != l1), F.struct(p["x"].alias("x"), l0.alias("l0"), l1.alias("l1")))
    sides = F.zip_with("ring", F.slice("ring", F.lit(2), F.size("ring")), side)
    upright = every.select("zone", "id", (F.col("a2") > 0).alias("shell"), F.explode(sides).alias("s")).filter("s is not null").select(
        "zone", "id", "shell", "s.x", F.explode(F.sequence(F.least("s.l0", "s.l1"), F.greatest("s.l0", "s.l1") - 1)).alias("k"))
    along = Window.partitionBy("zone", "k").orderBy("x")
    before = upright.select("id", "shell", "x", F.lag("id").over(along).alias("ptr"))
    first = before.filter("not shell").groupBy("id").agg(F.min_by("ptr", "x").alias("ptr"))
    shells = every.select(F.col("id").alias("ptr"), (F.col("a2") > 0).alias("settled"))
    state = stored(first.join(shells, "ptr").select("id", "ptr", "settled"), "hole-shells")
    while not state.filter("not settled").isEmpty():
        ahead = state.select(F.col("id").alias("ptr"), F.col("ptr").alias("further"), F.col("settled").alias("there"))
        moved = state.filter("not settled").join(ahead, "ptr").select("id", F.col("further").alias("ptr"), F.col("there").alias("settled"))
        state = stored(state.filter("settled").unionByName(moved), "hole-shells")
    return state.select("id", F.col("ptr").alias("shell"))


def polygons(runs: DataFrame, by: list[str], dy: float = DEFAULT_DY, **blocks) -> DataFrame:
    """(by, geom): the zones' polygons, each hole in the smallest shell around it; ``runs`` as of ``buffer_zones``."""
    zone = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("{}")
    every = stored(rings(runs.withColumn("zone", zone), dy, **blocks).withColumn("id", F.monotonically_increasing_id()), "rings")
    inner = (every.select("id", F.col("ring").alias("hole")).join(_shells(every, dy), "id")
             .groupBy(F.col("shell").alias("id")).agg(F.collect_list("hole").alias("holes")))
    parts = F.concat(F.array("ring"), F.coalesce("holes", F.array().cast("array<array<struct<x:double,y:double>>>")))
    schema = ", ".join(f"{c} {runs.schema[c].dataType.simpleString()}" for c in by)
    out = every.filter("a2 > 0").select("id", "zone", "ring").join(inner, "id", "left").withColumn("geom", g.geometry("Polygon", F.array(parts)))
    named = out.withColumn("own", F.from_json("zone", schema)).select("own.*", "geom") if by else out.select("geom")
    return named
