"""Spatial joins: within, within-distance, nearest."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.functions import predicates as pred
from terrane.operators.grid import FACTOR, boxes_in_reach, candidate_pairs, grow
from terrane.schema import BBOX_COLUMNS
from terrane.session import stored

BOX = list(BBOX_COLUMNS)
# The nearest join broadcasts the coarse pyramid levels only: at most
# 9 * (FACTOR**k + 2)**2 cells on level top-k, so a few ten thousand rows.
BROADCAST_LEVELS = 3
NEAREST_SHARES = 8
PIECES = 16          # pieces of a line, on average at most
LONGEST = 4096       # pieces of one segment at most; those of a longer one are longer too
FINER = 1            # levels by which cells are finer than the zones in which boxes are looked for
LOCAL_ROWS = 64      # features in an occupied cell, on average, up to which its level counts as fine


def _split_within(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Left and right features that are their own boxes, and the pairs of sides of which one is not."""
    left, right = (stored(df.withColumn("_boxed", _own_box()), "within") for df in (left, right))
    (left_box, left_odd), (right_box, right_odd) = ((df.filter("_boxed").drop("_boxed"), df.filter("not _boxed").drop("_boxed")) for df in (left, right))
    open_ = []
    if not right_odd.isEmpty():
        open_.append((left.drop("_boxed"), right_odd))
    if not left_odd.isEmpty():
        open_.append((left_odd, right_box))
    return left_box, right_box, open_


def _exactly_within(left: DataFrame, right: DataFrame) -> DataFrame:
    pairs = candidate_pairs(left, right, left_in_right=True)
    return pairs.filter(pred.within(F.col("l_geom"), F.col("r_geom")))


def _within(left_box: DataFrame, right_box: DataFrame, open_: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    pairs = candidate_pairs(left_box, right_box, left_in_right=True, finer=FINER)
    return reduce(DataFrame.unionByName, [_exactly_within(*sides) for sides in open_], pairs)


def within_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l_id, r_id, ...) for every left polygon inside a right polygon.

    Inputs need ``id``, ``geom`` and the bbox columns; other columns ride along.
    Polygons that are their own boxes are settled by the boxes, without the predicate.
    """
    return _within(*_split_within(left, right))


def within_join(left: DataFrame, right: DataFrame, attributes: list[str], how: str = "left",
                distinct: bool = False) -> DataFrame:
    """Attach attributes of the containing polygons; one row per containing zone.

    ``distinct`` keeps one row per left feature that lies in any zone. The left
    columns ride along to the pairs, and features in no zone (``how='left'``) are found by
    a join for existence, so the pairs themselves, of which there may be very many, are never exchanged.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    keep = right.select("id", "geom", *BOX, *[a for a in attributes if a != "id"])
    sides = _split_within(left.filter(F.col("id").isNotNull()), keep)
    left_box, right_box, open_ = sides
    shape = ["id", "geom", *BOX]
    some = [candidate_pairs(left_box.select("id", *BOX), right_box.select(BOX), True, finer=FINER, how="left_semi").select(F.col("l_id").alias("id"))]
    some += [_exactly_within(a.select(shape), b.select(shape)).select(F.col("l_id").alias("id")) for a, b in open_]
    held = reduce(DataFrame.union, some).distinct()
    if distinct:
        return left.join(held, "id", "left_semi")
    others = [c for c in left.columns if c != "id"]
    names = [a + "_zone" if a in left.columns else a for a in attributes]
    pairs = _within(*sides).select(F.col("l_id").alias("id"), *[F.col("l_" + c).alias(c) for c in others], F.col("r_id").alias("zone_id"),
                                   *[F.col("r_" + a).alias(n) for a, n in zip(attributes, names)])
    if how == "inner":
        return pairs
    bare = left.join(held, "id", "left_anti").select("id", *others, *[F.lit(None).cast(pairs.schema[n].dataType).alias(n) for n in ["zone_id", *names]])
    return pairs.unionByName(bare)


def settle_collision(joined: DataFrame, name: str) -> DataFrame:
    """The zone's value replaces the feature's own attribute of the same name."""
    if name + "_zone" not in joined.columns:
        return joined
    return joined.drop(name).withColumnRenamed(name + "_zone", name)


def distance_pairs(left: DataFrame, right: DataFrame, reach: float) -> DataFrame:
    """(l_id, r_id, dist) for all pairs at most ``reach`` apart.

    The distance of two polygons that are their own boxes is that of the boxes; only other pairs go to the predicate.
    """
    one = left is right
    left = stored(left.withColumn("_boxed", _own_box()), "distances", merged=False)
    right = left if one else stored(right.withColumn("_boxed", _own_box()), "distances", merged=False)
    l_box, r_box = ({k: F.col(f"{side}_{k}") for k in BOX} for side in "lr")
    (left_box, left_odd), (right_box, right_odd) = ((df.filter("_boxed").drop("_boxed"), df.filter("not _boxed").drop("_boxed")) for df in (left, right))
    out = boxes_in_reach(left_box, right_box, reach)
    sides = [] if right_odd.isEmpty() else [(left.drop("_boxed"), right_odd)]
    sides += [] if left_odd.isEmpty() else [(left_odd, right_box)]
    for a, b in sides:
        grown = {k: v + (reach if k in ("xmin", "ymin") else -reach) for k, v in l_box.items()}
        near = candidate_pairs(grow(a, reach), b).filter(g.bbox_distance(grown, r_box) <= reach * (1 + 1e-9) + 1e-6)
        out = out.unionByName(near.select("l_id", "r_id", pred.distance(F.col("l_geom"), F.col("r_geom")).alias("dist")).filter(F.col("dist") <= reach))
    return out


def near_pairs(left: DataFrame, right: DataFrame, reach: float) -> DataFrame:
    """The pairs of :func:`distance_pairs` without the distance.

    Boxes whose farthest corners are within reach need no exact test; only the
    geometries of the undecided pairs are handed to the predicate.
    """
    pairs = candidate_pairs(grow(left, reach), right)
    l_box = {k: F.col("l_" + k) + (reach if k in ("xmin", "ymin") else -reach) for k in BOX}
    r_box = {k: F.col("r_" + k) for k in BOX}
    widest = F.hypot(F.greatest(l_box["xmax"], r_box["xmax"]) - F.least(l_box["xmin"], r_box["xmin"]),
                     F.greatest(l_box["ymax"], r_box["ymax"]) - F.least(l_box["ymin"], r_box["ymin"]))
    near = pairs.filter(g.bbox_distance(l_box, r_box) <= reach).withColumn("_open", widest > reach)
    dist = pred.distance(F.when(F.col("_open"), F.col("l_geom")), F.when(F.col("_open"), F.col("r_geom")))
    return (near.withColumn("_dist", dist).filter(~F.col("_open") | (F.col("_dist") <= reach))
            .drop("_open", "_dist"))


def _vertex_cells(df: DataFrame, levels: list[int]) -> DataFrame:
    """Cells of the first vertex on each level."""
    lv = F.array(*[F.lit(v) for v in levels])
    return (df.select("*", F.explode(lv).alias("level"))
            .withColumn("cx", F.floor(F.col("x") / F.pow(F.lit(FACTOR), "level")))
            .withColumn("cy", F.floor(F.col("y") / F.pow(F.lit(FACTOR), "level"))))


def _pyramid(points: DataFrame, levels: list[int]) -> DataFrame:
    """One real vertex per occupied cell and level, lent to the eight neighbours."""
    own = (_vertex_cells(points, levels).groupBy("level", "cx", "cy")
           .agg(F.min(F.struct("x", "y")).alias("p")))
    step = F.array(*[F.lit(v) for v in (-1, 0, 1)])
    lent = (own.withColumn("dx", F.explode(step)).withColumn("dy", F.explode(step))
            .withColumn("cx", F.col("cx") + F.col("dx")).withColumn("cy", F.col("cy") + F.col("dy")))
    return lent.groupBy("level", "cx", "cy").agg(F.min("p").alias("p"))


def _span(points: DataFrame):
    """(corners, a point, top level) of the right side; the point is null without rows."""
    ext = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
                     F.max("y").alias("y1"), F.min(F.struct("x", "y")).alias("p")).first()
    if ext["p"] is None:
        return None, None
    span = max(ext["x1"] - ext["x0"], ext["y1"] - ext["y0"], 1.0)
    return ext["p"], max(1, math.ceil(math.log(span, FACTOR)))


def search_radius(left: DataFrame, points: DataFrame, some, top: int, low: int = 0) -> DataFrame:
    """(id, reach, level): a distance the nearest right feature is sure to lie within.

    The bound is the distance to a real vertex of the right side (``points``) found in the
    finest occupied cell around the query, so dense places get small circles and
    empty places large ones. ``level`` is that cell's, top + 1 where there is none.
    Cells are no finer than level ``low``.
    """
    split = max(low, top - BROADCAST_LEVELS)
    points = stored(_vertex_cells(points, [low]).groupBy("cx", "cy").agg(F.min(F.struct("x", "y")).alias("p")).select("p.x", "p.y"), "thinned")
    query = left.select("id", g.first_vertex(F.col("geom")).alias("v")).select("id", "v.x", "v.y")
    gap = F.hypot(F.col("x") - F.col("p.x"), F.col("y") - F.col("p.y"))

    coarse = _vertex_cells(query, list(range(split, top + 1))).join(
        F.broadcast(_pyramid(points, list(range(split, top + 1)))), ["level", "cx", "cy"])
    hits = coarse.select("id", gap.alias("reach"), "level")
    if split > low:
        shares = F.array(*[F.lit(v) for v in range(NEAREST_SHARES)])
        fine = (_vertex_cells(query, list(range(low, split)))
                .withColumn("share", F.pmod(F.xxhash64("id"), F.lit(NEAREST_SHARES)).cast("int"))
                .join(_pyramid(points, list(range(low, split))).withColumn("share", F.explode(shares)),
                      ["level", "cx", "cy", "share"]))
        hits = hits.unionByName(fine.select("id", gap.alias("reach"), "level"))
    far = query.select("id", F.hypot(F.col("x") - F.lit(some["x"]), F.col("y") - F.lit(some["y"])).alias("reach"), F.lit(top + 1).alias("level"))
    return hits.unionByName(far).groupBy("id").agg(F.min("reach").alias("reach"), F.min("level").alias("level"))


def _fine_level(points: DataFrame, top: int) -> int:
    """The coarsest level whose occupied cells hold LOCAL_ROWS features on average."""
    cells = [F.approx_count_distinct(F.struct(*[F.floor(F.col(v) / FACTOR**level) for v in ("x", "y")])).alias(f"n{level}") for level in range(top + 1)]
    n = points.agg(F.count(F.lit(1)).alias("rows"), *cells).first()
    return max([0, *[level for level in range(top + 1) if n["rows"] <= LOCAL_ROWS * n[f"n{level}"]]])


def _pairs_by_bounds(queries: DataFrame, right: DataFrame, fine: int, top: int) -> DataFrame:
    """Pairs (l_id, l_geom, r_id, r_geom) that hold the nearest right feature of each query, by branch and bound.

    Right features belong to the cell of their first vertex; a cell knows the box of its features and one of
    their vertices. From the top level down, each query keeps the cells whose box is not farther than the
    nearest known vertex, so of a far layer only its near front is ever looked at.
    """
    def cell(v, level):
        return F.floor(F.col(v) / FACTOR**level)

    def merged(df):
        return df.agg(*[(F.min if c.endswith("min") else F.max)(c).alias(c) for c in BOX], F.min("p").alias("p"))
    own = stored(right.select("id", "geom", *BOX, F.col("p") if "p" in right.columns else g.first_vertex(F.col("geom")).alias("p")).select("*", "p.x", "p.y")
                 .withColumns({"cx": cell("x", fine), "cy": cell("y", fine)}), "nearest-cells")
    nodes = {fine: stored(merged(own.groupBy("cx", "cy")), "nearest-nodes")}
    for level in range(fine + 1, top + 1):
        nodes[level] = stored(merged(nodes[level - 1].groupBy(*[F.floor(F.col(c) / int(FACTOR)).alias(c) for c in ("cx", "cy")])), "nearest-nodes")
    state = queries.select("id", *[F.col(c).alias("q" + c) for c in BOX], g.first_vertex(F.col("geom")).alias("v"))
    ids = state.crossJoin(F.broadcast(nodes[top].select("cx", "cy")))      # at most four cells: the extent is no wider than one
    box, query = {c: F.col(c) for c in BOX}, {c: F.col("q" + c) for c in BOX}
    for level in range(top, fine - 1, -1):
        seen = ids.join(nodes[level], ["cx", "cy"])
        nearest = F.min(F.hypot(F.col("v.x") - F.col("p.x"), F.col("v.y") - F.col("p.y"))).over(Window.partitionBy("id"))
        kept = stored(seen.withColumn("best", nearest * (1 + 1e-9) + 1e-6).filter(g.bbox_distance(query, box) <= F.col("best"))
                      .drop(*BOX, "p"), "nearest-kept")
        part = F.array(*[F.lit(k) for k in range(int(FACTOR))])
        ids = (kept.drop("best").withColumn("i", F.explode(part)).withColumn("j", F.explode(part))
               .withColumns({"cx": F.col("cx") * int(FACTOR) + F.col("i"), "cy": F.col("cy") * int(FACTOR) + F.col("j")}).drop("i", "j"))
    near = (kept.join(own.withColumnsRenamed({"id": "r_id", "geom": "r_geom"}), ["cx", "cy"])
            .filter(g.bbox_distance(query, box) <= F.col("best")).select(F.col("id").alias("l_id"), "r_id", "r_geom"))
    return near.join(queries.select(F.col("id").alias("l_id"), F.col("geom").alias("l_geom")), "l_id")


def _pieces(right: DataFrame) -> tuple[DataFrame, float]:
    """Lines cut into short pieces, other features whole: ``id, geom, x1 y1 x2 y2, p`` and the piece's own box; the pieces' length.

    The box of a long slanting line is mostly empty, and the more lines there are, the more such boxes hold a
    query that their lines pass far off. A piece knows its whole segment (``geom`` is null then), so that distances
    do not depend on the cuts, and one point. Pieces are as long as lines are apart, but not so short
    that there are more than PIECES a line.
    """
    geom = F.col("geom")
    line = F.coalesce(geom["kind"].contains("LineString") & ~F.exists(g.paths(geom), lambda v: F.size(v) < 2) & (F.size(g.segments(geom)) > 0), F.lit(False))
    lines = right.filter(line)
    size = lines.agg(F.count(F.lit(1)).alias("n"), F.sum(g.length(geom)).alias("length"), *[
        (F.min if b.endswith("min") else F.max)(b).alias(b) for b in BOX]).first()
    length = size["length"] or 1.0
    apart, width = 1.0, 1.0       # without lines nothing is cut
    if size["n"]:
        apart = max(1e-3, (size["xmax"] - size["xmin"]) * (size["ymax"] - size["ymin"]) / length)
        width = max(apart, length / (PIECES * size["n"]))
    cuts = lines.select("id", F.explode(g.segments(geom)).alias("s")).select("id", "s.x1", "s.y1", "s.x2", "s.y2")
    n = F.least(F.greatest(F.ceil(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))) / width), F.lit(1)), F.lit(LONGEST))
    cuts = cuts.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))

    def at(v, i):
        return F.col(v + "1") + (F.col(v + "2") - F.col(v + "1")) * (i / F.col("n"))
    ends = {v: (at(v, F.col("i")), at(v, F.col("i") + 1)) for v in "xy"}
    # a hair wider, so that rounding of the cuts leaves no gap
    cut = cuts.select("id", F.lit(None).cast(right.schema["geom"].dataType).alias("geom"), "x1", "y1", "x2", "y2",
                      F.struct(ends["x"][0].alias("x"), ends["y"][0].alias("y")).alias("p"),
                      *[(F.least(*ends[b[0]]) - 1e-6 if b.endswith("min") else F.greatest(*ends[b[0]]) + 1e-6).alias(b) for b in BOX])
    whole = right.filter(~line).select("id", "geom", *[F.lit(None).cast("double").alias(k) for k in ("x1", "y1", "x2", "y2")],
                                       g.first_vertex(geom).alias("p"), *BOX)
    return cut.unionByName(whole), math.sqrt(apart * width)


def _own_box() -> Column:
    """Whether a polygon is its bounding box: one ring from corner to corner, in one of its eight orders.

    No lambdas and no access to single vertices: both cost more than the join.
    """
    x0, y0, x1, y1 = (F.col(b) for b in BOX)
    corners = [F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    orders = [[(start + step * i) % 4 for i in range(5)] for step in (1, -1) for start in range(4)]
    shapes = [F.col("geom")["parts"] == F.array(F.array(F.array(*[corners[i] for i in order]))) for order in orders]
    wide = (x0 < x1) & (y0 < y1) & (x1 - x0 < float("inf")) & (y1 - y0 < float("inf"))     # not so with NaN
    return F.coalesce((F.col("geom")["kind"] == "Polygon") & wide & reduce(Column.__or__, shapes), F.lit(False))


def _enters() -> Column:
    """The segment r_x1 r_y1 r_x2 r_y2 meets the box of the left feature: slab clipping."""
    def slab(v):
        a, b, lo, hi = F.col(f"r_{v}1"), F.col(f"r_{v}2"), F.col(f"l_{v}min"), F.col(f"l_{v}max")
        inside, s, t = a.between(lo, hi), (lo - a) / (b - a), (hi - a) / (b - a)
        return (F.when(b != a, F.least(s, t)).when(inside, 0.0).otherwise(2.0), F.when(b != a, F.greatest(s, t)).when(inside, 1.0).otherwise(-1.0))
    (x0, x1), (y0, y1) = slab("x"), slab("y")
    return F.greatest(F.lit(0.0), x0, y0) <= F.least(F.lit(1.0), x1, y1)


def _crossed(left: DataFrame, pieces: DataFrame) -> DataFrame:
    """(id, best) of the rectangles that a line enters: distance 0 and the smallest such line, no other need be looked at."""
    pairs = candidate_pairs(left.filter("boxed").select("id", *BOX), pieces.select("id", "x1", "y1", "x2", "y2", *BOX))
    hits = pairs.filter(_enters()).groupBy(F.col("l_id").alias("id")).agg(F.min("r_id").alias("rid"))
    return hits.select("id", F.struct(F.lit(0.0).alias("dist"), "rid").alias("best"))


def nearest_join(left: DataFrame, right: DataFrame, how: str = "left", digits: int | None = 1) -> DataFrame:
    """Nearest right feature by true distance: ``id, nearest_id, dist``.

    Ties go to the smallest right id. ``how='left'`` keeps a left row that has
    no partner (empty right side) with nulls, ``'inner'`` drops it.
    """
    ids = left.select("id")
    pieces, gap = _pieces(right)
    pieces = stored(pieces, "pieces")
    points = pieces.select("p.x", "p.y")
    some, top = _span(points)
    if some is None:
        empty = ids.select("id", F.lit(None).cast("long").alias("nearest_id"),
                           F.lit(None).cast("double").alias("dist"))
        return empty if how == "left" else empty.filter(F.lit(False))
    rest = stored(left.select("id", "geom", *BOX, _own_box().alias("boxed")), "queries")
    ids, crossed = rest.select("id"), None
    if pieces.filter("x1 IS NULL").isEmpty():
        crossed = stored(_crossed(rest, pieces), "crossed")
        rest = stored(rest.join(crossed, "id", "left_anti"), "not-crossed")
    rest = rest.drop("boxed")
    segment = g.linestring(F.array(g.vertex(F.col("x1"), F.col("y1")), g.vertex(F.col("x2"), F.col("y2"))))
    shaped = pieces.select("id", F.when(F.col("x1").isNull(), F.col("geom")).otherwise(segment).alias("geom"), *BOX, "p")
    low = min(top, max(0, math.floor(math.log(gap, FACTOR))))       # still finer cells are mostly empty
    # a hair wider, so that rounding of the box arithmetic cannot lose the bound's own feature
    probe = rest.join(search_radius(rest, points, some, top, low), "id")
    probe = stored(probe.withColumn("reach", F.col("reach") * (1 + 1e-9) + 1e-6), "probe")
    fine = _fine_level(points, top)
    close = F.col("level") <= fine + 1
    pairs = candidate_pairs(grow(probe.filter(close).drop("level"), F.col("reach")), shaped.drop("p")).select("l_id", "l_geom", "r_id", "r_geom")
    far = probe.filter(~close).drop("reach", "level")
    if not far.isEmpty():
        pairs = pairs.unionByName(_pairs_by_bounds(far, shaped, fine, top).select("l_id", "l_geom", "r_id", "r_geom"))
    scored = pairs.select(F.col("l_id").alias("id"), F.struct(
        pred.distance(F.col("l_geom"), F.col("r_geom")).alias("dist"), F.col("r_id").alias("rid")).alias("best"))
    best = scored.groupBy("id").agg(F.min("best").alias("best"))
    best = best if crossed is None else best.unionByName(crossed)
    dist = F.col("best.dist") if digits is None else F.round("best.dist", digits)
    found = best.select("id", F.col("best.rid").alias("nearest_id"), dist.alias("dist"))
    return ids.join(found, "id", how)
