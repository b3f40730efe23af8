"""Geometry column expressions on the struct of :mod:`terrane.schema`.

Everything here is a built-in Spark expression (array higher-order functions),
so no row leaves the JVM. Coordinates are shifted to a local origin before they
are multiplied: projected northings are in the millions and their products
would lose the centimetres.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrane.schema import AREAL_KINDS, GEOMETRY_DDL, UTM13N


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def once(fn):
    """Bind the geometry argument, so its expression enters the plan only once.

    Filter push-down replaces a computed column by its expression wherever it is
    named; a measure naming it ten times would compute it ten times per row.
    """
    @functools.wraps(fn)
    def bound(geom: Column, *args, **kwargs) -> Column:
        return let(geom, lambda v: fn(v, *args, **kwargs))
    return bound


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


# ── construction ────────────────────────────────────────────────────────────
def vertex(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(kind, parts: Column, srid=UTM13N) -> Column:
    """Build the struct; ``kind`` is text, ``parts`` parts > rings > vertices."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    srid = F.lit(srid) if isinstance(srid, int) else srid
    return F.struct(srid.cast("int").alias("srid"), kind.alias("kind"),
                    parts.alias("parts")).cast(GEOMETRY_DDL)


def rectangle(x0: Column, y0: Column, w: Column, h: Column, srid=UTM13N) -> Column:
    corners = F.array(vertex(x0, y0), vertex(x0 + w, y0), vertex(x0 + w, y0 + h),
                      vertex(x0, y0 + h), vertex(x0, y0))
    return geometry("Polygon", F.array(F.array(corners)), srid)


def linestring(points: Column, srid=UTM13N) -> Column:
    return geometry("LineString", F.array(F.array(points)), srid)


def point(x: Column, y: Column, srid=UTM13N) -> Column:
    return geometry("Point", F.array(F.array(F.array(vertex(x, y)))), srid)


# ── access ──────────────────────────────────────────────────────────────────
def paths(geom: Column) -> Column:
    """All rings or paths of all parts."""
    return F.flatten(geom["parts"])


def vertices(geom: Column) -> Column:
    return F.flatten(F.flatten(geom["parts"]))


def first_vertex(geom: Column) -> Column:
    return F.get(vertices(geom), F.lit(0))


def path_segments(path: Column) -> Column:
    n = F.greatest(F.size(path) - 1, F.lit(0))
    return F.zip_with(
        F.slice(path, F.lit(1), n), F.slice(path, F.lit(2), n),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                              b["x"].alias("x2"), b["y"].alias("y2")))


def segments(geom: Column) -> Column:
    return F.flatten(F.transform(paths(geom), path_segments))


def is_areal(geom: Column) -> Column:
    return geom["kind"].isin(AREAL_KINDS)


def set_srid(geom: Column, srid: int) -> Column:
    return geom.withField("srid", F.lit(srid).cast("int"))


def default_srid(geom: Column, srid: int) -> Column:
    return geom.withField("srid", F.coalesce(geom["srid"], F.lit(srid).cast("int")))


@once
def promote_to_multi(geom: Column) -> Column:
    kind = geom["kind"]
    multi = F.when(kind.isin("Polygon", "LineString", "Point"),
                   F.concat(F.lit("Multi"), kind)).otherwise(kind)
    return geom.withField("kind", multi)


def map_vertices(geom: Column, fn) -> Column:
    """Replace every vertex; ``fn`` gets and returns a vertex column."""
    parts = F.transform(geom["parts"], lambda rings: F.transform(
        rings, lambda ring: F.transform(ring, fn)))
    return geom.withField("parts", parts)


# ── measures ────────────────────────────────────────────────────────────────
def bbox(geom: Column) -> dict[str, Column]:
    xs = F.transform(vertices(geom), lambda p: p["x"])
    ys = F.transform(vertices(geom), lambda p: p["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys),
            "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def with_bbox(df, geom: str = "geom"):
    """Materialise the four bbox columns next to the geometry."""
    return df.withColumns(bbox(F.col(geom)))


def ring_moments(ring: Column) -> Column:
    """Twice the signed area and its first moments about the ring's first vertex."""
    def measure(o):
        def step(acc, s):
            cross = ((s["x1"] - o["x"]) * (s["y2"] - o["y"])
                     - (s["x2"] - o["x"]) * (s["y1"] - o["y"]))
            return F.struct(
                (acc["a2"] + cross).alias("a2"),
                (acc["mx"] + cross * (s["x1"] + s["x2"] - o["x"] * 2)).alias("mx"),
                (acc["my"] + cross * (s["y1"] + s["y2"] - o["y"] * 2)).alias("my"))
        zero = F.struct(*[F.lit(0.0).alias(c) for c in ("a2", "mx", "my")])
        return F.aggregate(path_segments(ring), zero, step)
    return let(F.get(ring, F.lit(0)), measure)


@once
def area(geom: Column) -> Column:
    """Planar area; rings after the first of a part are holes."""
    def part_area(rings):
        return total(F.transform(rings, lambda ring, i: F.abs(ring_moments(ring)["a2"]) / 2
                                 * F.when(i == 0, 1.0).otherwise(-1.0)))
    return F.when(is_areal(geom), total(F.transform(geom["parts"], part_area))).otherwise(F.lit(0.0))


def rounded_area(geom: Column, digits: int = 1, mode: str = "half_up") -> Column:
    rounding = F.round if mode == "half_up" else F.bround
    return rounding(area(geom), digits)


def length(geom: Column) -> Column:
    return total(F.transform(segments(geom), lambda s: F.hypot(s["x2"] - s["x1"], s["y2"] - s["y1"])))


def _vertex_mean(geom: Column) -> Column:
    v = vertices(geom)
    return F.struct((total(F.transform(v, lambda p: p["x"])) / F.size(v)).alias("x"),
                    (total(F.transform(v, lambda p: p["y"])) / F.size(v)).alias("y"))


@once
def centroid(geom: Column) -> Column:
    """Area-weighted centroid as a vertex; vertex mean where the area is zero."""
    def ring_share(ring, i):
        def weigh(m):
            sign = F.signum(m["a2"]) * F.when(i == 0, 1.0).otherwise(-1.0)
            o = F.get(ring, F.lit(0))
            return F.struct((sign * m["a2"] * 3).alias("w"),
                            (sign * (m["mx"] + o["x"] * m["a2"] * 3)).alias("wx"),
                            (sign * (m["my"] + o["y"] * m["a2"] * 3)).alias("wy"))
        return let(ring_moments(ring), weigh)

    def about(o):
        local = map_vertices(geom, lambda p: vertex(p["x"] - o["x"], p["y"] - o["y"]))
        shares = F.flatten(F.transform(local["parts"], lambda rings: F.transform(rings, ring_share)))

        def finish(s):
            w = total(F.transform(s, lambda e: e["w"]))
            return F.when(w != 0, F.struct(
                (total(F.transform(s, lambda e: e["wx"])) / w + o["x"]).alias("x"),
                (total(F.transform(s, lambda e: e["wy"])) / w + o["y"]).alias("y")))
        return let(shares, finish)
    areal = let(first_vertex(geom), about)
    return F.coalesce(F.when(is_areal(geom), areal), _vertex_mean(geom))


# ── scan lines ──────────────────────────────────────────────────────────────
def crossings_at(segs: Column, y: Column) -> Column:
    """Sorted x where the boundary crosses the horizontal line at ``y``."""
    hits = F.filter(segs, lambda s: (s["y1"] > y) != (s["y2"] > y))
    return F.array_sort(F.transform(hits, lambda s: s["x1"] + (y - s["y1"]) / (s["y2"] - s["y1"])
                                    * (s["x2"] - s["x1"])))


def bbox_distance(a: dict, b: dict) -> Column:
    """Distance of two boxes: a cheap lower bound of the true distance."""
    dx = F.greatest(F.lit(0.0), a["xmin"] - b["xmax"], b["xmin"] - a["xmax"])
    dy = F.greatest(F.lit(0.0), a["ymin"] - b["ymax"], b["ymin"] - a["ymax"])
    return F.hypot(dx, dy)


def rounded(x: Column, digits: int) -> Column:
    """What ``F.round`` gives, without its decimal numbers except near a tie: they cost more than a join's test."""
    scaled = x * 10.0**digits
    whole = F.rint(scaled)
    return F.when((F.abs(scaled) < 2.0**40) & (F.abs(scaled - whole) < 0.499), whole / 10.0**digits + 0.0).otherwise(F.round(x, digits))


# ── text ────────────────────────────────────────────────────────────────────
def _coordinates(path: Column, digits: int) -> Column:
    form = f"%.{digits}f %.{digits}f"
    return F.concat(F.lit("("), F.array_join(F.transform(
        path, lambda p: F.format_string(form, p["x"], p["y"])), ", "), F.lit(")"))


@once
def to_wkt(geom: Column, digits: int = 2) -> Column:
    kind = geom["kind"]
    rings = F.transform(geom["parts"], lambda p: F.concat(F.lit("("), F.array_join(
        F.transform(p, lambda r: _coordinates(r, digits)), ", "), F.lit(")")))
    lone = F.transform(paths(geom), lambda r: _coordinates(r, digits))
    body = (F.when(kind.isin("Point", "LineString"), F.get(lone, F.lit(0)))
            .when(kind == "Polygon", F.get(rings, F.lit(0)))
            .when(kind == "MultiPolygon", F.concat(F.lit("("), F.array_join(rings, ", "), F.lit(")")))
            .otherwise(F.concat(F.lit("("), F.array_join(lone, ", "), F.lit(")"))))
    return F.concat(F.upper(kind), body)


def point_wkt(p: Column, digits: int = 2) -> Column:
    return F.format_string(f"POINT(%.{digits}f %.{digits}f)", p["x"], p["y"])
