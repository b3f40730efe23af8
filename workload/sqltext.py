"""SQL fragments of the checks, written from the definitions (all pairs, direct formulae)."""

from __future__ import annotations

from terrane.functions import projection as pj

HEIGHT = "CASE WHEN regexp_matches(height, '^[0-9.]+$') THEN TRY_CAST(height AS DOUBLE) END"
HIGHWAY = "COALESCE(tag1, tag2, 'unclassified')"
WITHIN = "b.x0 >= l.x0 AND b.x0 + b.w <= l.x0 + l.w AND b.y0 >= l.y0 AND b.y0 + b.h <= l.y0 + l.h"
MAJOR = "('motorway','trunk','primary','secondary','tertiary')"

SEGMENTS = """seg AS (
  SELECT id, COALESCE(tag1, tag2, 'unclassified') AS highway, CAST(x0 AS DOUBLE) AS ax, CAST(y0 AS DOUBLE) AS ay,
    CAST(x1 AS DOUBLE) AS ex, CAST(y1 AS DOUBLE) AS ey FROM fx_roads
  UNION ALL SELECT id, COALESCE(tag1, tag2, 'unclassified'), CAST(x1 AS DOUBLE), CAST(y1 AS DOUBLE),
    CAST(x2 AS DOUBLE), CAST(y2 AS DOUBLE) FROM fx_roads WHERE x2 IS NOT NULL)"""


def band(value: str, limits, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} < {v} THEN '{t}'" for v, t in limits) + f" ELSE '{rest}' END"


def point_segment(px, py, ax, ay, ex, ey) -> str:
    """Distance of a point to a segment."""
    len2 = f"(({ex}-{ax})*({ex}-{ax})+({ey}-{ay})*({ey}-{ay}))"
    t = (f"(CASE WHEN {len2} > 0 THEN GREATEST(0.0, LEAST(1.0, (({px}-{ax})*({ex}-{ax})+({py}-{ay})*({ey}-{ay}))"
         f" / CAST({len2} AS DOUBLE))) ELSE 0.0 END)")
    return f"sqrt(power({px}-({ax}+{t}*({ex}-{ax})),2)+power({py}-({ay}+{t}*({ey}-{ay})),2))"


def _point_rect(px, py) -> str:
    dx, dy = f"GREATEST(0, x0-{px}, {px}-(x0+w))", f"GREATEST(0, y0-{py}, {py}-(y0+h))"
    return f"sqrt({dx}*{dx}+{dy}*{dy})"


def _enters() -> str:
    """The segment (ax ay ex ey) meets the rectangle: slab clipping."""
    def slab(a, b, lo, hi):
        return (f"(CASE WHEN {b} <> {a} THEN LEAST(({lo}-{a})/({b}-{a}), ({hi}-{a})/({b}-{a})) WHEN {a} BETWEEN {lo} AND {hi} THEN 0.0 ELSE 2.0 END)",
                f"(CASE WHEN {b} <> {a} THEN GREATEST(({lo}-{a})/({b}-{a}), ({hi}-{a})/({b}-{a})) WHEN {a} BETWEEN {lo} AND {hi} THEN 1.0 ELSE -1.0 END)")
    t0x, t1x = slab("ax", "ex", "x0", "(x0+w)")
    t0y, t1y = slab("ay", "ey", "y0", "(y0+h)")
    return f"GREATEST(0.0, {t0x}, {t0y}) <= LEAST(1.0, {t1x}, {t1y})"


RECT_SEGMENT = ("(CASE WHEN " + _enters() + " THEN 0.0 ELSE LEAST(" + ", ".join(
    [point_segment(x, y, "ax", "ay", "ex", "ey") for x, y in (
        ("x0", "y0"), ("(x0+w)", "y0"), ("(x0+w)", "(y0+h)"), ("x0", "(y0+h)"))]
    + [_point_rect("ax", "ay"), _point_rect("ex", "ey")]) + ") END)")

# any segment end bounds the nearest distance; exact distances only for boxes within that bound
NEAREST = f"""WITH {SEGMENTS},
bound AS (SELECT b.id, sqrt(MIN((b.x0-s.ax)*(b.x0-s.ax) + (b.y0-s.ay)*(b.y0-s.ay))) + 1 AS ub FROM fx_buildings b, seg s GROUP BY 1),
cand AS (
  SELECT b.id, s.id AS rid, {RECT_SEGMENT} AS dist FROM fx_buildings b JOIN bound USING (id) JOIN seg s
    ON LEAST(ax, ex) <= x0 + w + ub AND GREATEST(ax, ex) >= x0 - ub AND LEAST(ay, ey) <= y0 + h + ub AND GREATEST(ay, ey) >= y0 - ub),
best AS (SELECT id, MIN({{'d': dist, 'r': rid}}) AS m FROM cand GROUP BY id),
near AS (SELECT id, m.r AS nearest_id, ROUND(m.d, 1) AS dist FROM best)"""

NEIGHBOURS = """gap AS (
  SELECT p.id AS a, q.id AS b, sqrt(power(GREATEST(0, p.x0-(q.x0+q.w), q.x0-(p.x0+p.w)), 2)
    + power(GREATEST(0, p.y0-(q.y0+q.h), q.y0-(p.y0+p.h)), 2)) AS dist
  FROM fx_buildings p JOIN fx_buildings q ON p.x0 - 150 <= q.x0 AND q.x0 <= p.x0 + 150 AND p.y0 - 150 <= q.y0 AND q.y0 <= p.y0 + 150),
nb AS (SELECT * FROM gap WHERE dist <= 100)"""


def capsule(y: str, r: float = 50.0) -> tuple[str, str]:
    """Interval of the capsule of (ax ay ex ey) on the line y."""
    size = "sqrt((ex-ax)*(ex-ax)+(ey-ay)*(ey-ay))"
    nx, ny = f"(-(ey-ay)/{size}*{r})", f"((ex-ax)/{size}*{r})"
    lo, hi = [], []
    for px, py in (("ax", "ay"), ("ex", "ey")):
        half = f"(CASE WHEN ABS({y}-{py}) <= {r} THEN sqrt(GREATEST(0.0, {r}*{r}-({y}-{py})*({y}-{py}))) END)"
        lo.append(f"({px}-{half})")
        hi.append(f"({px}+{half})")
    for sg in ("1.0", "-1.0"):
        ya, yb = f"(ay+{ny}*{sg})", f"(ey+{ny}*{sg})"
        x = (f"(CASE WHEN ey<>ay AND {y} BETWEEN LEAST({ya},{yb}) AND GREATEST({ya},{yb})"
             f" THEN (ax+{nx}*{sg})+({y}-{ya})/(ey-ay)*(ex-ax) END)")
        lo.append(x)
        hi.append(x)
    return f"LEAST({', '.join(lo)})", f"GREATEST({', '.join(hi)})"


_LO, _HI = capsule("((k+0.5)*5.0)")


def _merge(name: str, source: str, keys: str) -> str:
    return f"""{name}_m AS (SELECT *, MAX(hi) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_g AS (SELECT *, SUM(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM {name}_m),
{name} AS (SELECT {keys}, g, MIN(lo) AS lo, MAX(hi) AS hi FROM {name}_g GROUP BY ALL)"""


ZONE_RUNS = f"""WITH {SEGMENTS}, lines AS (
  SELECT *, UNNEST(range(CAST(ceil((LEAST(ay, ey)-50)/5.0-0.5) AS BIGINT), CAST(floor((GREATEST(ay, ey)+50)/5.0-0.5) AS BIGINT)+1)) AS k
  FROM seg WHERE highway IN {MAJOR} AND (ax <> ex OR ay <> ey)),
cuts AS (SELECT highway, k, {_LO} AS lo, {_HI} AS hi FROM lines),
{_merge('runs', 'cuts', 'highway, k')}, {_merge('runs_all', 'cuts', 'k')}"""

_LOY, _HIY = capsule("y")
IN_ZONE = f"""WITH {SEGMENTS},
heights AS (SELECT id, x0, x0 + w AS x1, UNNEST(list_concat([CAST(y0 AS DOUBLE), y0 + h],
  list_transform(range(CAST(floor(y0/5.0-0.5) AS BIGINT)+1, CAST(ceil((y0+h)/5.0-0.5) AS BIGINT)), lambda k: (k+0.5)*5.0))) AS y FROM fx_buildings),
cuts AS (SELECT h.id, h.x0, h.x1, h.y, s.highway, {_LOY} AS lo, {_HIY} AS hi FROM heights h JOIN seg s
  ON h.y BETWEEN LEAST(s.ay, s.ey) - 50 AND GREATEST(s.ay, s.ey) + 50 AND h.x1 >= LEAST(s.ax, s.ex) - 50 AND h.x0 <= GREATEST(s.ax, s.ex) + 50
  WHERE s.highway IN {MAJOR} AND (s.ax <> s.ex OR s.ay <> s.ey)),
{_merge('runs', '(SELECT * FROM cuts WHERE lo <= hi)', 'id, highway, x0, x1, y')},
good AS (SELECT DISTINCT id, highway, y FROM runs WHERE lo <= x0 AND hi >= x1),
inside AS (SELECT id, highway FROM good GROUP BY 1, 2
  HAVING COUNT(*) = (SELECT COUNT(DISTINCT y) FROM heights WHERE heights.id = good.id))"""

# transverse Mercator of zone 13, spelled out from the published series
_TERMS = [(f"cos({2*j}*xi)*sinh({2*j}*eta)*{a!r}", f"sin({2*j}*xi)*cosh({2*j}*eta)*{a!r}") for j, a in enumerate(pj._ALPHA, 1)]
def forward_utm(source: str) -> str:
    """Easting and northing of the points (lon, lat) of a table."""
    return f"""SELECT (eta+{"+".join(e for e, _ in _TERMS)})*{pj._R!r}+{pj._E0!r} AS east, (xi+{"+".join(n for _, n in _TERMS)})*{pj._R!r} AS north FROM (
  SELECT atan2(tau, cos(dl)) AS xi, asinh(sin(dl)/sqrt(tau*tau+cos(dl)*cos(dl))) AS eta FROM (
    SELECT radians(lon+105.0) AS dl, sinh(atanh(sin(radians(lat)))-{pj._E!r}*atanh({pj._E!r}*sin(radians(lat)))) AS tau FROM {source}))"""


# inverse transverse Mercator, spelled out from the published series
_XI, _ETA = f"(y0/{pj._R!r})", f"((x0-{pj._E0!r})/{pj._R!r})"
_XP = f"{_XI}-" + "-".join(f"{b!r}*sin({2*j}*{_XI})*cosh({2*j}*{_ETA})" for j, b in enumerate(pj._BETA, 1))
_EP = f"{_ETA}-" + "-".join(f"{b!r}*cos({2*j}*{_XI})*sinh({2*j}*{_ETA})" for j, b in enumerate(pj._BETA, 1))
def inverse_utm(source: str) -> str:
    """Series terms for the points (x0, y0) of a table; LON and LAT read from them."""
    return f"SELECT *, asin(sin(xp)/cosh(ep)) AS chi FROM (SELECT *, {_XP} AS xp, {_EP} AS ep FROM {source})"


LON = "(degrees(atan2(sinh(ep), cos(xp))) - 105.0)"
LAT = "degrees(chi+" + "+".join(f"{q!r}*sin({2*j}*chi)" for j, q in enumerate(pj._DELTA, 1)) + ")"
