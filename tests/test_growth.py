"""What grows with the input stays off the driver and out of pairs."""

from pyspark.sql import functions as F

from terrane.functions import geometry as g
from terrane.operators import cluster, grid, joins, zones
from terrane.operators.grid import candidate_pairs
from terrane.plans import layers
from terrane.session import SMALL_ROWS, stored


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_table_of_repeated_numbers_is_not_broadcast(spark):
    """Its files stay far below the broadcast threshold; its rows on the driver would not."""
    many = stored(spark.range(SMALL_ROWS * 4).select((F.col("id") / 1000).cast("int").alias("k"), F.lit(0).alias("i")))
    other = spark.range(5_000_000).select((F.col("id") % 7).cast("int").alias("k"))
    assert "BroadcastHashJoin" not in _plan(other.groupBy("k").count().join(many, "k").agg(F.count("*")))
    few = stored(spark.range(100).select(F.col("id").cast("int").alias("k")))
    assert "BroadcastHashJoin" in _plan(other.join(few, "k").agg(F.count("*")))


def test_cells_that_links_join_already_are_not_compared_again(spark, monkeypatch):
    """A field of dense cells: one component, found without opening the pairs that it settles."""
    spots = spark.range(20 * 20 * 6).select("id", (F.col("id") % 20 * 50 + F.col("id") % 6).cast("double").alias("x"),
                                           (F.floor(F.col("id") / 120) * 50 + F.col("id") % 5).cast("double").alias("y"))
    boxes = g.with_bbox(spots.select("id", g.rectangle(F.col("x"), F.col("y"), F.lit(3.0), F.lit(3.0)).alias("geom")))
    kept = {}

    def watched(df, label="layer"):
        kept[label] = stored(df, label)
        return kept[label]
    monkeypatch.setattr(cluster, "stored", watched)
    out = cluster.dbscan(boxes, 100.0, 5)
    assert out.select("cluster_id").distinct().collect() == [(0,)]
    assert kept["part-pairs"].count() > 500 and kept["open-pairs"].isEmpty()


def test_long_slanting_lines_are_not_met_by_their_boxes(spark, monkeypatch):
    """Parallel diagonals: each box holds every query, each query is near two lines at most."""
    shift = (F.col("id") * 50).cast("double")
    line = F.array(g.vertex(shift, F.lit(0.0)), g.vertex(shift + 600, F.lit(300.0)), g.vertex(shift + 800, F.lit(500.0)))
    lines = g.with_bbox(spark.range(60).select("id", g.linestring(line).alias("geom")))
    spot = spark.range(400).select("id", (F.col("id") % 20 * 150 + 7).cast("double").alias("x"), (F.floor(F.col("id") / 20) * 25 + 3).cast("double").alias("y"))
    boxes = g.with_bbox(spot.select("id", g.rectangle(F.col("x"), F.col("y"), F.lit(4.0), F.lit(6.0)).alias("geom")))
    brute = (boxes.select("id", "geom").crossJoin(lines.select(F.col("id").alias("r"), F.col("geom").alias("line")))
             .groupBy("id").agg(F.min(F.struct(joins.pred.distance(F.col("geom"), F.col("line")).alias("d"), "r")).alias("m")).select("id", "m.r", F.round("m.d", 6).alias("d")))
    looked = []

    def watched(left, right, **more):
        looked.append(candidate_pairs(left, right, **more))
        return looked[-1]
    monkeypatch.setattr(joins, "candidate_pairs", watched)
    got = joins.nearest_join(boxes, lines, digits=6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, brute.collect()))
    assert looked and sum(df.count() for df in looked) < 400 * 12


def test_boxes_within_boxes_are_neither_sent_to_python_nor_exchanged_as_pairs(spark):
    """Every feature in every zone but one: zone columns, features in no zone and odd shapes as in brute force."""
    def rectangles(rows):
        df = spark.createDataFrame(rows, "id long, x double, y double, w double, h double")
        return g.with_bbox(df.select("id", F.col("id").alias("tag"), g.rectangle(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("geom")))
    left = rectangles([(i, 10.0 * i, 7.0 * i, 2.0, 3.0) for i in range(30)] + [(30, 5000.0, 0.0, 2.0, 2.0), (31, 0.0, 0.0, 0.0, 4.0)])
    right = rectangles([(i, -1.0 * i, -2.0 * i, 150.0 + 90 * i, 100.0 + 70 * i) for i in range(8)] + [(8, 0.0, 0.0, 20.0, 3.0)])

    def plain(df, how):
        hits = (left.alias("l").crossJoin(df.alias("r")).filter(joins.pred.within(F.col("l.geom"), F.col("r.geom")))
                .select("l.id", F.col("r.id").alias("zone_id"), F.col("r.tag").alias("tag_zone")))
        return sorted(map(str, left.select("id").join(hits, "id", how).collect()))
    joined = joins.within_join(left, right, ["tag"]).select("id", "zone_id", "tag_zone")
    assert "Python" not in _plan(joins.within_join(left.filter("id < 31"), right, ["tag"]))      # the last one has no area
    assert sorted(map(str, joined.collect())) == plain(right, "left")
    corner = F.array(*[g.vertex(F.lit(x), F.lit(y)) for x, y in ((-9.0, -9.0), (400.0, -9.0), (-9.0, 300.0), (-9.0, -9.0))])
    odd = right.unionByName(g.with_bbox(spark.range(9, 10).select("id", F.col("id").alias("tag"), g.geometry("Polygon", F.array(F.array(corner))).alias("geom"))))
    for how in ("left", "inner"):
        assert sorted(map(str, joins.within_join(left, odd, ["tag"], how).select("id", "zone_id", "tag_zone").collect())) == plain(odd, how)
    assert sorted(r.id for r in joins.within_join(left, odd, [], distinct=True).collect()) == [*range(30), 31]


def test_only_footprints_at_a_zone_edge_are_scanned(spark, monkeypatch):
    """Inside one capsule, across two of a class, at the edge, far off, and in zones of a null class."""
    def capsule(i, tag, x0, x1, y):
        return (i, tag, float(x0), float(x1), float(y))
    rows = spark.createDataFrame([capsule(i, "a", 0, 400, 30 * i) for i in range(8)] + [capsule(8, "b", 0, 400, 0), capsule(9, "b", 0, 400, 90), capsule(10, None, 0, 90, 60)],
                                 "id long, highway string, x0 double, x1 double, y double")
    roads = rows.select("id", "highway", g.linestring(F.array(g.vertex(F.col("x0"), F.col("y")), g.vertex(F.col("x1"), F.col("y")))).alias("geom"))
    spot = spark.range(600).select("id", (F.col("id") % 30 * 20 - 60).cast("double").alias("x"), (F.floor(F.col("id") / 30) * 21 - 70).cast("double").alias("y"))
    boxes = g.with_bbox(spot.select("id", g.rectangle(F.col("x"), F.col("y"), F.lit(9.0), F.lit(12.0)).alias("geom")))
    kept = {}

    def watched(df, label="layer"):
        kept[label] = stored(df, label)
        return kept[label]
    monkeypatch.setattr(zones, "stored", watched)
    got = sorted(map(str, zones.within_zones(boxes, roads).collect()))
    scanned = kept["spans"].count()
    monkeypatch.setattr(zones, "_decided", lambda own, caps, by, radius: (
        spark.createDataFrame([], "id long, highway string"), own.select("id").crossJoin(caps.select(by).distinct())))
    assert got == sorted(map(str, zones.within_zones(boxes, roads).collect()))      # all by scan lines
    assert kept["spans"].count() == 1800 and len(got) > 300 and 0 < scanned < 100


def test_distances_of_boxes_are_not_sent_to_python(spark):
    """All pairs as by the predicate, also with a triangle on either side."""
    spot = spark.range(60).select("id", (F.col("id") * 37 % 101 * 3.7).alias("x"), (F.col("id") * 53 % 89 * 2.3).alias("y"))
    boxes = g.with_bbox(spot.select("id", g.rectangle(F.col("x"), F.col("y"), F.lit(7.5), F.lit(11.0)).alias("geom")))
    corner = F.array(*[g.vertex(F.lit(x), F.lit(y)) for x, y in ((50.0, 50.0), (200.0, 60.0), (90.0, 180.0), (50.0, 50.0))])
    odd = boxes.unionByName(g.with_bbox(spark.range(60, 61).select("id", g.geometry("Polygon", F.array(F.array(corner))).alias("geom"))))

    def rows(df):
        return sorted((a, b, round(d, 6)) for a, b, d in df.collect())
    for side in (boxes, odd):
        brute = side.alias("l").crossJoin(side.alias("r")).select("l.id", F.col("r.id").alias("r"), joins.pred.distance(F.col("l.geom"), F.col("r.geom")).alias("d"))
        got = joins.distance_pairs(side, side, 60.0).select("l_id", "r_id", "dist")
        assert rows(got) == rows(brute.filter("d <= 60"))
        assert ("Python" in _plan(got)) == (side is odd)


def test_footprints_are_repaired_once(spark):
    """The filter on validity is not pushed below the repair, which would then run for it as well."""
    ring = F.array(*[g.vertex(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (4.0, 6.0), (4.0, 0.0), (0.0, 6.0), (0.0, 0.0))])
    ties = spark.range(40).select("id", F.lit("a").alias("name"), F.lit("b").alias("building"), F.lit("3.5").alias("height"),
                                  g.geometry("Polygon", F.array(F.array(ring))).alias("geom"))
    done = layers.processed_buildings(ties)
    assert done.filter("area_m2 = 0 and area_repaired_m2 = 12").count() == 40
    assert done._jdf.queryExecution().optimizedPlan().toString().count("made_valid(") == 1


def test_first_matches_do_not_open_all_pairs(spark, monkeypatch):
    """A key that many rows of both sides share, one without a match, a missing one and a first row without a value."""
    left = spark.createDataFrame([(i // 2, i % 3) for i in range(300)] + [(900, 7), (901, None)], "id long, k long")
    right = spark.createDataFrame([(z, z % 3, None if z < 3 else f"v{z}") for z in range(400, 0, -1)] + [(0, None, "n")], "zone long, k long, v string")
    seen = []
    once = layers.first_per_key
    monkeypatch.setattr(layers, "first_per_key", lambda df, *how: seen.append(df) or once(df, *how))
    got = sorted(map(tuple, layers.first_match_per_key(left, right, ["k"], ["id"], ["zone"], ["v"]).collect()))
    assert got == sorted(map(tuple, once(left.join(right, "k"), ["id"], ["zone"], ["v"]).collect())) and len(got) == 150
    assert left.join(right, "k").count() > 30_000 and seen[-1].count() == 300


def test_boxes_in_reach_are_stored_once_and_not_sent_cell_by_cell(spark, monkeypatch):
    """Sizes from nothing to many reaches on both sides, below zero, crowded blocks: each pair once, as in brute force."""
    def boxes(n, salt):
        i = F.col("id")
        spot = spark.range(n).select("id", ((i * 37 + salt) % 1009 * 1.7 - 800).alias("x"), ((i * 53 + salt) % 997 * 1.3 - 500).alias("y"),
                                     F.pow(F.lit(40.0), i % 3 - 1).alias("w"), ((i + salt) % 2 * 9).cast("double").alias("h"))
        return g.with_bbox(spot.select("id", g.rectangle(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("geom")))
    left, right = boxes(260, 3), boxes(190, 41)
    a, b = ({k: F.col(f"{s}.{k}") for k in joins.BOX} for s in "lr")

    def rows(df):
        return sorted((p, q, round(d, 6)) for p, q, d in df.collect())
    for one, two, reach, hot in ((left, right, 90.0, 500_000), (right, left, 7.0, 5), (left, left, 0.0, 500_000)):
        every = one.alias("l").crossJoin(two.alias("r")).select("l.id", F.col("r.id").alias("r"), g.bbox_distance(a, b).alias("d")).filter(F.col("d") <= reach)
        assert rows(grid.boxes_in_reach(one, two, reach, hot)) == rows(every)
    labels = []
    monkeypatch.setattr(joins, "stored", lambda df, label="layer", **how: labels.append(label) or stored(df, label, **how))
    small = boxes(3000, 5).filter("xmax - xmin < 30 and ymax - ymin < 30")
    out = joins.distance_pairs(small, small, 100.0)
    assert labels == ["distances"]
    assert "SortMergeJoin" not in _plan(out) and "ShuffledHashJoin" in _plan(out)


def test_quick_rounding_is_that_of_decimals(spark):
    rows = spark.range(4000).select(F.explode(F.array((F.col("id") + 0.5) / 1e6, F.sqrt("id"), -F.sqrt("id") / 7, F.col("id") * 1e13 + 0.1, F.lit(-1e-9),
                                                      F.lit(float("nan")), F.lit(float("inf")), F.lit(None).cast("double"), F.lit(0.1234565), F.lit(2.0000005))).alias("x"))
    same = rows.select(F.round("x", 6).alias("a"), g.rounded(F.col("x"), 6).alias("b"))
    assert same.filter(~F.col("a").eqNullSafe(F.col("b")) | (F.col("a").cast("string") != F.col("b").cast("string"))).isEmpty()


def test_footprints_deep_in_a_zone_are_settled_by_their_cell(spark, monkeypatch):
    """A stack of crossing roads of two classes and of none: few footprints are left for the single capsules."""
    rows = spark.range(120).select((F.col("id") % 3).alias("k"), (F.col("id") * 17 % 200).cast("double").alias("x"), (F.col("id") * 29 % 190).cast("double").alias("y"),
                                   (F.col("id") * 7 % 90 - 45).cast("double").alias("dx"), (F.col("id") * 11 % 130 - 60).cast("double").alias("dy"))
    line = F.array(g.vertex(F.col("x") - 100, F.col("y") - 100), g.vertex(F.col("x") + F.col("dx") + 100, F.col("y") + F.col("dy") + 100))
    roads = rows.select(F.when(F.col("k") == 0, "a").when(F.col("k") == 1, "b").alias("highway"), g.linestring(line).alias("geom"))
    spot = spark.range(300).select("id", (F.col("id") % 20 * 13).cast("double").alias("x"), (F.floor(F.col("id") / 20) * 14).cast("double").alias("y"))
    boxes = g.with_bbox(spot.select("id", g.rectangle(F.col("x"), F.col("y"), 2 + F.col("id") % 40 * 1.0, F.lit(9.0)).alias("geom")))
    kept = {}

    def watched(df, label="layer"):
        kept[label] = stored(df, label)
        return kept[label]
    monkeypatch.setattr(zones, "stored", watched)
    got = sorted(map(str, zones.within_zones(boxes, roads).collect()))
    assert kept["settled"].filter("size(done) = 3").count() > 100 and kept["covered"].count() < len(got) / 2
    monkeypatch.setattr(zones, "_decided", lambda own, caps, by, radius: (
        spark.createDataFrame([], "id long, highway string"), own.select("id").crossJoin(caps.select(by).distinct())))
    assert got == sorted(map(str, zones.within_zones(boxes, roads).collect()))      # all by scan lines


def test_cells_are_made_without_lambdas_and_only_where_partners_can_be(spark, monkeypatch):
    """Small boxes on the right, wide ones on the left: right rows on their own level would meet nobody."""
    def boxes(n, size):
        spot = spark.range(n).select("id", (F.col("id") * 37 % 101 * 7.0).alias("x"), (F.col("id") * 53 % 89 * 5.0).alias("y"))
        return g.with_bbox(spot.select("id", g.rectangle(F.col("x"), F.col("y"), F.lit(size), F.lit(size)).alias("geom"))).select("id", *joins.BOX)
    left, right = stored(boxes(50, 60.0)), stored(boxes(400, 3.0))
    keyed = []
    split = grid._split
    monkeypatch.setattr(grid, "_split", lambda a, b, *how: keyed.append((a, b)) or split(a, b, *how))
    pairs = candidate_pairs(left, right)
    assert "lambda" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert keyed[0][1].select("_role").distinct().collect() == [(0,)]
    a, b = ({k: F.col(f"{s}.{k}") for k in joins.BOX} for s in "lr")
    assert pairs.count() == left.alias("l").crossJoin(right.alias("r")).filter(g.bbox_distance(a, b) == 0).count() > 0
