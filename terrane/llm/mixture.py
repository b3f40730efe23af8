"""Mixing sources to target weights by a low-discrepancy schedule.

Slots of ``block`` words each are laid out by the van der Corput sequence:
the n-th point, mapped through the cumulative target weights, names the source
of slot n. Every source is a stream of blocks of equal size cut from its
documents in a hash order, read twice at most. The r-th slot of a source takes
its r-th block; the last slot is cut so that the source ends on its target, and
a source that the sequence has left short gets its missing slots at the end of
the schedule. A document's ``taken`` is the number of its words in the blocks taken,
its ``first_slot`` the slot that takes the first of them (null if none does): read in
the order of ``first_slot``, every part of the mix is near the target shares.

Sources may be of any size: positions in a source and ranks of slots are prefix
sums over hash cells whose number follows the rows, so no task holds a whole
source. The list of sources (one row each) is kept on the driver and is
broadcast; it may hold up to ``MAX_SOURCES`` rows, more raise an error.

Defined results: size is the number of words (runs outside space and tab to
carriage return), 0 for null; a null source is a source of its own, the last;
documents without words are taken 0 times; an empty table gives no rows; repeated
rows are documents of their own; extra columns are left alone. Reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.session import stored

WEIGHTS = (3, 1, 2)        # by source in code point order, repeating
SHARE_PERCENT = 150        # of all words
REPEATS = 2                # a source is read this often at most
BLOCK_WORDS = 256
CELL_ROWS = 4096           # rows that a prefix-sum cell holds about
MAX_SOURCES = 100_000
GRID_BITS = 12             # cells of the unit interval that find a slot's source by an equi-join
WORD = r"[^\x20\x09-\x0D]+"


def _by_code_point(name: str | None):
    return (name is None, [ord(c) for c in name or ""])


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT) -> dict[str | None, float]:
    """Words to take of each source: shares by weight, at most REPEATS times its size, the excess reshared."""
    names = sorted(sizes, key=_by_code_point)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    open_, out, left = set(names), {}, sum(sizes.values()) * percent / 100
    while open_:
        total = sum(weight[n] for n in open_)
        over = [n for n in names if n in open_ and left * weight[n] / total > REPEATS * sizes[n]]
        if not over:
            return out | {n: left * weight[n] / total for n in open_}
        for n in over:
            out[n] = float(REPEATS * sizes[n])
            open_.discard(n)
        left -= sum(out[n] for n in over)
    return out


def _prefix(df: DataFrame, keys: list[str], cell: F.Column, order: list, value: F.Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same keys that come before, by cell and then ``order``.

    Cells are summed first and only their sums are accumulated per key; rows are sorted
    within their cell alone.
    """
    from pyspark.sql import Window as Wd
    df = df.withColumn("cell", cell).withColumn("step", value)
    sums = df.groupBy(*keys, "cell").agg(F.sum("step").alias("cell_sum"))
    before = Wd.partitionBy(*keys).orderBy("cell").rowsBetween(Wd.unboundedPreceding, -1)
    sums = sums.select(*keys, "cell", F.coalesce(F.sum("cell_sum").over(before), F.lit(0)).alias("base"))
    inside = Wd.partitionBy(*keys, "cell").orderBy(*order).rowsBetween(Wd.unboundedPreceding, -1)
    return (df.withColumn("inner", F.coalesce(F.sum("step").over(inside), F.lit(0))).join(sums, [*keys, "cell"])
            .withColumn(name, F.col("inner") + F.col("base")).drop("cell", "step", "inner", "base"))


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, source, size, place, tie) and ``keep``: place orders a source's documents by the MD5 of their id."""
    return docs.select(*keep, "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
                       F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("tie"))


def schedule(docs_spark, plan: list[tuple[int, int]], block: int = BLOCK_WORDS) -> DataFrame:
    """(source_no, rank, slot) for plan = (source_no, words to take): the slots in their order."""
    spark = docs_spark
    plan = [(s, w) for s, w in plan if w > 0]
    need = {s: -(-w // block) for s, w in plan}
    total, words = sum(need.values()), sum(w for _, w in plan)
    edges, at, cells = [], 0, 1 << GRID_BITS
    for s, w in plan:
        a, at = at, at + w
        edges.append((s, a / words, at / words if at < words else 1.0))
    grid = [(c, s, a, b) for s, a, b in edges for c in range(int(a * cells), min(cells, int(math.ceil(b * cells))))]
    grid = spark.createDataFrame(grid, "cell int, source_no int, lo double, hi double")
    slots = spark.createDataFrame([(s, n) for s, n in need.items()], "source_no int, need long")
    width = 40
    u = F.conv(F.reverse(F.lpad(F.bin("slot"), width, "0")), 2, 10).cast("double") / float(1 << width)
    points = spark.range(total).select(F.col("id").alias("slot")).withColumn("u", u).withColumn("cell", F.floor(F.col("u") * cells).cast("int"))
    named = points.join(F.broadcast(grid), "cell").filter("u >= lo and u < hi").select("slot", "source_no")
    ranked = _prefix(named, ["source_no"], F.floor(F.col("slot") / (CELL_ROWS * 16)), ["slot"], F.lit(1).cast("long"), "rank")
    ranked = stored(ranked.select("source_no", "rank", "slot"), "slots")
    got = ranked.groupBy("source_no").agg(F.count(F.lit(1)).alias("got"))
    short = (slots.join(got, "source_no", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long"))).filter("got < need")
             .select("source_no", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank"), F.lit(total).alias("slot")))
    return ranked.join(F.broadcast(slots), "source_no").filter("rank < need").select("source_no", "rank", "slot").unionByName(short)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, block: int = BLOCK_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_slot) and the columns ``keep`` of ``docs``, one row per document."""
    spark = docs.sparkSession
    base = stored(sized(docs, *keep), "sized")
    groups = base.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(groups) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r.source: r.words for r in groups}
    names, goal, rows = sorted(sizes, key=_by_code_point), targets(sizes, weights, percent), {r.source: r.rows for r in groups}
    plan = [(i, min(REPEATS * sizes[n], round(goal[n]))) for i, n in enumerate(names)]
    info = spark.createDataFrame(
        [(n, i, sizes[n], goal[n], plan[i][1], max(1, rows[n] // CELL_ROWS)) for i, n in enumerate(names)],
        T.StructType([T.StructField(c, t) for c, t in (("name", T.StringType()), ("source_no", T.IntegerType()), ("source_size", T.LongType()),
                                                       ("target", T.DoubleType()), ("take", T.LongType()), ("cells", T.LongType()))]))
    placed = base.join(F.broadcast(info), base["source"].eqNullSafe(info["name"])).drop("name")
    top = F.conv(F.substring("place", 1, 12), 16, 10).cast("long")
    cell = F.floor(top * F.col("cells") / F.lit(1 << 48)).cast("long")  # ascends with place
    placed = stored(_prefix(placed, ["source_no"], cell, ["place", "doc_id", "tie"], F.col("size"), "offset"), "placed")
    # the words of slot r of a source are [r * block, (r + 1) * block) of its stream, the stream being the source read again and again
    slots = (schedule(spark, plan, block).join(F.broadcast(info.select("source_no", "source_size", "take")), "source_no")
             .withColumn("a", F.col("rank") * block).withColumn("b", F.least(F.col("a") + block, "take")).filter("b > a"))
    lap = F.floor(F.col("a") / F.col("source_size"))
    cut = F.col("source_size") * (lap + 1)
    parts = slots.withColumnRenamed("slot", "first_slot").withColumn("part", F.explode(F.array_compact(F.array(
        F.struct((F.col("a") - lap * F.col("source_size")).alias("a"), (F.least("b", cut) - lap * F.col("source_size")).alias("b")),
        F.when(F.col("b") > cut, F.struct(F.lit(0).cast("long").alias("a"), (F.col("b") - cut).alias("b")))))))
    # pieces never straddle a multiple of block, so both sides meet on it
    def tiled(df: DataFrame, a: F.Column, b: F.Column) -> DataFrame:
        tile = F.explode(F.sequence(F.floor(a / block), F.floor((b - 1) / block)))
        return df.withColumn("tile", tile).withColumn("a", F.greatest(a, F.col("tile") * block)).withColumn("b", F.least(b, (F.col("tile") + 1) * block))
    pieces = tiled(parts.select("source_no", "first_slot", F.col("part.a").alias("pa"), F.col("part.b").alias("pb")), F.col("pa"), F.col("pb"))
    pieces = pieces.groupBy("source_no", "tile", "a", "b").agg(F.count(F.lit(1)).alias("times"), F.min("first_slot").alias("slot"))
    keyed = placed.filter("size > 0 and take > 0").select("source_no", "place", "doc_id", "tie", "offset", "size")
    spans = tiled(keyed, F.col("offset"), F.col("offset") + F.col("size"))
    other = pieces.select("source_no", "tile", F.col("a").alias("c"), F.col("b").alias("d"), "times", "slot")
    common = F.greatest(F.lit(0).cast("long"), F.least("b", "d") - F.greatest("a", "c"))
    taken = spans.join(other, ["source_no", "tile"]).groupBy("source_no", "offset").agg(
        F.sum(common * F.col("times")).alias("taken"), F.min(F.when(common > 0, F.col("slot"))).alias("first_slot"))
    full = placed.filter("size > 0").join(taken, ["source_no", "offset"], "left")  # an offset names one document of a source that has words
    none = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).withColumn("first_slot", F.lit(None).cast("long"))
    columns = [*keep, "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot"]
    return full.select(*columns).unionByName(none.select(*columns))


def report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def draw(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes words of, with ``docs``' columns, ``taken`` and ``first_slot``; own columns of these names are replaced.

    Rows are numbered and written once, so that equal rows are told apart and the mix is joined by number: the texts are shuffled once.
    """
    own = [c for c in docs.columns if c not in ("taken", "first_slot")]
    row = "row_" + "_".join(docs.columns)  # a name that no column has
    numbered = stored(docs.select(*own, F.monotonically_increasing_id().alias(row)), "mixture-rows")
    mixed = mix(numbered, keep=(row,)).filter("taken > 0").select(row, "taken", "first_slot")
    return numbered.join(mixed, row).select(*own, "taken", "first_slot")
