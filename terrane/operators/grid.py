"""Grid-partitioned candidate joins.

A feature of size s belongs to the level whose cells are just as wide as s (each
level is four times as coarse as the one below), so it touches at most four
cells there. Two features meet on the coarser of their two levels: the bigger
one is the owner and sits on its own level, the smaller one probes the levels
above its own. Every pair therefore meets on one level only, huge features
never explode into small cells, and small ones are never compared across a cell
much wider than the bigger partner.

A cell that holds very many rows is split: its rows get a random share number
and the partner rows are repeated once per share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.schema import BBOX_COLUMNS
from terrane.session import chosen_broadcast, stored

FACTOR = 4.0
HOT_ROWS = 500_000        # rows of one cell a single task is trusted with
TASK_ROWS = 100_000       # rows of one task of a join of boxes within reach; it holds one side of them in memory
BLOCK_BITS = 4            # cells of a block along each side, as a power of two: blocks are exchanged, cells are not
REACH_CELL = 0.6          # width of the finest cells as a share of the reach
BROADCAST_CELLS = 100_000  # rows of the list of split cells up to which it is broadcast; a longer one is joined by key
KEYS = ["_level", "_role", "_cx", "_cy"]


def level_of(size: Column) -> Column:
    """Smallest level whose cells are at least ``size`` wide (level 0 = 1 unit)."""
    return F.greatest(F.ceil(F.log(F.greatest(size, F.lit(1.0))) / F.log(F.lit(FACTOR)) - 1e-9), F.lit(0)).cast("int")


def cell_width(level: Column) -> Column:
    return F.pow(F.lit(FACTOR), level)


def own_level(prefix: str = "") -> Column:
    c = {k: F.col(prefix + k) for k in BBOX_COLUMNS}
    return level_of(F.greatest(c["xmax"] - c["xmin"], c["ymax"] - c["ymin"]))


def levels_present(df: DataFrame, finer: int = 0) -> list[int]:
    """Distinct feature levels, a handful of integers whatever the data size."""
    row = df.agg(F.sort_array(F.collect_set(_finer(own_level(), finer))).alias("levels")).first()
    return list(row["levels"])


def _finer(level: Column, by: int) -> Column:
    return F.greatest(level - by, F.lit(0)) if by else level


def _int_array(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<int>")


def _keyed(df: DataFrame, prefix: str, own: tuple[int, list[int]] | None, probe: tuple[int, list[int]] | None,
           include_own: bool, corner_only: bool, finer: int = 0) -> DataFrame:
    """One row per (level, role, cell) a feature takes part in: ``own`` and ``probe`` are a role and the levels of its rows.

    Levels and cells are exploded one after the other; as nested lambdas they took some 28 us a feature.
    """
    named = df.select(*[F.col(c).alias(prefix + c) for c in df.columns])
    box = {k: F.col(prefix + k) for k in BBOX_COLUMNS}
    mine = _finer(own_level(prefix), finer)
    if corner_only:     # one cell a level: no arrays of cells
        width, (role, levels) = cell_width(F.col("_level")), probe
        return (named.withColumn("_level", F.explode(_int_array(levels))).filter((F.col("_level") >= mine) if include_own else (F.col("_level") > mine))
                .withColumns({"_role": F.lit(role), "_cx": F.floor(box["xmin"] / width), "_cy": F.floor(box["ymin"] / width)}))
    kinds = [(v, role, at_own) for side, at_own in ((own, True), (probe, False)) if side for role in side[:1] for v in side[1]]
    each = F.array(*[F.struct(F.lit(v).alias("_level"), F.lit(role).alias("_role"), F.lit(FACTOR**v).alias("_width"), F.lit(at_own).alias("_own"))
                     for v, role, at_own in kinds]) if kinds else F.array().cast("array<struct<_level:int,_role:int,_width:double,_own:boolean>>")
    above = (F.col("_level") >= mine) if include_own else (F.col("_level") > mine)
    rows = named.select("*", F.inline(each)).filter(F.when(F.col("_own"), F.col("_level") == mine).otherwise(above))
    for a in "xy":
        rows = rows.withColumn("_c" + a, F.explode(F.sequence(F.floor(box[a + "min"] / F.col("_width")), F.floor(box[a + "max"] / F.col("_width")))))
    return rows.drop("_width", "_own")


def _shares(left: DataFrame, right: DataFrame, hot_rows: int, keys: list[str]) -> DataFrame:
    """Every cell above ``hot_rows`` on a side, with its share counts."""
    counts = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl")).withColumn("_nr", F.lit(0).cast("long"))
              .unionByName(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))
                           .withColumn("_nl", F.lit(0).cast("long")))
              .groupBy(*keys).agg(F.sum("_nl").alias("_nl"), F.sum("_nr").alias("_nr"))
              .filter((F.col("_nl") > hot_rows) | (F.col("_nr") > hot_rows)))
    return counts.select(*keys, F.ceil(F.col("_nl") / hot_rows).cast("int").alias("_sl"),
                         F.ceil(F.col("_nr") / hot_rows).cast("int").alias("_sr"))


def _split(left: DataFrame, right: DataFrame, hot_rows: int, keys: list[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Both sides with share numbers ``_kl`` and ``_kr``; unchanged if no cell is crowded."""
    shares = stored(_shares(left.select(*keys), right.select(*keys), hot_rows, keys), "shares")
    if shares.isEmpty():
        return left, right
    hot = chosen_broadcast(shares, BROADCAST_CELLS)

    def spread(df, mine, other, mine_key, other_key):
        n_mine = F.greatest(F.coalesce(F.col(mine), F.lit(1)), F.lit(1))
        n_other = F.greatest(F.coalesce(F.col(other), F.lit(1)), F.lit(1))
        row_key = F.xxhash64(*[c for c in df.columns if c.endswith(BBOX_COLUMNS) or c.endswith("id")])
        return (df.join(hot, keys, "left")
                .withColumn(mine_key, F.pmod(row_key, n_mine).cast("int"))
                .withColumn(other_key, F.explode(F.sequence(F.lit(0), n_other - 1)))
                .drop("_sl", "_sr"))
    return spread(left, "_sl", "_sr", "_kl", "_kr"), spread(right, "_sr", "_sl", "_kr", "_kl")


def candidate_pairs(left: DataFrame, right: DataFrame, left_in_right: bool = False,
                    split_hot: bool = True, hot_rows: int = HOT_ROWS, finer: int = 0, how: str = "inner") -> DataFrame:
    """All pairs whose bounding boxes meet, each once.

    Both inputs carry ``xmin ymin xmax ymax``. The output holds the left columns
    prefixed ``l_`` and the right ones prefixed ``r_``. With ``left_in_right``
    only pairs whose left box lies in the right box are wanted; then the left
    side needs one cell per level (that of its lower-left corner), and cells may be
    ``finer`` than the right features, which then lie in more of them and are compared less
    in vain. ``how='left_semi'`` gives left rows that have a partner, some of them more than once.
    """
    right_levels = levels_present(right, finer if left_in_right else 0)
    if left_in_right:
        lk = _keyed(left, "l_", None, (1, right_levels), True, True, finer)
        rk = _keyed(right, "r_", (1, right_levels), None, False, False, finer)
    else:       # a level on which no row of the other side can be is left out
        left_levels = levels_present(left)
        lk = _keyed(left, "l_", (0, [v for v in left_levels if any(w <= v for w in right_levels)]), (1, right_levels), False, False)
        rk = _keyed(right, "r_", (1, [v for v in right_levels if any(w < v for w in left_levels)]), (0, left_levels), True, False)
    keys = list(KEYS)
    if split_hot:
        lk, rk = _split(lk, rk, hot_rows)
        keys += [c for c in ("_kl", "_kr") if c in lk.columns]
    if left_in_right:
        meets = ((F.col("l_xmin") >= F.col("r_xmin")) & (F.col("l_xmax") <= F.col("r_xmax"))
                 & (F.col("l_ymin") >= F.col("r_ymin")) & (F.col("l_ymax") <= F.col("r_ymax")))
    else:
        width = cell_width(F.col("_level"))
        meets = ((F.col("l_xmin") <= F.col("r_xmax")) & (F.col("l_xmax") >= F.col("r_xmin"))
                 & (F.col("l_ymin") <= F.col("r_ymax")) & (F.col("l_ymax") >= F.col("r_ymin"))
                 & (F.floor(F.greatest("l_xmin", "r_xmin") / width) == F.col("_cx"))
                 & (F.floor(F.greatest("l_ymin", "r_ymin") / width) == F.col("_cy")))
    if how == "inner":
        return lk.join(rk, keys).filter(meets).drop(*keys)
    if not left_in_right:
        raise ValueError("existence of partners is for boxes within boxes")
    rk = rk.withColumnsRenamed({k: "r" + k for k in keys})
    return lk.join(rk, reduce(Column.__and__, [F.col(k) == F.col("r" + k) for k in keys], meets), how).drop(*keys)


def _reach_level(prefix: str, base: float) -> Column:
    c = {k: F.col(prefix + k) for k in BBOX_COLUMNS}
    return level_of(F.greatest(c["xmax"] - c["xmin"], c["ymax"] - c["ymin"]) / base)


def _meet(owner: DataFrame, probe: DataFrame, o: str, p: str, width: float, span: tuple[float, float], reach: float, rows: int,
          hot_rows: int) -> DataFrame:
    """Pairs of owners, each in the cell of its lower left corner, and the probes whose widened box touches that cell.

    Only blocks of cells are exchanged. A task holds the owners of its blocks as an array of cells, and its probes
    look their cells up there: a join by cell would exchange or sort every cell of every probe. Block numbers wrap
    round far beyond the reach.
    """
    side = 2**BLOCK_BITS

    def cell(x: Column) -> Column:
        return F.floor(x / width)

    def block(bx: Column, by: Column) -> Column:
        return (bx.bitwiseAND(0xFFFF) * 0x10000 + by.bitwiseAND(0xFFFF) - 0x80000000).cast("int").alias("_block")

    def inner(cx: Column, cy: Column) -> Column:
        return (cx.bitwiseAND(side - 1) * side + cy.bitwiseAND(side - 1)).cast("int")
    slack = reach * (1 + 1e-9) + 1e-6
    first = {a: cell(F.col(f"{p}{a}min") - slack - w) for a, w in zip("xy", span)}
    last = {a: cell(F.col(f"{p}{a}max") + slack) for a in "xy"}
    shape, names = probe.columns, owner.columns
    for a in "xy":
        probe = probe.withColumn("_b" + a, F.explode(F.sequence(F.shiftright(first[a], BLOCK_BITS), F.shiftright(last[a], BLOCK_BITS))))
    probe = probe.select(*shape, F.col("_bx").cast("int"), F.col("_by").cast("int"), block(F.col("_bx"), F.col("_by")))
    corner = [cell(F.col(f"{o}{a}min")) for a in "xy"]
    owner = owner.select("*", block(*[F.shiftright(v, BLOCK_BITS) for v in corner]), inner(*corner).alias("_cell"))
    owner, probe = _split(owner, probe, hot_rows, ["_block"])
    keys = [c for c in ("_block", "_kl", "_kr") if c in owner.columns]
    usual = int(owner.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(usual, rows // 1000), rows // TASK_ROWS, 1)
    members = owner.repartition(tasks, *keys).groupBy(*keys, "_cell").agg(F.collect_list(F.struct(*names)).alias("_own"))
    blocks = members.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_cell", "_own"))).alias("_own"))
    blocks = blocks.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda i: F.element_at("_own", i)).alias("_own"))
    pairs = probe.repartition(tasks, *keys).join(blocks.hint("shuffle_hash"), keys)
    for a in "xy":
        low = F.col("_b" + a).cast("long") * side
        pairs = pairs.withColumn("_c" + a, F.explode(F.sequence(F.greatest(first[a], low), F.least(last[a], low + (side - 1)))))
    pairs = pairs.select(*shape, F.explode(F.get("_own", inner(F.col("_cx"), F.col("_cy")))).alias("_own"))
    return pairs.select(*shape, *[F.col("_own")[c].alias(c) for c in names])


def boxes_in_reach(left: DataFrame, right: DataFrame, reach: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(l_id, r_id, dist) of all boxes at most ``reach`` apart, each pair once.

    The larger box of a pair (the right one, if both are of one level) owns the pair. Cells are about as wide as
    the reach, or as the owner where that is wider, so few candidates are in vain.
    """
    base = max(reach * REACH_CELL, 1.0)
    sizes, named = [], []
    for df, prefix in ((left, "l_"), (right, "r_")):
        c = {k: F.col(k) for k in BBOX_COLUMNS}
        found = df.groupBy(_reach_level("", base).alias("lv")).agg(
            F.max(c["xmax"] - c["xmin"]).alias("w"), F.max(c["ymax"] - c["ymin"]).alias("h"), F.count(F.lit(1)).alias("n")).collect()
        sizes.append({r["lv"]: r for r in found})
        named.append(df.select(*[F.col(k).alias(prefix + k) for k in ("id", *BBOX_COLUMNS)]))
    parts = []
    for own, other in ((1, 0), (0, 1)):
        o, p = "lr"[own] + "_", "lr"[other] + "_"
        for lv, size in sorted(sizes[own].items()):
            rows = sum(r["n"] for k, r in sizes[other].items() if k < lv or (own and k == lv))
            if rows:
                lower = _reach_level(p, base) <= lv if own else _reach_level(p, base) < lv
                parts.append(_meet(named[own].filter(_reach_level(o, base) == lv), named[other].filter(lower), o, p, base * FACTOR**lv,
                                   (size["w"], size["h"]), reach, rows + size["n"], hot_rows))
    pairs = reduce(DataFrame.unionByName, parts) if parts else named[0].limit(0).crossJoin(named[1].limit(0))
    a, b = ({k: F.col(f"{s}_{k}") for k in BBOX_COLUMNS} for s in "lr")
    dx, dy = (F.greatest(F.lit(0.0), a[v + "min"] - b[v + "max"], b[v + "min"] - a[v + "max"]) for v in "xy")
    return pairs.select("l_id", "r_id", F.sqrt(dx * dx + dy * dy).alias("dist")).filter(F.col("dist") <= reach)


def grow(df: DataFrame, by) -> DataFrame:
    """Widen the bounding boxes by a number or a column."""
    by = F.lit(float(by)) if isinstance(by, (int, float)) else by
    return df.withColumns({"xmin": F.col("xmin") - by, "ymin": F.col("ymin") - by,
                           "xmax": F.col("xmax") + by, "ymax": F.col("ymax") + by})
