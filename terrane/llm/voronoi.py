"""Exact top-k by inner product as a Voronoi kNN join (after Lu et al., 2012).

Vectors become integers, floor(64 * x) per component. With M the longest vector's
length, a row x gets one more component sqrt(M^2 - |x|^2) and a query one of 0; then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest rows are those of the largest inner
product. Queries and rows are assigned to their nearest pivot. Summaries per cell
(radius, rows, the k smallest distances to the pivot) bound, for each query cell,
the distance of every query's k-th neighbour; a row is sent to a group of query
cells only if the triangle inequality leaves it within that bound. Groups are
solved in tiles of bounded size, and the tiles' top k are merged.

Pivots are a sample of at most ``PIVOTS`` rows by hash; pivots and summaries, at
most ``PIVOTS`` * (k + dimensions) numbers, are all that the driver holds. Distances
are floating point, so bounds are widened by ``SLACK``; scores are integers, by
float products where these are exact and by 64-bit integers elsewhere.

Defined results: null vectors and vectors with a null, NaN or infinite component
take no part, nor do rows without an id; shorter vectors count as filled up with
zeros; ties go to the smaller vec_id; equal rows of one id take part as often as they
occur (as queries they are ranked together), but a query never meets a row of its own
id; without other rows a query gives no result; empty tables give none; extra columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.sampling import sampled
from terrane.session import stored

PIVOTS = 256
K = 20
QUERY_STEP = 20            # rows whose id is divisible by this are the queries
GROUP_QUERIES = 2048       # queries of one group
TILE_ROWS = 8192           # data rows of one tile
SLACK = 1e-6
EXACT = float(1 << 52)


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & whole)
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * 64).cast("long")).alias("v")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) integers; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, lengths = np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows (with their last component apart) to the pivots."""
    y = np.concatenate([x.astype(np.float64), extra[:, None]], 1)
    sq = (y * y).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * y @ pivots.T
    return np.sqrt(np.maximum(sq, 0))


def _assigned(rows: DataFrame, pivots: np.ndarray, dim: int, longest: float, query_step: int) -> DataFrame:
    """(vec_id, v, query, cell, dist): each row once as data, and once more as query where its id says so."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _matrix(batch.column("v"), dim), np.asarray(batch.column("vec_id"))
            if not len(x):
                continue
            length = (x.astype(np.float64) ** 2).sum(1)
            for query in (False, True):
                use = np.flatnonzero(ids % query_step == 0) if query else np.arange(len(ids))
                extra = np.zeros(len(use)) if query else np.sqrt(np.maximum(longest - length, 0))
                d = _distances(x[use], extra, shared.value)
                cell = d.argmin(1) if len(use) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[use]), batch.column("v").take(pa.array(use)), pa.array(np.full(len(use), query)), pa.array(cell.astype(np.int32)),
                     pa.array(d[np.arange(len(use)), cell])], names=["vec_id", "v", "query", "cell", "dist"])
    return rows.mapInArrow(place, "vec_id long, v array<long>, query boolean, cell int, dist double")


def bounds(pivots: np.ndarray, q_radius: np.ndarray, near: dict[int, list[float]], k: int) -> np.ndarray:
    """For each query cell a distance that its queries' k-th neighbours do not exceed.

    A row at distance s from pivot j is within radius_i + |p_i p_j| + s of every query of cell i.
    """
    between = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2), 0))
    known = [(j, s) for j, every in near.items() for s in every]
    out = np.full(len(pivots), np.inf)
    if len(known) >= k:
        cell, s = np.array([j for j, _ in known]), np.array([s for _, s in known])
        for i in np.flatnonzero(q_radius >= 0):
            out[i] = np.partition(q_radius[i] + between[i, cell] + s, k - 1)[k - 1]
    return out


def _top(pdf_q: pd.DataFrame, pdf_x: pd.DataFrame, dim: int, k: int) -> pd.DataFrame:
    """The k best rows of a tile for each query of a group; ties to the smaller id."""
    def matrix(col: pd.Series) -> np.ndarray:
        out = np.zeros((len(col), dim), np.int64)
        for i, v in enumerate(col):
            out[i, :len(v)] = v
        return out
    q, x = matrix(pdf_q["v"]), matrix(pdf_x["x"])
    qid, xid = pdf_q["vec_id"].to_numpy(), pdf_x["x_id"].to_numpy()
    order = np.argsort(xid, kind="stable")
    x, xid = x[order], xid[order]
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * dim < EXACT
    out = []
    for a in range(0, len(q), 256):
        part = q[a: a + 256]
        score = (part.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else part @ x.T
        for i, row in enumerate(score):
            other = np.flatnonzero(xid != qid[a + i])
            s = row[other]
            if len(s) > k:
                level = np.partition(s, len(s) - k)[len(s) - k]
                some = np.concatenate([np.flatnonzero(s > level), np.flatnonzero(s == level)])[:k]  # ids ascend within equal scores
            else:
                some = np.arange(len(s))
            out.append(pd.DataFrame({"query_id": qid[a + i], "vec_id": xid[other[some]], "score": s[some]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def search(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row whose id is divisible by ``query_step``."""
    spark = vectors.sparkSession
    rows = stored(quantised(vectors), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dim, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(length)).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not dim:
        dim, longest = max(1, dim or 0), longest or 0.0
        if not n:
            return empty
    if longest >= float(1 << 63):
        raise ValueError("the largest score does not fit into 64 bits")
    chosen = sampled(rows, "vec_id", min(PIVOTS, max(1, math.isqrt(n)))).collect()
    pivots = np.zeros((len(chosen), dim + 1))
    for i, r in enumerate(chosen):
        pivots[i, :len(r.v)] = r.v
        pivots[i, dim] = math.sqrt(max(0.0, longest - float((pivots[i] ** 2).sum())))
    placed = stored(_assigned(rows, pivots, dim, longest, query_step), "cells")
    # summaries: radius and rows of every query cell, the k smallest distances of every data cell
    q_stats = {r.cell: r for r in placed.filter("query").groupBy("cell").agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    if not q_stats:
        return empty
    radius = np.full(len(pivots), -1.0)
    for cell, r in q_stats.items():
        radius[cell] = r.radius
    # of k + 1 rows with different ids at most one has the query's own
    ranked = F.row_number().over(Window.partitionBy("cell").orderBy("dist"))
    near: dict[int, list[float]] = {}
    for r in (placed.filter("not query").groupBy("cell", "vec_id").agg(F.min("dist").alias("dist")).select("cell", "dist", ranked.alias("r"))
              .filter(F.col("r") <= k + 1).collect()):
        near.setdefault(r.cell, []).append(r.dist)
    theta = bounds(pivots, radius, near, k + 1)
    # cells in hash order of their pivots are packed into groups; a crowded cell is dealt over several
    slack = SLACK * (math.sqrt(longest) + 1)
    groups, at, filled = [], 0, 0
    for cell, r in sorted(q_stats.items()):
        shares = max(1, math.ceil(r.n / GROUP_QUERIES))
        if filled and filled + r.n > GROUP_QUERIES:
            at, filled = at + 1, 0
        groups += [(cell, at + i, shares) for i in range(shares)]
        at, filled = (at + shares, 0) if shares > 1 else (at, filled + r.n)
    between = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2), 0))
    # a row of cell j at distance s from its pivot is needed in group g if s >= least: |p_i p_j| - radius_i - theta_i over g's cells
    least = {}
    for cell, g, _ in groups:
        need = between[cell] - radius[cell] - theta[cell] - slack
        least[g] = np.minimum(least.get(g, np.inf), need)
    wanted = [(j, g, float(least[g][j])) for g in least for j in range(len(pivots))]
    wanted = spark.createDataFrame(wanted, "cell int, grp int, least double")
    dealt = spark.createDataFrame(groups, "cell int, grp int, shares int")
    queries = (placed.filter("query").join(F.broadcast(dealt.groupBy("cell").agg(F.min("grp").alias("first"), F.first("shares").alias("shares"))), "cell")
               .select("vec_id", "v", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("shares")).cast("int")).alias("grp")))
    tiles = max(1, math.ceil(n / TILE_ROWS))
    numbered = placed.filter("not query").withColumn("number", F.monotonically_increasing_id())  # rows of one id are dealt over all tiles
    data = (numbered.join(F.broadcast(wanted), "cell").filter("dist >= least")
            .select(F.col("vec_id").alias("x_id"), F.col("v").alias("x"), F.col("grp").alias("x_grp"),
                    F.pmod(F.xxhash64("number"), F.lit(tiles)).cast("int").alias("x_tile")))
    spread = queries.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        return _top(q, x, dim, k)
    local = spread.groupBy("grp", "tile").cogroup(data.groupBy("x_grp", "x_tile")).applyInPandas(solve, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
