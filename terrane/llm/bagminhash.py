"""Near-duplicate classes by BagMinHash over multisets of five-word shingles.

Signature (Ertl, 2018). A shingle that occurs w times owns the levels (0, w].
The levels are cut into (0,1], (1,2], (2,4], (4,8], ...; on each of these a Poisson
process of rate = its length, fixed by shingle and interval, gives points in
ascending order. A point falls on one level of its interval and on one of M
signature components; it counts if w reaches its level, which thins the parent
process of a partly covered interval exactly. A component keeps its earliest
point, so two documents agree on it with the probability sum min / sum max of
their multisets. Elements stop once their next point is later than every
component.

Bands of the signature give buckets. Links are verified exactly (multiset
overlap of at least ``SIMILARITY``): in each bucket against a leader. Where a bucket
then still holds several connected components, its members are compared across
components, if they are FEW; pairs are left out only where sizes, or the triangle
inequality of the multiset distance with the leader, rule a link out. More than FEW members come together anew by their rarest shingles (a prefix
filter, which is exact), so that a passage shared by a crowd of otherwise different
texts is not a reason to compare them. So no bucket is expanded into all its pairs, and
no class is split that the bands let meet.

Defined results: words are runs of non-blank bytes with A-Z folded; a text of
fewer than five words is one shingle; null and empty texts stay alone; texts with
equal multisets (copies) are one node and share a class; class_id is the smallest
doc_id of a class; rows with a null id take part and have class_id of the others,
null if there are none; repeated rows give one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm import words as W
from terrane.session import chosen_broadcast, stored

BANDS, ROWS = 25, 4
M = BANDS * ROWS
SIMILARITY = 0.8
FEW = 32                   # members of a bucket up to which all are compared across components
FATES = 1_000_000   # ids of leaving documents that are broadcast at most
HEADS = 512                # members of a crowded bucket that meet all others in one round
CELLS = 1 << 18            # hash cells in which the items of crowds are counted
BLOCK = 1 << 15            # points drawn at a time when few elements are left
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FINE = float(1 << 36)


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(doc: np.ndarray, value: np.ndarray, count: np.ndarray, rows: int, m: int = M) -> np.ndarray:
    """(rows, m) earliest points of the multisets given as (row, value, count); inf where a row holds nothing."""
    sig = np.full(rows * m, np.inf)
    pieces = []
    for j in range(int(count.max(initial=1) - 1).bit_length() + 1):
        low = 0 if j == 0 else 1 << (j - 1)
        has = count > low
        pieces.append((doc[has], W.mix(value[has] + np.uint64((j + 1) * int(_STEP) % (1 << 64))), count[has] - low,
                       np.full(int(has.sum()), 1 if j == 0 else 1 << (j - 1), np.int64)))
    d, seed, left, length = (np.concatenate(x) for x in zip(*pieces, strict=True))
    t, n = np.zeros(len(d)), 0
    while len(d):
        block = int(np.clip(BLOCK // len(d), 1, 64))
        k = (np.arange(n, n + block, dtype=np.uint64) + np.uint64(1)) * _STEP
        h = W.mix(seed[:, None] ^ k[None, :])
        # waits are rounded to binary fractions and added in order, so a point's time does not depend on what is drawn beside it
        waits = np.rint(-np.log(_unit(h)) * _FINE) / (_FINE * length[:, None])
        times = np.cumsum(np.concatenate([t[:, None], waits], axis=1), axis=1)[:, 1:]
        limit = sig.reshape(rows, m).max(axis=1)
        h2 = W.mix(h ^ _STEP)
        component = (h2 % np.uint64(m)).astype(np.int64)
        level = ((h2 >> np.uint64(32)) % length[:, None].astype(np.uint64)).astype(np.int64)
        use = (times < limit[d][:, None]) & (level < left[:, None])
        np.minimum.at(sig, ((d * m)[:, None] + component)[use], times[use])
        t, n = times[:, -1], n + block
        go = t < sig.reshape(rows, m).max(axis=1)[d]
        d, seed, left, length, t = d[go], seed[go], left[go], length[go], t[go]
    return sig.reshape(rows, m)


def _multiset(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    w = W.Words(raw, off)
    return (*W.occurrences(*w.shingles()), w.rows)


def _nodes(doc: np.ndarray, value: np.ndarray, count: np.ndarray, rows: int) -> list[bytes | None]:
    """A 128-bit fingerprint of each row's multiset."""
    out: list[bytes | None] = [None] * rows
    if not len(doc):
        return out
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    element = W.mix(value + count.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    both = np.stack([np.add.reduceat(element, at), np.add.reduceat(W.mix(element ^ np.uint64(0xE7037ED1A0B428DB)), at)], 1)
    data = both.astype(">u8").tobytes()
    for i, row in enumerate(doc[at]):
        out[row] = data[16 * i: 16 * i + 16]
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    for batch in batches:
        ids = batch.column("doc_id")
        for a, b, raw, off in W.slices(batch.column("text")):
            doc, value, count, rows = _multiset(raw, off)
            points = signatures(doc, value, count, rows).view(np.uint64).reshape(rows, BANDS, ROWS)
            band = np.broadcast_to(salt, (rows, BANDS))
            for k in range(ROWS):
                band = W.mix(band * np.uint64(0x9FB21C651E98DF25) + points[:, :, k])
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * BANDS + 1, BANDS, dtype=np.int32)),
                                             pa.array(band.reshape(-1).view(np.int64)))
            size = pa.array(np.bincount(doc, weights=count, minlength=rows).astype(np.int64))
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(_nodes(doc, value, count, rows), pa.binary()), size, bands],
                                             names=["doc_id", "node", "size", "bands"])


def _first_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text), each node once per task, so that copies are folded before the shuffle."""
    seen: set[bytes] = set()
    for batch in batches:
        texts = batch.column("text")
        for a, b, raw, off in W.slices(texts):
            nodes = _nodes(*_multiset(raw, off))
            rows = [i for i, x in enumerate(nodes) if x is not None and not (x in seen or seen.add(x))]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in rows], pa.binary()),
                                              texts.slice(a, b - a).take(pa.array(rows, pa.int64()))], names=["node", "text"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The multiset of each text as a set: every repeated shingle gets its number hashed in."""
    for batch in batches:
        nodes = batch.column("node")
        for a, b, raw, off in W.slices(batch.column("text")):
            doc, value, count, rows = _multiset(raw, off)
            d, v = np.repeat(doc, count), np.repeat(value, count)
            number = np.arange(len(d)) - np.repeat(np.cumsum(count) - count, count)
            v = W.mix(v + number.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
            ends = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=rows))]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(v.view(np.int64)))
            yield pa.RecordBatch.from_arrays([nodes.slice(a, b - a), pa.array(np.diff(ends).astype(np.int64)), sets], names=["node", "size", "items"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, s) with s = sum min / sum max; 0 where the sizes alone keep it below 2 * SIMILARITY - 1."""
    left = sets.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("items").alias("ib"))
    right = sets.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("items").alias("ia"))
    joined = pairs.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("ia", "ib"))
    near = F.least("na", "nb") >= F.greatest("na", "nb") * (2 * SIMILARITY - 1)
    return (joined.select("a", "b", "na", "nb", F.when(near, common).otherwise(0).alias("n"))
            .select("a", "b", (F.col("n") / (F.col("na") + F.col("nb") - F.col("n"))).alias("s")))


def components(edges: DataFrame) -> DataFrame:
    """(node, low): the smallest node of each connected node's component.

    Large-star and small-star steps (Kiveris et al., 2014) until nothing
    changes. Both aggregate before the shuffle; each state is stored.
    """
    state = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    mark = None
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a").filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(low.select("a", F.col("low").alias("b"))).distinct())
        state = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "star")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("low")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("low")).distinct())


def _led(members: DataFrame) -> DataFrame:
    """(bucket, node, size, rest, leader, leader_size, leader_rest): the node of each bucket that most others meet, in all their buckets, leads it.

    The original of many edited copies meets more of them than they meet each other.
    """
    counts = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max(_indexed()).alias("has")).filter("n > 1 and has")
    crowd = stored(members.join(counts.select("bucket", "n"), "bucket"), "crowd")
    known = crowd.groupBy("node").agg(F.sum("n").alias("met"))
    leaders = (crowd.join(known, "node").groupBy("bucket").agg(F.max(F.struct("met", "node", "size", "rest")).alias("l"))
               .select("bucket", F.col("l.node").alias("leader"), F.col("l.size").alias("leader_size"), F.col("l.rest").alias("leader_rest")))
    return crowd.drop("n").join(leaders, "bucket").filter("node != leader")


def _indexed() -> F.Column:
    """Whether a member may be the smaller partner of a link whose first common item is the bucket's."""
    return F.col("rest") >= F.col("size") * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-9


def _fits(other: str) -> F.Column:
    """Sizes and what is left of both after their first common item allow a link."""
    size, rest = F.col(other + "size"), F.col(other + "rest")
    return F.least("rest", rest) >= (F.col("size") + size) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9


def _judged(led: DataFrame, known: DataFrame) -> DataFrame:
    """``led`` with bounds lo and hi of the similarity to the leader; they differ where it was not computed."""
    s = known.select(F.col("a").alias("leader"), F.col("b").alias("node"), "s")
    ratio = F.least("size", "leader_size") / F.greatest("size", "leader_size")
    return (led.join(s, ["leader", "node"], "left").withColumn("hi", F.coalesce("s", ratio)).withColumn("lo", F.coalesce("s", F.lit(0.0)))
            .drop("s", "leader_size", "leader_rest"))


def _across(rows: DataFrame, low: DataFrame) -> DataFrame:
    """Members of the buckets in which several components still meet: (bucket, node, size, rest, low, lo, hi, n)."""
    placed = rows.select("bucket", "node", "size", "rest", "lo", "hi").join(low, "node", "left").withColumn("low", F.coalesce("low", "node"))
    mixed = (placed.groupBy("bucket").agg(F.min("low").alias("x"), F.max("low").alias("y"), F.count(F.lit(1)).alias("n"), F.max(_indexed()).alias("has"))
             .filter("x != y and has"))
    return placed.join(mixed.select("bucket", "n"), "bucket")


def _open(joined: DataFrame) -> DataFrame:
    """Of candidate rows with (node, low, size, rest, lo, hi) and (other, other_low, ...): those that may still be links."""
    loose = 1 - SIMILARITY + 1e-9
    return joined.filter((F.col("low") != F.col("other_low")) & (F.col("lo") - F.col("other_hi") <= loose) & (F.col("other_lo") - F.col("hi") <= loose)
                         & _fits("other_"))


def _others(left: DataFrame, name: str = "node") -> list:
    return [F.col(name).alias("other"), *[F.col(c).alias("other_" + c) for c in ("low", "size", "rest", "lo", "hi")]]


def _more(pairs: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """``known`` with the similarity of the pairs (node, other) that it does not have."""
    ordered = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    both = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return known.unionByName(stored(_verify(ordered.join(both, ["a", "b"], "left_anti"), sets), "similarity"))


def _meet(led: DataFrame, known: DataFrame | None, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(similarities, members of crowded buckets that still hold several components) after leaders and small buckets."""
    # the first time misses are computed as well, down to where the triangle inequality can use them
    near = F.least("size", "leader_size") >= F.greatest("size", "leader_size") * (2 * SIMILARITY - 1) if known is None else _fits("leader_")
    pairs = led.filter(near).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    if known is not None:
        known = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
        pairs = pairs.join(known, ["a", "b"], "left_anti")
    fresh = stored(_verify(pairs, sets), "similarity")
    known = fresh if known is None else known.unionByName(fresh)
    low = stored(components(known.filter(F.col("s") >= SIMILARITY).select("a", "b")), "component")
    left = stored(_across(_judged(led, known), low), "across")
    few = left.filter(F.col("n") <= FEW)
    return _more(_open(few.join(few.select("bucket", *_others(few)), "bucket").filter("node < other")), known, sets), left.filter(F.col("n") > FEW)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        counts += np.bincount(np.asarray(batch.column("items").flatten()) & (CELLS - 1), minlength=CELLS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["cell", "n"])


def _rare_items(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, node, size, rest): the rarest items of each node, as many as two nodes above SIMILARITY must share one of.

    What a crowd has in common, such as one long passage, is frequent in it and comes
    last in every order; ``rest`` counts the items from the bucket's own on. Of a
    linked pair, what follows the first common item must hold the whole overlap. Any
    order is exact; this one sorts by counts in hash cells, a table of fixed size.
    """
    chosen = sets.join(nodes, "node", "left_semi").select("node", "items")
    counts = np.zeros(CELLS, np.int64)
    for r in chosen.select("items").mapInArrow(_cell_counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r.cell] = r.n
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, nodes = batch.column("items"), batch.column("node")
            item, size = np.asarray(lists.flatten()), np.diff(np.asarray(lists.offsets))
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((item, shared.value[item & (CELLS - 1)], row))
            pos = np.arange(len(item)) - np.repeat(np.cumsum(size) - size, size)
            use = pos < (size - np.ceil(size * SIMILARITY - 1e-9) + 1)[row]
            at = row[use]
            yield pa.RecordBatch.from_arrays([pa.array(item[order][use]), nodes.take(pa.array(at)), pa.array(size[at].astype(np.int64)),
                                              pa.array((size[at] - pos[use]).astype(np.int64))], names=["bucket", "node", "size", "rest"])
    return chosen.mapInArrow(rarest, "bucket long, node binary, size long, rest long")


def links(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """Verified links (a, b) between nodes, enough to span every class."""
    nodes = signed.filter("node is not null").dropDuplicates(["node"])
    led = stored(_led(nodes.select(F.explode("bands").alias("bucket"), "node", "size", F.col("size").alias("rest"))), "led")
    meeting = led.select("node").unionByName(led.select(F.col("leader").alias("node"))).distinct()
    texts = docs.select("text").mapInArrow(_first_texts, "node binary, text string")
    sets = stored(texts.join(meeting, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
                  .mapInArrow(_sets, "node binary, size long, items array<long>"), "sets")
    known, crowded = _meet(led, None, sets)
    if not crowded.isEmpty():
        led = stored(_led(_rare_items(crowded.select("node").distinct(), sets)), "led")
        known, crowded = _meet(led, known, sets)
    while not crowded.isEmpty():
        # members outside a bucket's largest component, or those that can be the smaller partner if they are fewer, meet all others and leave
        sizes = crowded.groupBy("bucket", "low").agg(F.count(F.lit(1)).alias("m"), F.count_if(_indexed()).alias("i"))
        plan = sizes.groupBy("bucket").agg(F.max(F.struct("m", "low")).alias("top"), F.sum("m").alias("all"), F.sum("i").alias("i"))
        plan = plan.select("bucket", F.col("top.low").alias("largest"), (F.col("all") - F.col("top.m") < F.col("i")).alias("outside"))
        turn = F.row_number().over(Window.partitionBy("bucket").orderBy(F.xxhash64("node"), "node"))
        heads = (crowded.join(plan, "bucket").filter(F.when(F.col("outside"), F.col("low") != F.col("largest")).otherwise(_indexed()))
                 .withColumn("turn", turn).filter(F.col("turn") <= HEADS).select(*crowded.drop("n").columns))
        heads = stored(heads, "heads")
        pairs = crowded.join(heads.select("bucket", *_others(heads)), "bucket").filter("node != other")
        known = _more(_open(pairs), known, sets)
        low = stored(components(known.filter(F.col("s") >= SIMILARITY).select("a", "b")), "component")
        rest = crowded.join(heads.select("bucket", "node"), ["bucket", "node"], "left_anti")
        crowded = stored(_across(rest, low), "across")
    return known.filter((F.col("s") >= SIMILARITY) & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, n_spanning_links), one row per document; n_spanning_links counts
    the verified links of its text that joined parts of its class; other pairs at 0.8 or more are not compared, so it is no degree."""
    signed = stored(docs.select("doc_id", "text").mapInArrow(_signed, "doc_id long, node binary, size long, bands array<long>"), "signed")
    edges = stored(links(docs, signed), "links")
    low = components(edges)
    degree = (edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_spanning_links")))
    rows = signed.select("doc_id", "node")
    info = low.join(degree, "node")
    placed = (rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .join(info, "node", "left").withColumn("low", F.coalesce("low", "node")))
    placed = stored(placed.withColumn("n_spanning_links", F.coalesce("n_spanning_links", F.lit(0).cast("long"))), "placed")
    whole = placed.groupBy("low").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"))
    per_node = placed.join(whole, "low").select("node", "class_id", "class_size", "n_spanning_links")
    found = rows.filter("node is not null").join(per_node, "node").select("doc_id", "class_id", "class_size", "n_spanning_links")
    alone = rows.filter("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
                                               F.lit(0).cast("long").alias("n_spanning_links"))
    return found.unionByName(alone)


def keep(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the smallest id; of rows with one id and the same words one stays.

    Rows without an id always stay; so does an id that leads a class with one of several texts.
    """
    found = stored(classes(docs), "classes").filter("doc_id is not null")
    leads = found.filter("class_id = doc_id")
    losers = found.filter("class_id != doc_id").select("doc_id").distinct().join(leads.select("doc_id"), "doc_id", "left_anti")
    twice = leads.filter("class_size > 1").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    words, fate = ("_".join([n, *docs.columns]) for n in ("words", "fate"))  # names that no column has
    fates = stored(losers.withColumn(fate, F.lit("goes")).unionByName(twice.withColumn(fate, F.lit("once"))), "fates")
    told = docs.filter("doc_id is not null").join(chosen_broadcast(fates, FATES), "doc_id", "left")
    once = told.filter(F.col(fate) == "once").withColumn(words, F.xxhash64(F.lower("text"))).dropDuplicates(["doc_id", words])
    return docs.filter("doc_id is null").unionByName(told.filter(F.col(fate).isNull()).select(*docs.columns)).unionByName(once.select(*docs.columns))
