"""Importance resampling towards a target text, over checksums of word n-grams.

A document is reduced to its words with one space between them and scanned
once: the running CRC after each word is kept. The CRC of any n-gram then
follows from two of these prefixes. CRC is linear over GF(2), so

    crc(prefix + gram) = shift(crc(prefix), len(gram)) ^ crc(gram)

where ``shift`` feeds that many zero bytes, a linear map that is looked up in
tables: one for each length up to 63, one for each higher power of two. No
n-gram is ever cut out or hashed on its own.

Counts of all documents and of the target text, by bucket of the checksum, give
each bucket's gain; a document's weight is the floored mean of its gains, Gumbel
noise fixed by its id makes the score, and the highest scores are drawn. The
order of all scores comes from ranges: rows are dealt by range, numbered within,
and the ranges' sizes (one number for each) are added up.

Defined results: null is an empty text, without features and of weight 0; a
null id takes the noise of an empty one and comes last among ties; repeated
rows are counted and ranked one by one; an empty target or empty documents
count nothing; extra columns are left alone.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.session import stored

BUCKETS, GRAM, SEED = 10_000, 2, 7
PERCENT, MIN_WORDS = 25, 20
RANGE_ROWS = 1_000_000   # documents in one range of the order
_POLYNOMIAL = 0xEDB88320

# A-Z to a-z; everything that separates words to a space; bytes of other letters stay
_NORMAL = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _lookup(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """``table``: one row of 256 values for each byte of the checksum."""
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


class Shifts:
    """Tables of the linear maps that feed zero bytes."""

    def __init__(self):
        self.step = _byte_table()
        one = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
        self.small = np.empty((64, 4, 256), np.uint32)
        self.small[0] = one
        for n in range(1, 64):
            self.small[n] = self.step[self.small[n - 1] & 255] ^ (self.small[n - 1] >> 8)
        self.powers = [self.step[self.small[63] & 255] ^ (self.small[63] >> 8)]  # 64, 128, 256, ... bytes

    def power(self, n: int) -> np.ndarray:
        while len(self.powers) <= n:
            self.powers.append(_lookup(self.powers[-1], self.powers[-1]))
        return self.powers[n]

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Each checksum after as many zero bytes as its length says."""
        few = length & 63
        out = (self.small[few, 0, crc & 255] ^ self.small[few, 1, (crc >> 8) & 255] ^ self.small[few, 2, (crc >> 16) & 255] ^ self.small[few, 3, crc >> 24])
        rest, n = length >> 6, 0
        while rest.any():
            odd = np.flatnonzero(rest & 1)
            out[odd] = _lookup(self.power(n), out[odd])
            rest, n = rest >> 1, n + 1
        return out

    def space(self, crc: np.ndarray) -> np.ndarray:
        """Each checksum (of whole data) after one more space."""
        raw = ~crc
        return ~(self.step[(raw ^ 0x20) & 255] ^ (raw >> 8))


@functools.cache
def shifts() -> Shifts:
    return Shifts()


def checksums(text: bytes, gram: int = GRAM) -> tuple[int, np.ndarray]:
    """(number of words, CRC of every run of 1 to ``gram`` words)."""
    words = text.translate(_NORMAL).split()
    if not words:
        return 0, np.zeros(0, np.uint32)
    crc, n = zlib.crc32, len(words)
    after = np.fromiter(accumulate(words[1:], lambda c, w: crc(w, crc(b" ", c)), initial=crc(words[0])), np.uint32, n)
    size = np.fromiter(map(len, words), np.int64, n)
    shift = shifts()
    before = np.zeros(n, np.uint32)           # the CRC of nothing is 0
    before[1:] = shift.space(after[:-1])
    end = np.cumsum(size + 1) - 1
    start = end - size
    return n, np.concatenate([after[k:] ^ shift(before[: n - k], end[k:] - start[: n - k]) for k in range(min(gram, n))])


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text").cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py() or b""


def counts(texts: DataFrame, gram: int = GRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts are in each bucket that has any."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch):
                total += np.bincount(checksums(text, gram)[1] % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])
    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Floored thousandths of the log ratio of the target's share to the documents' share, by bucket."""
    s_all, t_all = sum(raw.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * (s_all + buckets) / ((raw.get(b, 0) + 1) * (t_all + buckets))))
                     for b in range(buckets)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_features, weight)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for batch in batches:
            words, features, weight = [], [], []
            for text in _texts(batch):
                n, found = checksums(text, gram)
                words.append(n)
                features.append(len(found))
                weight.append(int(value[found % np.uint32(len(value))].sum()) // len(found) if n else 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in (words, features, weight))],
                                             names=["doc_id", "n_words", "n_features", "weight"])
    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def numbered(rows: DataFrame, by: list, n: int, label: str) -> DataFrame:
    """``rows`` (stored, ``n`` of them) with their ``place`` (from 1) in the order ``by``, equal rows in any order.

    Rows are dealt by range and numbered within their range; the driver sees one size for each range.
    """
    order = [*by, F.col("salt").asc()]
    dealt = (rows.withColumn("salt", F.monotonically_increasing_id())     # keeps many equal rows apart
             .repartitionByRange(max(2, -(-n // RANGE_ROWS)), *order).sortWithinPartitions(*order).drop("salt"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(np.arange(at + 1, at + batch.num_rows + 1))],
                                             names=[*batch.schema.names, "part", "at"])
            at += batch.num_rows
    parts = stored(dealt.mapInArrow(number, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema) + ", part long, at long"), label)
    sizes = parts.groupBy("part").agg(F.max("at").alias("n")).orderBy("part").collect()
    starts = rows.sparkSession.createDataFrame(list(zip((r.part for r in sizes), accumulate((r.n for r in sizes), initial=0))), "part long, start long")
    return parts.join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("at")).drop("part", "at", "start")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, gram: int = GRAM, buckets: int = BUCKETS,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document; ``rank`` (from 1) where it is drawn.

    ``percent`` of the documents with at least ``min_words`` words are drawn, those with the highest scores.
    """
    raw, goal = (dict(counts(t, gram, buckets).collect()) for t in (docs, target))   # at most one row per bucket
    share = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((share.cast("double") + 0.5) / 4294967296.0)))
    scored = stored(weighed(docs, gains(raw, goal, buckets), gram).withColumn("score", F.col("weight") + noise), "crcgrams-scores")
    enough = F.col("n_words") >= min_words
    every, n = scored.agg(F.count(F.lit(1)), F.count_if(enough)).first()
    placed = numbered(scored.withColumn("enough", enough), [F.col("enough").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], every, "crcgrams-order")
    rank = F.when(F.col("place") <= percent * n // 100, F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
