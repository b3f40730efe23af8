"""Quality selection by importance resampling over hashed n-grams.

Two bag-of-n-gram models over hashed buckets are fitted, one on all documents
(raw) and one on labelled good documents (target). A document's log weight is
the sum of log p_target - log p_raw over its n-grams; adding Gumbel noise and
taking the k largest samples k documents without replacement in proportion to
their weights.

Defined results: a null or empty text has weight 0 (log) like any neutral
document; repeated rows get equal keys and stay or go together; ties at the
k-th key all stay; without good and bad labels every document is kept; extra
columns are left alone. Labels with a null id or quality are ignored, several
labels of one document count as the lowest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm import words as W
from terrane.llm.sampling import sampled
from terrane.session import stored

BUCKETS = 1 << 16
SAMPLE = 20_000          # labelled documents used at most, by hash order
SMOOTHING = 0.5
NOISE_SEED = 5
BINS, ROUNDS = 1024, 5   # refinement of the k-th key

# 0 separators, 1 capitals, 2 other letters and all non-ASCII bytes, 3 digits; every other byte is its own class
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x80:] = 2
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A] = 1, 2, 3
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0


def _shapes(raw: np.ndarray, w: W.Words) -> np.ndarray:
    """Hash of each word's classes with runs folded: 'Word!!' and 'Other!' are alike."""
    kind = _CLASS[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[w.start] = True
    keep &= kind > 0
    at = np.concatenate([[0], np.cumsum(keep)])
    folded = kind[keep]
    total = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * W._power("up", W._PRIME, len(folded)), out=total[1:])
    a, b = at[w.start], at[w.end]
    return W.mix((total[b] - total[a]) * W._power("down", W._INVERSE, len(folded) + 1)[a])


def _features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, bucket) of every n-gram: runs of one to three words, shapes, pairs of shapes, and words repeated within four."""
    w = W.Words(raw, off, fold=False)
    shape = _shapes(raw, w)
    doc, value = [w.doc, w.doc], [w.hash, shape ^ np.uint64(0x5851F42D4C957F2D)]
    gram = w.hash
    for n in range(1, 3):
        gram = W.mix(gram[:-1] * np.uint64(0x9FB21C651E98DF25) + w.hash[n:])
        whole = w.doc[n:] == w.doc[:-n]
        doc.append(w.doc[n:][whole])
        value.append(gram[whole])
    pair = w.doc[1:] == w.doc[:-1]
    doc.append(w.doc[1:][pair])
    value.append(W.mix(shape[:-1][pair] * np.uint64(3) + shape[1:][pair]))
    for lag in range(1, 5):
        same = (w.doc[lag:] == w.doc[:-lag]) & (w.hash[lag:] == w.hash[:-lag])
        doc.append(w.doc[lag:][same])
        value.append(np.full(int(same.sum()), lag * 0x632BE59BD9B4E019 % (1 << 64), np.uint64))
    value = W.mix(np.concatenate(value)) % np.uint64(BUCKETS)
    return np.concatenate(doc), value.astype(np.int64), w.rows


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw_count, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = np.asarray(batch.column("quality").fill_null(0)) == 1
        for a, b, raw, off in W.slices(batch.column("text")):
            doc, bucket, _ = _features(raw, off)
            raw_count += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[a:b][doc]], minlength=BUCKETS)
    some = np.flatnonzero(raw_count)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw_count[some]), pa.array(target[some])],
                                     names=["bucket", "raw", "target"])


def labelled(labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, quality) of at most ``limit`` labelled documents, chosen by hash."""
    one = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
           .agg(F.min("quality").cast("int").alias("quality")))
    return sampled(one, "doc_id", limit)


def fit(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log ratio of the target model to the raw model per bucket, counted over all documents."""
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "quality")
            .mapInArrow(_counted, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.sum():
        return np.zeros(BUCKETS)

    def logp(counts: np.ndarray) -> np.ndarray:
        return np.log(counts + SMOOTHING) - math.log(counts.sum() + SMOOTHING * BUCKETS)
    return logp(target) - logp(raw)


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with a column ``log_weight``; an own column of that name is replaced."""
    docs = docs.drop("log_weight")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for a, b, raw, off in W.slices(batch.column("text")):
                doc, bucket, rows = _features(raw, off)
                out[a:b] = np.bincount(doc, weights=ratio[bucket], minlength=rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "log_weight"])
    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("log_weight", T.DoubleType())]))


def _gumbel(column: str) -> F.Column:
    """Gumbel noise fixed by the document's id, so that reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(NOISE_SEED), F.col(column)), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def threshold(weights: np.ndarray, quality: np.ndarray) -> float:
    """The cut of the log weights with the best balanced accuracy on labelled rows, in the middle of its gap."""
    good, bad = int((quality == 1).sum()), int((quality != 1).sum())
    if not good or not bad:
        return -math.inf
    order = np.argsort(weights, kind="stable")
    w, q = weights[order], quality[order] == 1
    # rows before position p are rejected
    gain = np.concatenate([[0.0], np.cumsum(np.where(q, -1.0 / good, 1.0 / bad))])
    edge = np.concatenate([[True], w[1:] != w[:-1], [False]])
    p = int(np.argmax(np.where(edge, gain, -np.inf)))
    return -math.inf if p == 0 else float((w[p - 1] + w[p]) / 2)


def kth_key(keys: DataFrame, k: int) -> float:
    """A value that the k largest of column ``key`` reach, and next to no others: counts in ever finer bins, no sort."""
    lo, hi = keys.agg(F.min("key"), F.max("key")).first()
    if lo is None or k <= 0:
        return math.inf
    above, span = 0, (lo, hi)
    for _ in range(ROUNDS):
        lo, hi = span
        step = (hi - lo) / BINS
        if step <= 0 or lo + step <= lo:
            break
        bin_of = F.least(F.floor((F.col("key") - lo) / step), F.lit(BINS - 1)).cast("int")
        counts = dict(keys.filter((F.col("key") >= lo) & (F.col("key") <= hi)).groupBy(bin_of.alias("bin")).count().collect())
        for b in range(BINS - 1, -1, -1):
            if above + counts.get(b, 0) >= k or b == 0:
                span = (lo + b * step, hi if b == BINS - 1 else lo + (b + 1) * step)
                break
            above += counts.get(b, 0)
    return span[0]


def select(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, np.ndarray, float]:
    """(scores, ratio, cut): documents whose ``key`` reaches the cut are the Gumbel top-k.

    k is the number of documents whose log weight reaches the threshold that
    the labelled sample calibrates. scores: doc_id, quality (if sampled),
    log_weight, key; stored in the shared folder as it is read several times.
    """
    chosen = stored(labelled(labels, sample), "quality-labels")
    ratio = fit(docs, chosen)
    scored = weigh(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left").select("doc_id", "text", "quality"), ratio)
    scores = stored(scored.select("doc_id", "quality", "log_weight", (F.col("log_weight") + _gumbel("doc_id")).alias("key")), "quality-scores")
    known = scores.filter("quality is not null").groupBy("doc_id").agg(F.min("log_weight").alias("log_weight"), F.min("quality").alias("quality"))
    known = np.array([(r.log_weight, r.quality) for r in known.collect()], float).reshape(-1, 2)
    tau = threshold(known[:, 0], known[:, 1])
    if tau == -math.inf:
        return scores, ratio, -math.inf
    k = scores.filter(F.col("log_weight") >= tau).count()
    return scores, ratio, kth_key(scores, k)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, key) of the documents that the resampling keeps."""
    scores, _, cut = select(docs, labels)
    return scores.filter(F.col("key") >= cut).select("doc_id", "log_weight", "key")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the resampling keeps, with the columns of ``docs``."""
    _, ratio, cut = select(docs, labels)
    return weigh(docs, ratio).filter(F.col("log_weight") + _gumbel("doc_id") >= cut).select(*docs.columns)
