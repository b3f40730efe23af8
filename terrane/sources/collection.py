"""FeatureCollection documents of any size, cut at feature boundaries over tasks.

A document is read as text with ``}`` as the record separator, so Spark splits
it by bytes even if it is a single line. A split that begins in the middle of the
document does not know whether it begins inside a string, nor how deep. So every
split first says, for both cases, how it changes the depth, how far the depth
falls on the way, and whether it ends inside a string; these few numbers of all
splits are put together in order on the driver (one row for each split). Then
each split cuts its features out; a feature that lies across splits is put
together from its parts, which are the only text that is shuffled. What is cut out is stored once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.session import scratch_path

FEATURE_DEPTH = 2     # the document and its list of features are open
CHUNK = 1 << 20       # characters scanned at once
_QUOTE = 2
_KINDS = np.zeros(256, np.int8)
_KINDS[[ord(c) for c in "{[]}\""]] = 1, 1, -1, -1, _QUOTE


def _chunks(pieces: Iterable[str], size: int) -> Iterator[str]:
    """The records of a split with their separators, in larger portions."""
    held, n = [], 0
    for piece in pieces:
        held += [piece, "}"]
        n += len(piece) + 1
        if n >= size:
            yield "".join(held)
            held, n = [], 0
    if held:
        yield "".join(held)


def _escaped(codes: np.ndarray) -> np.ndarray:
    """Characters after an odd run of backslashes."""
    slashes = np.flatnonzero(codes == ord("\\"))
    begins = np.flatnonzero(np.append(True, np.diff(slashes) > 1))
    length = np.diff(np.append(begins, len(slashes)))
    after = (slashes[begins] + length)[length % 2 == 1]
    out = np.zeros(len(codes), bool)
    out[after[after < len(codes)]] = True
    return out


def brackets(pieces: Iterable[str], inside: bool, size: int = CHUNK) -> Iterator[tuple[str, int, tuple[np.ndarray, np.ndarray, bool]]]:
    """Portions of a split: (text, change of depth, (places of the brackets outside of strings, +1 or -1 for each, whether a
    string is open at the end)); ``inside``: it begins in a string. A portion ends with a separator, so no escape reaches into the next one."""
    for text in _chunks(pieces, size):
        codes = np.frombuffer(text.encode("ascii", "replace"), np.uint8)     # a byte for each character
        kind = _KINDS[codes]
        at = np.flatnonzero(kind)
        kind = kind[at]
        quote = kind == _QUOTE
        if "\\" in text:
            quote &= ~_escaped(codes)[at]
        real = (kind != _QUOTE) & ((np.cumsum(quote) + inside) % 2 == 0)
        inside = bool((np.count_nonzero(quote) + inside) % 2)
        steps = kind[real].astype(np.int64)
        yield text, int(steps.sum()), (at[real], steps, inside)


def measure(pieces: Iterable[str], inside: bool) -> tuple[int, int, bool]:
    """(change of depth, its lowest value on the way, whether a string is open at the end)."""
    depth = low = 0
    open_ = inside
    for _, change, (_, steps, open_) in brackets(pieces, inside):
        low = min(low, depth + int(np.cumsum(steps).min(initial=0)))
        depth += change
    return depth, low, open_


def cut(pieces: Iterable[str], depth: int, inside: bool) -> Iterator[tuple[str, str]]:
    """(kind, text): whole features, a ``tail`` of one that begins before, a ``head`` of one that ends later, and what lies outside."""
    parts: list[str] = []
    kind = "tail" if depth > FEATURE_DEPTH else "outside"
    for text, change, (at, steps, _) in brackets(pieces, inside):
        after = depth + np.cumsum(steps)
        edge = np.where(steps > 0, after == FEATURE_DEPTH + 1, after == FEATURE_DEPTH)    # a feature begins or ends at this bracket
        done = 0
        for i, step in zip(at[edge].tolist(), steps[edge].tolist()):
            end = i if step > 0 else i + 1
            yield "outside" if step > 0 else kind, "".join([*parts, text[done:end]])
            parts, kind, done = [], "feature" if step > 0 else "outside", end
        if done < len(text):
            parts.append(text[done:])
        depth += change
    if parts:
        yield "head" if kind == "feature" else "middle" if kind == "tail" else kind, "".join(parts)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """((file, first byte), records) of each split."""
    def runs():
        for file, start, value in (batch.columns for batch in batches if batch.num_rows):
            turns = pc.or_(*(pc.not_equal(c[1:], c[:-1]) for c in (file, start))).to_numpy(zero_copy_only=False)
            for a, b in pairwise([0, *(np.flatnonzero(turns) + 1).tolist(), len(value)]):
                yield (file[a].as_py(), start[a].as_py()), value.slice(a, b - a)
    for key, run in groupby(runs(), lambda r: r[0]):
        yield key, (v for _, values in run for at in range(0, len(values), 4096) for v in values.slice(at, 4096).to_pylist())


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), records in _splits(batches):
        pieces = list(records)        # one split, of spark.sql.files.maxPartitionBytes at most
        out = [*measure(pieces, False), *measure(pieces, True)]
        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start]} | {n: [v] for n, v in zip(("d0", "l0", "s0", "d1", "l1", "s1"), out)},
                                         schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("d0", pa.int64()), ("l0", pa.int64()), ("s0", pa.bool_()),
                                                           ("d1", pa.int64()), ("l1", pa.int64()), ("s1", pa.bool_())]))


def states(measured: Iterable) -> dict[tuple[str, int], tuple[int, bool, int]]:
    """(depth, inside a string, first byte of the split where the open feature begins) at the start of each split."""
    out: dict[tuple[str, int], tuple[int, bool, int]] = {}
    for _, rows in groupby(sorted(measured, key=lambda r: (r.file, r.start)), lambda r: r.file):
        depth, inside, begun = 0, False, 0
        for r in rows:
            out[r.file, r.start] = depth, inside, begun
            change, low, open_ = (r.d1, r.l1, r.s1) if inside else (r.d0, r.l0, r.s0)
            if depth <= FEATURE_DEPTH or depth + low <= FEATURE_DEPTH:      # what is open at the end began here
                begun = r.start
            depth, inside = depth + change, open_
    return out


def read_collection(spark: SparkSession, source: str) -> tuple[DataFrame, DataFrame]:
    """((file, feature) as JSON text, (file, outside): what the document holds besides its features)."""
    records = spark.read.option("lineSep", "}").text(source).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    schema = "file string, start long, d0 long, l0 long, s0 boolean, d1 long, l1 long, s1 boolean"
    known = spark.sparkContext.broadcast(states(records.mapInArrow(_measured, schema).collect()))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), pieces in _splits(batches):
            depth, inside, begun = known.value[file, start]
            out: list[tuple] = []
            for kind, text in cut(pieces, depth, inside):
                if kind == "outside":
                    text = text.strip(", \n\r\t")
                if text:
                    out.append((file, start, begun if kind in ("tail", "middle") else start, kind, text))
                if len(out) == 1024:
                    yield _parts(out)
                    out = []
            if out:
                yield _parts(out)
    path = scratch_path(spark, "collection-parts")       # cut once, read for each use
    records.mapInArrow(look, "file string, start long, begun long, kind string, text string").write.parquet(path)
    parts = spark.read.parquet(path)
    whole = parts.filter("kind = 'feature'").select("file", F.col("text").alias("feature"))

    def joined(df: DataFrame, *keys: str) -> DataFrame:
        text = F.concat_ws("", F.sort_array(F.collect_list(F.struct("start", "text")))["text"])
        return df.groupBy(*keys).agg(text.alias("text"))
    across = joined(parts.filter("kind in ('head', 'middle', 'tail')"), "file", "begun").select("file", F.col("text").alias("feature"))
    outside = joined(parts.filter("kind = 'outside'"), "file").withColumnRenamed("text", "outside")
    return whole.unionByName(across), outside


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "start", "begun", "kind", "text"])
