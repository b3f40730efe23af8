"""Benchmark decontamination by pigeonhole edit matching.

Every window of ``PASSAGE_WORDS`` words of a test item is a passage, and a shorter
item is one as a whole. A passage may occur in a document
with up to k character edits; it is split into k + 1 pieces, so that one piece at
least must occur unchanged. All pieces of all passages are sought at once with
an Aho-Corasick automaton; around each hit Myers' bit-parallel algorithm (1999)
computes the smallest edit distance of the passage to any part of the text.

Blanks are folded to one space and case is ignored on both sides.

Benchmarks are taken in portions of bounded size, so what each task holds does
not grow with the benchmark; each portion is one pass over the documents.

Defined results: null and empty texts or items match nothing; an item shorter
than ``MIN_CHARS`` matches only verbatim and as whole words; equal items each
report their own id; a repeated document row is reported once per row in
``matches`` input order but folded to distinct (doc_id, item_id); extra columns
are left alone.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSAGE_WORDS = 24
CHARS_PER_EDIT = 16        # k = length // CHARS_PER_EDIT - 1 edits, so pieces have this many characters at least
MIN_CHARS = 32             # shorter passages have no edits
PORTION_CHARS = 330_000    # of benchmark text held by a task at once; each word of it begins a passage


def folded(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def passages(text: str | None) -> list[str]:
    """The windows of an item, one from every word on as long as they are whole; an item of fewer words as it is."""
    words = folded(text).split(" ")
    out = [" ".join(words[a: a + PASSAGE_WORDS]) for a in range(max(1, len(words) - PASSAGE_WORDS + 1))]
    return [p for p in dict.fromkeys(out) if p]


def edits_allowed(length: int) -> int:
    return max(0, length // CHARS_PER_EDIT - 1)


def pieces(passage: str) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 parts of nearly equal length."""
    n = edits_allowed(len(passage)) + 1
    cuts = [i * len(passage) // n for i in range(n + 1)]
    return [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(distance, end): the smallest edit distance of ``pattern`` to a part of ``text``, and where the first such part ends."""
    masks = masks if masks is not None else char_masks(pattern)
    full, high = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, score = full, 0, len(pattern)
    best, end = score, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d0 = ((((eq & up) + up) ^ up) | eq) & full
        plus = (down | ~(d0 | up)) & full
        minus = up & d0
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = (minus | ~(x | plus)) & full
        down = plus & x
        if score < best:
            best, end = score, i + 1
    return best, end


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


def whole_words(text: str, a: int, b: int) -> bool:
    """Whether no letter or digit goes on over an end of text[a:b]."""
    return not (a > 0 and text[a - 1].isalnum() and text[a].isalnum() or b < len(text) and text[b - 1].isalnum() and text[b].isalnum())


class Matcher:
    """The automaton of one portion of a benchmark, given as (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]]):
        owners: dict[str, set[int]] = defaultdict(set)
        for item, text in items:
            for p in passages(text):
                owners[p].add(item)
        self.passages = list(owners)
        self.owners = [sorted(owners[p]) for p in self.passages]
        self.budget = [edits_allowed(len(p)) for p in self.passages]
        self.masks: dict[int, dict[str, int]] = {}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, p in enumerate(self.passages):
            for offset, piece in pieces(p):
                where[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def __call__(self, text: str | None, first: bool = False) -> dict[int, int]:
        """Smallest edit distance of a matched passage, by item; ``first`` stops at any match.

        A piece that is not hit has an edit, so passages are taken by the number of such
        pieces and left out once their items are known with as few edits.
        """
        if not self.passages or not text:
            return {}
        text = folded(text)
        wanted: dict[int, list[tuple[int, int]]] = defaultdict(list)
        hit: dict[int, set[int]] = defaultdict(set)
        for last, (length, at) in self.automaton.iter(text):
            for n, offset in at:
                start, k = last + 1 - length - offset, self.budget[n]
                if len(self.passages[n]) < MIN_CHARS and not whole_words(text, start, last + 1):
                    continue
                wanted[n].append((max(0, start - k), start + len(self.passages[n]) + k))
                hit[n].add(offset)
        found: dict[int, int] = {}
        for least, n in sorted((self.budget[n] + 1 - len(hit[n]), n) for n in wanted):
            if all(found.get(item, least + 1) <= least for item in self.owners[n]):
                continue
            spans = sorted(wanted[n])
            masks = self.masks.get(n) or self.masks.setdefault(n, char_masks(self.passages[n]))
            best, begin, end = self.budget[n] + 1, *spans[0]
            for a, b in [*spans[1:], (1 << 62, 0)]:  # those that overlap are looked at together
                if a <= end:
                    end = max(end, b)
                    continue
                best = min(best, best_distance(self.passages[n], text[begin:end], masks)[0])
                if not best:
                    break
                begin, end = a, b
            if best <= self.budget[n]:
                for item in self.owners[n]:
                    found[item] = min(best, found.get(item, best))
                if first:
                    break
        return found


def portions(benchmark: DataFrame, limit: int = PORTION_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items, streamed through the driver in lists of at most about ``limit`` characters."""
    part, size = [], 0
    for r in benchmark.select("item_id", "text").filter("item_id is not null and text is not null").toLocalIterator():
        if part and size + len(r.text) > limit:
            yield part
            part, size = [], 0
        part.append((r.item_id, r.text))
        size += len(r.text)
    if part:
        yield part


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance): documents that hold a passage of an item, with its smallest edit distance."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, distance long"
    out = spark.createDataFrame([], schema)
    for items in portions(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            match = Matcher(shared.value)
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
                rows = [(d, i, e) for d, t in zip(ids, texts) for i, e in match(t.as_py()).items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), ()))],
                                                 names=["doc_id", "item_id", "distance"])
        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(look, schema))
    return out.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def keep(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of an item, with the columns of ``docs``."""
    spark = docs.sparkSession
    for items in portions(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            match = Matcher(shared.value)
            for batch in batches:
                yield batch.filter(pa.array([not match(t.as_py(), first=True) for t in batch.column("text")], pa.bool_()))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_items, items, distance) of the contaminated documents; items is comma-joined in order."""
    return (matches(docs, benchmark).groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("i"), F.min("distance").alias("distance"))
            .select("doc_id", "n_items", F.array_join(F.col("i").cast("array<string>"), ",").alias("items"), "distance"))
