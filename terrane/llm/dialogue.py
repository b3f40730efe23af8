"""Repair of the turn structure of conversations.

``reports`` gives one row per conversation: what is wrong with it and the
cheapest repair; ``repaired`` gives the repaired turns themselves. The
alignment is in ``alignment``; here are the faults and the jobs.

A conversation of up to ``BIG`` turns is dealt to one task, sorted, and aligned
there: one shuffle of the turns. Larger ones take a path of their own with the
same result, so that no task holds one: equal turns are counted, first
occurrences are an aggregation, the turns are dealt by ranges of their order,
each task puts the segments that it holds together, and only these summaries
(some letters per turn) meet. The digest of a repaired conversation is a chain
over its text, so the last step streams the sorted turns through one task
without holding them.

Defined results: null in role or text counts as one space; null turns come
first; turns of one number are ordered by role and text; repeated rows are
turns of their own (the later ones duplicates); rows with ``copies`` 0 only
name their conversation, which is reported with zeros; a null conversation id
is an id like others; empty tables give no rows; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import chain, groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from terrane.llm.alignment import SEGMENT, Turn, Ways, align, best, deletions, edited, joined, ways
from terrane.session import stored

BIG = 2000            # turns that one task may hold at once
RANGE_ROWS = 50_000   # distinct turns of large conversations in one range

SPACES = " \t\n\x0b\x0c\r"
PAIRS = ("su", "ua", "au")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "place long, edit string, role string, text string"
_ORDER = (F.col, "conv_id"), (F.asc_nulls_first, "turn"), (F.col, "role"), (F.col, "text")


class Facts(NamedTuple):
    """What a run of neighbouring turns has; runs are added in their order."""

    first: int | None = None      # turn numbers, nulls left out
    last: int | None = None
    distinct: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    opening: str | None = None    # initials of the outer turns, none without turns
    closing: str | None = None

    def __add__(self, other: Facts) -> Facts:
        if self.opening is None or other.opening is None:
            return other if self.opening is None else self
        same = self.last is not None and self.last == other.first
        return Facts(other.first if self.first is None else self.first, self.last if other.last is None else other.last, self.distinct + other.distinct - same,
                     self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
                     self.illegal + other.illegal + (self.closing + other.opening not in PAIRS), self.opening, other.closing)

    def report(self) -> tuple[int, ...]:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def judged(number: int | None, role: str, text: str, seen: bool) -> tuple[Turn, Facts]:
    """A turn for the alignment, and what it adds to its conversation's report."""
    end, initial = text.rstrip(SPACES)[-1:], role[:1]
    blank, duplicate = not end, bool(end) and seen
    truncated = not blank and not duplicate and end not in ".!?"
    return Turn(initial, blank or duplicate, truncated), Facts(number, number, int(number is not None), int(blank), int(duplicate), int(truncated), 0, initial, initial)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the turns, each damaged by the remainder of a checksum of its place."""
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind, text = F.crc32(place.cast("binary")) % 20, F.coalesce("text", blank)
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


# ---- one conversation after the other

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    return groupby(_rows(batches), itemgetter(0))


def _digest(audit: str, rows: Iterator[tuple[str, str]]) -> str:
    out, gap = hashlib.sha256(), b""
    for _, role, text in edited(audit, rows):
        out.update(gap + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        gap = b"\n"
    return out.hexdigest()


def _report(conv, facts: tuple, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    yield conv, *facts, audit, _digest(audit, rows)


def _turns(conv, facts: tuple, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    for place, (edit, role, text) in enumerate(edited(audit, rows)):
        yield conv, place, edit, role, text


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in chain(rows, [None]):
        if held and (row is None or len(held) == 1024):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
        if row is not None:
            held.append(row)


def _whole(emit: Callable, schema: pa.Schema, segment: int) -> Callable:
    """Conversations held whole, one at a time: rows (conv_id, turn, role, text, copies) in order."""
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for conv, run in _runs(batches):
                seen, turns, facts, rows = set(), [], Facts(), []
                for _, number, role, text, copies in run:
                    for _ in range(copies):
                        turn, fact = judged(number, role, text, (role, text) in seen)
                        seen.add((role, text))
                        turns.append(turn)
                        rows.append((role, text))
                        facts += fact
                cost, audit = align(turns, segment)
                yield from emit(conv, (*facts.report(), cost), audit, iter(rows))
        yield from _batches(out(), schema)
    return repair


# ---- large conversations, in segments

def _pack(facts: Facts, parts: Ways) -> str:
    return json.dumps([facts, [(*pair, *way) for pair, way in parts.items()]])


def _unpack(text: str) -> tuple[Facts, Ways]:
    facts, parts = json.loads(text)
    return Facts(*facts), {(a, z): (cost, audit) for a, z, cost, audit in parts}


def _summaries(schema: pa.Schema, segment: int) -> Callable:
    """What each task knows of each conversation: rows (conv_id, turn, role, text, copies, seen) in order."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def out() -> Iterator[tuple]:
            for conv, run in _runs(batches):
                parts, turns, facts = [], [], Facts()
                for _, number, role, text, copies, seen in run:
                    turn, fact = judged(number, role, text, seen)
                    turns.append(turn)
                    facts += fact
                    if copies > 1 or len(turns) == segment:
                        parts.append(ways(turns))
                        turns = []
                    if copies > 1:  # the others are duplicates, or blank as the first is
                        more = fact._replace(distinct=0) if fact.blank else judged(number, role, text, True)[1]
                        parts.append(deletions(copies - 1))
                        pair = int(fact.closing * 2 not in PAIRS)
                        facts += more._replace(distinct=int(number is not None), blank=more.blank * (copies - 1), duplicate=more.duplicate * (copies - 1),
                                               illegal=pair * (copies - 2))
                yield conv, part, _pack(facts, joined([*parts, ways(turns)]))
        yield from _batches(out(), schema)
    return summarise


def _combined(schema: pa.Schema) -> Callable:
    """The report of each conversation from its summaries (conv_id, part, summary) in order."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for conv, run in _runs(batches):
                facts, parts = Facts(), []
                for _, _, summary in run:
                    more, part = _unpack(summary)
                    facts += more
                    parts.append(part)
                cost, audit = best(joined(parts))
                yield conv, json.dumps([(*facts.report(), cost), audit])
        yield from _batches(out(), schema)
    return combine


def _streamed(emit: Callable, schema: pa.Schema) -> Callable:
    """Conversations as a stream: rows (conv_id, rank, turn, role, text, copies), the report first."""
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for conv, run in _runs(batches):
                facts, audit = json.loads(next(run)[4])
                yield from emit(conv, tuple(facts), audit, ((role, text) for _, _, _, role, text, copies in run for _ in range(copies)))
        yield from _batches(out(), schema)
    return repair


def _schemas(turns: DataFrame, rest: str) -> tuple[T.StructType, pa.Schema]:
    schema = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *T.StructType.fromDDL(rest).fields])
    return schema, to_arrow_schema(schema)


def _large(turns: DataFrame, emit: Callable, rest: str, segment: int) -> DataFrame:
    order = [f(c) for f, c in _ORDER]
    rows = stored(turns.filter("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
                  .withColumn("what", F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"))), "dialogue-turns")
    number = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy("conv_id", "what").agg(F.min(number).alias("first")).withColumnsRenamed({"conv_id": "c", "what": "w"})
    known = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("what") == F.col("w")), "left")
    ranges = max(2, -(-rows.count() // RANGE_ROWS))
    spark_schema, schema = _schemas(turns, "part int, summary string")
    parts = (known.select("conv_id", "turn", "role", "text", "copies", (number > F.col("first")).alias("seen"))
             .repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_summaries(schema, segment), spark_schema))
    spark_schema, schema = _schemas(turns, "summary string")
    reports = (parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_combined(schema), spark_schema))
    head = reports.select("conv_id", F.lit(0).alias("rank"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                          F.col("summary").alias("text"), F.lit(1).cast("long").alias("copies"))
    body = rows.select("conv_id", F.lit(1).alias("rank"), "turn", "role", "text", "copies")
    spark_schema, schema = _schemas(turns, rest)
    return (head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "rank", *order[1:])
            .mapInArrow(_streamed(emit, schema), spark_schema))


def _repair(turns: DataFrame, emit: Callable, rest: str, big: int, segment: int) -> DataFrame:
    if "copies" not in turns.columns:
        turns = turns.withColumn("copies", F.lit(1))
    blank = F.lit(" ")
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), "copies")
    spark_schema, schema = _schemas(turns, rest)
    large = stored(turns.groupBy("conv_id").agg(F.sum("copies").alias("n")).filter(F.col("n") > big).select(F.col("conv_id").alias("c")), "dialogue-large")
    whole = turns
    if not large.isEmpty():
        same = F.col("conv_id").eqNullSafe(F.col("c"))
        whole = turns.join(large, same, "left_anti")
    order = [f(c) for f, c in _ORDER]
    out = whole.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_whole(emit, schema, segment), spark_schema)
    return out if whole is turns else out.unionByName(_large(turns.join(large, same, "left_semi"), emit, rest, segment))


def reports(turns: DataFrame, big: int = BIG, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``turns`` has conv_id, turn, role, text and, where rows stand for several or no turns, copies.
    """
    return _repair(turns, _report, REPORT, big, segment)


def repaired(turns: DataFrame, big: int = BIG, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of the repaired conversations."""
    return _repair(turns, _turns, TURNS, big, segment)
