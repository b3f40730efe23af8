"""Turn repair against an automaton search, and both paths against each other."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from terrane.llm import alignment as A
from terrane.llm import dialogue
from tests.llm.test_text_operators import SF

TURNS = "conv_id long, turn long, role string, text string"
NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}
STATE = {"s": 1, "u": 2, "a": 3}


def search(turns):
    """(cost, audit) by the least (cost, audit) first over (turn, what was written last)."""
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, s = heapq.heappop(heap)
        if i == len(turns) and s in (0, 3):
            return cost, audit
        if (i, s) in done:
            continue
        done.add((i, s))
        for c in NEXT[s].replace("s", ""):
            heapq.heappush(heap, (cost + 3, audit + "I", i, STATE[c]))
        if i < len(turns):
            t = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, s))
            for c in "" if t.deleted else NEXT[s]:
                if t.initial == c:
                    heapq.heappush(heap, (cost + 3 * t.truncated, audit + "K", i + 1, STATE[c]))
                elif c != "s":
                    heapq.heappush(heap, (cost + 3 + 3 * t.truncated, audit + "R", i + 1, STATE[c]))


def brute(rows):
    """Reports from (conv_id, turn, role, text) rows, damage included."""
    kept = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        place = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(place.encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        kept.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = {}
    for conv, turns in kept.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append(A.Turn(role[:1], fault in (0, 1), fault == 2))
        numbers = {t for t, _, _ in turns if t is not None}
        cost, audit = search(facts)
        size, lines, i = len(audit) - audit.count("D"), [], 0
        for e in audit:
            if e != "D":
                want = ["system"] * (size % 2) + ["user", "assistant"] * (size // 2)
                role = turns[i][1] if e == "K" else want[len(lines)]
                lines.append(f"{role}:{'' if e == 'I' else turns[i][2]}")
            i += e != "I"
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_alignment_is_the_cheapest_and_first():
    rng = random.Random(4)
    for n in range(4000):
        size, letters = rng.randint(0, 12), "sua" if n % 3 else "suatx "
        turns = [A.Turn("ua"[i % 2] if rng.random() < 0.5 else rng.choice(letters), rng.random() < 0.2, rng.random() < 0.3) for i in range(size)]
        want = search(turns)
        assert all(A.align(turns, segment) == want for segment in (256, 1, 2, 5))


def test_a_long_conversation_in_segments():
    rng = random.Random(5)
    turns = [A.Turn(rng.choice("sua"), rng.random() < 0.1, rng.random() < 0.2) for _ in range(1500)]
    assert A.align(turns) == search(turns)


def noisy(seed, convs=60, most=12):
    rng, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Why?", "So.", "no end", "", " \n", None, "Well! ", "é?", "So."])))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("big,segment", [(dialogue.BIG, A.SEGMENT), (0, 3), (4, 2)])
def test_reports_and_turns_on_awkward_rows(spark, big, segment):
    rows = noisy(big)
    turns = dialogue.damaged(spark.createDataFrame(rows, TURNS).withColumn("copies", F.lit("x")).withColumn("place", F.lit(1)))
    want = brute(rows)
    assert got(dialogue.reports(turns, big, segment)) == want
    lines = {}
    for r in sorted(dialogue.repaired(turns, big, segment).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == w[-1] for c, w in want.items())


def test_a_large_conversation_and_an_often_repeated_row(spark):
    rows = noisy(9, convs=5) + [(77, n, "user" if n % 2 else "assistant", f"turn {n % 700}.") for n in range(3000)] + [(78, 1, "user", "again.")] * 3000
    turns = dialogue.damaged(spark.createDataFrame(rows, TURNS))
    assert got(dialogue.reports(turns)) == brute(rows)


def test_an_empty_table_and_a_very_long_text(spark):
    assert dialogue.reports(dialogue.damaged(spark.createDataFrame([], TURNS))).collect() == []
    rows = [(1, 0, "user", "a?" * 1_000_000), (1, 1, "assistant", "yes " * 300_000)]
    assert got(dialogue.reports(dialogue.damaged(spark.createDataFrame(rows, TURNS)))) == brute(rows)


def test_the_small_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert got(dialogue.reports(dialogue.damaged(table))) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
