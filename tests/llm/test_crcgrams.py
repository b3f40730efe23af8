"""Checksums from prefixes against checksums of cut-out n-grams; the whole draw against a plain one."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from terrane.llm import crcgrams
from tests.llm.test_text_operators import AWKWARD, SF, frame

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n=2):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i: i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) of (doc_id, text) rows, ties of equal rows in any order."""
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = (collections.Counter(bucket(g) for x in texts for g in grams(x)[1]) for texts in ([d[1] for d in docs], target))
    a, b = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        n, g = grams(text)
        gain = [math.floor(1000 * math.log((t[bucket(x)] + 1) * (a + 10000) / ((s[bucket(x)] + 1) * (b + 10000)))) for x in g]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((n >= 20, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), doc, len(g), weight))
    enough = sorted((r for r in rows if r[0]), key=lambda r: (-r[1], r[2] is None, r[2] or 0))
    k = 25 * len(enough) // 100
    out = [(r[2], r[3], r[4], r[1], i + 1 if i < k else None) for i, r in enumerate(enough)]
    return out + [(r[2], r[3], r[4], r[1], None) for r in rows if not r[0]]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_checksums_are_those_of_the_grams():
    rng = random.Random(1)
    parts = ["a", "B", "é", "😀", " ", "  ", ",", "9", "-", "\n", "Z", "[", "@"]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.8 else "x" * rng.randint(1, 300) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["", "x" * 300_000 + " y " + "z" * 70_000]
    for text in texts:
        for n in (1, 2, 3):
            size, found = crcgrams.checksums(text.encode(), n)
            words, want = grams(text, n)
            assert size == words and found.tolist() == [zlib.crc32(g.encode()) for g in want]


def test_the_small_tables(spark):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert ordered(crcgrams.resample(docs, target).collect()) == ordered(want)


@pytest.mark.parametrize("ranges", [1_000_000, 3])
def test_awkward_rows_ties_and_clashing_columns(spark, monkeypatch, ranges):
    monkeypatch.setattr(crcgrams, "RANGE_ROWS", ranges)   # few rows a range: ties and repeated rows meet range ends
    rows = AWKWARD + [(9, "common words " * 15)] * 17 + [(n, f"some rare text {n} " * 6) for n in range(20, 40)]
    docs = frame(spark, rows, ("rank", "score", "weight", "part", "at", "place", "salt", "enough", "n_words"))
    target = spark.createDataFrame([(1, "rare text"), (2, None), (3, "")], "item_id long, text string").withColumn("bucket", F.lit(1))
    assert ordered(crcgrams.resample(docs, target).collect()) == ordered(brute(rows, ["rare text"]))


def test_empty_tables(spark):
    docs = frame(spark, [(1, "one two three " * 10), (2, None)])
    none = spark.createDataFrame([], "item_id long, text string")
    assert ordered(crcgrams.resample(docs, none, percent=100).collect())[0][4] == 1
    assert crcgrams.resample(docs.limit(0), none).collect() == []
