"""License texts by an exact set-similarity join, in DataFrame operations only.

A block is any run of ``BLOCK_WORDS`` words of the whole text (the whole text if
it is shorter); line breaks are gaps like others. A block holds a template if at
least ``CONTAINMENT`` of the template's distinct words are in it.

Each text is read once. Only words of the templates can count, so a text is
reduced to the set of those that it holds; where that set could hold a template
(length filter), the words' places are kept too, and only these small rows are
read again. The vocabulary is ordered by the number of documents that hold each
word. At most n - ceil(t * n) words of a template of n may be missing, so a block
that holds it has one of its n - ceil(t * n) + 1 rarest words: only the places of
those are joined with the templates. What lies within a block's reach of such a
place must have enough vocabulary words (length filter) and, in the order of
rarity, enough of them on both sides of the joined word (positional filter).
What is left is verified: every block over the place is counted.

The templates are a fixed list of some hundred words, which bounds the broadcast
and the counts that the driver sees.

Defined results: null is an empty text without words; a document is reported
once however many blocks hold a template; repeated rows give one row each; a
null id stays null; extra columns are left alone.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.session import stored

CONTAINMENT = 0.8
BLOCK_WORDS = 64

# The base phrases with their labels, and short forms of licence notices.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial international license"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def folded(text: str = "text") -> F.Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)


def templates() -> list[tuple[int, str, list[str], int]]:
    """(number, label, distinct words, words that must be there)."""
    out = []
    for i, (label, text) in enumerate(TEMPLATES):
        words = sorted(set(text.split()))
        out.append((i, label, words, math.ceil(CONTAINMENT * len(words) - 1e-9)))
    return out


def vocabulary() -> list[str]:
    return sorted({w for _, _, words, _ in templates() for w in words})


def base(docs: DataFrame) -> DataFrame:
    """(row columns, spaced, n_words, n_base, first_word, last_word, base_list): places of the phrases.

    The text is rewritten to its words, each between two blanks of its own, so a
    phrase is a plain substring and its places never share a character.
    """
    def padded(words: str) -> str:
        return " " + "  ".join(words.split()) + " "
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(folded(), GAP, "  ")), F.lit(" "))
    words_of = lambda s: (F.length(s) - F.length(F.replace(s, F.lit("  "), F.lit(" ")))) + F.when(F.trim(s) == "", 0).otherwise(1)
    df = docs.withColumn("spaced", spaced).withColumn("n_words", F.when(F.col("spaced") == "  ", 0).otherwise(words_of(F.col("spaced"))).cast("long"))
    may = F.instr("spaced", " license ") > 0
    for n, (phrase, _) in enumerate(PHRASES):
        form, size = padded(phrase), len(phrase.split())
        there = may & (F.instr("spaced", form) > 0)
        head, tail = F.substring_index("spaced", form, 1), F.substring_index("spaced", form, -1)
        count = ((F.length("spaced") - F.length(F.replace("spaced", F.lit(form), F.lit("")))) / F.lit(len(form))).cast("long")
        blank = lambda s: F.when(F.trim(s) == "", 0).otherwise(F.length(F.trim(s)) - F.length(F.replace(F.trim(s), F.lit("  "), F.lit(" "))) + 1)
        df = (df.withColumn(f"n{n}", F.when(there, count).otherwise(0).cast("long"))
              .withColumn(f"first{n}", F.when(there, blank(head)).cast("long"))
              .withColumn(f"last{n}", F.when(there, F.col("n_words") - blank(tail) - size).cast("long")))
    every = range(len(PHRASES))
    total = sum((F.col(f"n{n}") for n in every), F.lit(0).cast("long"))
    labels = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"n{n}") > 0, F.lit(PHRASES[n][1])) for n in every])))
    return df.select(*docs.drop("text").columns, "spaced", "n_words", total.alias("n_base"), F.least(*[f"first{n}" for n in every]).alias("first_word"),
                     F.greatest(*[f"last{n}" for n in every]).alias("last_word"), labels.alias("base_list"))


def reduced(docs: DataFrame) -> DataFrame:
    """``base`` with a row number, the vocabulary words that a text holds (``present``) and, where these
    could hold a template, the places of vocabulary words in their order (``places``: pos, word)."""
    words = F.array(*[F.lit(f" {w} ") for w in vocabulary()])
    present = F.transform(F.filter(words, lambda w: F.contains("spaced", w)), lambda w: F.trim(w))
    rows = base(docs).withColumn("present", present)
    enough = functools.reduce(lambda a, b: a | b, (F.size(F.array_intersect("present", _words(w))) >= need for _, _, w, need in templates()))
    numbered = F.transform(F.split(F.trim("spaced"), "  "), lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    places = F.when((F.size("present") >= min(need for *_, need in templates())) & enough, F.filter(numbered, lambda p: p["word"].isin(vocabulary())))
    return rows.withColumn("places", places).drop("spaced").withColumn("row", F.monotonically_increasing_id())


def _words(words: list[str]) -> F.Column:
    return F.array(*map(F.lit, words))


def contained(rows: DataFrame) -> DataFrame:
    """(row, label, score): the templates that blocks of a text hold, with the largest share held.

    ``rows`` comes from ``reduced`` and is stored.
    """
    spark, known, reach = rows.sparkSession, templates(), BLOCK_WORDS - 1
    counts = {r.word: r.n for r in rows.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    rarest = sorted(vocabulary(), key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(rarest)}
    prefix = []
    for i, label, words, need in known:
        ordered = sorted(words, key=rank.get)
        prefix += [(w, label, ordered, rank[w], len(words), need, p) for p, w in enumerate(ordered[: len(words) - need + 1])]
    index = spark.createDataFrame(prefix, "word string, label string, ordered array<string>, rank int, n int, need int, at int")
    rare = sorted({p[0] for p in prefix})
    tokens = (rows.filter("places is not null").select("row", "places", F.posexplode("places").alias("i", "token"))
              .select("row", "places", "i", "token.pos", "token.word").filter(F.col("word").isin(rare)))
    # a block's words are at most as many places away as it has words
    near = F.slice("places", F.greatest(F.lit(1), F.col("i") + 1 - reach), F.lit(2 * reach + 1))
    near = F.filter(near, lambda p: (p["pos"] >= F.col("pos") - reach) & (p["pos"] <= F.col("pos") + reach))
    pairs = (tokens.select("row", "pos", "word", near.alias("near")).join(F.broadcast(index), "word")
             .withColumn("block", F.array_distinct(F.col("near")["word"])).filter(F.size("block") >= F.col("need")))                    # length
    later = F.size(F.filter("block", lambda w: F.array_position(_words(rarest), w) - 1 > F.col("rank")))
    earlier = F.size("block") - later - 1
    pairs = pairs.filter(1 + F.least(F.col("at"), earlier) + F.least(F.col("n") - F.col("at") - 1, later) >= F.col("need"))             # positional
    own = F.filter("near", lambda p: F.array_contains("ordered", p["word"]))
    blocks = F.transform(F.filter("own", lambda p: p["pos"] <= F.col("pos")),
                         lambda p: F.size(F.array_distinct(F.filter("own", lambda q: (q["pos"] >= p["pos"]) & (q["pos"] <= p["pos"] + reach))["word"])))
    held = pairs.withColumn("own", own).withColumn("held", F.array_max(blocks)).filter("held >= need")
    return held.groupBy("row", "label").agg(F.max(F.col("held") / F.col("n")).alias("score"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per document."""
    rows = stored(reduced(docs.select("doc_id", "text")), "licenses-words")
    found = contained(rows).groupBy("row").agg(F.array_sort(F.collect_set("label")).alias("more"), F.max("score").alias("held"))
    none = F.lit(None)
    rest = rows.filter("places is null").withColumns({"more": none.cast("array<string>"), "held": none.cast("double")})
    every = F.array_sort(F.array_union("base_list", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.size("base_list") > 0, 1.0).otherwise(F.coalesce("held", F.lit(0.0)))
    return (rows.filter("places is not null").join(found, "row", "left").unionByName(rest)
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"),
                    F.array_join(every, ",").alias("labels"), score.alias("score")))
