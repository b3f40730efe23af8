"""The registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrane.llm import bagminhash, bpe, crcgrams, decontaminate, dialogue, html, language, licenses, mixture, pii, quality, secrets, voronoi

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op5_quality_resampling")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_bagminhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class."""
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a passage of a benchmark item."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


@query("op3_mixture", """
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS place, coalesce(md5(text), '') AS tie FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS total,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM doc GROUP BY source),
-- sources whose share passes twice their size are a prefix in the order of size over weight
step AS (
  SELECT source, total, w, 2.0 * total / w AS ratio,
    (SELECT sum(total) FROM src) * 150 / 100.0 - coalesce((SELECT sum(2.0 * b.total) FROM src b WHERE 2.0 * b.total / b.w < 2.0 * a.total / a.w), 0) AS rest,
    (SELECT sum(b.w) FROM src b WHERE 2.0 * b.total / b.w >= 2.0 * a.total / a.w) AS open_w FROM src a),
level AS (SELECT rest::DOUBLE AS rest, open_w::DOUBLE AS open_w, ratio FROM step WHERE rest / open_w <= ratio ORDER BY ratio LIMIT 1),
goal AS (
  SELECT source, total, CASE WHEN NOT EXISTS (SELECT 1 FROM level) OR 2.0 * total / w < (SELECT ratio FROM level) THEN (2 * total)::DOUBLE
    ELSE (SELECT rest * w / open_w FROM level) END AS target FROM src),
cut AS (SELECT source, total, target, least(2 * total, round_even(target, 0)::BIGINT) AS take FROM goal),
-- slots of 256 words, dealt by the van der Corput points over the sources' shares; what a source lacks is appended
edge AS (
  SELECT source, take, sum(take) OVER (ORDER BY source NULLS LAST) AS b, sum(take) OVER () AS words, (take + 255) // 256 AS need FROM cut WHERE take > 0),
point AS (
  SELECT slot, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(reverse(lpad(bin(slot), 40, '0')), ''), lambda x: x::BIGINT)),
    lambda a, x: a * 2 + x)::DOUBLE / 1099511627776 AS u FROM range((SELECT sum(need) FROM edge)::BIGINT) r(slot)),
dealt AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank, slot FROM point
  JOIN edge ON u >= (b - take)::DOUBLE / words::DOUBLE AND u < CASE WHEN b = words THEN 1.0 ELSE b::DOUBLE / words::DOUBLE END),
placed AS (
  SELECT d.*, g.total, g.target, g.take, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, d.doc_id, tie, rid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
  FROM doc d JOIN cut g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, total AS source_size, target,
  (greatest(0, least(o + size, take) - o) + greatest(0, least(o + size, take - total) - o))::BIGINT AS taken,
  CASE WHEN size > 0 AND o < take THEN coalesce(slot, (SELECT sum(need) FROM edge))::BIGINT END AS first_slot
FROM placed p LEFT JOIN dealt ON p.source IS NOT DISTINCT FROM dealt.source AND o // 256 = rank""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixture.report(table(spark, sf_dir, "documents"))


@query("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.find(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op7_licenses", f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
worded AS (SELECT rid, doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM docs),
places AS (
  SELECT rid, doc_id, len(w) AS n_words,
    list_filter(range(0, len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
    list_filter(range(0, len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
    list_filter(range(0, len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl
  FROM worded),
template AS (
  SELECT label, list_distinct(string_split(words, ' ')) AS words FROM (VALUES
    ('mit', 'released under the mit license'),
    ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
    ('apache', 'licensed under the apache license version 2 0'),
    ('apache', 'you may not use this file except in compliance with the license'),
    ('gpl', 'this work is licensed under the gnu general public license version 3'),
    ('gpl', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license'),
    ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted'),
    ('cc-by-nc', 'licensed under cc by nc 4 0'),
    ('cc-by-nc', 'licensed under a creative commons attribution noncommercial international license'),
    ('cc-by', 'licensed under a creative commons attribution international license'),
    ('mpl', 'this source code form is subject to the terms of the mozilla public license'),
    ('unlicense', 'this is free and unencumbered software released into the public domain')) AS v(label, words)),
-- every run of 64 words, the whole text if it is shorter, reduced to the templates' words
vocabulary AS (SELECT list_distinct(flatten(list(words))) AS v FROM template),
block AS (
  SELECT DISTINCT rid, list_sort(list_intersect(w[a : a + 63], v)) AS b
  FROM (SELECT rid, w, unnest(range(1, greatest(1, len(w) - 63) + 1)) AS a FROM worded), vocabulary),
held AS (
  SELECT rid, label, len(list_intersect(b, words)) / len(words) AS share FROM block, template
  WHERE len(list_intersect(b, words)) >= ceil(0.8 * len(words) - 1e-9)),
found AS (SELECT rid, list(DISTINCT label) AS more, max(share) AS share FROM held GROUP BY rid),
base AS (
  SELECT rid, doc_id, n_words, len(mit) + len(apache) + len(gpl) AS n_base,
    least(list_min(mit), list_min(apache), list_min(gpl)) AS first_word,
    greatest(list_max(mit), list_max(apache), list_max(gpl)) AS last_word,
    list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                 CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS labels FROM places)
SELECT doc_id, n_words, n_base, first_word, last_word, array_to_string(b.labels, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(b.labels, coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM base b LEFT JOIN found USING (rid)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op9_voronoi_topk", """
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vec q, vec c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every query vector."""
    return voronoi.search(table(spark, sf_dir, "embeddings"))


@query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.predict(table(spark, sf_dir, "documents"))


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


# CRC-32 in SQL: the table of a byte's remainders, and a fold over the bytes of a text
_CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def _crc(codes: str) -> str:
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"


_BYTES = """list_transform(range(0, octet_length(encode(gram))::BIGINT), lambda i:
    (strpos('0123456789ABCDEF', hex(encode(gram))[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', hex(encode(gram))[2 * i + 2]) - 1)"""


def _grams(table_name: str, key: str) -> str:
    return f"""SELECT {key}, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams, len(w) AS n_words
  FROM (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table_name})"""


@query("op11_prefix_crc_resampling", f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
d AS ({_grams("doc", "rid, doc_id")}),
b AS ({_grams("benchmark", "item_id")}),
dg AS (SELECT rid, unnest(grams) AS gram FROM d),
bg AS (SELECT unnest(grams) AS gram FROM b),
bucket AS (
  SELECT gram, {_crc(_BYTES)} % 10000 AS bucket FROM (SELECT gram FROM dg UNION SELECT gram FROM bg), {_CRC_TABLE}),
raw AS (SELECT bucket, count(*) AS s FROM dg JOIN bucket USING (gram) GROUP BY bucket),
goal AS (SELECT bucket, count(*) AS t FROM bg JOIN bucket USING (gram) GROUP BY bucket),
gain AS (
  SELECT b AS bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dg) + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bg) + 10000))))::BIGINT AS gain
  FROM range(10000) r(b) LEFT JOIN raw ON raw.bucket = b LEFT JOIN goal ON goal.bucket = b),
weight AS (SELECT rid, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight FROM dg JOIN bucket USING (gram) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weight USING (rid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM placed""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's text, and the rank of those drawn."""
    return crcgrams.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_bpe_transducer")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of what they decode to."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


# the check reads the grammar as an automaton: 0 nothing, 1 a system, 2 a user, 3 an assistant turn last
@query("op13_alternation_repair", f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x))")} % 20 AS kind
  FROM conversations, {_CRC_TABLE}),
dam AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM src),
seq AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, E' \t\n\x0B\x0C\r') AS body, left(role, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen FROM dam),
row AS (
  SELECT *, body = '' AS blank, body <> '' AND seen AS dup, body <> '' AND NOT seen AND right(body, 1) NOT IN ('.', '!', '?') AS trunc,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS illegal FROM seq),
one AS (
  SELECT conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(dup) AS duplicate,
    count_if(trunc) AS truncated, count_if(illegal) AS illegal FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN row USING (conv_id) GROUP BY conv_id),
never AS (SELECT {{'c': 1000000000000, 'a': ''}} AS x),
step AS (
  SELECT conv_id, n, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, x AS s1, {{'c': 3::BIGINT, 'a': 'I'}} AS s2, {{'c': 6::BIGINT, 'a': 'II'}} AS s3 FROM one, never
  UNION ALL
  SELECT conv_id, n, i, t0 AS s0, t1 AS s1, {_least("u2", _way("u3", "3", "I"))} AS s2, u3 AS s3 FROM (
    SELECT *, {_least("t3", _way("u2", "3", "I"))} AS u3 FROM (
      SELECT *, {_least("t2", *(_way(f"t{k}", "3", "I") for k in (0, 1, 3)))} AS u2 FROM (
        SELECT s.conv_id, n, r.i, {_way("s0", "4", "D")} AS t0,
          CASE WHEN blank OR dup OR ini <> 's' THEN {_way("s1", "4", "D")} ELSE {_least(_way("s1", "4", "D"), _way("s0", "3 * trunc::INT", "K"))} END AS t1,
          CASE WHEN blank OR dup THEN {_way("s2", "4", "D")} WHEN ini = 'u' THEN {_least(_way("s2", "4", "D"), *(_way(f"s{k}", "3 * trunc::INT", "K") for k in (0, 1, 3)))}
            ELSE {_least(_way("s2", "4", "D"), *(_way(f"s{k}", "3 + 3 * trunc::INT", "R") for k in (0, 1, 3)))} END AS t2,
          CASE WHEN blank OR dup THEN {_way("s3", "4", "D")} WHEN ini = 'a' THEN {_least(_way("s3", "4", "D"), _way("s2", "3 * trunc::INT", "K"))}
            ELSE {_least(_way("s3", "4", "D"), _way("s2", "3 + 3 * trunc::INT", "R"))} END AS t3
        FROM step s JOIN row r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1)))),
ended AS (SELECT conv_id, {_least("s0", "s3")} AS best FROM step WHERE i = n),
letter AS (
  SELECT *, count_if(edit <> 'I') OVER w AS i, count_if(edit <> 'D') OVER w AS place, count_if(edit <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM (
    SELECT conv_id, unnest(string_split(best.a, '')) AS edit, generate_subscripts(string_split(best.a, ''), 1) AS p FROM ended WHERE best.a <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
turned AS (
  SELECT l.conv_id, place, CASE WHEN edit = 'K' THEN r.role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END AS line
  FROM letter l LEFT JOIN row r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.i = r.i WHERE edit <> 'D'),
whole AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS lines FROM turned GROUP BY conv_id)
SELECT o.conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated, illegal::BIGINT AS illegal,
  best.c::BIGINT AS cost, best.a AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM one o JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN whole w ON o.conv_id IS NOT DISTINCT FROM w.conv_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with every damaged conversation, and its cheapest repair."""
    return dialogue.reports(dialogue.damaged(table(spark, sf_dir, "conversations")))
