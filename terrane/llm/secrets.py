"""Secrets: base patterns, and strings that a primed zstandard compressor finds new.

A candidate is a whole run of token characters, of any length and at least
``MIN_CHARS``, that begins within ``REACH`` code points after a word of sensitive
meaning. A run that assigns a value to a name (``key=value``) or goes on after the
sensitive word (``bearer/value``) counts from the value on. Its novelty is what it adds to the
compressed size of its surroundings: the text before it, with a dictionary of
identifiers as the compressor's prefix. Names, paths, repeated words and
placeholders cost little; random keys cost about their entropy. Candidates of
at least ``MIN_BITS`` bits per character are reported as ``novel`` spans; those of more than
``CHUNK`` characters are measured in equal chunks, and the newest chunk decides.

The dictionary holds fixed common identifiers and the names that stand before
: or = in most documents, counted over all of them. A name is a whole identifier
that a value is assigned to; padding at the end of a token, and what lies in a
candidate, is none, so a secret does not become known by its copies.

Defined results: null is an empty text; offsets are code points, end exclusive;
texts of any length are read whole; a candidate that touches a base span adds
nothing; repeated rows give one row each; a null id stays null; extra columns
are left alone.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
REACH = 48                 # code points between the sensitive word and the candidate
AROUND = 256               # code points before the candidate that prime its compression
MIN_CHARS = 16
CHUNK = 512                # characters measured at once
MIN_BITS = 5.0
NAMES = 4096               # identifiers of the corpus in the dictionary

# The base patterns and the words that make a context sensitive.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]++")
_HEX_HINT = re.compile(r"[0-9a-f]{24}")
_CONTEXT = re.compile(r"passw(?:or)?d|pwd|secret|token|credential|private.?key|api.?key|auth|bearer|access.?key|signature|client.?id|connection.?string", re.IGNORECASE)
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]++")
# what stands before the value in a run: a name with =, or what is left of the sensitive word's name with = or /
_ASSIGNED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]{0,63}+=(?=[A-Za-z0-9+/_.-])")
_GOES_ON = re.compile(r"[A-Za-z0-9_.-]{0,64}+[=/]++(?=[A-Za-z0-9+_.-])")
IDENTIFIERS = ("password passwd secret token api_key apikey access_key secret_key private_key client_id client_secret username user_name "
               "authorization bearer basic session cookie signature connection_string localhost example.com changeme placeholder your_token_here "
               "xxxxxxxxxxxxxxxx 0123456789abcdef abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 1234567890 import export return function "
               "public static final string const class self def void null true false https:// http:// www. .com .org .net /usr/local/bin "
               "/etc/config application/json content-type environment variable process.env os.environ getenv settings.py config.yaml")
# = that touches the name needs a value that touches it, else it can be padding
_NAME = re.compile(r"""(?<![A-Za-z0-9+/_.=-])([A-Za-z_][A-Za-z0-9_.-]{2,63}+)(?:["']?(?:\x20{0,3}:|\x20{1,3}=)\x20{0,3}|["']?=)["']?[A-Za-z0-9_/.$+-]""")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by start and then kind."""
    out = [(0, *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [(1, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _HEX_HINT.search(text):
        out += [(2, *m.span()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda s: (s[1], s[0]))


class Novelty:
    """Marginal compressed bits of a string after its surroundings."""

    def __init__(self, names: list[str]):
        content = (" ".join(names) + " " + IDENTIFIERS).encode("utf-8", "replace")
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_RAWCONTENT),
                                                   write_content_size=False)

    def _bits(self, text: str) -> int:
        return 8 * len(self.compressor.compress(text.encode("utf-8", "replace")))

    def __call__(self, before: str, candidate: str) -> float:
        """Bits per character, at least 0."""
        return max(0.0, (self._bits(before + candidate) - self._bits(before)) / len(candidate))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Token runs of MIN_CHARS and more that begin within REACH of the end of a sensitive word."""
    last = free = -1
    for word in _CONTEXT.finditer(text):
        at = word.end()
        inside = _GOES_ON.match(text, at)
        starts = [inside.end()] if inside else []
        for m in _CANDIDATE.finditer(text, max(at, last + 1), at + REACH + 1):
            name = _ASSIGNED.match(text, m.start())
            starts.append(name.end() if name else m.start())
        for start in starts:
            if start > last and start >= free:
                last, free = start, _RUN.match(text, start).end()
                if free - start >= MIN_CHARS:
                    yield start, free


def novelty_of(text: str, a: int, b: int, novelty: Novelty) -> float:
    """Bits per character of text[a:b] after what stands before it; of its newest chunk if it is long."""
    n = -(-(b - a) // CHUNK)
    cuts = [a + i * (b - a) // n for i in range(n + 1)]
    return max(novelty(text[max(0, c - AROUND):c], text[c:d]) for c, d in zip(cuts, cuts[1:]))


def spans(text: str, novelty: Novelty) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, float]]]:
    """(base spans, novel spans with their bits per character)."""
    base = base_spans(text)
    if not _CONTEXT.search(text):
        return base, []
    starts, reach, far = [], [], 0
    for _, a, b in base:
        far = max(far, b)
        starts.append(a)
        reach.append(far)
    novel = []
    for a, b in candidates(text):
        i = bisect_right(starts, b - 1)
        if i and reach[i - 1] > a:
            continue
        bits = novelty_of(text, a, b, novelty)
        if bits >= MIN_BITS:
            novel.append((a, b, bits))
    return base, novel


def names_in(text: str) -> set[str]:
    """The names that a value is assigned to, without those that lie in a candidate."""
    taken = list(candidates(text))
    ends = [b for _, b in taken]
    out = set()
    for m in _NAME.finditer(text):
        i = bisect_right(ends, m.start(1))
        if i == len(taken) or taken[i][0] >= m.end(1):
            out.add(m[1])
    return out


def corpus_names(docs: DataFrame, limit: int = NAMES) -> list[str]:
    """Names that stand before : or = in most documents, the commonest last (nearest to what is compressed)."""
    named = docs.filter("text is not null and (instr(text, ':') > 0 or instr(text, '=') > 0)")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                names = [n for t in whole.slice(at, 512).column("text") for n in names_in(t.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])
    found = named.select("text").mapInArrow(look, "name string")
    rows = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(F.desc("n"), "name").limit(limit).collect()
    return [r.name for r in reversed(rows)]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"


def find(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    names = docs.sparkSession.sparkContext.broadcast(corpus_names(docs))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(names.value)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    base, novel = spans(text.as_py() or "", novelty)
                    written = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base)
                    every = sorted([(a, k, f"{KINDS[k]}:{a}:{b}") for k, a, b in base] + [(a, 3, f"novel:{a}:{b}") for a, b, _ in novel])
                    rows.append((doc, *(sum(k == n for k, _, _ in base) for n in range(3)), hashlib.sha256(written.encode()).hexdigest(),
                                 ",".join(x for _, _, x in every), len(novel)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in SCHEMA.split(", ")])
    return docs.select("doc_id", "text").mapInArrow(look, SCHEMA)
