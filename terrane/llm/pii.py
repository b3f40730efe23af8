"""Personal data: base patterns, and a character-level BiLSTM-CRF that adds spans.

Windows of ``SIZE`` code points lie on a fixed grid and overlap by half. The
tagger decodes each. A span that a window's inner edge cuts is continued in the
neighbouring window, which is read for that if it was not yet, so spans have no
greatest length; one that its neighbour holds whole is left to it, one
that it does not see counts as it is. Spans
grow to whole numbers and to the whole name and host of an address. All spans of
a document are reconciled at once: the set without overlap with the highest total
score stays.
A span must hold a digit or an @ (every kind does), so only windows with one,
and those that continue a span, are read. A text's last window is filled up with
padding, which has no label. An added span must also pass its kind's own
arithmetic (digits, Luhn sum, parts of an address) and must not touch a span of
the base patterns, which always stay.

The tagger is trained on labelled spans: values of the four kinds in the forms
that the base patterns know and in forms that they do not, and look-alikes
without a label, written into passages of a bounded sample of documents.

Defined results: null is an empty text; offsets are code points, end exclusive;
texts of any length are read whole; repeated rows give one row each; a null id
stays null; extra columns are left alone.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.sampling import sampled
from terrane.llm.tagger import Tagger, encode

KINDS = ("email", "ip", "card", "phone")
SIZE, STRIDE = 256, 128
EXAMPLE = 128                           # characters of a training window
SAMPLE_DOCS, SAMPLE_CHARS = 256, 2000   # passages for training: this many documents, this many characters each
WINDOWS, EPOCHS = 4096, 5               # training windows and passes
MARGIN = 3.0                            # log odds of a span's labels against O that an added span needs
BATCH = 256                             # windows run at once in a task

# The base patterns. The look-behind of the address and the lazy walk of
# the e-mail give the same leftmost matches in linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_HOST = _LOCAL - frozenset("._%+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        if m:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if m and start < at:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns."""
    if not _ANCHOR.search(text):
        return []
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def plausible(kind: int, text: str) -> bool:
    """What the arithmetic of a kind demands of an added span."""
    d = _digits(text)
    if kind == 0:
        user, at, host = text.partition("@")
        return bool(at and user.strip() and re.search(r"[A-Za-z0-9]\s?\.\s?[A-Za-z]{2}", host))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        if ":" in text:
            return text.count(":") >= 2 and not re.search(r"[^0-9a-fA-F:.]", text) and len(d) >= 2
        return len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts) and not re.search(r"[^0-9. ]", text)
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    return 8 <= len(d) <= 15 and bool(re.search(r"[ ()./-]", text))


# ---- training data

def _card(rng: random.Random, n: int = 16) -> str:
    head = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(head + c for c in "0123456789" if luhn(head + c))


def _n(rng: random.Random, k: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(k))


def example(rng: random.Random, words: list[str]) -> tuple[int | None, str]:
    """(kind or None, text) of one value."""
    word = lambda: re.sub(r"[^a-z]", "", rng.choice(words).lower()) or "mail"
    pick = rng.random()
    if pick < 0.26:
        if rng.random() < 0.4:  # long addresses
            user = rng.choice([".", "_", "-", "."]).join(word() for _ in range(rng.randint(2, 6)))
            host = ".".join([f"{rng.choice(['mail', 'mx', 'post'])}{_n(rng, 1)}", "-".join(word() for _ in range(rng.randint(1, 4))), rng.choice(["example.org", "example.com", f"{word()}.net"])])
            return 0, user + rng.choice(["@", " @ ", "@ ", " @"]) + host
        user = rng.choice([word(), f"{word()}.{word()}", f"{word()}_{_n(rng, 2)}", f"{word()}{_n(rng, rng.randint(1, 3))}", f"{_n(rng, 2)}"])
        host = rng.choice([f"mail{_n(rng, 1)}.example.com", f"{word()}.org", f"{word()}-{word()}.net", f"mx.{word()}.co"])
        gap = rng.choice(["@", "@", "@", " @ ", "@ ", " @"])
        return 0, user + gap + host
    if pick < 0.42:
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        if rng.random() < 0.2:
            return 1, ":".join(f"{rng.randint(1, 65535):x}" for _ in range(rng.randint(3, 8)))
        return 1, rng.choice([".", ".", ".", " . ", ". "]).join(parts)
    if pick < 0.58:
        d = _card(rng, rng.choice([16, 16, 16, 15, 19]))
        if rng.random() < 0.5:
            return 2, d
        cut = [4, 10] if len(d) == 15 else [4, 8, 12, 16]
        return 2, rng.choice([" ", "-", "-", ".", "  ", "/"]).join(d[a:b] for a, b in zip([0, *cut], [*cut, len(d)]) if a < b)
    if pick < 0.78:
        a, b, c = _n(rng, 3), _n(rng, 3), _n(rng, 4)
        return 3, rng.choice([f"+1 ({a}) {b}-{c}", f"+{_n(rng, 2)} {a} {b} {c}", f"+1-{a}-{b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}",
                              f"0{_n(rng, 2)}/{_n(rng, 7)}", f"00{_n(rng, 2)} {_n(rng, 3)} {_n(rng, 6)}", f"{a}.{b}.{c}"])
    hexed = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([24, 32, 40])))
    return None, rng.choice([f'token = "{hexed}"', hexed, f"{rng.randint(1900, 2100)}-{_n(rng, 2)}-{_n(rng, 2)}", f"{_n(rng, 2)}:{_n(rng, 2)}:{_n(rng, 2)}",
                             f"version {_n(rng, 1)}.{_n(rng, 1)}", f"v{_n(rng, 1)}.{_n(rng, 2)}.{_n(rng, 1)}", f"{_n(rng, 3)},{_n(rng, 3)}.{_n(rng, 2)}",
                             f"#{_n(rng, rng.randint(3, 9))}", f"AKIA{hexed[:16].upper()}", f"@{word()}", f"{_n(rng, rng.randint(1, 6))}",
                             f"{_n(rng, 2)}.{_n(rng, 2)}.{rng.randint(1900, 2100)}", f"{word()}{_n(rng, 3)}", f"{_n(rng, 1)}%"])


def training_windows(passages: list[str], n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, labels) of ``n`` windows with one or two values each."""
    rng = random.Random(seed)
    passages = [p for p in passages if len(p) > 8] or ["the reading room opens at noon and the letters lie on the table"]
    words = [w for p in passages for w in p.split()] or ["letter"]
    ids, labels = np.zeros((n, EXAMPLE), np.int16), np.zeros((n, EXAMPLE), np.int64)
    for row in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 2)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += re.sub(r"[0-9@]", "", p[a: a + rng.randint(0, 60)]) + rng.choice([" ", " ", ": ", " (", "\n", ", "])
            kind, value = example(rng, words)
            if kind is not None:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value + rng.choice([" ", " ", ".", ", ", ")", "\n", "*** ", "!! "])
        p = rng.choice(passages)
        text += re.sub(r"[0-9@]", "", p[: rng.randint(0, 60)])
        shift = max(0, min(rng.randint(0, max(0, len(text) - EXAMPLE)), spans[0][1] if spans else 0))
        part = encode(text)[shift: shift + EXAMPLE]
        ids[row, :len(part)] = part
        for kind, a, b in spans:
            a, b = a - shift, b - shift
            if 0 <= a and b <= EXAMPLE:
                labels[row, a], labels[row, a + 1: b] = 1 + 2 * kind, 2 + 2 * kind
            elif a < EXAMPLE and b > 0:  # cut by the edge: what is seen keeps its label
                labels[row, max(a, 0): min(b, EXAMPLE)] = 2 + 2 * kind
                labels[row, max(a, 0)] = 1 + 2 * kind
    return ids, labels


_trained: dict[str, dict] = {}


def train(passages: list[str], windows: int = WINDOWS, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Parameters of a tagger fitted to labelled values in these passages; kept per process by their hash."""
    key = hashlib.sha256(repr((passages, windows, epochs)).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _trained:
        tagger = Tagger(len(KINDS))
        tagger.fit(*training_windows(passages, windows), epochs, batch=128, rate=0.04)
        _trained.clear()
        _trained[key] = tagger.p
    return _trained[key]


def sample_passages(docs: DataFrame) -> list[str]:
    """Passages of at most SAMPLE_DOCS documents, chosen and placed by hash."""
    at = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text"), F.lit(1)).cast("long")).cast("int") + 1
    parts = docs.filter("text is not null").select("doc_id", F.substring(F.col("text"), at, F.lit(SAMPLE_CHARS)).alias("p"))
    return [r.p for r in sampled(parts, "doc_id", SAMPLE_DOCS, ("p",)).collect()]


# ---- finding

def _reconcile(spans: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (score, start, end, kind) without overlap whose scores add up highest."""
    spans = sorted(set(spans), key=lambda s: (s[2], s[1], s[3], s[0]))
    ends = [s[2] for s in spans]
    best = [0.0]
    take = []
    for i, (score, a, _, _) in enumerate(spans):
        j = bisect_right(ends, a, 0, i)
        take.append(best[j] + score > best[-1])
        best.append(max(best[-1], best[j] + score))
    out, i = [], len(spans)
    while i:
        if take[i - 1]:
            _, a, b, kind = spans[i - 1]
            out.append((kind, a, b))
            i = bisect_right(ends, a, 0, i - 1)
        else:
            i -= 1
    return out


def _cells(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(text, cell) of the windows that hold a digit or an @."""
    for doc, text in enumerate(texts):
        last = -1
        for m in _ANCHOR.finditer(text):
            cell = m.start() // STRIDE
            for g in (cell - 1, cell):
                if g > last:
                    yield doc, g
                    last = g


def _cut(g: int, a: int, b: int, size: int) -> tuple[bool, bool]:
    """Whether a span of window ``g`` is cut at its left and at its right edge."""
    return a == g * STRIDE > 0, b == g * STRIDE + SIZE < size


def _widened(kind: int, text: str, a: int, b: int) -> tuple[int, int]:
    """A span grown to whole numbers, or to the whole name and host of an address (a name holds no blank), without blanks at its ends."""
    while b > a and text[b - 1].isspace():
        b -= 1
    if kind == 0 and "@" in text[a:b]:
        name = text[a:b].split("@", 1)[0].rstrip()
        a += max((i + 1 for i, c in enumerate(name) if c.isspace()), default=0)
    more = _LOCAL if kind == 0 else _DIGITS
    while 0 < a < b and text[a] in more and text[a - 1] in more:
        a -= 1
    while a < b < len(text) and (text[b] in _HOST if kind == 0 else text[b] in _DIGITS) and (text[b - 1] in _HOST or text[b - 1] == "."):
        b += 1
        if kind == 0 and b + 1 < len(text) and text[b] == "." and text[b + 1] in _HOST:
            b += 1
    return a, b


def _joined_parts(parts: list[tuple[int, float, int, int, int]], size: int) -> list[tuple[float, int, int, int]]:
    """Spans (score, start, end, kind) of (cell, score, start, end, kind).

    A span that is cut at its window's left edge goes on from the span of the window before
    that reaches over this edge, whose part before the edge counts with it. A span that is cut at
    the right edge is left to the next window if that has one over this edge.
    """
    seen: dict[tuple[int, int], list[tuple[float, int, int]]] = {}

    def over(g: int, kind: int, edge: int) -> list[tuple[float, int, int]]:
        return [s for s in seen.get((g, kind), ()) if s[1] < edge < s[2]]
    for g, score, a, b, kind in sorted(parts):
        if _cut(g, a, b, size)[0] and (before := over(g - 1, kind, a)):
            more, start, end = before[0]
            if end >= b:
                continue
            seen[g - 1, kind].remove(before[0])
            score, a = score + more * (a - start) / (end - start), start
        seen.setdefault((g, kind), []).append((score, a, b))
    return [(score, a, b, kind) for (g, kind), spans in seen.items() for score, a, b in spans
            if not (_cut(g, a, b, size)[1] and over(g + 1, kind, b))]


class Finder:
    def __init__(self, params: dict[str, np.ndarray]):
        self.tagger = Tagger(len(KINDS))
        self.tagger.p = params

    def _tagged(self, windows: np.ndarray) -> Iterator[tuple[int, float, int, int, int]]:
        """(window, score, start, end, kind)."""
        e = self.tagger.emissions(windows)
        path, trans = self.tagger.decode(e), self.tagger.p["t"]
        for row in np.flatnonzero(path.any(1)):
            y, at = path[row], 0
            while at < SIZE:
                if y[at] % 2:
                    end = at + 1
                    while end < SIZE and y[end] == y[at] + 1:
                        end += 1
                    odds = (e[row, np.arange(at, end), y[at:end]] - e[row, at:end, 0]).sum() - (end - at) * trans[0, 0]
                    odds += trans[0, y[at]] + trans[y[at:end - 1], y[at + 1:end]].sum() + (trans[y[end - 1], 0] - trans[0, 0] if end < SIZE else 0)
                    yield row, float(odds), at, end, int(y[at]) // 2
                    at = end
                else:
                    at += 1

    def _read(self, cells: Iterable[tuple[int, int]], texts: list[str]) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(text, cell, score, start, end, kind) of the spans in these windows, start and end in the text."""
        cells, symbols, at = iter(cells), np.zeros(0, np.int16), -1
        while some := list(islice(cells, BATCH)):
            windows = np.zeros((len(some), SIZE), np.int16)
            for row, (doc, g) in enumerate(some):
                if doc != at:
                    symbols, at = encode(texts[doc]), doc
                part = symbols[g * STRIDE: g * STRIDE + SIZE]
                windows[row, :len(part)] = part
            for row, score, a, b, kind in self._tagged(windows):
                doc, g = some[row]
                yield doc, g, score, a + g * STRIDE, b + g * STRIDE, kind

    def _drawn(self, texts: list[str]) -> list[list[tuple[float, int, int, int]]]:
        """For each text the spans (score, start, end, kind) that the tagger sees, cut ones joined."""
        parts: list[list[tuple[int, float, int, int, int]]] = [[] for _ in texts]
        cells, read = _cells(texts), set()
        while cells:
            more = set()
            for doc, g, score, a, b, kind in self._read((read.add(c) or c for c in cells), texts):
                parts[doc].append((g, score, a, b, kind))
                left, right = _cut(g, a, b, len(texts[doc]))
                more |= {(doc, g - 1)} if left else set()
                more |= {(doc, g + 1)} if right else set()
            cells = sorted(more - read)
        return [_joined_parts(p, len(t)) for p, t in zip(parts, texts)]

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int, bool]]]:
        """For each text its spans (kind, start, end, base), ordered by kind and start."""
        base = [base_spans(t) for t in texts]
        drawn: list[list[tuple[float, int, int, int]]] = []
        for text, spans in zip(texts, self._drawn(texts)):
            drawn.append([])
            for score, a, b, kind in spans:
                a, b = _widened(kind, text, a, b)
                if score >= MARGIN and plausible(kind, text[a:b]) and _ANCHOR.search(text, a, b):
                    drawn[-1].append((score, a, b, kind))
        out = []
        for text_base, more in zip(base, drawn):
            taken = sorted((a, b) for _, a, b in text_base)
            reach, far = [], 0
            for _, b in taken:
                far = max(far, b)
                reach.append(far)
            starts = [a for a, _ in taken]
            free = [s for s in more if not ((i := bisect_right(starts, s[2] - 1)) and reach[i - 1] > s[1])]
            out.append(sorted([(k, a, b, True) for k, a, b in text_base] + [(k, a, b, False) for k, a, b in _reconcile(free)]))
        return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, and how many the tagger added."""
    params = docs.sparkSession.sparkContext.broadcast(train(sample_passages(docs)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(params.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = []
                for doc, spans in zip(batch.column("doc_id").to_pylist(), finder.find([t or "" for t in batch.column("text").to_pylist()])):
                    base = [s[:3] for s in spans if s[3]]
                    rows.append((doc, *(sum(k == n for k, _, _ in base) for n in range(4)), hashlib.sha256(_joined(base).encode()).hexdigest(),
                                 _joined([s[:3] for s in spans]), len(spans) - len(base)))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=[f.split()[0] for f in SCHEMA.split(", ")])
    return docs.select("doc_id", "text").mapInArrow(look, SCHEMA)


def _redacted(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b, _ in spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a column n_chars follows the new text."""
    params, schema = docs.sparkSession.sparkContext.broadcast(train(sample_passages(docs))), docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(params.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").to_pylist()
                new = pa.array([None if t is None else _redacted(t, s) if s else t for t, s in zip(texts, finder.find([t or "" for t in texts]))],
                               batch.schema.field("text").type)
                columns = [new if f.name == "text" else pc.utf8_length(new).cast(f.type) if f.name == "n_chars" else batch.column(f.name) for f in batch.schema]
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    return docs.mapInArrow(clean, schema)
