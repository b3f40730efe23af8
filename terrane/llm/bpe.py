"""Byte-pair encoding as a streaming transducer, and the decoder that undoes it.

Merges are applied by rank. If a text goes on to the right, that can change a
token only through a chain of merges that cross ever earlier boundaries: a
merge (u, v) that happens in one continuation and not in another moves the
boundary of certain text to the start of u, and the next one must be a later
merge (x, y) whose y starts there, so that u lies on the left edge of y. The
longest such chain over the whole merge list, weighted by the lengths of its
left parts, is the sufficient lookahead: tokens that end that far before the
end of what has been read are final. ``Stream`` reads a piece in portions,
emits tokens as they become final and holds one window, however long the piece.

A text is normalised and cut into pieces block by block as well, so besides the
text and what is asked for nothing grows with it. Short pieces, which recur, are
looked up.

The file's own settings are read (added tokens, NFC, replaced spaces, lower
case, split pattern, byte letters, word ends); settings that are not known here
raise an error.

Defined results: null is an empty text without tokens; texts of any length are
read whole; repeated rows give one row each; a null id stays null; extra
columns are left alone.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

BLOCK = 1 << 16      # characters normalised and cut at once
SHORT = 64           # letters of a piece that is looked up
CACHE = 1 << 19      # pieces held by a worker, some 200 MB
FEW = 128            # letters merged without a heap
WINDOW = 4096        # letters read at once of a long piece, beyond the lookahead
_FAR = 1 << 60

# What the file may ask for. Steps as the file words them.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be printed, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]], length: Callable[[str], int] = len) -> int:
    """The sufficient lookahead of a merge list, in letters.

    Every part of a merge must be a letter or made by an earlier merge, and no two
    merges make the same token; otherwise merges need not happen by rank alone.
    """
    left: dict[str, str] = {}        # token: left part of the merge that makes it
    reach: dict[str, int] = {}       # token u: the longest chain so far that ends with a merge (u, ...)
    longest = 0
    for u, v in merges:
        if any(length(part) > 1 and part not in left for part in (u, v)) or u + v in left:
            raise ValueError(f"merge ({u!r}, {v!r}) is not made of earlier ones")
        chain_length, edge = 0, v
        while edge is not None:
            chain_length = max(chain_length, reach.get(edge, 0))
            edge = left.get(edge)
        left[u + v] = u
        reach[u] = max(reach.get(u, 0), chain_length + length(u))
        longest = max(longest, reach[u])
    return longest


class Model:
    """Vocabulary, ranks and settings of a tokenizer file's text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = ((spec["normalizer"] or {}).get("normalizers") == NORMALIZERS and len(steps) == 2
                 and steps[0] == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
                 and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
                 and spec["decoder"] is None and spec["post_processor"] is None and model["type"] == "BPE"
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
                 and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
        if not known:
            raise ValueError("the tokenizer file asks for steps that are not known here")
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in chain(self.ids.items(), self.added.items())}
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): n for n, (a, b) in enumerate(merges)}
        self.made = [self.ids[a + b] for a, b in merges]
        self.lookahead = lookahead(merges, lambda t: len(t) - len(self.end) if self.end and t.endswith(self.end) else len(t))
        letters = byte_letters()
        self.inner, self.last = [self.ids[c] for c in letters], [self.ids[c + self.end] for c in letters]
        self.bytes = {c: b for b, c in enumerate(letters)}

    def merge(self, ids: list[int]) -> list[int]:
        """Tokens after all merges: lowest rank first, leftmost among equals."""
        return self.merge_long(ids) if len(ids) > FEW else self.merge_few(ids)

    def merge_few(self, ids: list[int]) -> list[int]:
        """By a scan for each merge."""
        rank, made = self.ranks.get, self.made
        found = [rank(pair, _FAR) for pair in zip(ids, ids[1:])]
        while found and (least := min(found)) < _FAR:
            i = found.index(least)
            ids[i: i + 2] = made[least],
            del found[i]
            if i < len(found):
                found[i] = rank((ids[i], ids[i + 1]), _FAR)
            if i:
                found[i - 1] = rank((ids[i - 1], ids[i]), _FAR)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """By a heap of the pairs."""
        n, rank = len(ids), self.ranks.get
        ids, after, before = [*ids], list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            least, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank((ids[i], ids[j])) != least:
                continue
            ids[i], ids[j] = made, _ = self.made[least], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((made, ids[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank((ids[h], made))) is not None:
                heapq.heappush(heap, (r, h))
        return [t for t in ids if t >= 0]

    @functools.cached_property
    def sizes(self) -> dict[int, int]:
        """Letters of each token."""
        return {i: len(t) - len(self.end) if self.end and t.endswith(self.end) else len(t) for t, i in self.ids.items()}


class Stream:
    """The tokens of one piece that comes in portions; holds at most a window and the lookahead."""

    def __init__(self, model: Model, window: int = WINDOW):
        self.model, self.window, self.held = model, window, b""

    def feed(self, data: bytes) -> Iterator[int]:
        """The tokens that no continuation can change."""
        m = self.model
        for at in range(0, len(data), self.window):
            self.held += data[at: at + self.window]
            # the last letter read may yet be the piece's last, which is another symbol
            final, size = len(self.held) - 1 - m.lookahead, 0
            if final <= 0:
                continue
            for token in m.merge([m.inner[b] for b in self.held]):
                if size + m.sizes[token] > final:
                    break
                size += m.sizes[token]
                yield token
            self.held = self.held[size:]

    def close(self) -> list[int]:
        data, self.held, m = self.held, b"", self.model
        return m.merge([*(m.inner[b] for b in data[:-1]), m.last[data[-1]]]) if data else []


def _opens(c: str) -> bool:
    """Nothing before ``c`` can be composed with it or moved behind it."""
    return c < "\x80" or not unicodedata.category(c).startswith("M") and not 0x1160 <= ord(c) <= 0x11FF


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """Normalised portions of a text, cut where that makes no difference."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and not _opens(text[end]):
            end += 1
        # lower case letter by letter: no final sigma
        yield unicodedata.normalize("NFC", text[at:end]).replace("Σ", "σ").lower()
        at = end


_PIECE = regex.compile(SPLIT)
# the same pieces of text that is ASCII and lower case
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_LETTERS, _OTHERS, _SPACES = (regex.compile(p) for p in (r"\p{L}*", r"[^\s\p{L}\p{N}]*", r"\s*"))


def _found(text: str) -> list[str]:
    return (_ASCII if text.isascii() else _PIECE).findall(text)


def pieces(portions: Iterable[str], long: int = BLOCK) -> Iterator[list[str] | Iterator[str]]:
    """The pieces of a text that comes in portions, in lists; one beyond ``long`` characters is an iterator of its parts.

    Such an iterator must be used up before the next is asked for.
    """
    source, held, done = iter(portions), "", False

    def more() -> bool:
        nonlocal held, done
        part = next(source, None)
        if part is None:
            done = True
        else:
            held += part
        return not done

    def parts() -> Iterator[str]:
        nonlocal held
        run = _LETTERS if _LETTERS.match(held).end() else _OTHERS
        while True:
            end = run.match(held).end()
            if end:
                yield held[:end]
            held = held[end:]
            if held or not more():
                return
    while more():
        space = held.rfind(" ")       # a space ends every piece
        if space >= 0:
            yield _found(held[:space])
            held = held[space:]
        if len(held) > long:
            # what ends near the end of the portion may go on, or begin a shortened verb
            found, at = [], 0
            for piece in _PIECE.finditer(held):
                if piece.end() > len(held) - 3:
                    break
                at = piece.end()
                found.append(piece[0])
            yield found
            held = held[at:]
            held = held[_SPACES.match(held).end():]
            if max(_LETTERS.match(held).end(), _OTHERS.match(held).end()) > long:
                yield parts()
    if held:
        yield _found(held)


class _Known(dict):
    """What becomes of a piece; short ones are held."""

    def __init__(self, make: Callable[[str], object]):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> object:
        run = self.make(piece)
        if len(piece) <= SHORT:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = run
        return run


class Encoder:
    """Texts to tokens; ``render`` makes something of the tokens of a piece."""

    def __init__(self, model: Model, render: Callable[[list[int]], object] = tuple):
        self.model, self.render = model, render
        self.known = _Known(lambda piece: render(self.whole(piece)))
        self.cut = regex.compile("|".join(map(regex.escape, sorted(model.added, key=len, reverse=True)))) if model.added else None

    def whole(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass")
        if len(data) > WINDOW:
            return [i for ids in self.streamed([piece]) for i in ids]
        m = self.model
        return m.merge([*(m.inner[b] for b in data[:-1]), m.last[data[-1]]])

    def streamed(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """The tokens of one piece as they become final."""
        stream = Stream(self.model)
        for part in parts:
            yield list(stream.feed(part.encode("utf-8", "surrogatepass")))
        yield stream.close()

    def runs(self, text: str) -> Iterator[object]:
        """What ``render`` makes of the tokens, piece by piece."""
        at = 0
        for found in self.cut.finditer(text) if self.cut else ():
            yield from self._plain(text[at: found.start()])
            yield self.render([self.model.added[found[0]]])
            at = found.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[object]:
        for group in pieces(blocks(text)):
            if isinstance(group, list):
                yield from map(self.known.__getitem__, group)
            else:
                yield from (self.render(ids) for ids in self.streamed(group) if ids)

    def ids(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.runs(text)))


class Decoder:
    """Tokens to text, one after the other. ``feed`` gives what a token adds, ``close`` what is left.

    Without a decoder in the file the library shows the tokens' own letters with a
    space between (``plain=False``). ``plain`` gives the text instead: letters are bytes,
    the word end is a space, and bytes become characters as soon as one is complete; bytes
    that are no character become U+FFFD.
    """

    def __init__(self, model: Model, plain: bool = False):
        self.model, self.plain, self.first = model, plain, True
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        name, m = self.model.tokens[token], self.model
        if not self.plain:
            gap, self.first = "" if self.first else " ", False
            return gap + name
        if name in m.added:
            return self.close() + name
        ends = bool(m.end) and name.endswith(m.end)
        return self.state.decode(bytes(m.bytes[c] for c in (name[: -len(m.end)] if ends else name)) + b" " * ends)

    def close(self) -> str:
        out = self.state.decode(b"", True)
        self.state.reset()
        return out

    def text(self, ids: Iterable[int]) -> str:
        return "".join([*map(self.feed, ids), self.close()])


def read(path: str) -> str:
    """A tokenizer file of the driver; its text is sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


@functools.lru_cache(maxsize=2)
def model(text: str) -> Model:
    return Model(text)


def _mapped(docs: DataFrame, spec: str, schema: str, types: list[pa.DataType], row: Callable[[str], Callable]) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id and one more), 64 at a time; ``row(spec)`` maps the second column."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = row(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                out = zip(*(one(v.as_py()) for v in batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=names)
    return docs.mapInArrow(work, schema)


def _id(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the tokens of every text."""
    def row(spec: str) -> Callable:
        encoder = Encoder(model(spec))
        return lambda text: (encoder.ids(text or ""),)
    return _mapped(docs.select("doc_id", "text"), read(path), f"{_id(docs)}, ids array<int>", [pa.list_(pa.int32())], row)


def decode(tokens: DataFrame, path: str, plain: bool = True) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); see ``Decoder`` for ``plain``."""
    def row(spec: str) -> Callable:
        m = model(spec)
        return lambda ids: (Decoder(m, plain).text(ids or ()),)
    return _mapped(tokens.select("doc_id", "ids"), read(path), f"{_id(tokens)}, text string", [pa.string()], row)


@functools.lru_cache(maxsize=1)
def _written(spec: str) -> Encoder:
    """An encoder to (tokens, their decimal ids, what they decode to), each with the space before it; kept by a worker for its next tasks."""
    m = model(spec)

    def rendered(ids: list[int]) -> tuple[int, bytes, bytes]:
        decoder = Decoder(m)
        decoder.first = False
        return len(ids), "".join(f" {i}" for i in ids).encode(), "".join(map(decoder.feed, ids)).encode()
    return Encoder(m, rendered)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the tokens and of what they decode to, both as they come."""
    def row(spec: str) -> Callable:
        encoder = _written(spec)

        def digest(text: str | None) -> tuple[int, str, str]:
            n, ids, decoded, skip = 0, hashlib.sha256(), hashlib.sha256(), 1
            runs = encoder.runs(text or "")
            while held := list(islice(runs, 4096)):
                sizes, names, letters = zip(*held)
                n += sum(sizes)
                ids.update(b"".join(names)[skip:])
                decoded.update(b"".join(letters)[skip:])
                skip = 0
            return n, ids.hexdigest(), decoded.hexdigest()
        return digest
    schema = f"{_id(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs.select("doc_id", "text"), read(path), schema, [pa.int64(), pa.string(), pa.string()], row)
