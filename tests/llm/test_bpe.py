"""The transducer against the tokenizers library: tokens, decoded text, and every way of cutting the input."""

import hashlib
import itertools
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terrane.llm import bpe
from tests.llm.test_text_operators import AWKWARD, SF, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["'s", "'r", "'re", "'ll", "'", "!", "??", "hello", " ", "\n", "  ", "é", "é", "́", "Σ", "ΑΣ", "İ", "世界", "9", "123", "<|endoftext|>", "<|", "😀",
         "a", "th", "ing", "한", "한", "\x1c", "\x85", "ǅ", "x" * 50]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def model():
    return bpe.model(bpe.read(PATH))


def texts(seed, n, most=14, without=()):
    rng = random.Random(seed)
    parts = [p for p in PARTS if p not in without]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_tokens_and_text_are_the_library_s(library, model):
    encoder = bpe.Encoder(model)
    points = ["a" + chr(c) + "b" for c in range(0x3000) if not unicodedata.category(chr(c)).startswith("C") or c < 0xA0]
    for text in texts(1, 3000) + points:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == want, text
        assert bpe.Decoder(model).text(want) == library.decode(want, skip_special_tokens=False)


def test_portions_make_no_difference():
    for block, text in itertools.product((1, 2, 3, 7, 50), texts(2, 400, without=("<|endoftext|>",))):
        got = [p for group in bpe.pieces(bpe.blocks(text, block), 2 * block) for p in (group if isinstance(group, list) else ["".join(group)])]
        assert got == bpe._PIECE.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def test_streamed_tokens_are_final(model):
    rng = random.Random(3)
    for n in range(600):
        data = "".join(rng.choice("aeinthrsd") for _ in range(rng.randint(1, 900))) if n % 3 else (rng.choice(["th", "a", "in", "the", "ahah"]) * 900)[: rng.randint(1, 900)]
        stream = bpe.Stream(model, rng.choice([16, 64, 300]))
        got = list(stream.feed(data.encode()))
        assert len(stream.held) <= model.lookahead + stream.window + max(model.sizes.values())
        assert got + stream.close() == model.merge_long([*(model.inner[ord(c)] for c in data[:-1]), model.last[ord(data[-1])]])


def test_merging_few_and_many(model):
    rng = random.Random(4)
    for _ in range(1500):
        ids = [model.inner[rng.choice(b"aeinthrsd")] for _ in range(rng.randint(0, 60))]
        assert model.merge_few([*ids]) == model.merge_long(ids)


def merged(merges, text):
    """Tokens by the merges one after the other, each from left to right."""
    tokens = list(text)
    for u, v in merges:
        out = []
        for t in tokens:
            if out and out[-1] == u and t == v:
                out[-1] = u + v
            else:
                out.append(t)
        tokens = out
    return tokens


def test_the_lookahead_suffices_for_random_merge_lists():
    rng = random.Random(5)
    for _ in range(300):
        known, merges = ["a", "b"], []
        for _ in range(rng.randint(1, 6)):
            u, v = rng.choice(known), rng.choice(known)
            if u + v not in known and len(u + v) <= 5:
                merges.append((u, v))
                known.append(u + v)
        reach = bpe.lookahead(merges)
        for _ in range(60):
            text, more = ("".join(rng.choice("ab") for _ in range(rng.randint(0, n))) for n in (14, 8))
            tokens, at = merged(merges, text + more), 0
            for n, t in enumerate(merged(merges, text)):
                at += len(t)
                if at > len(text) - reach:
                    break
                assert tokens[n] == t, (merges, text, more)


def test_a_list_that_is_not_in_order_is_refused():
    with pytest.raises(ValueError):
        bpe.lookahead([("ab", "c"), ("a", "b")])


def test_digests_and_round_trip(spark, library, model):
    rows = AWKWARD + [(20 + n, t) for n, t in enumerate(texts(6, 40))] + [(90, "ab" * 100_000 + "世" * 50_000 + "!?" * 40_000)]
    docs = frame(spark, rows, ("ids", "n_tokens", "decoded"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=repr) == sorted(want, key=repr)
    tokens = bpe.encode(docs, PATH)
    shown = {r.doc_id: r.text for r in bpe.decode(tokens.filter("doc_id is not null"), PATH, plain=False).collect()}
    assert all(sha(shown[d]) == h for d, _, _, h in want if d is not None)
    plain = {r.doc_id: r.text for r in bpe.decode(tokens.filter("doc_id is not null"), PATH).collect()}
    assert plain[5] == "ünïcödé 😀 text " and plain[2] == ""
    assert bpe.digests(docs.limit(0), PATH).collect() == []


def test_bytes_that_are_no_character(model):
    half = model.ids[bpe.byte_letters()[0xE4]]
    assert bpe.Decoder(model, True).text([half, model.ids["a</w>"], half]) == "�a �"


def test_the_small_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode(docs, PATH).collect():
        assert r.ids == library.encode(text[r.doc_id], add_special_tokens=False).ids
