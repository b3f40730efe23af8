"""Spans at the ends of texts and windows: padding has no label, cut spans are joined."""

import random

import numpy as np
import pytest

from terrane.llm import pii
from terrane.llm.tagger import PAD, Tagger
from tests.llm.test_text_operators import SF, naive_pii, prose

LONG = "jonathan_alexander.montgomery_fitzgerald @ mail7.department-of-letters.example.org"


def eager(kind):
    """A tagger that labels everything it may as one span of ``kind``."""
    t = Tagger(len(pii.KINDS))
    t.p["x"][:], t.p["h"][:], t.p["o"][:], t.p["t"][:], t.p["b"][:] = 0, 0, 0, 0, 0
    t.p["b"][1 + 2 * kind], t.p["b"][2 + 2 * kind] = 5, 6
    finder = pii.Finder({})
    finder.tagger = t
    return finder


@pytest.mark.parametrize("kind", range(4))
def test_spans_end_with_the_text_whatever_is_labelled(kind):
    finder = eager(kind)
    texts = [("1.2.3.4 " * 200)[:n] for n in [*range(1, 200), 255, 256, 257, 383, 384, 385, 511, 512, 513, 1200]]
    for text, spans in zip(texts, finder._drawn(texts)):
        assert [(a, b) for _, a, b, _ in spans] == [(0, len(text))]
    assert all(b <= len(t) for t, found in zip(texts, finder.find(texts)) for _, _, b, _ in found)


def test_padding_can_only_be_outside():
    t = eager(0).tagger
    ids = np.full((2, 12), 5, np.int16)
    ids[0, 7:] = PAD
    assert t.decode(t.emissions(ids)).tolist() == [[1] + [2] * 6 + [0] * 5, [1] + [2] * 11]


def test_a_span_without_anchors_of_its_own_windows_is_whole():
    text = "x " * 300 + "a" * 700 + "@b.c " + "y " * 300       # an eager tagger joins the whole text, window by window
    (spans,) = eager(0)._drawn([text])
    assert [(a, b) for _, a, b, _ in spans] == [(0, len(text))]


@pytest.fixture(scope="module")
def trained():
    rng = random.Random(16)
    return pii.Finder(pii.train([prose(rng, 80) for _ in range(50)]))


def test_a_long_spaced_address_is_found_at_every_offset(trained):
    before, after = prose(random.Random(17), 120), prose(random.Random(18), 60)
    texts = [before[:300 + n] + " " + LONG + " and then " + after for n in range(pii.SIZE)]
    hits = [any(t[a:b] == LONG for _, a, b, _ in found) for t, found in zip(texts, trained.find(texts))]
    assert sum(hits) >= 0.95 * len(hits)


def test_a_spaced_address_longer_than_a_window(trained):
    name = ".".join(["jonathan", "alexander", "montgomery"] * 12)
    text = prose(random.Random(19), 60) + " " + name + " @ mail7.example.org now"
    (found,) = trained.find([text])
    assert any(text[a:b].endswith("@ mail7.example.org") for k, a, b, _ in found if k == 0)
    assert all(b <= len(text) for _, _, b, _ in found)


def test_base_spans_of_the_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find(docs).collect():
        spans = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        base = naive_pii(text[r.doc_id])
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        assert all(0 <= a < b <= len(text[r.doc_id]) for _, a, b in spans)
        added = sorted((a, b) for k, a, b in set(spans) - set(base))
        assert all(x[1] <= y[0] for x, y in zip(added, added[1:]))
