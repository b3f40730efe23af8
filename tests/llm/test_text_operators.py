"""Text operators against brute force, and on the awkward rows that their docstrings define."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.llm import bagminhash, decontaminate, html, language, licenses, mixture, pii, quality, secrets, voronoi, words
from terrane.llm.tagger import Tagger

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
SYLLABLES = "ba be bi bo bu da de di do du la le li lo lu ma me mi mo mu ra re ri ro ru".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4))) for _ in range(n))


def frame(spark, rows, clash=()):
    """Documents from (id, text) or whole rows, with extra columns."""
    rows = [(*r, "en", "s", len(r[1] or "")) if len(r) == 2 else r for r in rows]
    df = spark.createDataFrame(rows, DOCS)
    for c in clash:
        df = df.withColumn(c, F.lit("x"))
    return df


AWKWARD = [(1, None), (2, ""), (3, "   \n\t"), (4, "x"), (5, "ünïcödé 😀 text"), (6, "word " * 60000), (7, "same"), (7, "same"), (None, "no id here"), (None, None)]


# ---- words

def test_word_hashes_follow_words():
    import pyarrow as pa
    texts = ["The cat  sat\nthe CAT", "", None, "é the", "cat"]
    (a, b, raw, off), = words.slices(pa.array(texts))
    w = words.Words(raw, off)
    assert w.count().tolist() == [5, 0, 0, 2, 1]
    names = [x for t in texts for x in (t or "").lower().split()]
    seen = dict(zip(names, w.hash))
    assert all(seen[n] == h for n, h in zip(names, w.hash)) and len(set(seen.values())) == len(set(names))
    doc, value = w.shingles()
    assert doc.tolist() == [0, 3, 4]


def test_slices_cover_all_rows():
    import pyarrow as pa
    texts = ["a" * n for n in (0, 5, 3000, 10, 0, 7)]
    parts = list(words.slices(pa.array(texts).slice(1), limit=100))
    assert [p[:2] for p in parts] == [(0, 1), (1, 2), (2, 5)]
    assert b"".join(p[2].tobytes() for p in parts).decode() == "".join(texts)


# ---- 1 personal data

def naive_pii(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_personal_data_is_that_of_the_patterns(spark):
    rng, parts = random.Random(1), ["a@b.c", "@", ".", "x.y@z", "@q.w.e", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111", "+1 (555) 123-4567",
                                     "+", "12345678", " ", "-", "é", "a", "+49 30 1", "0", "(", ")"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert all(pii.base_spans(t) == naive_pii(t) for t in texts)
    pii.base_spans("1" * 200_000 + "a@" * 50_000 + "a" * 200_000)  # linear, or this never ends


def test_tagger_gradients_are_the_losss_slopes():
    t = Tagger(2, hidden=3)
    t.p, t.limit = {k: v.astype(np.float64) for k, v in t.p.items()}, t.limit.astype(float)
    ids = np.random.default_rng(0).integers(0, 98, (3, 7))
    y = np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [1, 2, 0, 3, 4, 4, 0]])
    g = t.gradients(ids, y)[1]
    for k in t.p:
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        at = t.p[k][i]
        t.p[k][i] = at + 1e-3
        up = t.gradients(ids, y)[0]
        t.p[k][i] = at - 1e-3
        down = t.gradients(ids, y)[0]
        t.p[k][i] = at
        assert g[k][i] == pytest.approx((up - down) / 2e-3 * 7, rel=1e-2)


def test_viterbi_finds_the_best_path():
    from itertools import product
    t = Tagger(1, hidden=2)
    t.p["t"] = np.random.default_rng(1).normal(size=(4, 3)).astype(np.float32)
    e = np.random.default_rng(2).normal(size=(4, 5, 3)).astype(np.float32)
    trans = t.p["t"] + t.limit
    for row, path in zip(e, t.decode(e)):
        def score(p):
            return trans[-1][p[0]] + sum(row[i][k] for i, k in enumerate(p)) + sum(trans[a][b] for a, b in zip(p, p[1:]))
        assert score(path) == pytest.approx(max(map(score, product(range(3), repeat=5))), rel=1e-5)


@pytest.fixture(scope="session")
def found_pii(spark):
    rng = random.Random(3)
    docs = frame(spark, [(i, prose(rng, 60)) for i in range(20, 60)] + AWKWARD + [
        (100, "call (555) 123-4567 or write jane_doe @ mail.example.org today"), (101, "the card 3782 822463 10005 was used at noon"),
        (102, "on 2021-03-04 at 12:34:56 version 2.0 of 4111 1111 1111 1112"), (103, "a@b.co " * 20000)], clash=("n_email", "spans"))
    return {r.doc_id: r for r in pii.find(docs).collect()}, docs


def test_added_spans_and_awkward_rows(found_pii):
    found, docs = found_pii
    assert len(pii.find(docs).collect()) == docs.count()
    text = "call (555) 123-4567 or write jane_doe @ mail.example.org today"
    kinds = [s.split(":")[0] for s in found[100].spans.split(",")]
    assert "email" in kinds and found[100].n_phone == 0
    assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in (s.split(":") for s in found[100].spans.split(",")))
    assert found[101].spans == "card:9:26" and found[102].spans == ""
    assert found[103].n_email == 20000 and len(found[103].spans.split(",")) == 20000
    for i in (1, 2, 3, 4, 5, 6, 7):
        assert (found[i].n_email, found[i].spans, found[i].base_sha256) == (0, "", hashlib.sha256(b"").hexdigest())


def test_tagger_on_held_out_values():
    rng = random.Random(16)
    passages = [prose(rng, 80) for _ in range(50)]
    tagger = Tagger(len(pii.KINDS))
    tagger.p = pii.train(passages)
    ids, y = pii.training_windows(passages, 400, seed=99)
    path = tagger.decode(tagger.emissions(ids))
    assert (path == y)[y > 0].mean() > 0.95 and ((path > 0) & (y == 0)).sum() < 0.03 * (y > 0).sum()


def test_overlapping_windows_are_reconciled_to_the_best_total():
    rng = random.Random(4)
    for _ in range(200):
        spans = [(rng.randint(1, 9) / 2, a, a + rng.randint(1, 6), rng.randint(0, 3)) for a in (rng.randint(0, 15) for _ in range(7))]
        best = 0.0
        for mask in range(1 << 7):
            some = sorted((s[1], s[2], s[0]) for i, s in enumerate(spans) if mask >> i & 1)
            if all(x[1] <= y[0] for x, y in zip(some, some[1:])):
                best = max(best, sum(s[2] for s in some))
        got = pii._reconcile(spans)
        score = {(k, a, b): 0 for k, a, b in got}
        for s, a, b, k in spans:
            if (k, a, b) in score:
                score[k, a, b] = max(score[k, a, b], s)
        assert sum(score.values()) == pytest.approx(best)


def test_redaction_replaces_every_span(spark):
    out = {r.doc_id: r for r in pii.redact(frame(spark, [(1, "mail a.b@c.org now"), (2, None), (3, "+1 (555) 123-4567")], clash=("spans",))).collect()}
    assert (out[1].text, out[1].n_chars, out[1].spans) == ("mail [EMAIL] now", 16, "x")
    assert out[2].text is None and out[3].text == "[PHONE]"


# ---- 2 decontamination

def test_myers_distance_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(lo, hi))) for lo, hi in ((1, 12), (0, 30)))
        prev = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            cur = [i]
            for j, d in enumerate(t, 1):
                cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
            prev = cur
        assert decontaminate.best_distance(p, t)[0] == min(prev)


def test_pigeonhole_matches_equal_brute_force(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(3, 60))) for i in range(12)]
    rows = []
    for n in range(60):
        text, (item, passage) = prose(rng, 80), rng.choice(items)
        if n % 2:
            chars = list(passage)
            for _ in range(rng.randint(0, len(chars) // 10)):
                k = rng.randrange(len(chars))
                chars[k] = rng.choice(["", "z", chars[k] + "q"])
            text = text[:100] + " " + "".join(chars) + " " + text[100:]
        rows.append((n, text))
    want = set()
    for n, text in rows:
        for item, passage in items:
            for p in decontaminate.passages(passage):
                if decontaminate.best_distance(p, decontaminate.folded(text))[0] <= decontaminate.edits_allowed(len(p)):
                    want.add((n, item))
    bench = spark.createDataFrame(items + [(99, None), (98, ""), (None, "x" * 50)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(frame(spark, rows + AWKWARD), bench).collect()}
    assert got == want and want
    kept = decontaminate.keep(frame(spark, rows + AWKWARD, clash=("distance",)), bench)
    assert kept.columns[-1] == "distance"
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([i for i, _ in rows if i not in {d for d, _ in want}] + [i or 0 for i, _ in AWKWARD])
    assert decontaminate.report(frame(spark, rows), bench.limit(0)).count() == 0


def test_edited_periodic_passages_equal_brute_force():
    rng = random.Random(4)
    for n in range(300):
        part = rng.choice([" press the button", " ----------", " 0000 0000", " again and again"])
        passage = decontaminate.folded(prose(rng, 2) + part * rng.randint(2, 4) + " " + prose(rng, 2) + part * rng.randint(0, 2) + " " + prose(rng, 2))
        passage = " ".join(passage.split(" ")[:24])
        k, chars = decontaminate.edits_allowed(len(passage)), list(passage)
        for _ in range(rng.randint(1, k)):
            at = rng.randrange(len(chars) // (1 + n % 3))  # also with the edits in the first pieces only
            chars[at] = rng.choice(["", "z", chars[at] + "q"])
        text = decontaminate.folded(prose(rng, 8) + " " + "".join(chars) + part * rng.randint(0, 3) + " " + prose(rng, 8))
        want = decontaminate.best_distance(passage, text)[0]
        assert decontaminate.Matcher([(1, passage)])(text) == ({1: want} if want <= k else {})


def test_every_copied_fragment_of_24_words_is_found(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, 24 + 7 * i)) for i in range(6)]
    rows, want = [], set()
    for item, text in items:
        w = text.split(" ")
        for size in (24, 26, 30):
            for a in range(len(w) - size + 1):  # brute force: every fragment of the item, at its own place
                rows.append((len(rows), prose(rng, 9) + " " + " ".join(w[a: a + size]) + " " + prose(rng, 9)))
                want.add((len(rows) - 1, item))
    got = decontaminate.matches(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and {r.distance for r in got} == {0}


def test_short_items_match_verbatim_as_whole_words(spark):
    items = [(1, "What is 2 + 2?"), (2, "cat"), (3, "Paris, France")]
    rows = [(1, "so what is\n2 + 2? easy"), (2, "concatenate"), (3, "The CAT."), (4, "paris, franc"), (5, "(Paris,  France)"), (6, "what is 2 + 3?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(frame(spark, rows), bench).collect()} == {(1, 1), (3, 2), (5, 3)}
    assert sorted(r.doc_id for r in decontaminate.keep(frame(spark, rows), bench).collect()) == [2, 4, 6]


def test_portions_cover_the_benchmark(spark):
    bench = spark.createDataFrame([(i, "y" * 40) for i in range(20)], "item_id long, text string")
    parts = list(decontaminate.portions(bench, limit=100))
    assert len(parts) == 10 and sorted(i for p in parts for i, _ in p) == list(range(20))


# ---- 3 mixture

def test_targets_reshare_the_excess():
    t = mixture.targets({"a": 10, "b": 1000, "c": 1000, None: 30})
    assert t["a"] == 20 and t[None] == 60
    left = 1.5 * 2040 - 80
    assert t["b"] == pytest.approx(left / 3) and t["c"] == pytest.approx(left * 2 / 3)
    assert sum(mixture.targets({"a": 5}).values()) == 7.5


def test_mixture_takes_the_targets(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(0, 400)), "en", rng.choice(["a", "a", "a", "b", "c", "Z", None]), 0) for i in range(400)]
    rows += [(900, None, "en", "a", 0), (901, "", "en", "lone", 0), (902, "two words", "en", "tiny", 0), (5, "again again", "en", "a", 0), (5, "again again", "en", "a", 0)]
    docs = frame(spark, rows, clash=("size", "cell"))
    out = mixture.mix(docs).collect()
    assert len(out) == len(rows)
    size = collections.Counter()
    for _, text, _, source, _ in rows:
        size[source] += len((text or "").split())
    goal, got = mixture.targets(dict(size)), collections.Counter()
    for r in out:
        got[r.source] += r.taken
        assert r.source_size == size[r.source] and r.target == pytest.approx(goal[r.source]) and 0 <= r.taken <= 2 * r.size
    assert all(abs(got[s] - goal[s]) <= 1 for s in size)
    again = mixture.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in out)
    drawn = mixture.draw(docs)
    assert drawn.columns == [*docs.columns, "taken", "first_slot"] and sum(r.taken for r in drawn.collect()) == sum(got.values())
    assert mixture.mix(docs.limit(0)).count() == 0


def test_schedule_is_spread_evenly(spark):
    plan = [(0, 256 * 300), (1, 256 * 100), (2, 256 * 50)]
    rows = mixture.schedule(spark, plan).collect()
    per = collections.defaultdict(list)
    for r in rows:
        per[r.source_no].append((r.rank, r.slot))
    assert {s: len(v) for s, v in per.items()} == {0: 300, 1: 100, 2: 50}
    for s, v in per.items():
        assert [r for r, _ in sorted(v)] == list(range(len(v)))
        share = len(v) / 450
        assert all(abs((r + 1) - (slot + 1) * share) <= 10 for r, slot in v)


def test_the_schedule_decides_the_order_of_the_mix(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(1, 60)), "en", rng.choice("aaabc"), 0) for i in range(900)]
    docs = frame(spark, rows)
    out = [r for r in mixture.mix(docs, percent=50, block=16).collect() if r.taken]    # no source is read twice
    total, seen = collections.Counter(), collections.Counter()
    for r in out:
        total[r.source] += r.taken
    whole = sum(total.values())
    for r in sorted(out, key=lambda r: r.first_slot):
        seen[r.source] += r.taken
        assert all(abs(seen[s] - total[s] * sum(seen.values()) / whole) <= 300 for s in total)   # a few documents of each source
    assert all(r.first_slot is None for r in mixture.mix(frame(spark, [(1, ""), (2, None)])).collect())

    def end_to_end(spark, plan, block):
        need, at, slots = [(s, -(-w // block)) for s, w in plan if w > 0], 0, []
        for s, n in need:
            slots += [(s, r, at + r) for r in range(n)]
            at += n
        return spark.createDataFrame(slots, "source_no int, rank long, slot long")
    monkeypatch.setattr(mixture, "schedule", end_to_end)
    other = {r.doc_id: r.first_slot for r in mixture.mix(docs, percent=50, block=16).collect()}
    assert any(other[r.doc_id] != r.first_slot for r in out)


# ---- 4 secrets

def naive_secrets(text):
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(0, *m.span()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(2, *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_secrets(spark):
    rng = random.Random(6)
    parts = ["password", "Token", "api_key", "=", ":", " ", '"', "'", "abc123", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef" * 2, "é", "ſecret", "\n", "secret"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    assert all(secrets.base_spans(t) == naive_secrets(t) for t in texts)
    secrets.base_spans("f" * 100_000 + "token" * 20_000)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    rows = [(200, f"the bearer {key} opens it"), (201, "token name client_secret_key_2 in settings.py"), (202, "secret xxxxxxxxxxxxxxxx1 placeholder"), (203, 'token = "' + "ab1" * 14 + '"')]
    out = {r.doc_id: r for r in secrets.find(frame(spark, rows + AWKWARD, clash=("spans",))).collect()}
    assert out[200].spans == f"novel:11:{11 + 40}" and out[200].n_novel == 1
    assert out[201].spans == "" and out[202].spans == "" and out[203].n_assign == 1
    assert all(out[i].spans == "" for i in (1, 2, 3, 4, 5, 6, 7)) and secrets.find(frame(spark, [])).count() == 0


def test_secrets_of_any_length_and_letters_only():
    rng = random.Random(7)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    novelty = secrets.Novelty([])
    for n in (16, 24, 512, 513, 1600, 20_000):
        for key in (draw(letters, n), draw(letters + "0123456789+/", n)):
            text = f"the bearer {key} opens it"
            assert [(a, b) for a, b, _ in secrets.spans(text, novelty)[1]] == [(11, 11 + n)]
    assert secrets.spans("secret " + "a" * 5000 + " and token " + "abcd1" * 300, novelty)[1] == []
    assert list(secrets.candidates("token" * 50_000 + " " + "k" * 20)) == [(250_001, 250_021)]


@pytest.mark.parametrize("before", ["private_key=", "pwd=", "signature=", "connection_string=", "bearer/", "auth: key=", "auth: ", "client_id_value=", "credential.name="])
def test_the_value_of_an_assignment_in_one_run_is_a_candidate(before):
    key = "Zx81kLmQp93vTy7RwB20qWc"
    text = f"first {before}{key} then"
    assert [(a, b) for a, b, _ in secrets.spans(text, secrets.Novelty([]))[1]] == [(6 + len(before), 6 + len(before) + len(key))]


def naive_candidates(text):
    """Whole runs after a word of sensitive meaning, from the value on where a name is assigned."""
    runs = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text)]
    out = set()
    for w in secrets._CONTEXT.finditer(text):
        for a, b in runs:
            if w.end() <= a <= w.end() + secrets.REACH:
                m = re.match(r"[A-Za-z_][A-Za-z0-9_.-]{0,63}=(?=[A-Za-z0-9+/_.-])", text[a:b])
                out.add((a + (m.end() if m else 0), b))
            elif a < w.end() < b and (m := re.match(r"[A-Za-z0-9_.-]{0,64}[=/]+(?=[A-Za-z0-9+_.-])", text[w.end():b])):
                out.add((w.end() + m.end(), b))
    return sorted((a, b) for a, b in out if b - a >= secrets.MIN_CHARS)


def test_candidates_equal_brute_force():
    rng, parts = random.Random(13), ["token", "pwd", "auth", "bearer", "=", "/", " ", ": ", "name", "k3Y" * 8, "abcdefghijklmnop", "+", ".", "é", "\n" + " " * 40]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        got, want = list(secrets.candidates(text)), naive_candidates(text)
        # of candidates that overlap (a sensitive word within a value) the first stays
        first = [s for i, s in enumerate(want) if not any(a < s[1] and s[0] < b for a, b in want[:i])]
        assert [s for s in got if s not in want] == [] and set(first) <= set(got), (text, got, want)


def test_padded_secret_in_many_copies_stays_new(spark):
    rng = random.Random(8)
    draw = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_") for _ in range(n))
    keys = ["k" + draw(42) + "=" for _ in range(20)] + ["k" + draw(30) + ": " + draw(30) for _ in range(20)]
    rows = [(100 * i + c, f"the bearer {key} opens it") for i, key in enumerate(keys) for c in range(5)]
    rows += [(9000 + i, f"max_connections = 5\nport: {i}\nhome_folder=/usr\nabc+plus_name: 1") for i in range(3)]
    alone = {key: secrets.spans(f"the bearer {key} opens it", secrets.Novelty([]))[1] for key in keys}
    assert all(alone.values())
    docs = frame(spark, rows)
    assert sorted(secrets.corpus_names(docs)) == ["home_folder", "max_connections", "port"]
    out = {r.doc_id: r.n_novel for r in secrets.find(docs).collect()}
    assert all(out[100 * i + c] >= 1 for i in range(len(keys)) for c in range(5))


# ---- 5 quality

def test_quality_keeps_good_documents(spark):
    rng = random.Random(7)
    good = [(i, ". ".join(prose(rng, 8).capitalize() for _ in range(rng.randint(2, 10)))) for i in range(200)]
    junk = [(1000 + i, " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in prose(rng, 60).split())) for i in range(40)]
    labels = [(i, 1, 0) for i, _ in good[:80]] + [(i, 0, 0) for i, _ in junk[:20]] + [(None, 1, 0), (3, None, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = frame(spark, good + junk + AWKWARD, clash=("log_weight", "key"))
    kept = collections.Counter(r.doc_id for r in quality.keep(docs, lab).collect())
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)
    assert kept == collections.Counter(r.doc_id for r in quality.resample(docs, lab).collect())
    assert quality.keep(docs, lab).columns == docs.drop("log_weight").columns or "log_weight" in docs.columns
    assert quality.keep(docs, lab.limit(0)).count() == docs.count() and quality.keep(docs.limit(0), lab).count() == 0


def test_features_are_counted_as_by_hand():
    import pyarrow as pa
    texts = ["one two three one two three", "", "a", "b a", "one two three one two three"]
    (_, _, raw, off), = words.slices(pa.array(texts))
    doc, bucket, rows = quality._features(raw, off)
    w = [t.split() for t in texts]
    repeats = lambda x: sum(x[i] == x[i - lag] for lag in range(1, 5) for i in range(lag, len(x)))
    want = [2 * len(x) + 2 * max(0, len(x) - 1) + max(0, len(x) - 2) + repeats(x) for x in w]
    assert rows == 5 and np.bincount(doc, minlength=5).tolist() == want
    assert sorted(bucket[doc == 0]) == sorted(bucket[doc == 4])


def test_weights_and_draw_equal_brute_force(spark):
    rng = random.Random(15)
    rows = [(i, prose(rng, rng.randint(5, 60)) + ("!!! $$$ %%%" * 3 if i % 4 == 0 else ".")) for i in range(200)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(120)]
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    import pyarrow as pa
    counts, target, own = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS), {}
    for i, text in rows:
        (_, _, raw, off), = words.slices(pa.array([text]))
        own[i] = np.bincount(quality._features(raw, off)[1], minlength=quality.BUCKETS)
        counts += own[i]
        target += own[i] * (i < 120 and i % 4 != 0)
    logp = lambda c: np.log(c + quality.SMOOTHING) - np.log(c.sum() + quality.SMOOTHING * quality.BUCKETS)
    weight = {i: float(own[i] @ (logp(target) - logp(counts))) for i in own}
    scores, _, cut = quality.select(docs, lab)
    seen = {r.doc_id: (r.log_weight, r.key) for r in scores.collect()}
    assert {i: w for i, (w, _) in seen.items()} == pytest.approx(weight)
    tau = quality.threshold(np.array([weight[i] for i, _, _ in labels]), np.array([q for _, q, _ in labels]))
    k = sum(w >= tau - 1e-9 for w in weight.values())
    best = sorted((key for _, key in seen.values()), reverse=True)[:k]
    assert sorted(r.key for r in quality.resample(docs, lab).collect()) == pytest.approx(sorted(best))


def test_kth_key_is_the_order_statistic(spark):
    rng = random.Random(8)
    values = [rng.gauss(0, 5) for _ in range(500)] + [1.0] * 20
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 7, 250, 520):
        cut = quality.kth_key(keys, k)
        want = sorted(values)[-k]
        assert sum(v >= cut for v in values) == sum(v >= want for v in values)


# ---- 6 HTML

@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b <b>c</b> d<ul><li>one<li>two<ol><li>x<li>y</ol></ul>end", "a\n\nb c d\n\n* one\n* two\n  1. x\n  2. y\n\nend"),
    ("<table><tr><td>a<td>bbb<tr><th>cccc<td>d</table>", "a    | bbb\ncccc | d"),
    ("<table><caption>T</caption><tr><td colspan=2>wide cell here<tr><td>1<td>2</table>", "T\nwide cell here\n1 | 2"),
    ("plain < text &amp; more <", "plain < text & more <"),
    ("<pre>a\n  b</pre>x", "a\n  b\n\nx"),
    ("<div hidden>no</div><div style='display: none'>no</div>yes<script>var a='</p>'</script>", "yes"),
    ("a<br><br>b", "a\n\nb"), ("<b>x<p>y</b>z</p>w", "x\n\ny\n\nz\n\nw"), ("<!-- c -->t<!doctype html>u", "tu"),
    ("</p>x", "x"), ("<a href='>'>l</a>", "l"), ("", ""), (None, None), ("<title>t</title>", ""), ("a<b", "a"),
    ("<select><option>a<option selected>b</select>", "a\nb"), ("<dl><dt>k<dd>v<dt>l</dl>", "k\n  v\nl"), ("x<hr>y", "x\n\n---\n\ny"),
])
def test_layout(page, text):
    assert html.to_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p>a <svg><title>no</title><desc>no</desc><defs><text>no</text></defs><path d='M0'/><text>Label <tspan>one</tspan></text><text>two</text></svg> b", "a Label one two b"),
    ("x <math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation>no</annotation></semantics></math> y", "x E=m y"),
    ("<table><tr>Total 5<td>x</table>", "Total 5\nx"), ("<svg/>after<p>b", "after\n\nb"), ("<svg><title/><text>t</text></svg>u", "tu"),
])
def test_svg_math_and_row_text_are_visible(page, text):
    assert html.to_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>", "a | b\n  | c | d"),
    ("<table><tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td colspan=1>f<td>g<tr><td>h<td>i<td>j</table>", "a | b | c\nd |   | e\nf |   | g\nh | i | j"),
    ("<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "ab    | c\n      | d\ne | f | g"),
    ("<table><tfoot><tr><td>sum<tbody><tr><td>one<thead><tr><td>head</table>", "head\none\nsum"),
    ("<table><tbody><tr><td rowspan=9>x<tbody><tr><td>y</table>", "x\ny"),
    ("<div style='visibility:hidden'>no<span style='visibility: visible'>yes</span>no</div>z", "yes\nz"),
    ("<table style='visibility:hidden'>no<tr><td>no<td style='visibility:visible'>yes</table>", " | yes"),
])
def test_spans_sections_and_visibility(page, text):
    assert html.to_text(page) == text


def test_cells_of_random_tables_keep_their_columns():
    rng = random.Random(12)
    for _ in range(300):
        rows, cols = rng.randint(1, 6), rng.randint(1, 6)
        grid, names, source = {}, iter(range(1000)), []
        for r in range(rows):
            line = "<tr>"
            for c in range(cols):
                if (r, c) in grid:
                    continue
                wide = rng.randint(1, max(k for k in range(1, cols - c + 1) if all((r, c + i) not in grid for i in range(k))))
                high, name = rng.randint(1, rows - r), next(names)
                grid |= {(r + i, c + j): name for i in range(high) for j in range(wide)}
                line += f"<td colspan={wide} rowspan={high} id={name}>"
            source.append(line)
        section = html._cells(html.parse("<table>" + "".join(source) + "</table>").children[0])[1]
        found = {}
        for r, row in enumerate(html.layout([x for part in section for x in part])):
            for at, n, cell in row:
                found |= {(r, at + i): (int(cell.attrs["id"]) if cell else found[r - 1, at + i]) for i in range(n)}
        assert found == grid


def test_tables_nested_at_any_depth():
    deep = "<table><tr><td>" * 400 + "x" + "</table>" * 400
    assert html.to_text(deep).strip() == "x"


def test_html_operator(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (1, "<p>a"), (2, None), (3, ""), (None, "<div>" * 30000 + "deep"), (4, "<" * 50000), (5, "<table><tr><td>" * 200 + "x")],
                                  "page_id long, html string").withColumn("text", F.lit(1))
    out = sorted(((r.page_id or 0), r.text, r.n_chars, r.n_lines) for r in html.extract(pages).collect() if r.text is None or len(r.text) < 100)
    assert out[:3] == [(0, "deep", 4, 1), (1, "a", 1, 1), (1, "a", 1, 1)] and (3, "", 0, 0) in out
    assert html.extract(pages).count() == 7 and html.extract(pages.limit(0)).count() == 0


# ---- 7 licences

def test_licence_join_equals_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for n in range(150):
        lines = [prose(rng, 12) for _ in range(3)]
        _, text = rng.choice(licenses.TEMPLATES)
        some = [w for w in text.split() if rng.random() > 0.15]
        lines.insert(1, " ".join(rng.sample(some, len(some))).upper() + ", " + prose(rng, 3))
        rows.append((n + 1000, "\n".join(lines) if n % 3 else " ".join(lines * 6)))
    rows += AWKWARD + [(300, "MIT license mit-license, the MIT\nLicense"), (301, "x general public license " * 3)]
    want = {}
    for n, text in rows:
        labels, found = set(), []
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        take = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s)
        w = take(lower)
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            found += at
            labels |= {label} if at else set()
        more = set(labels)
        for line in lower.split("\n"):
            lw = take(line)
            for a in range(0, max(1, len(lw) - 32), 32) if len(lw) > 64 else [0]:
                block = set(lw[a:a + 64]) if len(lw) > 64 else set(lw)
                for label, text in licenses.TEMPLATES:
                    if len(block & set(text.split())) >= 0.8 * len(set(text.split())) - 1e-9:
                        more.add(label)
        want[n] = (len(w), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(labels)), ",".join(sorted(more)))
    got = licenses.scan(frame(spark, rows, clash=("block", "spaced"))).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == want[r.doc_id], r
    assert licenses.scan(frame(spark, [])).count() == 0


def test_wrapped_licence_notices_are_found(spark):
    rng = random.Random(10)
    rows, want = [], {}
    for n in range(120):
        label, text = rng.choice([t for t in licenses.TEMPLATES if t[0] in ("bsd", "cc-by", "cc-by-nc", "mpl", "unlicense")])
        w = prose(rng, rng.randint(0, 90)).split() + text.split() + prose(rng, rng.randint(0, 90)).split()
        width = rng.randint(1, 9)
        rows.append((n, rng.choice(["\n", "\r\n", "\n * ", "\n\n"]).join(" ".join(w[a: a + width]) for a in range(0, len(w), width))))
        want[n] = label
    rows += [(500, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"),
             (501, "licensed under a Creative Commons Attribution 4.0\nInternational License.")]
    want |= {500: "bsd", 501: "cc-by"}
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(frame(spark, rows)).collect()}
    assert all(label in got[n][0].split(",") and got[n][1] > 0 for n, label in want.items())
    assert got[500] == ("bsd", 1.0) and got[501][1] == 1.0


# ---- 8 near duplicates

def multiset(text):
    w = re.findall(r"[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute_classes(rows):
    sets, parent = [multiset(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            n = sum((sets[a] & sets[b]).values())
            if n and n >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - n):
                parent[find(a)] = find(b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return {doc: low[find(i)] for i, (doc, _) in enumerate(rows)}


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = prose(rng, 1)
    return " ".join(w)


def test_near_duplicate_classes_equal_brute_force(spark):
    rng, rows = random.Random(10), []
    shared = prose(rng, 60)
    for group in range(12):
        text = prose(rng, rng.randint(30, 300))
        rows.append(text)
        for _ in range(rng.randint(0, 6)):
            text = edited(rng, text, rng.randint(0, 4))  # chains: far ends of a class are unlike
            rows.append(text)
    rows += [shared + " " + prose(rng, rng.randint(20, 80)) for _ in range(60)]  # alike, but not enough
    rows += ["a b c d e f " * 40, "a b c d e f " * 41, "a b c d e f " * 20, "Short text", "short TEXT", "one"]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in bagminhash.classes(frame(spark, rows, clash=("node", "class_id"))).collect()}
    assert got == brute_classes(rows)


def test_near_duplicate_rounds_with_few_leaders(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "FEW", 2)
    monkeypatch.setattr(bagminhash, "HEADS", 8)
    rng = random.Random(11)
    shared = prose(rng, 200)
    rows = [(i, shared + " " + prose(rng, 25 if i % 5 else 60)) for i in range(60)]
    rows += [(100 + i, edited(rng, rows[i][1], 3)) for i in range(30)]
    got = {r.doc_id: r.class_id for r in bagminhash.classes(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_links_of_a_class_are_named_spanning(spark):
    assert bagminhash.classes(frame(spark, [(1, "one text")])).columns == ["doc_id", "class_id", "class_size", "n_spanning_links"]


def test_one_of_each_class_stays(spark):
    docs = frame(spark, AWKWARD + [(30, "A b c d e f g h i j"), (31, "a b c d e f g h i j"), (32, "same")], clash=("bands",))
    kept = bagminhash.keep(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.doc_id and r.text and r.doc_id > 6) == [(7, "same"), (30, "A b c d e f g h i j")]
    assert kept.count() == 10 and bagminhash.classes(frame(spark, [])).count() == 0


def test_signatures_estimate_the_multiset_similarity():
    rng = np.random.default_rng(12)
    value = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    doc = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
    sig = bagminhash.signatures(doc, np.concatenate([value[a > 0], value[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, m=4096)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert (sig[0] == sig[1]).mean() == pytest.approx(true, abs=4 * (true * (1 - true) / 4096) ** 0.5)


def test_signatures_do_not_depend_on_what_is_signed_beside():
    rng = np.random.default_rng(17)
    doc = np.repeat(np.arange(40), rng.integers(1, 50, 40))
    value, count = rng.integers(0, 1 << 62, len(doc)).astype(np.uint64), rng.integers(1, 40, len(doc))
    whole = bagminhash.signatures(doc, value, count, 40)
    for d in range(40):
        assert (bagminhash.signatures(np.zeros((doc == d).sum(), int), value[doc == d], count[doc == d], 1)[0] == whole[d]).all()


# ---- 9 top k

def test_top_k_equals_brute_force_with_ties(spark):
    rng = random.Random(13)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.3]) for _ in range(4)]) for i in range(0, 300)]
    rows += [(1000, [0.5] * 4), (1000, [0.5] * 4), (1001, [0.5, None, 0.0, 0.0]), (1002, None), (1003, [float("nan")] * 4), (1004, [float("inf")] * 4), (1005, []),
             (1006, [9.0, 9.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want, pooled = set(), collections.defaultdict(list)  # rows of one query id are ranked together
    for q, v in good:
        if q % 20 == 0:
            pooled[q] += [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q]
    for q, every in pooled.items():
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(every)[:20])}
    got = voronoi.search(df).collect()
    assert {tuple(r) for r in got} == want
    assert voronoi.search(df.limit(0)).count() == 0 and voronoi.search(df.filter("vec_id = 0")).count() == 0


def test_top_k_in_small_groups_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(voronoi, "GROUP_QUERIES", 3)
    monkeypatch.setattr(voronoi, "TILE_ROWS", 50)
    rng = np.random.default_rng(14)
    centres = rng.normal(0, 4, (6, 8))
    rows = [(int(i), [float(x) for x in centres[i % 6] + rng.normal(0, 0.1, 8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64)
    want = set()
    for q in range(0, 400, 20):
        s = x @ x[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-s[i], i))[:20]
        want |= {(q, n + 1, i, int(s[i])) for n, i in enumerate(order)}
    assert {tuple(r) for r in voronoi.search(df).collect()} == want


def test_top_k_of_repeated_ids_and_large_values(spark):
    rng = random.Random(14)
    rows = [(i, [rng.gauss(0, 3) for _ in range(4)]) for i in range(150)] + [(20, [1.0, 2.0, 0.5, 0.0])] * 90 + [(40, [float(n), 0.0, 0.0, 0.0]) for n in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in voronoi.search(df, k=5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    for q in {i for i, _ in rows if i % 20 == 0}:
        own = [v for i, v in whole if i == q]
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for v in own for i, w in whole if i != q)[:5]
        assert [(s, i) for _, i, s in sorted(got[q])] == [(-s, i) for s, i in scored]
    with pytest.raises(ValueError):
        voronoi.search(spark.createDataFrame([(1, [1e18, 1.0]), (20, [1e18, 2.0])], "vec_id long, embedding array<double>"))


# ---- 10 language

def test_language_held_out_accuracy_and_awkward_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(frame(spark, [(5000 + (r[0] or 0), r[1], None, "s", 0) for r in AWKWARD]))
    out = {r.doc_id: r for r in language.predict(docs.withColumn("score", F.lit("x"))).collect()}
    truth = {r.doc_id: r.lang for r in docs.filter("lang is not null").collect()}
    held = [i for i in truth if out[i].held_out]
    assert {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2} == set(held)
    assert np.mean([out[i].lang_pred == truth[i] for i in held]) >= 0.97
    assert [out[5000 + i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in out.values())
    alone = language.predict(frame(spark, [(1, "abc"), (2, None)])).collect()
    assert {r.doc_id: r.lang_pred for r in alone} == {1: "en", 2: "und"}
    assert [r.lang_pred for r in language.predict(frame(spark, [(1, "abc", None, "s", 1)])).collect()] == ["und"]
    assert language.predict(frame(spark, [])).count() == 0


def test_language_sample_is_bounded_for_repeated_rows(spark, monkeypatch):
    seen, make = [], language.Model
    monkeypatch.setattr(language, "Model", lambda x, names: seen.append(collections.Counter(names)) or make(x, names))
    rows = [(None, "der hund und die katze sind im garten", "de", "s", 0)] * 500 + [(3, f"the dog number {n} and the cat", "en", "s", 0) for n in range(500)]
    language.train(spark.createDataFrame(rows, DOCS), 10)
    assert all(n <= 20 for n in seen[0].values())


def test_machines_separate():
    rng = np.random.default_rng(15)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] - x[:, 1] > 0, 1, -1)
    w = language.svm(x, y, rounds=400, cost=100)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).all()
