"""Language identification in two steps: the family, then the language within it.

Texts become counts of hashed letter n-grams (1 to 3 letters, words bounded by
blanks). Families are found from the data: the languages' mean profiles are merged
by average linkage until about sqrt(languages) groups are left. One-versus-rest
linear support vector machines tell families apart; one-versus-one machines
separate the languages within a family, and the votes decide, ties by margin.

The machines are fitted by dual coordinate descent on a sample of ``PER_LANGUAGE``
expected documents of each language, drawn by hash from those that are not held
out; the counts that set the sampling rates cover all documents.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is
every text where nothing could be learned; with one language learned every other
text is that language; repeated rows give one row each; a null id hashes as no
text and is not held out; extra columns are left alone; texts are read whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIM = 1 << 12
PER_LANGUAGE = 400         # expected training documents of a language
FOLDS, HELD = 4, 2
ROUNDS, COST = 12, 1.0
PART = 1 << 20             # code points turned into features at once

_letters: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Lower case of every letter of the basic plane, 0 for all else."""
    if not _letters:
        t = np.zeros(1 << 16, np.uint32)
        for i in range(1 << 16):
            c = chr(i)
            if unicodedata.category(c)[0] == "L":
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _letters.append(t)
    return _letters[0]


def folded(text: str) -> np.ndarray:
    """Lower-case letters as numbers; every run of other characters is one 0."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    far = points >= 1 << 16
    out = _table()[np.minimum(points, 0xFFFF)]
    if far.any():
        letters = {int(p): ord(chr(p).lower()) if chr(p).isalpha() else 0 for p in np.unique(points[far])}
        out = np.where(far, np.array([letters.get(int(p), 0) for p in points], np.uint32), out) if len(points) else out
    out = np.concatenate([[0], out, [0]]).astype(np.uint32)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of a text, None without a letter."""
    total = None
    for a in range(0, len(text), PART):
        c = folded(text[a: a + PART]).astype(np.uint64)
        if len(c) < 3:
            continue
        one = c * np.uint64(0x9E3779B1)
        two = c[:-1] * np.uint64(0x85EBCA77) + c[1:] * np.uint64(0xC2B2AE3D) + np.uint64(1)
        three = c[:-2] * np.uint64(0x27D4EB2F) + c[1:-1] * np.uint64(0x165667B1) + c[2:] * np.uint64(0x9E3779B1) + np.uint64(2)
        h = np.concatenate([one, two, three])
        h ^= h >> np.uint64(15)
        h *= np.uint64(0x2C1B3C6D297A2D39)
        part = np.bincount((h >> np.uint64(40)).astype(np.int64) & (DIM - 1), minlength=DIM)
        total = part if total is None else total + part
    return total


def features(text: str | None) -> np.ndarray | None:
    c = counts(text) if text else None
    if c is None:
        return None
    x = np.sqrt(c).astype(np.float32)
    return x / np.linalg.norm(x)


def svm(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, cost: float = COST, seed: int = 1) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine for y = +-1, by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    w, alpha, q = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1)
    weight = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) / len(y) * 2 * cost  # both sides weigh the same
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            old = alpha[i]
            alpha[i] = min(max(old - (y[i] * (w @ x[i]) - 1) / q[i], 0.0), weight[i])
            if alpha[i] != old:
                w += (alpha[i] - old) * y[i] * x[i]
    return w


def families(profiles: np.ndarray) -> list[list[int]]:
    """Average-linkage groups of the languages' profiles (rows of length 1)."""
    groups, near = [[i] for i in range(len(profiles))], profiles @ profiles.T
    goal = max(1, round(len(profiles) ** 0.5))
    while len(groups) > goal:
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: near[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[a] = sorted(groups[a] + groups[b])
        del groups[b]
    return groups


class Model:
    def __init__(self, x: np.ndarray, labels: list[str]):
        self.names = sorted(set(labels))
        y = np.array([self.names.index(v) for v in labels], int)
        means = np.stack([x[y == i].mean(0) for i in range(len(self.names))])
        means = means - means.mean(0)  # what all languages share tells nothing
        self.families = families(means / (np.linalg.norm(means, axis=1, keepdims=True) + 1e-9))
        inside = np.array([next(f for f, g in enumerate(self.families) if i in g) for i in range(len(self.names))])
        of = inside[y]
        self.family_w = np.stack([svm(x, np.where(of == f, 1, -1)) for f in range(len(self.families))]) if len(self.families) > 1 else None
        self.pair_w = {}
        for group in self.families:
            for a, b in combinations(group, 2):
                rows = (y == a) | (y == b)
                self.pair_w[a, b] = svm(x[rows], np.where(y[rows] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores from 0 to 1: the chance of the family's margin times that of the weakest pair won."""
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
        sure = lambda m: 1 / (1 + np.exp(-4 * np.clip(m, -30, 30)))
        if self.family_w is None:
            family, score = np.zeros(len(x), int), np.ones(len(x))
        else:
            m = x @ self.family_w.T
            family = m.argmax(1)
            top = np.sort(m, 1)
            score = sure((top[:, -1] - top[:, -2]) / 2)
        names: list[str] = [""] * len(x)
        for f, group in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            if not len(rows):
                continue
            votes, margin, worst = (np.zeros((len(rows), len(group))) for _ in range(3))
            worst[:] = np.inf
            for (a, b), w in self.pair_w.items():
                if a in group:
                    s, i, j = x[rows] @ w, group.index(a), group.index(b)
                    votes[:, i] += s > 0
                    votes[:, j] += s <= 0
                    for col, v in ((i, s), (j, -s)):
                        margin[:, col] += v
                        worst[:, col] = np.minimum(worst[:, col], v)
            best = (votes + 1e-3 * np.tanh(margin)).argmax(1)
            for r, b in zip(rows, best):
                names[r] = self.names[group[b]]
            if len(group) > 1:
                score[rows] *= sure(worst[np.arange(len(rows)), best])
        return names, score


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the documents that are not held out and whose lang is known; None if there are none."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rates = {r.lang: min(1.0, per_language / r.n) for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rates:
        return None
    rate = docs.sparkSession.createDataFrame(list(rates.items()), "lang string, rate double")
    place = F.xxhash64("doc_id", "text", F.lit(9))
    chance = F.pmod(place, F.lit(1 << 20)) / float(1 << 20)
    drawn = known.select("doc_id", "lang", "text").join(F.broadcast(rate), "lang").filter(chance < F.col("rate"))
    # repeated rows are drawn together: no more than twice the documents asked for, whatever they are
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    drawn = drawn.withColumn("place", place).withColumn("turn", turn).filter(F.col("turn") <= 2 * per_language).select("lang", "text")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(g, x.tobytes()) for g, t in zip(batch.column("lang").to_pylist(), batch.column("text")) if (x := features(t.as_py())) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())], names=["lang", "x"])
    rows = sorted((r.lang, bytes(r.x)) for r in drawn.mapInArrow(look, "lang string, x binary").collect())
    if not rows:
        return None
    return Model(np.stack([np.frombuffer(x, np.float32) for _, x in rows]), [g for g, _ in rows])


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per document; only the text is read for it."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                xs = [features(t.as_py()) for t in batch.column("text")]
                names, score = ["und"] * len(xs), np.zeros(len(xs))
                some = [i for i, x in enumerate(xs) if x is not None] if model.value else []
                if some:
                    found, s = model.value.predict(np.stack([xs[i] for i in some]))
                    score[some] = s
                    for i, n in zip(some, found):
                        names[i] = n
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(look, "doc_id long, held_out boolean, lang_pred string, score double")
