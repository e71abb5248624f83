"""Toxicity: class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts. Either discounts its own
counts of words and backs off to those of word beginnings (``STEM`` bytes) with
the letters after them, and then to letters alone, four at a time; those are
discounted again and back off to one continuation model shared by both
classes. So an expression that is rare, or an unseen form of a known one, is
judged by counts that do not come from a single text. Counts are of texts, not
of occurrences, and copies in the sample count once.

A text is judged by the difference of its log-likelihoods under the two
models, normalised by length: that of the whole text, and, so that a short
insult in a long text counts, the greatest of its runs of ``NEIGHBOURS`` words
and of its words. A logistic curve fitted on cross-validated differences,
weighed to the classes' true proportions, turns the three into a probability.

Models are fitted on a bounded sample (``PER_CLASS`` rows of either label);
scoring is a narrow pass over whole texts with the sample's words and
beginnings and two tables of ``40**4`` letter groups.

Defined results: null and empty texts, and texts without letters, have no
evidence and score the curve's value at 0; with labels of one class or none,
every score is that class's (or 0.5); a null doc_id is not held out.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, annotate, binaries, field
from .labelled import balance, logistic, remainder, sample, sigmoid

PER_CLASS = 2000
#: Absolute discounts, and powers of a stretch's length that normalise it, that cross-validation chooses from.
DISCOUNTS = (0.75, 0.95)
POWERS = (0.5, 1.0)
NEIGHBOURS = 4
STEM = 5
FOLDS = 2
THRESHOLD = 0.7
MODULUS, KEPT_OUT = 3, 1
#: Symbols: 0 word boundary, 1-26 letters, 27 any digit, 28-39 bytes of other characters.
BASE = 40
_SYMBOL = bytes(
    b - 0x60 if 0x61 <= b <= 0x7A else 27 if 0x30 <= b <= 0x39 else 28 + b % 12 if b >= 0x80 else 0 for b in range(256)
)
#: Words that are worked through at a time.
PIECE = 1 << 16


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(four-symbol numbers ending at each symbol, word starts, word lengths with their end).

    Words stand between three boundaries each, so no context reaches into
    another word.
    """
    s = np.frombuffer((b"\0\0\0" + b"\0\0\0".join(words) + b"\0").translate(_SYMBOL), np.uint8).astype(np.int32)
    key = ((s[:-3] * BASE + s[1:-2]) * BASE + s[2:-1]) * BASE + s[3:]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return key, np.concatenate([[0], np.cumsum(sizes[:-1] + 2)]), sizes


class Counts:
    """In how many texts of each class each four-symbol group, and each word, stands."""

    def __init__(self, texts: list[list[bytes]], y: np.ndarray):
        self.n = np.zeros((2, BASE**4), np.float32)
        self.words: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
        self.stems: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
        for words, label in zip(texts, y, strict=True):
            kinds = list(set(words))
            self.words[label].update(kinds)
            self.stems[label].update({w[:STEM] for w in kinds})
            if kinds:
                self.n[label, np.unique(grams(kinds)[0])] += 1


def shared_model(kept: np.ndarray) -> np.ndarray:
    """P(x | two symbols) from continuation counts over both classes, down to the uniform."""
    three = (kept.reshape(BASE, BASE, BASE, BASE) > 0).sum(axis=0).astype(np.float32)
    two = (three > 0).sum(axis=0).astype(np.float32)
    one = (two > 0).sum(axis=0).astype(np.float32)
    p = np.full(BASE, 1 / BASE, np.float32)
    for counts in (one, two, three):
        left = np.maximum(counts - 0.75, 0)
        total = counts.sum(axis=-1, keepdims=True)
        p = left / np.maximum(total, 1) + (1 - left.sum(axis=-1, keepdims=True) / np.maximum(total, 1)) * p
    return p


def letter_logs(seen: Counts, discount: float) -> list[np.ndarray]:
    """log P(a symbol after three) of either class, for all groups."""
    back = shared_model(seen.n.sum(axis=0))
    logs = []
    for n in seen.n.reshape(2, BASE**3, BASE):
        total = np.maximum(n.sum(axis=1, keepdims=True), 1)
        left = np.maximum(n - discount, 0)
        p = left / total + (1 - left.sum(axis=1, keepdims=True) / total) * np.tile(back.reshape(BASE**2, BASE), (BASE, 1))
        logs.append(np.log(np.maximum(p, 1e-12)).reshape(-1))
    return logs


class Discounted:
    """Discounted shares of either class's own counts, and what is left to the level below."""

    def __init__(self, counts: tuple[Counter[bytes], Counter[bytes]], discount: float):
        kinds = sorted(set(counts[0]) | set(counts[1]))
        self.place = Places((w, i) for i, w in enumerate(kinds))
        self.own, self.rest = [], []
        for mine in counts:
            total = max(1, sum(mine.values()))
            kept = np.array([max(mine[w] - discount, 0) / total for w in kinds] + [0.0])
            with np.errstate(divide="ignore"):
                self.own.append(np.log(kept))
            self.rest.append(float(np.log(max(1e-9, 1 - kept.sum()))))

    def places(self, of: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, of), np.int64, len(of))

    def logs(self, label: int, at: np.ndarray, below: np.ndarray) -> np.ndarray:
        return np.logaddexp(self.own[label][at], self.rest[label] + below)


class Models:
    """Both classes' log probabilities of words: of the words, over their beginnings, over letters."""

    def __init__(self, seen: Counts, discount: float):
        self.letters = letter_logs(seen, discount)
        self.words, self.stems = Discounted(seen.words, discount), Discounted(seen.stems, discount)

    def difference(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(log P_toxic / P_ordinary, length) of each word."""
        key, starts, sizes = grams(words)
        stems, whole = self.stems.places([w[:STEM] for w in words]), self.words.places(words)
        middle, ends = starts + np.minimum(sizes - 1, STEM), starts + sizes
        logs = []
        for label in (0, 1):
            sums = np.concatenate([[0.0], np.cumsum(self.letters[label][key], dtype=np.float64)])
            begun = self.stems.logs(label, stems, sums[middle] - sums[starts])
            logs.append(self.words.logs(label, whole, begun + sums[ends] - sums[middle]))
        return logs[1] - logs[0], sizes


class Places(dict):
    """Places of known words; the last place for every other."""

    def __missing__(self, word: bytes) -> int:
        return -1


def evidence(words: list[bytes], models: Models, power: float) -> tuple[float, float, float]:
    """Log-likelihood differences normalised by length: (strongest word, strongest run of words, whole text)."""
    if not words:
        return 0.0, 0.0, 0.0
    # Words stand alone, so a text can be cut between any two.
    parts = [models.difference(words[at : at + PIECE]) for at in range(0, len(words), PIECE)]
    each, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    k = min(NEIGHBOURS, len(each))
    run, length = (np.concatenate([[0.0], np.cumsum(x)]) for x in (each, sizes))
    near = (run[k:] - run[:-k]) / (length[k:] - length[:-k]) ** power
    return float((each / sizes**power).max()), float(near.max()), float(run[-1] / length[-1])


def without_copies(texts: list[list[bytes]], y: np.ndarray) -> np.ndarray:
    """Numbers of the texts of which at most half of the eight-word runs stood in an earlier one of their class."""
    seen: set[int] = set()
    kept = []
    for i, words in enumerate(texts):
        runs = {zlib.crc32(b" ".join((b"%d" % y[i], *words[j : j + 8]))) for j in range(max(1, len(words) - 7))}
        if 2 * len(runs & seen) <= len(runs):
            kept.append(i)
        seen |= runs
    return np.array(kept, int)


def fit(rows: list[tuple[int, list[bytes]]], totals: dict[int, int]):
    """(models, power, curve); discount and power are those of least cross-validated log loss."""
    y = np.array([r[0] for r in rows], int)
    if len(set(y)) < 2:
        return None, 0.0, float(y[0]) if len(y) else 0.5
    own = without_copies([r[1] for r in rows], y)
    weight, y, texts = balance(y, totals)[own], y[own], [rows[i][1] for i in own]
    fold = np.arange(len(y)) % FOLDS
    out = {(d, p): np.zeros((len(y), 3)) for d in DISCOUNTS for p in POWERS}
    for f in range(FOLDS):
        train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        seen = Counts([texts[i] for i in train], y[train])
        for d in DISCOUNTS:
            models = Models(seen, d)
            for p in POWERS:
                out[d, p][test] = [evidence(texts[i], models, p) for i in test]
    curves = {c: logistic(x, y, weight) for c, x in out.items()}

    def loss(c) -> float:
        p = np.clip(sigmoid(out[c] @ curves[c][:-1] + curves[c][-1]), 1e-6, 1 - 1e-6)
        return -float((weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean())

    best = min(out, key=loss)
    return Models(Counts(texts, y), best[0]), best[1], curves[best]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, modulus: int = MODULUS, kept_out: int = KEPT_OUT):
    rows, totals = sample(docs, labels, label, per_class, modulus, kept_out)
    found = sorted(rows.select("doc_id", "y", F.col("text").cast("binary").alias("b")).collect(), key=lambda r: (r["doc_id"], r["y"], bytes(r["b"])))
    return fit([(r["y"], alnum_words(bytes(r["b"]))) for r in found], totals)


def with_scores(docs: DataFrame, fitted, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1."""
    models, power, curve = fitted

    def start():
        if models is None:
            return lambda batch: [pa.array([curve] * batch.num_rows, pa.float64())]

        def one(x: bytes | None) -> float:
            return float(sigmoid(float(np.dot(curve, (*evidence(alnum_words(x), models, power), 1.0)))))

        return lambda batch: [pa.array([one(x) for x in binaries(batch, text)], pa.float64())]

    return annotate(docs, [field(name, "double")], start)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", "text")
    held_out = F.coalesce(remainder(F.col("doc_id"), MODULUS) == KEPT_OUT, F.lit(False))
    scored = with_scores(rows, train(rows, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
