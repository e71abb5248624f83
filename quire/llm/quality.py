"""Quality classifier: naive Bayes support vectors.

Features are hashed indicators of n-grams: of three bytes (A-Z lower-cased),
and of up to six words seen as symbols (does the word repeat the one before,
and what does it end in). Indicators are scaled by their class log-count
ratio, and a linear model with hinge loss is fitted by dual coordinate descent
on a bounded sample of labelled rows (``PER_CLASS`` of either label). Margins
become probabilities by a logistic curve fitted on cross-validated margins,
weighed to the classes' true proportions.

Scoring is a narrow pass with a table of ``2**BITS`` weights; a text is worked
through in pieces that overlap by as much as the longest n-gram, so its
indicators do not depend on where a piece ends.

Defined results: null and empty texts have no n-grams and get the model's
score for that; with labels of one class or none, every score is that class's
(or 0.5); a null doc_id is not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, aside, binaries, field
from .labelled import balance, logistic, remainder, sample, sigmoid

BITS = 17
PER_CLASS = 2500
#: Bytes, and words, that are worked through at a time.
PIECE = 1 << 18
FOLDS = 3
THRESHOLD = 0.3
#: The query's held-out rows: crc32 of the id modulo 5 is 0.
MODULUS, KEPT_OUT = 5, 0
_SIZE = 1 << BITS
_PLAIN, _STOP, _BAR, _SIGN = range(4)


def symbols(words: list[bytes]) -> np.ndarray:
    """3 bits a word: whether it repeats the last one, and what it ends in."""
    kinds = [
        _PLAIN if (c := w[-1]) >= 0x61 and c != 0x7C and c < 0x7F or c >= 0x80 or 0x30 <= c <= 0x39
        else _STOP if c in b".,;:!?"
        else _BAR if c == 0x7C
        else _SIGN
        for w in words
    ]
    again = np.zeros(len(words), np.int64)
    again[1:] = [a == b for a, b in zip(words, words[1:], strict=False)]
    return np.array(kinds, np.int64) | again << 2


def mark(text: bytes | None, seen: np.ndarray) -> None:
    """Set the indicators of a text in ``seen`` (``2**BITS`` flags, cleared first)."""
    seen[:] = False
    if not text:
        return
    low = text.lower()
    for at in range(0, len(low), PIECE):
        b = np.frombuffer(low[at : at + PIECE + 2], np.uint8).astype(np.uint32)
        if len(b) > 2:
            h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2_654_435_761)
            seen[h >> np.uint32(32 - BITS + 1)] = True  # the lower half of the table
    words = low.split()
    for at in range(0, len(words), PIECE):
        # The first word only tells whether the next one repeats it; five more begin the n-grams that reach into the piece.
        s = symbols(words[max(0, at - 6) : at + PIECE])[1 if at > 6 else 0 :]
        key = np.zeros(len(s), np.int64)
        for n in range(1, 7):
            if len(s) < n:
                break
            key = key[: len(s) - n + 1] << 3 | s[n - 1 :]
            if n < 6:
                seen[_SIZE // 2 + (key * 8 + n) % (_SIZE // 4)] = True
            else:
                seen[_SIZE * 3 // 4 + key * 2_654_435_761 % (_SIZE // 4)] = True


def features(rows: DataFrame) -> list[tuple[int, int, np.ndarray]]:
    """(doc_id, y, indicator numbers) of the bounded sample; texts stay on the executors."""

    def start():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            seen, out = np.zeros(_SIZE, bool), []
            for x in binaries(batch, "text"):
                mark(x, seen)
                out.append(np.flatnonzero(seen).astype(np.int32).tobytes())
            return [pa.array(out, pa.binary())]

        return work

    found = annotate(rows, [field("ids", "binary")], start).select("doc_id", "y", "ids").collect()
    found.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["ids"])))
    return [(r["doc_id"], r["y"], np.frombuffer(bytes(r["ids"]), np.int32)) for r in found]


def count_ratios(xs: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = np.full((2, _SIZE), alpha)
    for ids, label in zip(xs, y, strict=True):
        counts[int(label), ids] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_descent(xs: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge loss, L2: one dual variable for each row, in random order, within [0, cost].

    Rows are scaled to unit length, so that long texts weigh no more than short ones.
    """
    w, bias = np.zeros(_SIZE), 0.0
    alpha = np.zeros(len(xs))
    values = [ratio[ids] / max(1e-9, float(np.linalg.norm(ratio[ids]))) for ids in xs]
    sign = np.where(y == 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(xs)):
            gradient = sign[i] * (w[xs[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost[i])  # the row's norm is 1, and 1 for the bias
            if new != alpha[i]:
                change = (new - alpha[i]) * sign[i]
                w[xs[i]] += change * values[i]
                bias += change
                alpha[i] = new
    return w, bias


def margin(ids: np.ndarray, ratio: np.ndarray, w: np.ndarray, bias: float) -> float:
    v = ratio[ids]
    return float(w[ids] @ v) / max(1e-9, float(np.linalg.norm(v))) + bias


def fit(rows: list[tuple[int, int, np.ndarray]], totals: dict[int, int]) -> dict:
    """The model: weights of the indicators, squared ratios, and the logistic curve."""
    y = np.array([r[1] for r in rows], int)
    if len(set(y)) < 2:
        return {"flat": float(y[0]) if len(y) else 0.5}
    xs = [r[2] for r in rows]
    weight = balance(y, totals)
    cost = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    fold = np.arange(len(y)) % FOLDS
    out = np.zeros(len(y))
    for f in range(FOLDS):
        train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        ratio = count_ratios([xs[i] for i in train], y[train])
        w, bias = dual_descent([xs[i] for i in train], y[train], ratio, cost[train])
        out[test] = [margin(xs[i], ratio, w, bias) for i in test]
    curve = logistic(out[:, None], y, weight)
    ratio = count_ratios(xs, y)
    w, bias = dual_descent(xs, y, ratio, cost)
    return {"weights": (w * ratio).astype(np.float32), "squares": (ratio**2).astype(np.float32), "bias": bias, "curve": curve}


def with_scores(docs: DataFrame, model: dict, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; a narrow pass over whole texts."""

    def start():
        if "flat" in model:
            return lambda batch: [pa.array([model["flat"]] * batch.num_rows, pa.float64())]
        seen = np.zeros(_SIZE, bool)
        weights, squares, (slope, shift) = model["weights"], model["squares"], model["curve"]

        def one(x: bytes | None) -> float:
            mark(x, seen)
            ids = np.flatnonzero(seen)
            norm = float(squares[ids].sum(dtype=np.float64)) ** 0.5
            m = float(weights[ids].sum(dtype=np.float64)) / max(1e-9, norm) + model["bias"]
            return float(sigmoid(slope * m + shift))

        return lambda batch: [pa.array([one(x) for x in binaries(batch, text)], pa.float64())]

    return annotate(docs, [field(name, "double")], start)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, modulus: int = MODULUS, kept_out: int = KEPT_OUT) -> dict:
    rows, totals = sample(docs, labels, label, per_class, modulus, kept_out)
    return fit(features(rows), totals)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", "text")
    held_out = F.coalesce(remainder(F.col("doc_id"), MODULUS) == KEPT_OUT, F.lit(False))
    scored = with_scores(rows, train(rows, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score at least ``threshold``, with their own columns."""
    rows, back = aside(docs, "doc_id", "text")
    return back(with_scores(rows, train(rows, labels)).where(F.col("score") >= threshold))
