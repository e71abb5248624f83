"""Personal data: fixed patterns, and a linear-chain conditional random field.

The patterns find the plain forms (email, ip, card, phone); every match of
theirs stays. The conditional random field adds forms that they miss, such as
``name [at] host [dot] org``, addresses with letters beyond ASCII, or phone
numbers without a plus sign. Its features are the shapes of a token and of its
neighbours and whether they touch; it is trained by maximum likelihood on a
small labelled table (``labelled_table``, made by rule), and decoded by
Viterbi over padded numpy batches. An added span must overlap no pattern
match, must beat the outside reading by ``MARGIN``, and must pass its kind's
exact check (``sound``).

Every sound span holds an anchor (a digit, an ``@``, a bracketed *at* or
*dot*), and none of its chunks is further than two from one. So the field is
run where a span can be: within ``REACH`` chunks of an anchor, which is
further past any sound span than the features look (four tokens). Elsewhere
all tokens are outside, and ordinary prose costs one search.

Offsets are code points, end exclusive. Defined results: null text is empty
and has no spans; empty tables give empty results; repeated rows are rows of
their own. Every search is linear in the text's length.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import annotate, aside, field, strings

KINDS = ("email", "ip", "card", "phone")
REACH = 6
#: Tokens whose label scores are worked out at a time.
SLICE = 1 << 15
MARGIN = 1.0
_RANK = {k: i for i, k in enumerate(KINDS)}

# Patterns -------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins: the lookbehind keeps the search linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Anchored at each ``@``: the local part is the run before it, not before the last match's end."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches: leftmost and non-overlapping by kind, failing ones dropped without retry."""
    out = [("email", a, b) for a, b in emails(text)]
    if _ANY_DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(only_digits(m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return ordered(out)


_ANY_DIGIT = re.compile("[0-9]")


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# Tokens and shapes ----------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_ANCHOR = re.compile(r"[0-9@]|[\[({] ?(?:at|dot) ?[\])}]", re.IGNORECASE)
_CHUNK = re.compile(r"\S+")
#: Cue words of the shape features (fixed values).
_CUES = {"at": "AT", "dot": "DOT", "com": "TLD", "org": "TLD", "net": "TLD", "edu": "TLD", "de": "TLD", "fr": "TLD", "es": "TLD", "io": "TLD",
         "tel": "CALL", "phone": "CALL", "call": "CALL", "mobile": "CALL", "fax": "CALL", "card": "CARD", "email": "MAIL", "mail": "MAIL"}


def shape(token: str) -> str:
    c = token[0]
    if "0" <= c <= "9":
        n = len(token)
        if n >= 14:
            return "D20" if n > 19 else "DL" if luhn(token) else "DN"
        return f"D{n}" if n <= 5 else "D6" if n <= 9 else "D10"
    if c.isalpha():
        low = token.lower()
        return _CUES.get(low) or ("U" if token.isupper() and len(token) > 1 else "C" if c.isupper() else "a1" if len(token) == 1 else "a")
    return c if c in "@.-+()[]{}/:,_=%#\"'$" else "?"


#: All shapes; a token of none of them cannot be made by ``shape``.
SHAPES = ["<pad>", *(f"D{n}" for n in (1, 2, 3, 4, 5, 6, 10, 20)), "DL", "DN", *sorted(set(_CUES.values())), "U", "C", "a1", "a", *"@.-+()[]{}/:,_=%#\"'$", "?"]
_SHAPE_ID = {s: i for i, s in enumerate(SHAPES)}
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
OFFSETS = tuple(range(-4, 5))


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


def encode(text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(shape numbers, whether the token touches the one before)."""
    shapes = np.array([_SHAPE_ID[shape(text[a:b])] for a, b in spans], np.int64)
    touch = np.array([0, *(int(p[1] == q[0]) for p, q in zip(spans, spans[1:], strict=False))], np.int64)
    return shapes, touch


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches of whole chunks within ``REACH`` chunks of an anchor."""
    anchors = [m.start() for m in _ANCHOR.finditer(text)]
    if not anchors:
        return []
    chunks = [m.span() for m in _CHUNK.finditer(text)]
    ends = [b for _, b in chunks]
    out: list[list[int]] = []
    for at in anchors:
        k = bisect.bisect_right(ends, at)  # the chunk of the anchor, or the next
        a, b = chunks[max(0, k - REACH)][0], ends[min(len(ends) - 1, k + REACH)]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


# The model ------------------------------------------------------------------


def rows_of(shapes: np.ndarray, touch: np.ndarray) -> np.ndarray:
    """Feature numbers (tokens x features) into the weight table."""
    n, wide = len(shapes), max(map(abs, OFFSETS))
    s = np.concatenate([np.zeros(wide, np.int64), shapes, np.zeros(wide, np.int64)])
    t = np.concatenate([np.zeros(wide, np.int64), touch, np.zeros(wide + 1, np.int64)])
    out = np.empty((n, len(OFFSETS) + 1), np.int16)
    for i, o in enumerate(OFFSETS):
        at = slice(wide + o, wide + o + n)
        # A neighbour's shape, told apart by whether it touches on its side of the token.
        side = t[wide + o : wide + o + n] if o > 0 else t[wide + o + 1 : wide + o + 1 + n]
        out[:, i] = (i * len(SHAPES) + s[at]) * 2 + side
    base = len(OFFSETS) * len(SHAPES) * 2
    out[:, -1] = base + (s[wide : wide + n] * 2 + t[wide : wide + n]) * 2 + t[wide + 1 : wide + 1 + n]
    return out


N_FEATURES = len(OFFSETS) * len(SHAPES) * 2 + len(SHAPES) * 4


def allowed() -> np.ndarray:
    """0 where a transition may be, a large penalty where I- does not continue its kind."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            for i, a in enumerate(LABELS):
                if a == "O" or a[2:] != b[2:]:
                    out[i, j] = -1e4
    return out


def pad(batch: list[np.ndarray], fill: int = 0) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in batch])
    out = np.full((len(batch), sizes.max(), *batch[0].shape[1:]), fill, batch[0].dtype)
    for i, x in enumerate(batch):
        out[i, : len(x)] = x
    return out, sizes


def label_scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums of the weights of each token's features; no table of all features by all labels is made."""
    out = w[x[..., 0]]
    for c in range(1, x.shape[-1]):
        out += w[x[..., c]]
    return out


_INSIDE = [i for i, s in enumerate(LABELS) if s[0] == "I"]


class Likelihood:
    """The log-likelihood of labelled sequences, and its gradient.

    Sequences stand side by side, longest first, so that those which go on at
    a place are the first rows; only real tokens are stored.
    """

    def __init__(self, feats: list[np.ndarray], gold: list[np.ndarray]):
        order = sorted(range(len(feats)), key=lambda i: -len(feats[i]))
        self.n, self.length = len(feats), max(map(len, feats))
        self.on = [sum(len(f) > i for f in feats) for i in range(self.length)]  # sequences with a token at place i
        self.at = np.concatenate([[0], np.cumsum(self.on)])
        self.x = np.stack([feats[j][i] for i in range(self.length) for j in order[: self.on[i]]])
        y = np.array([gold[j][i] for i in range(self.length) for j in order[: self.on[i]]])
        self.hot = np.eye(len(LABELS))[y]
        self.pairs = np.zeros((len(LABELS), len(LABELS)))
        for i in range(1, self.length):
            m = self.on[i]
            np.add.at(self.pairs, (y[self.at[i - 1] : self.at[i - 1] + m], y[self.at[i] : self.at[i] + m]), 1.0)
        # Feature numbers in order once: sums by feature are then sums of runs.
        flat = self.x.ravel()
        by_feature = np.argsort(flat, kind="stable")
        self.token = by_feature // self.x.shape[1]
        self.which, self.first = np.unique(flat[by_feature], return_index=True)

    def gradient(self, w: np.ndarray, trans: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(log-likelihood, its gradient by the weights, by the transitions), by forward and backward sums."""
        e, t = label_scores(self.x, w), trans + allowed()
        e[: self.on[0], _INSIDE] -= 1e4
        top = e.max(axis=1, keepdims=True)
        p, step = np.exp(e - top), np.exp(t)
        # Forward and backward sums are kept in scale by each token's own total.
        alpha, beta, total = p.copy(), np.ones_like(p), np.empty(len(p))
        for i in range(self.length):
            here = slice(self.at[i], self.at[i + 1])
            if i:
                alpha[here] *= alpha[self.at[i - 1] : self.at[i - 1] + self.on[i]] @ step
            total[here] = alpha[here].sum(axis=1)
            alpha[here] /= total[here, None]
        expected = np.zeros_like(step)
        for i in range(self.length - 1, 0, -1):
            here, before = slice(self.at[i], self.at[i + 1]), slice(self.at[i - 1], self.at[i - 1] + self.on[i])
            after = p[here] * beta[here] / total[here, None]
            beta[before] = after @ step.T
            expected += alpha[before].T @ after
        diff = self.hot - alpha * beta
        grad = np.zeros_like(w)
        grad[self.which] = np.add.reduceat(diff[self.token], self.first, axis=0)
        value = (self.hot * e).sum() + (self.pairs * t).sum() - (np.log(total) + top[:, 0]).sum()
        return float(value), grad, self.pairs - step * expected


def labelled_sequences(table: list[tuple[str, list[tuple[str, int, int]]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    feats, gold = [], []
    for text, spans in table:
        where = tokens(text, 0, len(text))
        tags = np.zeros(len(where), np.int64)
        for kind, a, b in spans:
            inside = [i for i, (x, y) in enumerate(where) if x >= a and y <= b]
            tags[inside] = LABELS.index(f"I-{kind}")
            tags[inside[0]] = LABELS.index(f"B-{kind}")
        feats.append(rows_of(*encode(text, where)))
        gold.append(tags)
    return feats, gold


def fit(table: list[tuple[str, list[tuple[str, int, int]]]], steps: int = 160, rate: float = 0.25, ridge: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, transitions) by gradient ascent with Adam on the log-likelihood."""
    goal = Likelihood(*labelled_sequences(table))
    k = len(LABELS)
    w, trans = np.zeros((N_FEATURES, k)), np.zeros((k, k))
    moments = [np.zeros_like(v) for v in (w, w, trans, trans)]
    for step in range(1, steps + 1):
        _, *grads = goal.gradient(w, trans)
        for j, (value, grad) in enumerate(((w, grads[0]), (trans, grads[1]))):
            grad = grad / goal.n - ridge * value
            m, v = moments[2 * j], moments[2 * j + 1]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w, trans + allowed()


def viterbi(batch: list[np.ndarray], model: tuple[np.ndarray, np.ndarray], margin: float = MARGIN) -> list[np.ndarray]:
    """Best labels of each sequence of feature rows; sequences are padded to the longest.

    Scores are worked out for about ``SLICE`` tokens at a time; only one byte
    a label and token is kept for the way back.
    """
    w, trans = model
    x, sizes = pad(batch)
    n, length, _ = x.shape
    back = np.zeros((n, length, len(LABELS)), np.int8)
    stay = np.arange(len(LABELS), dtype=np.int8)
    step = max(1, SLICE // n)
    score = None
    for begin in range(0, length, step):
        e = label_scores(x[:, begin : begin + step], w)
        e[:, :, 0] += margin / 2  # a span must beat the outside reading
        for i in range(e.shape[1]):
            if score is None:
                e[:, 0, _INSIDE] -= 1e4
                score = e[:, 0]
                continue
            options = score[:, :, None] + trans
            on = (begin + i < sizes)[:, None]
            back[:, begin + i] = np.where(on, options.argmax(axis=1), stay)
            score = np.where(on, options.max(axis=1) + e[:, i], score)
    at = score.argmax(axis=1)
    out = np.zeros((n, length), np.int8)
    for i in range(length - 1, -1, -1):
        out[:, i] = at
        at = back[np.arange(n), i, at]
    return [row[:s] for row, s in zip(out, sizes, strict=True)]


# The labelled table -----------------------------------------------------------


def labelled_table(seed: int = 7, rows: int = 600) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small table of texts with labelled spans, made by rule from a fixed seed."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnoprstuvwz"
    word = lambda a=2, b=8: "".join(rng.choice(letters) for _ in range(rng.randint(a, b)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    tld = lambda: rng.choice(["com", "org", "net", "de", "fr", "io"])
    accent = lambda: word(1, 3) + rng.choice("äöüéèñ") + word(1, 4)

    def card() -> str:
        body = number(15)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def grouped(s: str, sep: str) -> str:
        return sep.join(s[i : i + 4] for i in range(0, len(s), 4))

    made = {
        "email": [
            lambda: f"{word()}.{number(2)}@{word()}{rng.randint(0, 9)}.{word()}.{tld()}",
            lambda: f"{word()}@{word()}.{tld()}",
            lambda: f"{word()}.{word()}@{word()}-{word()}.{tld()}",
            lambda: f"{accent()}@{word()}.{tld()}",
            lambda: f"{word()}.{accent()}@{accent()}.{tld()}",
            lambda: f"{word()} [at] {word()} [dot] {tld()}",
            lambda: f"{word()}.{word()}(at){word()}.{tld()}",
            lambda: f"{word()} (at) {word()} (dot) {tld()}",
            lambda: f"{word()}{number(2)}[at]{word()}[dot]{tld()}",
            lambda: f"{word()} @ {word()}.{tld()}",
        ],
        "ip": [lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))],
        "card": [lambda: card(), lambda: grouped(card(), "-"), lambda: grouped(card(), " "), lambda: grouped(card(), ".")],
        "phone": [
            lambda: f"+{rng.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}",
            lambda: f"+{rng.randint(1, 99)} {number(3)} {number(3)} {number(4)}",
            lambda: f"({number(3)}) {number(3)}-{number(4)}",
            lambda: f"{number(3)}-{number(3)}-{number(4)}",
            lambda: f"{number(3)}.{number(3)}.{number(4)}",
            lambda: f"({number(3)}){number(3)}-{number(4)}",
        ],
    }
    other = [
        lambda: f'token = "{hexes(40)}"',
        lambda: f"password={hexes(18)}",
        lambda: "AK" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)),
        lambda: f"version {rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}",
        lambda: f"Version {rng.randint(1, 9)}.0.",
        lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(10, 12)}/{rng.randint(10, 28)}/{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
        lambda: f"${rng.randint(1, 999)}.{number(2)}",
        lambda: f"{rng.randint(1, 999)},{number(3)},{number(3)}",
        lambda: f"{rng.randint(1, 99)}%",
        lambda: f"page {rng.randint(1, 999)}",
        lambda: f"({rng.randint(1, 999)})",
        lambda: f"[{rng.randint(1, 99)}]",
        lambda: f"{rng.randint(1, 99)}-{rng.randint(100, 999)}",
        lambda: f"{number(3)}-{number(2)}-{number(4)}",
        lambda: f"{number(rng.randint(5, 24))}",
        lambda: f"{number(3)} {number(3)} {number(4)}",
        lambda: f"@{word()}",
        lambda: f"{word()}@{word()}",
        lambda: f"{word()} at {word()}",
        lambda: f"{word()} (at {word()})",
        lambda: f"http://{word()}.{word()}.{tld()}/{word()}/{number(4)}?{word()}={number(2)}",
        lambda: f"{number(3)}.{number(3)}.{number(3)}.{number(3)}.{number(2)}",
        lambda: f"{word()}{number(3)}{word()}",
        lambda: f"{hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)}",
        lambda: f"{rng.randint(300, 999)}.{rng.randint(300, 999)}.{rng.randint(300, 999)}.{rng.randint(300, 999)}",
    ]
    prose = lambda: " ".join(word(1, 9).capitalize() if rng.random() < 0.15 else word(1, 9) + rng.choice(["", "", "", ".", ","]) for _ in range(rng.randint(1, 5)))
    table = []
    for i in range(rows):
        text, spans = prose(), []
        for _ in range(rng.randint(1, 2)):
            text += rng.choice([" ", " ", ". ", ", ", ": ", "\n"])
            if i % 5 < 3:
                kind = KINDS[rng.choice((0, 0, 1, 2, 3, 3))]
                piece = rng.choice(made[kind])()
                spans.append((kind, len(text), len(text) + len(piece)))
            else:
                piece = rng.choice(other)()
            text += piece + rng.choice([" ", " ", ". ", ", ", "\n"]) + prose()
        table.append((text, spans))
    return table


@functools.cache
def default_model() -> tuple[np.ndarray, np.ndarray]:
    return fit(labelled_table())


#: Characters of the longest span that the method adds, by what its kind can need: an address of 64 + 255, bracketed words for its signs, and blanks.
LONGEST = {"email": 400, "ip": 15, "card": 64, "phone": 64}


def sound(kind: str, body: str) -> bool:
    """The exact check of an added span; a span over ``LONGEST`` is none, so a check is bounded whatever the text is."""
    if len(body) > LONGEST[kind]:
        return False
    digits = only_digits(body)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+(?:@|\s?[\[({] ?at ?[\])}]\s?| @ )[^\s@]+(?:(?:\.|\s?[\[({] ?dot ?[\])}]\s?)[^\W\d_]{2,})+", body, re.IGNORECASE))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", body)) and all(int(p) <= 255 for p in body.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and bool(re.fullmatch(r"\+?\(?[0-9]{1,4}\)?(?:[ .-]?\(?[0-9]{2,}\)?)+", body))


class Covered:
    """Stretches covered by spans, merged and in order."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted((a, b) for _, a, b in spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect.bisect_right(self.ends, a)
        return k < len(self.starts) and self.starts[k] < b


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], model, batch_tokens: int = 1 << 15) -> list[list[tuple[str, int, int]]]:
    """Spans that the model adds to each text's matches."""
    jobs, covered = [], [Covered(b) for b in base]
    for i, text in enumerate(texts):
        for a, b in windows(text):
            # A window whose anchors all lie in matches has nothing to add.
            if any(not covered[i].meets(m.start(), m.start() + 1) for m in _ANCHOR.finditer(text, a, b)):
                where = tokens(text, a, b)
                jobs.append((i, where, rows_of(*encode(text, where))))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    jobs.sort(key=lambda j: len(j[1]))
    at = 0
    while at < len(jobs):
        end = at + 1
        while end < len(jobs) and (end - at + 1) * len(jobs[end][1]) <= batch_tokens:
            end += 1
        for (i, where, _), tags in zip(jobs[at:end], viterbi([j[2] for j in jobs[at:end]], model), strict=True):
            for kind, a, b in spans_of(tags, where):
                if not covered[i].meets(a, b) and sound(kind, texts[i][a:b]):
                    out[i].append((kind, a, b))
        at = end
    return out


def spans_of(tags: np.ndarray, where: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    out: list[list] = []
    for n, (a, b) in zip(tags, where, strict=True):
        label = LABELS[int(n)]
        if label[0] == "B":
            out.append([label[2:], a, b])
        elif label[0] == "I":
            out[-1][2] = b
    return [tuple(s) for s in out]


def with_spans(docs: DataFrame, text: str = "text", model=None) -> DataFrame:
    """``docs`` with base_spans and spans (lists of kind, start, end); a narrow pass."""
    weights = model or default_model()
    kind = "array<struct<kind:string,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def start():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = [x or "" for x in strings(batch, text)]
            base = [base_spans(x) for x in texts]
            more = added_spans(texts, base, weights)
            tell = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
            return [pa.array([tell(b) for b in base], arrow), pa.array([tell(ordered(b + m)) for b, m in zip(base, more, strict=True)], arrow)]

        return work

    return annotate(docs, [field("base_spans", kind), field("spans", kind)], start)


def report(docs: DataFrame) -> DataFrame:
    """The query's digest; counts are those of the patterns, spans has all."""
    from pyspark.sql import functions as F

    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    found = with_spans(docs.select("doc_id", "text"))
    is_kind = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter("base_spans", is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(line("base_spans"), 256).alias("base_sha256"), line("spans").alias("spans"))


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each stretch covered by spans becomes its first span's kind in brackets."""
    out, end = [], 0
    for kind, a, b in ordered(spans):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars", model=None) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and its length kept in ``size``; null stays null."""
    weights = model or default_model()
    fields = [f for f in docs.schema if f.name in (text, size)]
    rows, back = aside(docs, text, size)

    def start():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            raw = strings(batch, text)
            texts = [x or "" for x in raw]
            base = [base_spans(x) for x in texts]
            more = added_spans(texts, base, weights)
            done = [None if r is None else redact_text(x, b + m) for r, x, b, m in zip(raw, texts, base, more, strict=True)]
            made = {text: pa.array(done, pa.string())}
            if any(f.name == size for f in fields):
                kind = batch.schema.field(size).type
                old = batch.column(batch.schema.get_field_index(size)).to_pylist()
                made[size] = pa.array([o if d is None or d == r else len(d) for o, d, r in zip(old, done, raw, strict=True)], kind)
            return [made[f.name] for f in fields]

        return work

    return back(annotate(rows, fields, start))


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
