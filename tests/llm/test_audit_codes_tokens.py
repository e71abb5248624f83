"""Filter audit, vector codes and byte-level BPE: brute force, SQL, round trips and odd rows."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest

from quire.llm import audit, tokens, vector_codes
from quire.llm.common import table
from tests.conftest import same_rows

# Filter interaction audit --------------------------------------------------------------------


def audit_by_hand(docs, labels):
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        mine = [(q, x) for d, q, x in labels if d == i and i is not None]
        rows.append((part or "", fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    out = {}
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        sums = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            alive = here
            for k, f in enumerate(order):
                gone = [r for r in alive if r[1][f]]
                alive = [r for r in alive if not r[1][f]]
                failing = [r for r in here if r[1][f]]
                alone = [r for r in failing if sum(r[1].values()) == 1]
                sums[f] += len(gone)
                found.append((order, k, f, len(alive), len(gone), len(failing) - len(gone), len(alone), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        for order, k, f, *numbers in found:
            out[part, "".join(order), k + 1] = (*numbers, sums[f])
    return out


def test_audit_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "Be", "see", "D#", "é", "F", "漢字"])
    docs = [(i, " ".join(word() if i % 3 else f"w{rng.random()}" for _ in range(rng.choice([0, 3, 150, 250]))), rng.choice(["x", "y", "", None])) for i in range(60)]
    docs += [(100 + i, rng.choice(docs)[1], rng.choice(["x", "z"])) for i in range(30)]
    docs += [(None, docs[3][1], "x"), (None, docs[3][1], "x"), (7, None, "y"), (8, "", None), (100, docs[60][1], "x"), (100, docs[60][1], "x"), (200, "long " * 50_000, "z"), (201, "x" * 200_000, "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 140, 2), 4, 6]] + [(None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame([(i, t, p, 1, "clash", b"") for i, t, p in docs], "doc_id long, text string, source string, mask int, part string, digest binary").repartition(5)
    got = audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in audit.FIELDS) for r in got} == audit_by_hand(docs, labels)
    assert len(got) == 600 * len({p or "" for _, _, p in docs})


def test_audit_of_an_empty_table_and_sql(spark, sf, duck):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(empty, labels).count() == 0
    same_rows(audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels")), duck, audit.ORACLE)


def test_zeta_against_sums_over_subsets():
    counts = np.random.default_rng(0).integers(0, 9, (3, 32))
    assert (audit.zeta(counts) == [[sum(c[m] for m in range(32) if m & s == m) for s in range(32)] for c in counts]).all()
    assert (audit.survivors(counts) == [[sum(c[m] for m in range(32) if not m & s) for s in range(32)] for c in counts]).all()


# Vector codes ---------------------------------------------------------------------------


def codes_by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * x) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    length = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == length]
    edges = vector_codes.edges_of(length, parts)
    cut = [[v[a:b] for a, b in zip(edges, edges[1:], strict=False)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    near = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            at = [near(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, at, strict=True) if a == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in f), e, sum(x for x, r in zip(error, kept, strict=True) if r[2] == g), sha) for (i, _, g), f, e in zip(kept, found, error, strict=True)), key=repr
    )


@pytest.mark.parametrize("length", [16, 19])
def test_codes_against_brute_force(spark, length):
    rng = random.Random(length)
    vector = lambda: [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(length)]
    rows = [(rng.randint(-5, 200), vector(), rng.choice([None, 1, 2])) for _ in range(150)]
    rows += [(r[0], r[1], 3) for r in rows[:40]] + [(500, [0.5] * length, 9)] * 60 + [(None, vector(), 1)]
    rows += [(1, None, 1), (2, [None] * length, 1), (3, [float("nan")] * length, 1), (4, [float("inf")] * length, 2), (999, [1.0] * 3, 2), (998, [], 2)]
    df = spark.createDataFrame([(*r, "clash", 1, 0) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int, _sum int").repartition(7)
    assert sorted((tuple(r) for r in vector_codes.report(df).collect()), key=repr) == codes_by_hand(rows)


def test_codes_of_few_huge_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    few = [(3, [0.1] * 8, None), (1, [3.0e5] * 8, None), (2, [-3.0e9] * 8, 1)]
    got = vector_codes.report(spark.createDataFrame(few, schema)).collect()
    f32 = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in few]
    assert sorted((tuple(r) for r in got), key=repr) == codes_by_hand(f32)
    huge = vector_codes.report(spark.createDataFrame([(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [1.0] * 8, 1)], schema)).collect()
    assert {r["vec_id"]: r["error"] for r in huge} == {1: 0, 2: 0, 3: 0}
    assert vector_codes.report(spark.createDataFrame([], schema)).collect() == []
    assert vector_codes.report(spark.createDataFrame([(1, None, 1)], schema)).count() == 0


def test_tree_finds_the_lowest_of_equally_near_entries():
    rng = np.random.default_rng(1)
    for width in (0, 1, 3):
        points = rng.integers(-3, 4, (40, width))
        x = rng.integers(-5, 6, (500, width))
        entry, d = vector_codes.Tree(points).nearest(x)
        far = ((x[:, None] - points[None]) ** 2).sum(axis=2)
        assert (d == far.min(axis=1)).all() and (entry == far.argmin(axis=1)).all()
        big, e = vector_codes.Tree(points << 40).nearest(x << 40)
        assert (big == entry).all() and all(int(a) == int(b) << 80 for a, b in zip(e, d, strict=True))


def test_codes_sql_salted_labels_and_decoding(spark, sf, duck, monkeypatch):
    rows = table(spark, sf, "embeddings")
    same_rows(vector_codes.report(rows), duck, vector_codes.oracle())
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 0)
    same_rows(vector_codes.report(rows), duck, vector_codes.oracle())
    books = vector_codes.train(rows)
    back = vector_codes.decode(vector_codes.encode(rows, books), books).collect()
    for r in back[:20]:
        own = sum((math.floor(4096 * x) - round(4096 * y)) ** 2 for x, y in zip(r["embedding"], r["vector"], strict=True))
        assert own == r["error"]


# Byte-level BPE -------------------------------------------------------------------------

TEXTS = [None, "", "a", "it's 'round the '90s: don't'", " \n\n  x\t\t y ", "漢字かな交じり文、です。" * 30, "é́   x\x1c y\x85z", "<|endoftext|>", "a1!b2?'c3' 'd4" * 50, "\x00\x01", " " * 30 + "end", "end" + " " * 30, "😀👍🏽" * 20]


def test_pieces_never_change_the_ids():
    enc = tokens.encoder(tokens.read_ranks())
    rng = random.Random(2)
    alphabet = list("ab'sdmrevtl09 !?\n\t　 é漢\x1c") + ["  ", "\n\n", "'s", "'re", " '", "   "]
    for text in [t or "" for t in TEXTS] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(4000)]:
        want = enc.encode_ordinary(text)
        for piece, run in ((1, 1), (3, 2), (7, 5), (20, 1)):
            assert tokens.ids_of(enc, text, piece, run) == want, (text, piece, run)
            assert "".join(p for p, _ in tokens.pieces(text, piece, run)) == text


def test_encoding_and_raw_decoding(spark):
    enc = tokens.encoder(tokens.read_ranks())
    long = [" " * 300_000 + "x", "x" + "\n" * 200_000, "a" * 300_000, "some words, and 12 more; " * 20_000, "漢" * 100_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate([*TEXTS, *long])] + [(None, "no id", "", 2), (1, "", "twice", 3), (1, "", "twice", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, bytes int").repartition(4)
    both = tokens.decode(tokens.encode(df)).collect()
    assert len(both) == len(rows)
    for r in both:
        assert bytes(r["bytes"]) == (r["text"] or "").encode()
        if len(r["text"] or "") < 1000:
            assert list(r["ids"]) == enc.encode_ordinary(r["text"] or "")
    got = tokens.report(df).collect()
    want = {(r["doc_id"], len(r["ids"]), hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in both}
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    assert tokens.report(df.limit(0)).count() == 0


def test_a_character_over_two_tokens_and_bad_ids(spark):
    enc = tokens.encoder(tokens.read_ranks())
    ids = enc.encode_ordinary("漢")
    assert len(ids) > 1
    rows = [(1, ids[:1]), (2, None), (3, []), (4, [0, None]), (5, [-1]), (6, [60_000]), (7, ids)]
    got = {r["i"]: None if r["bytes"] is None else bytes(r["bytes"]) for r in tokens.decode(spark.createDataFrame(rows, "i long, ids array<int>")).collect()}
    assert got == {1: enc.decode_single_token_bytes(ids[0]), 2: None, 3: b"", 4: None, 5: None, 6: None, 7: "漢".encode()}
