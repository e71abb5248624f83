"""Text operators: brute force, held-out accuracy and odd rows."""

import math
import random
import re
import resource
import zlib

import numpy as np
import pytest
import xxhash

from quire.llm import decontamination, lm_scoring, pii, quality, simhash, toxicity
from quire.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, "one"), (4, " \t\n"), (None, "no id"), (5, "twice"), (5, "twice"), (6, "é ü 漢字 \0 \x1f"), (7, "long " * 60_000), (8, "x" * 300_000)]


def odd(spark, extra=()):
    rows = [(i, t, "clash", "clash", 1) for i, t in [*ODD, *extra]]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, spans string, n_words int").repartition(3)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# Decontamination ---------------------------------------------------------------------


def hits_by_hand(text, items, n=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = split(text), set(), set()
    for item, body in items:
        w = split(body)
        for k in range(max(1, len(w) - n + 1)) if w else ():
            window = w[k : k + n]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


def test_decontamination_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["the", "of", "Zé", "x1", "word", "other", "a"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(0, 16))) for i in range(30)] + [(3, None), (40, "!!"), (41, "Lone"), (7, text(12)), (None, "of no name")]
    real = [x for x in items if x[1]]
    docs = [(i, text(rng.randint(0, 120)) + " " + rng.choice(real)[1]) if i % 2 else (i, text(50)) for i in range(60)]
    docs += [(99, "a word of no name"), (100, "lone"), (101, None), (102, "the-of,LONE."), (5, "lone"), (None, "lone")]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((i, *hits_by_hand(t, real)) for i, t in docs), key=repr)
    for few, bits in ((100_000, 1 << 27), (0, 1 << 27), (100_000, 1 << 6)):  # windows broadcast, or merged; a filter that spares nothing
        for name, value in (("FEW_WINDOWS", few), ("FEW_DOCS", few), ("MOST_BITS", bits), ("LEAST_BITS", min(bits, 1 << 16)), ("COUNTED", 3)):
            monkeypatch.setattr(decontamination, name, value)
        got = decontamination.contamination(df, bench).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got), key=repr) == want


def test_items_without_an_id_remove_documents(spark):
    bench = spark.createDataFrame([(None, "a passage of five words"), (1, "lone")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "here: a passage of five words."), (2, "clean"), (3, "lone")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontamination.remove_contaminated(docs, bench).collect()] == [2]
    named = spark.createDataFrame([("b/1", "lone"), ("a", "clean")], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.report(docs, named).collect()}
    assert got == {1: (0, 0), 2: (1, 1), 3: (1, 1)}


def test_windows_meet_on_their_rarest_shingle(spark):
    common, rare = "the of and a to in that is was he", "for it with as his on be at zebra quince"
    docs = spark.createDataFrame([(i, f"{common} {common}") for i in range(20)] + [(99, f"x {common} {rare} y"), (100, rare), (100, "zebra quince"), (None, rare)], "doc_id long, text string")
    bench = spark.createDataFrame([("one", f"{common} {rare}"), ("two", rare)], "item_id string, text string")
    owned = decontamination.windows(bench, 10, "item_id", "text")
    assert owned.select("body").distinct().count() == 11 and owned.count() == 12
    each = decontamination.window_shingles(owned.select("body").distinct())
    sent = spark.sparkContext.broadcast(decontamination.bit_filter(each.select("shingle").distinct()))
    counts = {r["shingle"]: r["n"] for r in decontamination.shingle_counts(docs, [3], sent, "text").collect()}
    own = {r["shingle"] for r in each.collect()}
    by_hand = lambda words: decontamination.shingles(decontamination.WordHashes().of([w.encode() for w in words.split()]), 3).tolist()
    first, last = by_hand(common)[0], by_hand(rare)[-1]
    assert own <= set(counts) and counts[first] == 41 and counts[last] == 3
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.report(docs.where("doc_id <> 100"), bench).collect()}
    assert got[99] == (20, 2) and got[0] == (20, 1)
    again = sorted((r["n_words"], r["n_hit"]) for r in decontamination.report(docs.where("doc_id = 100 OR doc_id IS NULL"), bench).collect())
    assert again == [(2, 0), (10, 10), (10, 10)]


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.report(odd(spark), none).collect()
    assert len(got) == len(ODD) and not any(r["contaminated"] for r in got)
    assert decontamination.report(odd(spark).limit(0), none).count() == 0


# SimHash ------------------------------------------------------------------------------


def print_by_hand(text, width=4):
    w = [x.encode() for x in words_of(text)]
    runs = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes_by_hand(prints, radius):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_simhash_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    rng = random.Random(2)
    for k in range(60):  # copies with a changed word, and copies of those
        i, t = rows[rng.randrange(len(rows))]
        w = t.split(" ")
        w[rng.randrange(len(w))] = f"new{k}"
        rows.append((1000 + k, " ".join(w)))
    rows += [(2000, None), (2001, ""), (2002, "one"), (2002, "one"), (2003, "ONE")]
    # One id on two unrelated texts, one of them a copy of an earlier row; and an id that is smaller.
    rows += [(3000, rows[3][1]), (3000, "a text of words that no other row has at all"), (-5, rows[4][1]), (-5, "yet another one of its own kind here")]
    got = {}
    for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    prints = [print_by_hand(t) for _, t in rows]
    roots = classes_by_hand(prints, 4)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(i, least.get(r, i))
    want = {}
    for (i, _), p, r in zip(rows, prints, roots):
        want.setdefault(i, set()).add((f"{p:016x}", least[r]))
    assert got == want and len(got[3000]) == 2


def test_key_size_grows_with_the_table():
    assert [simhash.key_size(n, 64, 4) for n in (0, 10**6, 10**8, 10**10, 10**12)] == [1, 1, 2, 3, 3]


@pytest.mark.parametrize(("size", "radius"), [(8, 4), (32, 44)])
def test_bit_sliced_links(size, radius):
    rng = np.random.default_rng(1)
    for _ in range(20):
        left = rng.integers(0, 256, (int(rng.integers(1, 140)), size), dtype=np.uint8)
        for i in range(1, len(left), 2):
            left[i] = left[rng.integers(0, i)]
            for _ in range(rng.integers(0, radius + 3)):
                left[i, rng.integers(0, size)] ^= 1 << rng.integers(0, 8)
        cells = [(left[:50], None), (left[:30], left[30:]) if len(left) > 30 else (left, None)]
        for (a, b), edges in zip(cells, simhash.links(cells, radius)):
            whole = a if b is None else np.concatenate([a, b])
            number = [int.from_bytes(x.tobytes(), "big") for x in whole]
            up, want = list(range(len(whole))), list(range(len(whole)))

            def root(u, i):
                while u[i] != i:
                    i = u[i]
                return i

            for i in range(len(a)):
                for j in range(len(whole)):
                    if (b is None or j >= len(a)) and (number[i] ^ number[j]).bit_count() <= radius:
                        x, y = root(want, i), root(want, j)
                        want[max(x, y)] = min(x, y)
            for i, j in edges:
                x, y = root(up, i), root(up, j)
                assert x != y
                up[max(x, y)] = min(x, y)
            assert [root(up, i) for i in range(len(up))] == [root(want, i) for i in range(len(want))]


def test_simhash_chunks_and_longer_keys(spark, monkeypatch):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(5)]
    prints = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 2))) for b in base for _ in range(80)})
    df = spark.createDataFrame([(bytearray(p.to_bytes(8, "big")), i) for i, p in enumerate(prints)], "fp binary, first_id long")
    want = classes_by_hand(prints, 4)
    monkeypatch.setattr(simhash, "CHUNK", 16)
    for bands, size in ((5, 1), (6, 2)):
        got = {bytes(r["fp"]): r["component_id"] for r in simhash.classes(df, 4, bands, size).collect()}
        assert [got[p.to_bytes(8, "big")] for p in prints] == want


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    of = {r["doc_id"]: r for r in got}
    assert of[1]["fingerprint"] == of[2]["fingerprint"] == of[4]["fingerprint"] == "0" * 16 and of[4]["component_id"] == 1
    assert simhash.near_duplicates(odd(spark).limit(0)).count() == 0


def test_stage_finds_near_copies_and_keeps_others(spark):
    rng = random.Random(9)
    text = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    rows, copies = [], set()
    for k in range(60):
        t = text(200)
        rows.append((k, " ".join(t)))
        c = list(t)
        c[rng.randrange(200)] = "changed"  # similarity about 0.95
        copies.add(1000 + k)
        rows.append((1000 + k, " ".join(c)))
        half = t[:100] + text(100)  # similarity about 0.33
        rows.append((2000 + k, " ".join(half)))
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in rows], DOCS)
    kept = {r["doc_id"] for r in simhash.remove_near_duplicates(docs).collect()}
    assert len(copies & kept) <= 1 and {i for i, _ in rows} - copies <= kept


def jaccard_by_hand(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (words_of(a), words_of(b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 0.0


def test_stage_takes_candidates_by_fingerprints(spark, monkeypatch):
    """Without any shared min-hash the bit planes alone find what differs in a few bits; the exact check still judges."""
    monkeypatch.setattr(simhash, "min_hash_keys", lambda shingles: [int(shingles[0])] if len(shingles) else [])
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(5000)}"
    rows, near = [], []
    for i in range(40):
        t = [word() for _ in range(600)]
        rows.append((2 * i, " ".join(t)))
        t[rng.randrange(600)] = "changed"
        rows.append((2 * i + 1, " ".join(t)))
        if len({simhash.shingle_set(x[1].encode())[0] for x in rows[-2:]}) == 2:
            near.append(2 * i + 1)
    prints = [np.unpackbits(np.frombuffer(simhash.fingerprint(x.split(), 4), np.uint8)) for x in (t.encode() for _, t in rows)]
    found = [i for i in near if (prints[i] != prints[i - 1]).sum() <= 4]
    assert found
    # The same run of four words throughout has one fingerprint whatever follows it once: similar prints, other sets.
    same = "a b c d " * 40
    rows += [(900, None), (901, ""), (902, same + " ".join(f"x{j}" for j in range(30))), (903, same + " ".join(f"y{j}" for j in range(30)))]
    kept = {r["doc_id"] for r in simhash.remove_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not kept & set(found) and {2 * i for i in range(40)} <= kept and {902, 903} <= kept
    everything = {r["doc_id"]: r["fp"] for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(everything) == len(rows)



def test_recall_of_links_against_brute_force(spark):
    """Pairs of every similarity from 0.6 to 1: at least 0.9 of those from 0.8 on are found, and none below."""
    rng = random.Random(12)
    rows, like = [], {}
    for k in range(240):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((9, 20, 60, 200)))]
        other = list(base)
        for _ in range(rng.randint(0, max(1, len(base) // 45 + 1))):
            other[rng.randrange(len(other))] = f"n{rng.randrange(10**6)}"
        rows += [(k, " ".join(base)), (1000 + k, " ".join(other))]
        like[1000 + k] = jaccard_by_hand(rows[-2][1], rows[-1][1])
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in rows], DOCS)
    kept = {r["doc_id"] for r in simhash.remove_near_duplicates(docs).collect()}
    near = [i for i, s in like.items() if s >= 0.8]
    assert len(near) > 60 and len([s for s in like.values() if 0.6 < s < 0.8]) > 20
    assert sum(i not in kept for i in near) >= 0.9 * len(near)
    assert all(i in kept for i, s in like.items() if s < 0.8) and all(k in kept for k in range(240))


def test_stage_judges_rows_not_ids(spark):
    text = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(2, text("a")), (5, text("a")), (5, text("b")), (5, text("b")), (None, text("a")), (None, text("c")), (None, text("c")), (7, None), (8, ""), (9, text("d")), (9, text("d") + " more")]
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in rows], DOCS)
    kept = [(r["doc_id"], r["text"]) for r in simhash.remove_near_duplicates(docs).collect()]
    nine = [t for i, t in kept if i == 9]
    assert len(nine) == 1 and sorted((x for x in kept if x[0] != 9), key=repr) == sorted([(2, text("a")), (5, text("b")), (None, text("c")), (7, None)], key=repr)


def test_stage_links_by_shingle_sets(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, gone = [], set()
    for k in range(30):
        short, long, line = text(8), text(60), text(12)
        rows += [(k, short), (1000 + k, short + " more")]  # 4 of 5 shingles
        rows += [(2000 + k, f"{line} " * 2 + long), (3000 + k, f"{line} " * 20 + long)]  # equal sets
        rows += [(4000 + k, f"{line} " * 20 + text(100)), (5000 + k, f"{line} " * 20 + text(100))]  # one line in common
        gone |= {1000 + k, 3000 + k}
    base = text(100).split()
    rows += [(6000 + k, " ".join([*base[:-1], f"end{k}"])) for k in range(40)]
    gone |= set(range(6001, 6040))
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in rows], DOCS)
    for chunk in (simhash.CHUNK, 7):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        kept = {r["doc_id"] for r in simhash.remove_near_duplicates(docs).collect()}
        assert kept == {i for i, _ in rows} - gone


# Classifiers --------------------------------------------------------------------------


def held_out_accuracy(scored, labels, column):
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    rows = [(r["predicted"], truth[r["doc_id"]]) for r in scored.where("held_out").collect() if r["doc_id"] in truth]
    return sum(p == t for p, t in rows) / len(rows)


def test_quality_held_out(spark):
    d, la = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    scored = quality.score(d, la)
    assert held_out_accuracy(scored, la, "quality") > 0.95
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_learns_words_and_their_forms(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["ba", "ti", "ron", "el", "gu"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(400):
        t = [word() for _ in range(80)]
        if i % 4 == 0:
            t[rng.randrange(80)] = "zwok" + rng.choice(["ig", "en", "s", word()])
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(i % 4 == 0)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    la = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = toxicity.score(d, la)
    assert held_out_accuracy(scored, la, "toxic") > 0.97
    held = {r["doc_id"]: r["held_out"] for r in scored.collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)


def test_toxicity_on_real_labels(spark):
    d, la = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    scored = toxicity.score(d, la)
    assert held_out_accuracy(scored, la, "toxic") > 0.94
    truth = {r["doc_id"]: r["toxic"] for r in la.collect()}
    flagged = [truth[r["doc_id"]] for r in scored.where("held_out AND predicted = 1").collect() if r["doc_id"] in truth]
    assert sum(flagged) > 0.95 * len(flagged)


def test_kneser_ney_by_hand():
    """P(x | a b c) of either class from the definition, with counts in dictionaries."""
    texts, y = [[b"abca", b"abd"], [b"abcd"], [b"abcb"], [b"xabc"]], np.array([1, 1, 0, 0])
    models = toxicity.Models(toxicity.Counts(texts, y), 0.75)
    counts = ({}, {})
    for words, label in zip(texts, y):
        for key in set(toxicity.grams(words)[0].tolist()):
            counts[label][key] = counts[label].get(key, 0) + 1
    base = toxicity.BASE
    places = lambda key, n: tuple(key // base**i % base for i in range(n - 1, -1, -1))
    seen = {places(k, 4) for c in counts for k in c}

    def shared(context, x):
        """Continuation counts: before how many distinct symbols a group stands, over both classes."""
        if context is None:
            return 1 / base
        n = len(context)
        tails = {g[3 - n - 1 :] for g in seen}  # groups of n + 2 symbols
        after = {}
        for g in tails:
            if g[1:-1] == context:
                after[g[-1]] = after.get(g[-1], 0) + 1
        total, left = sum(after.values()), sum(max(v - 0.75, 0) for v in after.values())
        back = shared(context[1:] if n else None, x)
        return max(after.get(x, 0) - 0.75, 0) / max(total, 1) + (1 - left / max(total, 1)) * back

    def p(label, group):
        mine = {g: n for g, n in ((places(k, 4), n) for k, n in counts[label].items()) if g[:3] == group[:3]}
        total = max(1, sum(mine.values()))
        left = sum(max(n - 0.75, 0) for n in mine.values())
        return max(mine.get(group, 0) - 0.75, 0) / total + (1 - left / total) * shared(group[1:3], group[3])

    def word(label, w):
        """Its own discounted count, over that of its beginning, over the letters."""
        keys, starts, sizes = toxicity.grams([w])
        letters = [p(label, places(k, 4)) for k in keys[starts[0] : starts[0] + sizes[0]].tolist()]
        cut = min(len(w), toxicity.STEM)

        def over(kinds, one, below):
            left = 1 - sum(max(kinds.count(x) - 0.75, 0) for x in set(kinds)) / len(kinds)
            return max(kinds.count(one) - 0.75, 0) / len(kinds) + left * below

        mine = [set(t) for t, c in zip(texts, y) if c == label]
        begun = over([x for t in mine for x in {v[: toxicity.STEM] for v in t}], w[: toxicity.STEM], math.prod(letters[:cut]))
        return over([x for t in mine for x in t], w, begun * math.prod(letters[cut:]))

    words = [b"abca", b"abcd", b"abcz", b"zzzz", b"abd", b"xabc", b"abcabca"]
    got, sizes = models.difference(words)
    assert sizes.tolist() == [5, 5, 5, 5, 4, 5, 8]
    for w, d in zip(words, got):
        assert abs(d - math.log(word(1, w) / word(0, w))) < 1e-3


def test_pieces_do_not_show(monkeypatch):
    rng = random.Random(1)
    words = [rng.choice([b"aa", b"b.", b"c|", b"aa", b"x%"]) for _ in range(400)]
    seen, again = np.zeros(quality._SIZE, bool), np.zeros(quality._SIZE, bool)
    quality.mark(b" ".join(words), seen)
    models = toxicity.Models(toxicity.Counts([words[:40], words[50:70]], np.array([0, 1])), 0.75)
    low = [w.rstrip(b".|%") for w in words]
    whole = toxicity.evidence(low, models, 0.5)
    for size in (7, 50):
        monkeypatch.setattr(quality, "PIECE", size)
        quality.mark(b" ".join(words), again)
        assert (seen == again).all()
        monkeypatch.setattr(toxicity, "PIECE", size)
        assert np.allclose(toxicity.evidence(low, models, 0.5), whole)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_rows(spark, module):
    la = spark.createDataFrame([(i, i % 2, i % 2) for i in (2, 3, 5, 6, 7, 9, 11)] + [(None, 1, 1), (3, None, None), (6, 1, 1)], "doc_id long, quality int, toxic int")
    got = module.score(odd(spark), la).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in module.score(odd(spark), none).collect()} == {0.5}
    assert module.score(odd(spark).limit(0), la).count() == 0


# Language model -------------------------------------------------------------------------


def test_lm_base_by_hand_and_better_than_it(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    extra = spark.createDataFrame([(900_001, None), (900_002, ""), (900_003, "Zzz"), (900_003, "Zzz"), (None, "the of"), (900_004, "q" * 20_000)], "doc_id long, text string")
    docs = d.select("doc_id", "text").unionByName(extra)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count, total = {}, 0
    for i, t in rows:
        if not out(i):
            for w in [*words_of(t), None]:
                count[w] = count.get(w, 0) + 1
                total += 1
    want = []
    for i, t in rows:
        w = [*words_of(t), None]
        base = sum(math.log10((count.get(x, 0) + 1) / (total + len(count) + 1)) for x in w)
        want.append((i, out(i), len(w), sum(x in count for x in w), total, round(base, 4)))
    got = lm_scoring.report(docs).collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def small_network(ids=40):
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 50, ids)
    cls = np.concatenate([rng.integers(0, lm_scoring.CLASSES - 2, ids), [lm_scoring.CLASSES - 2, lm_scoring.CLASSES - 1]]).astype(np.int32)
    log_in, share = lm_scoring.within_class(np.append(counts, 9), cls)
    row = np.concatenate([np.arange(ids), [lm_scoring.END_ROW, lm_scoring.PAD_ROW]]).astype(np.int32)
    return lm_scoring.Network(row, cls, share), counts, cls, log_in


def test_lm_is_a_distribution_and_windows_score_once():
    ids = 40
    net, counts, cls, log_in = small_network(ids)
    after = lm_scoring.after_table(np.array([[1, 1, 2], [2, 3, 1], [5, 4, 3]], np.int32), counts, cls, log_in)
    score = lambda seqs: lm_scoring.log_probabilities(seqs, net, log_in, after, ids + 1)
    seq = np.concatenate([[ids], np.random.default_rng(1).integers(0, ids, 150)]).astype(np.int32)
    for n in (2, 17, 32, 33, 64, 65, 151):
        each = 10 ** (score([np.append(seq[:n], x).astype(np.int32) for x in range(ids + 1)]) - score([seq[:n]])[0])
        assert 0.95 < each.sum() <= 1.01  # classes without ids hold a little of the mass
    both = score([seq, seq[:40]])
    assert abs(both[1] - score([seq[:40]])[0]) < 1e-4 and abs(both[0] - score([seq])[0]) < 1e-4


def test_lm_is_a_distribution_with_ids_beyond_the_table(monkeypatch):
    monkeypatch.setattr(lm_scoring, "TOP", 12)
    ids = 40
    net, counts, cls, _ = small_network(ids)
    cls[:ids] = 5 + np.arange(ids) % 3  # every class has ids within the table and beyond
    log_in, _ = lm_scoring.within_class(np.append(counts, 9), cls)
    net.cls = cls
    rank = lm_scoring.ranks(counts)
    after = lm_scoring.after_table(np.array([[1, 1, 2, 0], [2, 3, 1, 11], [5, 4, 3, 900]], np.int32), counts, cls, log_in)
    for last in range(ids):
        for c in (5, 6, 7):
            members = [i for i in range(ids) if cls[i] == c]
            each = [after[1][rank[last], rank[i]] if rank[i] < 12 else log_in[i] + after[2][rank[last], c] for i in members]
            assert abs(np.exp(np.array(each, np.float64)).sum() - 1) < 2e-3
    # The share of a class's ids in what is scored is the class's own probability, whatever the last id.
    score = lambda seqs: lm_scoring.log_probabilities(seqs, net, log_in, after, ids + 1)
    begin = np.array([ids, *np.argsort(rank)[:3], *np.argsort(-rank)[:3]], np.int32)
    for n in range(2, len(begin) + 1):
        alone = 10 ** (score([np.append(begin[:n], x).astype(np.int32) for x in range(ids)]) - score([begin[:n]])[0])
        rows = np.full(lm_scoring.CONTEXT + lm_scoring.STRIDE, lm_scoring.PAD_ROW)
        rows[lm_scoring.CONTEXT : lm_scoring.CONTEXT + n] = net.row[begin[:n]]
        for c in (5, 6, 7):
            want = np.exp(net.log_class(rows[None], np.full((1, lm_scoring.STRIDE), c))[0, n - 1])
            assert abs(alone[cls[:ids] == c].sum() / want - 1) < 3e-3


def test_lm_keeps_every_pair(spark):
    counts = np.array([9, 0, 7, 3])
    pairs = spark.createDataFrame([(0, 2, 1), (2, 0, 5), (3, 3, 2)], "a long, b long, n long")
    assert sorted(map(tuple, lm_scoring.pair_table(pairs, counts).T.tolist())) == [(0, 1, 1), (1, 0, 5), (2, 2, 2)]


def test_lm_gradient_by_differences(monkeypatch):
    monkeypatch.setattr(lm_scoring, "F32", np.float64)
    rng = np.random.default_rng(0)
    net, *_ = small_network()
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    rows, cls = rng.integers(0, 40, (2, lm_scoring.WINDOW)), rng.integers(0, lm_scoring.CLASSES, (2, lm_scoring.STRIDE))
    rows[0, : lm_scoring.CONTEXT] = lm_scoring.PAD_ROW
    valid = rng.random(cls.shape) > 0.2
    grads, loss = net.gradient(rows, cls, valid)
    assert abs(loss + (net.log_class(rows, cls) * valid).sum() / valid.sum()) < 1e-6
    for name in net.NAMES:
        w = getattr(net, name)
        i = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        old, step = w[i], 1e-5
        w[i] = old + step
        up = net.gradient(rows, cls, valid)[1]
        w[i] = old - step
        down = net.gradient(rows, cls, valid)[1]
        w[i] = old
        assert abs((up - down) / (2 * step) - grads[name][i]) < 1e-4 * max(1, abs(grads[name][i]))


def test_lm_words_to_ids():
    subwords = lm_scoring.Subwords(lm_scoring.read_vocabulary(lm_scoring.VOCABULARY))
    words = [b"hello", b"x" * 700, "é".encode() * 300, b"the", b"<|endoftext|>", b"\x00a", b"hello"]
    flat, sizes = subwords.many(words)
    assert flat.tolist() == subwords.ids(words).tolist() and len(sizes) == len(words) and subwords.many([b"hello", b"the"])[1].tolist() == [1, 1]
    assert subwords.coder.decode(subwords.ids(words[:2]).tolist()) == " hello " + "x" * 700 and subwords.ids([]).size == 0


def test_lm_most_frequent_is_bounded(spark):
    df = spark.createDataFrame([(str(i), 1 + i // 10) for i in range(1000)], "word string, n long")
    for limit in (0, 5, 100, 2000):
        got = [r["n"] for r in lm_scoring.most_frequent(df, limit).collect()]
        assert len(got) <= limit and (not got or min(got) > max([1 + i // 10 for i in range(1000) if 1 + i // 10 not in got], default=0))
    assert len(got) == 1000


def test_lm_trains_on_every_id(spark):
    raw = lm_scoring.read_vocabulary(lm_scoring.VOCABULARY)
    subwords = lm_scoring.Subwords(raw)
    texts = [None, "", "one", *(" ".join(f"w{i * j % 97}" for j in range(200 + i)) for i in range(50))]
    counts = np.bincount(np.concatenate([subwords.ids([w.encode() for w in words_of(t)]) for t in texts if t]), minlength=subwords.size)
    row, cls = lm_scoring.clusters([], counts)
    net = lm_scoring.Network(row, cls, lm_scoring.within_class(np.append(counts, len(texts)), cls)[1])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    before = net.weights()
    assert lm_scoring.average(net, docs, lm_scoring.Reader(raw, [b"w1", b"w96", b"unseen"])) == counts.sum() + 2 * len(texts) and (net.weights() != before).any()


def test_lm_clusters_come_from_all_texts(spark):
    raw = lm_scoring.read_vocabulary(lm_scoring.VOCABULARY)
    subwords = lm_scoring.Subwords(raw)
    texts = [None, "", *(" ".join(f"w{i * j % 97} the" for j in range(20 + i % 7)) for i in range(2_000))]  # more than a start of 1,500
    seqs = [subwords.ids([w.encode() for w in words_of(t)]) for t in texts if t]
    counts = np.bincount(np.concatenate(seqs), minlength=subwords.size)
    want = lm_scoring.neighbours(seqs, counts)
    rank = lm_scoring.ranks(counts)
    assert want.sum() == sum(int((np.abs(np.arange(len(s)) - i) <= lm_scoring.NEAR).sum()) - 1 for s in seqs for i in np.flatnonzero(rank[s] < lm_scoring.SINGLES))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assert (lm_scoring.all_neighbours(docs, lm_scoring.Reader(raw, [b"the", b"w1"]), counts) == want).all()


def test_lm_stores_ids_once(spark, monkeypatch):
    raw = lm_scoring.read_vocabulary(lm_scoring.VOCABULARY)
    subwords = lm_scoring.Subwords(raw)
    texts = [None, "", "The same", "The same", "y" * 700, *(" ".join(f"w{i * j % 97} é" for j in range(20 + i % 7)) for i in range(600))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    reader = lm_scoring.Reader(raw, [b"the", b"w1"])
    stored = lm_scoring.stored_ids(docs, reader)
    got = sorted(np.frombuffer(r["ids"], subwords.kind).tolist() for r in stored.collect())
    assert got == sorted([subwords.end, *subwords.ids([w.encode() for w in words_of(t)] if t else []).tolist(), subwords.end] for t in texts)
    assert {r["share"] for r in stored.collect()} == set(range(lm_scoring.ROUNDS))
    # Training and the clusters read these alone: no text is encoded again.
    monkeypatch.setattr(lm_scoring.Reader, "read", None)
    counts = np.bincount(np.concatenate(got), minlength=subwords.size + 2)[: subwords.size]
    row, cls = lm_scoring.clusters([], counts)
    net = lm_scoring.Network(row, cls, lm_scoring.within_class(np.append(counts, len(texts)), cls)[1])
    assert lm_scoring.stored_average(net, stored, subwords) == sum(map(len, got))
    assert lm_scoring.stored_neighbours(stored, subwords.kind, counts).sum() > 0


def test_lm_steps_keep_their_memory():
    net, _, cls, _ = small_network()
    seqs = [np.random.default_rng(i).integers(0, 40, 400).astype(np.int32) for i in range(150)]
    lm_scoring.keep_memory()
    adam = lm_scoring.Adam(net)
    lm_scoring.train_on(net, seqs, 41, 0.01, 1, adam)
    before, steps = resource.getrusage(resource.RUSAGE_SELF).ru_minflt, adam.done
    lm_scoring.train_on(net, seqs, 41, 0.01, 2, adam)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 100 * (adam.done - steps)


def test_lm_adam_by_hand():
    net, *_ = small_network()
    adam, rng = lm_scoring.Adam(net), np.random.default_rng(0)
    w = net.weights().astype(np.float64)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, 5):
        grads = {n: rng.standard_normal(getattr(net, n).shape).astype(np.float32) for n in net.NAMES}
        g = np.concatenate([grads[n].ravel() for n in net.NAMES]).astype(np.float64)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        adam.step(net, grads, 0.02)
        assert np.abs(net.weights() - w).max() < 1e-5


def test_lm_without_training_rows(spark):
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([(out, "a b")], "doc_id long, text string")
    (r,) = lm_scoring.report(df).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0)
    assert lm_scoring.report(df.limit(0)).count() == 0


# Personal data ----------------------------------------------------------------------------


def spans_by_hand(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_patterns_against_plain_regexes():
    rng = random.Random(1)
    for _ in range(4000):
        t = "".join(rng.choice("01259.+-@ ()a.b@é") for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(t) == spans_by_hand(t)


def test_patterns_are_linear():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 100_000, "+1" + "(" * 200_000, "1 " * 200_000):
        pii.base_spans(t)


def test_field_on_a_table_it_has_not_seen():
    model = pii.default_model()
    rows = pii.labelled_table(seed=99, rows=300)
    where = [pii.tokens(t, 0, len(t)) for t, _ in rows]
    tags = pii.viterbi([pii.rows_of(*pii.encode(t, w)) for (t, _), w in zip(rows, where)], model)
    made = [set(pii.spans_of(g, w)) for g, w in zip(tags, where)]
    right = sum(len(m & set(s)) for m, (_, s) in zip(made, rows))
    assert right / sum(map(len, made)) > 0.95 and right / sum(len(s) for _, s in rows) > 0.85


def test_viterbi_and_gradient_against_all_paths(monkeypatch):
    import itertools

    rng = np.random.default_rng(3)
    k = len(pii.LABELS)
    w, trans = rng.normal(0, 0.5, (pii.N_FEATURES, k)), rng.normal(0, 0.5, (k, k))
    texts = ["a@b.c", "x 1", "+1 2"]
    feats = [pii.rows_of(*pii.encode(t, pii.tokens(t, 0, len(t)))) for t in texts]
    gold = [np.array([pii.LABELS.index(n) for n in tags]) for tags in (["B-email", *["I-email"] * 4], ["O", "B-ip"], ["O", "B-phone", "I-phone"])]

    def path_scores(x, bonus):
        e = w[x].sum(axis=1)
        e[:, 0] += bonus
        limit = trans + pii.allowed()
        return {
            p: sum(e[i, t] for i, t in enumerate(p)) + sum(limit[a, b] for a, b in zip(p, p[1:])) - (1e4 if pii.LABELS[p[0]][0] == "I" else 0)
            for p in itertools.product(range(k), repeat=len(x))
        }

    for size in (1 << 15, 2):  # at once, and in slices
        monkeypatch.setattr(pii, "SLICE", size)
        for x, tags in zip(feats, pii.viterbi(feats, (w, trans + pii.allowed()))):
            scores = path_scores(x, pii.MARGIN / 2)
            assert tuple(tags.tolist()) == max(scores, key=scores.get)
    goal = pii.Likelihood(feats, gold)
    value, grad, grad_t = goal.gradient(w, trans)
    want = 0.0
    for x, y in zip(feats, gold):
        scores = path_scores(x, 0)
        want += scores[tuple(y.tolist())] - np.logaddexp.reduce(list(scores.values()))
    assert abs(value - want) < 1e-8
    for g, v in ((grad, w), (grad_t, trans)):
        for i in zip(*(rng.integers(0, n, 6) for n in v.shape)):
            i = i if g is grad_t else (int(rng.choice(feats[0].ravel())), i[1])
            old = v[i]
            v[i] = old + 1e-5
            up = goal.gradient(w, trans)[0]
            v[i] = old - 1e-5
            down = goal.gradient(w, trans)[0]
            v[i] = old
            assert abs((up - down) / 2e-5 - g[i]) < 1e-6


def test_windows_find_what_whole_texts_hold(spark, sf):
    """The field over whole texts adds the same spans as over windows."""
    model = pii.default_model()
    texts = [r["text"] for r in table(spark, sf, "documents").collect() if r["text"] and pii._ANCHOR.search(r["text"])][:150]
    texts += ["word " * 30 + t + " word" * 30 for t, _ in pii.labelled_table(seed=5, rows=200)]
    base = [pii.base_spans(t) for t in texts]
    for t, b, got in zip(texts, base, pii.added_spans(texts, base, model)):
        where, held = pii.tokens(t, 0, len(t)), pii.Covered(b)
        tags = pii.viterbi([pii.rows_of(*pii.encode(t, where))], model)[0]
        assert [s for s in pii.spans_of(tags, where) if pii.sound(s[0], t[s[1] : s[2]]) and not held.meets(*s[1:])] == got


def test_field_is_linear_in_matches_and_tokens():
    import time

    model, began = pii.default_model(), time.time()
    many = " ".join(f"ann{i}@host{i}.example.org" for i in range(16_000))
    assert pii.added_spans([many], [pii.base_spans(many)], model) == [[]]
    numbers = "12 7 " * 40_000
    assert pii.added_spans([numbers], [pii.base_spans(numbers)], model) == [[]]
    assert time.time() - began < 20


def test_windows_reach_past_every_anchor():
    for t in (
        "write to jane42 [at] example [dot] com", "room 12 ask jane [at] example [dot] com", "a@b.com, jane (at) example (dot) org",
        "jane [at] example [dot] co [dot] uk", "1 a b 2 c d e [at] f g h",
    ):
        assert [t[a:b].strip() for a, b in pii.windows(t)] == [t]
    assert len(pii.windows("1 " + "x " * 20 + "2")) == 2
    assert not any(pii.Covered([("ip", 3, 5), ("card", 4, 9), ("ip", 20, 22)]).meets(a, b) for a, b in ((0, 3), (9, 20), (22, 30)))
    assert all(pii.Covered([("ip", 3, 5), ("card", 4, 9), ("ip", 20, 22)]).meets(a, b) for a, b in ((0, 4), (8, 9), (1, 30), (21, 22)))
    pii.windows("1 " * 200_000), pii.windows("1" * 400_000)


def test_report_and_redaction(spark):
    extra = [(20, "ann.b@x.org, 10.1.2.3 or +1 (257) 555-8854; 4061026190267370!"), (21, "mary (at) host (dot) org"), (22, "Ü 😀 a@b.de")]
    df = odd(spark, extra)
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    assert (got[20]["n_email"], got[20]["n_ip"], got[20]["n_card"], got[20]["n_phone"]) == (1, 1, 1, 1)
    assert got[20]["base_sha256"] == pii.digest(spans_by_hand(extra[0][1])) and got[22]["spans"] == "email:4:10"
    assert got[21]["n_email"] == 0 and got[21]["spans"] == "email:0:24" and got[1]["spans"] == ""
    docs = spark.createDataFrame([(i, t, "l", "s", len(t or "")) for i, t in [*ODD, *extra]], DOCS)
    clean = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert clean[20]["text"] == "[EMAIL], [IP] or [PHONE]; [CARD]!" and clean[20]["n_chars"] == len(clean[20]["text"])
    assert clean[1]["text"] is None and clean[7]["text"] == ODD[8][1]
    assert pii.report(df.limit(0)).count() == 0


def test_many_bracketed_forms_in_one_run_are_linear():
    import time

    model = pii.default_model()
    for piece in ("a[at]a", "a [at] b [dot] c ", "(at)(dot)", "x[at]y[dot]com", "a@", "1.", "+1 "):
        text = piece * 25_000
        began = time.process_time()
        base = pii.base_spans(text)
        added = pii.added_spans([text], [base], model)[0]
        assert time.process_time() - began < 12, piece
        assert all(b - a <= pii.LONGEST[k] for k, a, b in added)
    assert not pii.sound("email", "a[at]" + "b" * 500 + "[dot]org") and pii.sound("email", "name [at] host [dot] org")
