"""What must hold at any length: segmented scans, streaming digests, rule covers, exact quantiles, spaces and bytes of all kinds."""

import hashlib
import random
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import convert, ranges, report, scan, sequence, stats, validate, verify


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_segments_equal_plain_windows(spark, size):
    rng = random.Random(size)
    rows = [(g, i, rng.randint(0, 3), rng.choice([None, 1, 5]), rng.choice([None, "a", "b"])) for g in ("x", "y", None) for i in rng.sample(range(-50, 300), 80)]
    rows += [("x", 1000, 0, 1, "z"), ("x", 1000, 1, 2, "y")]  # a tie of the order that the next column decides
    df = spark.createDataFrame(rows, "g string, i long, j int, n int, s string").repartition(5)
    got = scan.segmented(df, ["g"], ["i", "j"], sums={"before": F.col("n")}, lags={"last": F.col("s"), "i_last": F.col("i")}, number="place", size=size)
    w = Window.partitionBy("g").orderBy("i", "j")
    want = df.withColumns({"before": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "last": F.lag("s").over(w), "i_last": F.lag("i").over(w), "place": F.row_number().over(w)})
    assert got.columns == want.columns and rows_of(got, *want.columns) == rows_of(want, *want.columns)
    other = scan.segmented(df.withColumn("i", F.col("i").cast("string")), ["g"], ["i", "j"], number="place")  # no whole numbers, no segments
    assert other.count() == len(rows) and scan.segmented(df.limit(0), ["g"], ["i"], number="place").count() == 0


def test_one_module_is_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(scan, "SIZE", 50)
    records = spark.range(1000).select(F.lit("m").alias("module"), F.col("id").alias("i"), F.lit("Gen").alias("osis"), F.col("id").cast("string").alias("key"), (F.col("id") % 7 + 1).alias("c"), (F.col("id") % 3 + 1).alias("v"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("raw"))
    laid = scan.segmented(records, ["module"], ["i"], number="n", size=50)
    assert laid.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 1
    days = {r["day_number"]: r["content"] for r in convert.devotional_table(records).collect()}
    assert days == {i + 1: f"word {i}" for i in range(1000)}
    entries = {r["entry_id"]: r["content"] for r in convert.commentary_tables(records)["commentary_entry"].collect()}
    assert entries == {i + 1: f"word {i}" for i in range(1000)}


def test_digest_of_long_groups_a_batch_at_a_time(spark):
    df = spark.range(200_000).select((F.col("id") % 2 * (F.col("id") % 50 == 1).cast("int")).alias("g"), F.col("id"), F.concat(F.col("id").cast("string"), F.lit("é\n")).alias("line"))
    df = df.unionByName(spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), (None, 3, None), (9, 1, None)], "g int, id long, line string")).repartition(9)
    got = {r["g"]: r["content_sha256"] for r in sequence.content_hash(df, "g", ["id"], F.col("line")).collect()}
    inside = lambda g: "".join(f"{i}é\n" for i in range(200_000) if (1 if i % 50 == 1 and i % 2 else 0) == g)
    assert got == {0: hashlib.sha256(inside(0).encode()).hexdigest(), 1: hashlib.sha256(inside(1).encode()).hexdigest(), None: hashlib.sha256(b"ab").hexdigest(), 9: hashlib.sha256(b"").hexdigest()}


def test_covers_are_exact_and_small(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.choice([0, 1, 3, 15, 16, 200, 5000])) for a in (rng.randint(-300, 3000) for _ in range(300))]
    df = spark.createDataFrame(spans, "low long, high long")
    for top in (0, 2, 6):
        for r in df.select("low", "high", ranges.cover(F.col("low"), F.col("high"), top).alias("n")).collect():
            if top:
                assert len(r["n"]) <= 2 * (ranges.FAN - 1) * top + (r["high"] - r["low"] + 1) // ranges.FAN**top + 1
            held = sorted(x for n in r["n"] for x in range(n["node"] * ranges.FAN ** n["level"], (n["node"] + 1) * ranges.FAN ** n["level"]))
            assert held == list(range(r["low"], r["high"] + 1))


def test_first_rule_of_many(spark):
    rng = random.Random(2)
    rules = [(rng.choice("ab"), a, a + rng.choice([0, 2, 30, 999]), rng.randint(0, 300), i) for i, a in enumerate(rng.randint(-50, 4000) for _ in range(400))] + [("a", 5, 4, 0, -1), ("c", 0, 9, 0, 7)]
    df = spark.createDataFrame(rules, "g string, low long, high long, rule_order int, target int")
    rows = [(rng.choice(["a", "b", "d", None]), rng.choice([None, rng.randint(-100, 5000)])) for _ in range(500)]
    found = ranges.first_rule(spark.createDataFrame(rows, "g string, v int"), df, ("g",), "v")
    first = lambda g, v: min(((o, t) for h, a, b, o, t in rules if h == g and v is not None and a <= v <= b), default=(None, None))[1]
    assert sorted(map(repr, map(tuple, found.select("g", "v", "target").collect()))) == sorted(repr((g, v, first(g, v))) for g, v in rows)
    many = spark.range(100_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 1_000_003).alias("low"), F.col("id").alias("rule_order"), F.col("id").alias("target")).withColumn("high", F.col("low") + F.col("rule_order") % 1000)
    probe = spark.range(1_000_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    joined = ranges.first_rule(probe, many, ("g",), "v")
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString() and joined.where("target IS NOT NULL").count() > 900_000
    none = ranges.first_rule(probe.limit(3), df.limit(0).withColumn("g", F.lit(1).cast("long")), ("g",), "v")
    assert none.where("target IS NULL").count() == 3


@pytest.mark.parametrize("q", [0.0, 0.3, 1.0])
def test_quantiles_against_sorted_values(spark, monkeypatch, q):
    monkeypatch.setattr(stats, "FINAL_ROWS", 5)
    monkeypatch.setattr(stats, "BUCKETS", 4)
    rng = random.Random(4)
    groups = {"even": [float(i % 10) for i in range(200)], "gap": [0.0] * 50 + [1e9] * 50, "tail": [10.0 ** rng.randint(-5, 12) for _ in range(101)], "one": [3.5], "same": [2.0] * 30, "signs": [rng.gauss(0, 1) for _ in range(150)], None: [1.0, 2.0]}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("one", None), ("one", float("nan")), ("void", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    got = {r["g"]: r["quantile"] for r in stats.quantile(df, ["g"], F.col("x"), q).collect()}
    assert got == {g: pytest.approx(float(np.quantile(xs, q))) for g, xs in groups.items()}
    alone = stats.quantile(df.where("g = 'signs'"), [], F.col("x"), q, "m").collect()
    assert [r["m"] for r in alone] == [pytest.approx(float(np.quantile(groups["signs"], q)))]
    assert stats.quantile(df.where("false"), [], F.col("x"), q).count() == 0


def one(spark, value, kind, make):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


def test_structure_of_bytes(spark):
    def structural(b: bytes) -> bool:  # lead byte, then as many bytes of the form 10xxxxxx
        i = 0
        while i < len(b):
            n = 0 if b[i] < 0x80 else 1 if 0xC2 <= b[i] <= 0xDF else 2 if 0xE0 <= b[i] <= 0xEF else 3 if 0xF0 <= b[i] <= 0xF4 else None
            if n is None or i + n >= len(b) + (n == 0) or any(x & 0xC0 != 0x80 for x in b[i + 1 : i + 1 + n]):
                return False
            i += 1 + n
        return True

    rng = random.Random(3)
    edges = [b"", b"a\n", b"\xc3\xa9", b"\xc3", b"\xe2\x82", b"\xed\xa0\x80", b"\xe0\x80\x80", b"\xf0\x80\x80\x80", b"\xf4\xbf\xbf\xbf", b"\xf5\x80\x80\x80", b"\xc0\x80", b"\xc1\xbf", b"\x80", b"\xff", b"ok \xe9"]
    cases = edges + [bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xED, 0xF0, 0xF4, 0xF5, 0x0A]) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(cases)], "i int, b binary")
    got = {r["i"]: r["y"] for r in df.select("i", text.is_structural_utf8(F.col("b")).alias("y")).collect()}
    assert got == {i: structural(b) for i, b in enumerate(cases)}
    assert structural(b"\xed\xa0\x80") and structural(b"\xe0\x80\x80") and not structural(b"\xc0\x80")
    assert one(spark, bytearray(b"x" * 1_000_000 + b"\xe9"), "binary", text.is_structural_utf8) is False
    assert "�" in one(spark, bytearray(b"a\xed\xa0\x80b"), "binary", text.repaired) and one(spark, bytearray(b"caf\xe9"), "binary", lambda c: text.repaired(c, False)) == "café"


def test_spaces_of_all_scripts(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["﻿", "​"]
    rows = [(s, f"one{s}two {s} *") for s in spaces]
    for r in spark.createDataFrame(rows, "s string, x string").withColumn("n", text.count_lettered_words(F.col("x"))).collect():
        assert r["n"] == sum(any(ch.isalnum() for ch in t) for t in r["x"].split()), hex(ord(r["s"]))
    assert one(spark, "a b﻿c\x85d\x1ce", "string", text.count_web_words) == 3
    codes = lambda x: set(one(spark, x, "string", text.hygiene_codes))
    for x in (" a", "a\u0085", "a  b", "a\x1c"):
        assert "whitespace" in codes(x), repr(x)
    assert "usfm_attribute" in codes('a| lemma = "x"') and "strongs_tag" not in codes("éstrong:G1") and "strongs_tag" in codes("-strong:G1") and "strongs_number" in codes("G١٢٣") and unicodedata.category("١") == "Nd"


def test_word_counts_read_each_character_once(spark):
    rng = random.Random(8)
    some = "aZ5*-é¡ɐж٣中😀𝔸ﬁ́​­\x01\x7f\x84" + "  \t\x1c\x85\xa0    　﻿"
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    apart = lambda x, spaces: "".join(" " if c in spaces else c for c in x).split(" ")
    units, web = {c for c in some if c.isspace()}, {c for c in some if c.isspace() and c not in "\x1c\x85"} | {"﻿"}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", text.count_lettered_words(F.col("x")), text.count_web_words(F.col("x")))
    want = [(i, sum(any(unicodedata.category(c)[0] in "LN" for c in w) for w in apart(x, units)), sum(w != "" for w in apart(x, web))) for i, x in enumerate(texts)]
    assert sorted(map(tuple, df.collect())) == want
    # A plain count is the yardstick: the ranges of the rarer spaces used to cost over ten times as much.
    long = spark.range(0, 8, 1, 4).select(F.repeat(F.lit("the quick brown fox jumped, "), 30_000).alias("x")).localCheckpoint()

    def seconds(count):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            long.select(F.sum(count(F.col("x")))).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    plain = seconds(text.count_space_words)
    assert seconds(text.count_lettered_words) < 5 * plain and seconds(text.count_web_words) < 5 * plain, plain


def test_what_the_raw_source_has_is_inherited(spark):
    schema = "verse_id long, text string, raw string"
    source = spark.createDataFrame([(1, "plain", "<w>a</w> &gt; b"), (2, "plain", "nothing"), (3, "3,20>", "x"), (4, None, "&#123;"), (5, "plain", None)], schema)
    result = spark.createDataFrame([(1, "a > b"), (2, "c > d"), (3, "3,20>"), (4, "{"), (5, "fine")], "verse_id long, text string")
    found = {r["code"]: (r["severity"], r["n"]) for r in report.hygiene_findings(source, result).collect()}
    assert found == {"text_angle_bracket": ("warn", 3), "text_braces_inherited": ("warn", 1)}
    marks = {r["code"]: (r["introduced"], r["inherited"]) for r in verify.hygiene(result, source, "verse_id").collect()}
    assert marks == {"angle_bracket": (1, 2), "braces": (0, 1)}


def test_positions_by_the_stored_number_of_words(spark):
    verses = spark.createDataFrame([(1, 3), (2, None)], "verse_id long, word_count int")
    words = spark.createDataFrame([(1, 2, 1), (1, 0, 3), (1, -1, 0), (1, None, 2), (2, 0, 9), (2, -1, 0), (3, 9, 9)], "verse_id long, word_position_start int, word_position_end int")
    assert rows_of(validate.positions_out_of_bounds(words, verses), "verse_id", "word_position_start") == [(1, -1), (1, 0), (2, -1)]
