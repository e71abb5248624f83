"""Keys, references, markup, text functions and ranking on small cases."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from quire.functions import keys, markup, text
from quire.functions.refs import Books, code_reference, parse_loose, parse_reference, parse_reference_list, phrase_groups
from quire.operators import fulltext

BOOKS = Books()


def col(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


def one(df, expression):
    return df.select(expression.alias("y")).first()["y"]


def test_references():
    assert parse_reference("John 3:16", BOOKS) == (43003016, 43003016)
    assert parse_reference("Gen 1:1-5", BOOKS) == (1001001, 1001005)
    assert parse_reference("Ps 23", BOOKS) == (19023001, 19023999)
    assert parse_reference("2 Cor 5:21-19", BOOKS) == (47005021, 47005019)
    with pytest.raises(ValueError):
        parse_reference("Nowhere 3:16", BOOKS)
    assert parse_loose("43003016", BOOKS) == 43003016 and parse_loose("3 John 1.14", BOOKS) == 64001014 and parse_loose("Jo 1:1", BOOKS) is None
    assert code_reference("Bible:Josh.17.1-Josh.17.2", BOOKS) == 6017001 and code_reference("X.1.1", BOOKS) == 0
    assert BOOKS.format_range(47005019, 47005021) == "2Cor 5:19-2Cor 5:21" and BOOKS.format(99001001) == "Unknown(99001001)"


def test_reference_lists():
    read = lambda s, b=45, c=8: [BOOKS.format_range(*x) for x in parse_reference_list(s, b, c, BOOKS)]
    assert read("35-39; 5:3,4; Gen 50:20") == ["Rom 8:35-Rom 8:39", "Rom 5:3", "Rom 5:4", "Gen 50:20"]
    assert read("Josh 14:1-21:45") == ["Josh 14:1-Josh 21:45"]
    assert read("Rom 1:1; 6:22; 16") == ["Rom 1:1", "Rom 6:22", "Rom 16:1"]
    assert read("Jude 3,4") == ["Jude 1:3", "Jude 1:4"] and read("9-3; 7") == ["Rom 8:7"] and read("") == [] and read(None) == []


def test_phrases():
    html = '<a href="x">1</a><br/>Heading<br /><a>Gen 1:1</a><br>In the <b>beginning</b><BR/><a>Prov 8:22</a><br/>empty phrase'
    assert phrase_groups(html) == [(None, ["Gen 1:1"]), ("In the beginning", ["Prov 8:22"])]
    assert phrase_groups(None) == []


def test_markup_spans_cover_words():
    p = markup.parse("The <divineName>LORD</divineName> <transChange type='added'>is</transChange> my shep<hi type='bold'>herd</hi>; I shall not want.")
    assert p["text"] == "The LORD is my shepherd; I shall not want." and p["word_count"] == 9
    assert [(s["type"], s["start"], s["end"]) for s in p["spans"]] == [("divine_name", 1, 1), ("supplied", 2, 2), ("emphasis", 4, 4)]


def test_markup_drops_and_lifts():
    p = markup.parse("<title>A  song</title>¶One<note>gone <b>x</b></note> <seg type='x-variant' subType='x-2'>other</seg> two<sup class='n'>a</sup><br/>three &amp; &#8212; four &lt;note&gt;out&lt;/note&gt; \\it five\\it*")
    assert p["text"] == "One two three & — four five" and p["block"]["heading"] == "A song" and p["block"]["paragraph_start"]
    assert not p["trailing_paragraph"] and markup.parse("last ¶")["trailing_paragraph"]


def test_markup_milestones_words_and_poetry():
    p = markup.parse('<l level="2">He <q who="Jesus" sID="a"/>said <w lemma="strong:G3004 strong:G1 lemma.TR:lego" morph="robinson:V-AAI">I am</w> <w lemma="strong:G1"/>he<q eID="a"/> <q>open')
    assert [(s["type"], s["start"], s["end"]) for s in p["spans"]] == [("words_of_christ", 1, 4), ("quotation", 5, 5)]
    w = p["words"]
    assert [(x["strongs_number"], x["start"], x["end"], x["gloss"]) for x in w] == [("G3004", 2, 3, "I am"), ("G1", 4, 4, None)]
    assert w[0]["all_strongs"] == "G3004 G1" and w[0]["original_word"] == "lego" and w[0]["morphology"] == "V-AAI" and p["block"]["poetry_level"] == 2
    assert markup.parse(None)["word_count"] == 0 and markup.formatting_of(markup.parse("plain")) is None
    assert markup.parse('<font color="red">A <font face="x">B</font> C</font> D')["spans"][0]["end"] == 2


def test_markup_in_columns(spark):
    df = spark.createDataFrame([(1, "<i>a</i> b"), (2, None), (3, "plain")], "k int, raw string")
    rows = {r["k"]: r for r in df.select("k", markup.parsed(F.col("raw")).alias("p")).select("k", "p.text", markup.formatting(F.col("p.block"), F.col("p.spans")).alias("f")).collect()}
    assert rows[1]["f"] == '{"v":1,"spans":[{"type":"supplied","start":0,"end":0}]}' and rows[2]["text"] == "" and rows[3]["f"] is None


@pytest.mark.parametrize(
    ("value", "want"),
    [("Public Domain", "PD"), ("Creative Commons: BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"), ("CC BY 3.0", "CC-BY-3.0"), ("cc0", "CC0-1.0"), ("GPL v3", "GPL-3.0-or-later"), ("Copyrighted; Free non-commercial distribution", "LicenseRef-SWORD-FreeNonCommercial"), ("  ", ""), (None, "")],
)
def test_licences(spark, value, want):
    assert one(col(spark, value), text.licence_to_spdx(F.col("x"))) == want


def test_text_functions(spark):
    assert one(col(spark, r"\pard One\par two \{x\} <p>three &amp; four\'"), text.strip_rtf(F.col("x"))) == "One two {x} three & four'"
    assert one(col(spark, "in 19999 and 1611."), text.first_year(F.col("x"))) == 1611
    assert one(col(spark, "ku-Arab-IQ"), text.is_right_to_left(F.col("x"), F.lit(None).cast("string"))) is True
    assert one(col(spark, "he"), text.is_right_to_left(F.col("x"), F.lit("LtoR"))) is False
    assert one(col(spark, "a<b>c</b> &lt;¶  d"), text.strip_markup_clean(F.col("x"))) == "ac < d"
    assert one(col(spark, "strong:g0123 lemma.TR:x strong:H7"), F.array_join(text.strongs_numbers(F.col("x")), ",")) == "G0123,H7"
    assert one(col(spark, "H07225"), text.plain_strongs(F.col("x"))) == "H7225"
    assert one(col(spark, "robinson:T-NSM x"), text.plain_morphology(F.col("x"))) == "T-NSM x"
    assert one(col(spark, bytearray(b"caf\xc3\xa9 \x93q\x94"), "binary"), text.repaired(F.col("x"))) == "café “q”"
    assert one(col(spark, bytearray(b"\xe9\x85"), "binary"), text.latin1_to_text(F.col("x"))) == "é…"
    assert one(col(spark, "Ab—c´ ÉX 1"), text.normal_text(F.col("x"))) == "abcéx1"
    assert one(col(spark, "CC-BY-NC-ND-4.0"), text.spdx_url(F.col("x"))) == "https://creativecommons.org/licenses/by-nc-nd/4.0/"
    key = text.identity_key(F.lit("xref"), F.col("x"), F.lit("EN"))
    got = one(col(spark, "TSK"), text.deterministic_uuid(key))
    assert len(got) == 36 and got[14] == "8" and got[19] in "89ab" and one(col(spark, "TSK"), key) == "cross_reference:tsk:en"


def test_similarity(spark):
    rows = [("abcd", "abcd"), ("", "x"), ("abcdefgh", "abcdefgx"), ("abc", "xyz"), (None, "a")]
    got = [r["s"] for r in spark.createDataFrame(rows, "a string, b string").select(text.similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [1.0, 0.0, 0.875, 0.0, None]


def test_hygiene(spark):
    bad = {"html_tag": "a <b>", "angle_bracket": "a < b", "entity": "&amp;", "pilcrow": "\u00b6", "backslash": "\\", "strongs_number": "x G123 y", "braces": "{", "control_char": "\x07", "replacement_char": "\ufffd", "mojibake": "\u00c3\u00a9", "whitespace": "a  b", "odd_space": "a\u2003b", "zero_width": "a\u200bb", "private_use": "\ue123", "note_marker": "\u2020", "double_bracket": "[[", "usfm_attribute": "| lemma=\"x\"", "strongs_tag": "strong:G1"}
    df = spark.createDataFrame(list(bad.items()), "code string, x string")
    for r in df.select("code", text.hygiene_codes(F.col("x")).alias("found")).collect():
        assert r["code"] in r["found"], r
    assert one(col(spark, "Clean text, with “quotes”."), F.size(text.hygiene_codes(F.col("x")))) == 0


def test_keys(spark):
    df = spark.createDataFrame([(43003016, 43003016), (47005019, 47005021), (1, None)], "a long, b long")
    name = F.when(keys.book_of(F.col("a")) > 0, F.concat(F.lit("B"), keys.book_of(F.col("a"))))
    got = [r["r"] for r in df.select(keys.format_range(F.col("a"), F.col("b"), name, name).alias("r")).collect()]
    assert got == ["B43 3:16", "B47 5:19-B47 5:21", "Unknown(1)"]
    assert [r["e"] for r in df.select(keys.range_end(F.col("a"), F.col("b")).alias("e")).collect()] == [43003016, 47005021, 1]


@pytest.mark.parametrize(("word", "stem"), [("loving", "love"), ("caresses", "caress"), ("ponies", "poni"), ("relational", "relat"), ("hopping", "hop"), ("happy", "happi"), ("sky", "sky"), ("generalizations", "gener"), ("agreed", "agre"), ("controlling", "control")])
def test_porter(word, stem):
    assert fulltext.porter(word) == fulltext.porter(stem) if word == "loving" else fulltext.porter(word) == stem


def test_rank_equals_the_index_of_a_database(spark):
    con = sqlite3.connect(":memory:")
    try:
        con.execute("CREATE VIRTUAL TABLE t USING fts5(body, tokenize='porter unicode61')")
    except sqlite3.OperationalError:
        pytest.skip("no full-text module")
    rows = [(1, "For God so loved the world"), (2, "love, loving and the World"), (3, "a café in the world of words"), (4, "nothing here"), (5, "loves the sea"), (6, "the earth"), (7, "other things altogether")]
    con.executemany("INSERT INTO t(rowid, body) VALUES (?, ?)", rows)
    index = fulltext.postings(spark.createDataFrame(rows, "doc_id long, body string"), "doc_id", "body", stem=True)
    plain = ("love", "love world", '"the world"', "lov* NOT sea", "cafe OR earth", "nothing OR altogether", "(love OR cafe) AND world", "world NOT love god", "love OR cafe AND words", "NEAR(the world, 2)", "NEAR(loved world, 0)")
    for q in plain:
        want = dict(con.execute("SELECT rowid, rank FROM t WHERE t MATCH ? ORDER BY rank", (q,)).fetchall())
        got = {r["doc_id"]: r["rank"] for r in fulltext.search(index, q, stem=True).collect()}
        assert set(got) == set(want), q
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want) or "NEAR" in q, q


def test_snippet():
    words = " ".join(f"w{i}" for i in range(100))
    s = fulltext.snippet_of(words, ["w50", "w55"])
    assert s.startswith("...") and s.endswith("...") and ">>>w50<<<" in s and ">>>w55<<<" in s and len(s.split()) == 40
    assert fulltext.snippet_of("Ünder the sea.", ["under"]) == ">>>Ünder<<< the sea."


def test_section_html_and_kinds(spark):
    raw = 'One <a href="passagestudy.jsp?x=1">Luke 1:1</a><!/P><br /><!P><br />two   three\t\tfour<!P>'
    assert one(col(spark, raw), text.clean_section_html(F.col("x"))) == "<p>One Luke 1:1</p>\n<p>two threefour</p>"
    assert one(col(spark, " <h2>x</h2></p>\n"), text.clean_section_html(F.col("x"))) == " <h2>x</h2></p>\n"
    kind = lambda n, d, c: one(col(spark, n), text.dictionary_kind(F.col("x"), F.lit(d), F.lit(c)))
    assert [kind("StrongsGreek", "", ""), kind("Thayer", "", ""), kind("BDB", "", ""), kind("x", "A Glossary", ""), kind("x", "", "Glossaries"), kind("Easton", "", "")] == ["strongs", "greek_lexicon", "hebrew_lexicon", "glossary", "glossary", "bible_dictionary"]
    assert [one(col(spark, d), text.devotional_kind(F.col("x"))) for d in ("40 days", "Daily 40 days", "other")] == ["fixed_length", "day_of_year", "day_of_year"]


def test_plain_ranges():
    r = markup.plain_ranges('a <font color="red">b c</font> <i>d</i>e &amp; <u></u>f')
    assert r["text"] == "a b c de & f" and r["red"] == [(1, 2)] and r["italic"] == [(3, 3)] and r["underline"] == []


def test_query_language(spark):
    docs = spark.createDataFrame([(1, "alpha", "one two three four"), (2, "beta", "four three two one"), (3, "one", "alpha x x x beta"), (4, None, None)], "doc_id long, title string, body string")
    index = fulltext.columns_postings(docs, "doc_id", ["title", "body"])
    found = lambda q: sorted(r["doc_id"] for r in fulltext.search(index, q).collect())
    want = {
        "one NOT two three": [3], "one AND two OR beta": [1, 2, 3], "(alpha OR beta) AND one": [1, 2, 3], "title: one": [3], "- title: alpha": [3], "{title body}: (one two)": [1, 2], '"three four"': [1], '"one tw" *': [1],
        "NEAR(alpha beta, 3)": [3], "NEAR(alpha beta, 2)": [], 'NEAR("one two" four, 1)': [1], "": [], "NOT one": [],
    }
    assert {q: found(q) for q in want} == want
    for bad in ("(one", "one )", "nothing: one"):
        with pytest.raises(ValueError):
            fulltext.search(index if "(" in bad or ")" in bad else index.drop("col"), bad).collect()


def test_matching_blocks_against_the_plain_rule(monkeypatch):
    import difflib
    import random
    import time

    from quire.functions import blocks

    rng = random.Random(1)
    plain = lambda a, b: sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
    monkeypatch.setattr(blocks, "SMALL", 30)
    for t in range(2000):
        letters = rng.choice(["ab", "abc", "abcdefgh", "aé漢\U0001f600"])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        b = "".join(c if rng.random() < 0.9 else rng.choice(letters) for c in a) if t % 2 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert blocks.matched_letters(a, b) == plain(a, b), (a, b)
    monkeypatch.undo()
    a = " ".join(rng.choice(["the", "of", "light", "darkness", "was", "upon", "waters"]) for _ in range(4500))[:20_000]
    b = "".join(c if rng.random() > 0.05 else rng.choice("abcdefg ") for c in a)
    began = time.process_time()
    assert 0.9 * len(a) < blocks.matched_letters(a, b) <= len(a)
    assert time.process_time() - began < 3
    assert text.similarity_of(a, b) > 0.9
