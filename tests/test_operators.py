"""Operators on module-shaped fixtures."""

import json
import sqlite3

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions.refs import Books
from quire.operators import catalog, convert, fulltext, lookup, ranges, sequence, stats, textindex, trees, validate, verify, xrefs
from quire.sources import files, sinks, sqlite
from quire.sources.shared import published

TOPICS = [(1, None, "Israel", 1), (2, 1, "Manasseh", 1), (3, None, "Manasseh", 2), (4, 3, "Son of Joseph and Asenath", 1), (5, 3, "Tribe of", 2), (6, 5, "Inheritance of", 1), (7, 3, "King of Judah", 3)]
LINKS = [(1, "topic", 4, 1041050, 1041050, 1), (2, "topic", 6, 6017001, 6017002, 1)]
BOOKS = Books()


@pytest.fixture(scope="module")
def topics(spark):
    return spark.createDataFrame(TOPICS, "topic_id long, parent_topic_id long, name string, sort_order int")


@pytest.fixture(scope="module")
def links(spark):
    return spark.createDataFrame(LINKS, "link_id long, source_type string, source_id long, verse_id_start long, verse_id_end long, sort_order int")


@pytest.fixture(scope="module")
def canon(spark):
    rows = [(1, c, n) for c, n in ((1, 31), (2, 25))] + [(66, c, n) for c, n in ((12, 17), (13, 18))] + [(64, 1, 14)]
    return spark.createDataFrame(rows, "book long, chapter long, max_verse long")


def ids(df, name="topic_id"):
    return [r[name] for r in df.collect()]


def test_topics(spark, topics, links):
    root = lookup.resolve_node(topics, "Manasseh")
    assert ids(root) == [3] and ids(lookup.resolve_node(topics, "5")) == [5] and ids(lookup.resolve_node(topics, "joseph")) == [4] and ids(lookup.resolve_node(topics, "none")) == []
    top = lookup.with_counts(lookup.children(topics, "parent_topic_id", None), "topic_id", topics, "parent_topic_id", "n")
    assert [(r["name"], r["n"]) for r in top.orderBy("sort_order").collect()] == [("Israel", 1), ("Manasseh", 3)]
    walked = trees.descendants(topics, root, "topic_id", "parent_topic_id")
    assert sorted(ids(walked, "node")) == [3, 4, 5, 6, 7]
    found = links.join(walked, F.col("source_id") == F.col("node")).orderBy("verse_id_start").collect()
    assert [BOOKS.format_range(r["verse_id_start"], r["verse_id_end"]) for r in found] == ["Gen 41:50", "Josh 17:1-Josh 17:2"]
    assert sorted(ids(trees.descendants(topics, root, "topic_id", "parent_topic_id", 1), "node")) == [3, 4, 5, 7]
    crumb = trees.breadcrumb(topics, topics.where("topic_id = 6"), "topic_id", "parent_topic_id", "name").first()["crumb"]
    assert crumb == ["Manasseh", "Tribe of"]
    text = trees.render([r.asDict() for r in topics.orderBy("sort_order").collect()], 3)
    assert text.splitlines()[0] == "Manasseh  (#3)" and "  2. Tribe of" in text.splitlines() and "      1. Inheritance of" in text.splitlines()
    assert stats.node_stats(topics, "parent_topic_id", links).first().asDict() == {"topics": 7, "roots": 2, "subs": 5, "links": 2}


def test_cycles_end(spark):
    loop = spark.createDataFrame([(1, 2), (2, 1), (3, 3)], "id long, up long")
    assert sorted(ids(trees.descendants(loop, loop.where("id = 1"), "id", "up"), "node")) == [1, 2]
    assert ids(trees.ancestors(loop, loop.where("id = 1"), "id", "up"), "node") == [2]


def test_cascades(spark):
    d = spark.createDataFrame([(1, "G25", "agapao"), (2, "g25", "Love"), (3, "H1", "lovely"), (4, "H2", "unloved")], "entry_id long, entry_key string, word string")
    assert ids(lookup.define(d, "G25"), "entry_id") == [1] and ids(lookup.define(d, "h1"), "entry_id") == [3] and ids(lookup.define(d, "LOVE"), "entry_id") == [2]
    assert ids(lookup.define(d, "lov"), "entry_id") == [2, 3, 4] and ids(lookup.define(d, "zz"), "entry_id") == []
    v = spark.createDataFrame([(1, 1, "January 1"), (2, 2, "January 12")], "entry_id long, day_number int, date_label string")
    assert ids(lookup.devotional(v, "2"), "entry_id") == [2] and ids(lookup.devotional(v, "january 12"), "entry_id") == [2] and ids(lookup.devotional(v, "uary"), "entry_id") == [1] and ids(lookup.devotional(v, "02"), "entry_id") == []
    with pytest.raises(ValueError):
        lookup.key_list(d, "entry_id", ["x"])
    with pytest.raises(ValueError):
        lookup.read_only_sql(spark, "DROP TABLE x", {})
    assert lookup.read_only_sql(spark, "PRAGMA table_info(d)", {"d": d}).count() == 3


def test_overlap_join_against_nested_loop(spark):
    import random

    rng = random.Random(1)
    make = lambda n, wide: [(i, a, a + rng.choice([0, 3, 40, wide]) if rng.random() > 0.05 else None) for i in range(n) for a in [rng.randint(0, 20_000)]]
    a, b = make(300, 9000) + [(900, 50, 10)], make(200, 15_000)
    want = sorted((i, j) for i, s, e in a for j, t, f in b if e is not None and f is not None and s <= e and t <= f and s <= f and e >= t)
    left, right = spark.createDataFrame(a, "i long, a0 long, a1 long"), spark.createDataFrame(b, "j long, b0 long, b1 long")
    for width, wide in ((30, 64), (5, 4)):
        got = ranges.overlap_join(left, right, ("a0", "a1"), ("b0", "b1"), width, wide)
        assert sorted((r["i"], r["j"]) for r in got.collect()) == want
    plan = ranges.overlap_join(left, right, ("a0", "a1"), ("b0", "b1"), 30)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_sequences(spark):
    df = spark.createDataFrame([("m", 1, 5, "x"), ("m", 2, 5, "y"), ("m", 3, 6, "y"), ("m", 4, 6, "z"), ("m", 5, 7, "z")], "module string, i long, k long, raw string")
    assert [r["i"] for r in sequence.first_of_key(df, ["k"], ["i"]).orderBy("i").collect()] == [1, 3, 5]
    assert [r["i"] for r in sequence.until_duplicates(df, "module", "k", "i", 1).orderBy("i").collect()] == [1, 3]
    assert [r["repeats"] for r in sequence.repeats_previous(df, "module", "i", "raw").orderBy("i").collect()] == [False, False, True, False, True]
    t = spark.createDataFrame([(1, "a" * 30), (2, "a" * 30), (4, "a" * 30), (5, "b")], "k long, t string")
    assert [tuple(r) for r in sequence.equal_neighbours(t, "k", "t").collect()] == [(1, 2)]


def test_pearson_guards(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 4), ("a", 3, 6), ("b", 1, 1), ("b", 1, 2), ("b", 1, 3), ("c", 1, 1), ("c", 2, 2)], "g string, x int, y int")
    got = {r["g"]: r["r"] for r in df.groupBy("g").agg(stats.pearson(F.col("x"), F.col("y")).alias("r")).collect()}
    assert abs(got["a"] - 1) < 1e-12 and got["b"] is None and got["c"] is None


def info(spark, **more):
    row = {"info_id": 1, "module_uuid": "0b6f2f5e-8a1c-8d3e-9f00-000000000001", "module_type": "bible", "abbreviation": "X", "full_name": "X", "format": "f", "format_version": "0.1", "content_version": "1", "versification": "kjv-english", "language_code": "en", "content_sha256": "0", "license_spdx": "PD", "source_url": "u"} | more
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if k == 'info_id' else 'string'}" for k in row))


def test_validation(spark, canon):
    good = spark.createDataFrame([(1001001 + i, "In the beginning was text", '{"v":1,"spans":[{"type":"supplied","start":0,"end":4}]}', 5) for i in range(5)], "verse_id long, text string, formatting string, word_count int")
    link = spark.createDataFrame([(1, 1001001, 1001002)], "link_id long, verse_id_start long, verse_id_end long")
    version = spark.createDataFrame([(1, "0.1")], "version_id long, version_number string")
    module = {"module_info": info(spark), "bible_verse": good, "verse_link": link, "schema_version": version}
    assert validate.report(module, canon).count() == 0
    bad_verses = [
        (1001040, "past the end of it", None, 5), (1003001, "a chapter too many", None, 4), (40001001, "a book too many", None, 4), (1001000, "verse nought here", None, 3), (1000001, "chapter nought here", None, 3),
        (1001001, "a <b>tag</b> ¶ \\x", '{"v":1,"other":1,"block":{"selah":true},"spans":[{"type":"odd","start":0,"end":1},{"type":"supplied","start":1.5,"end":2},{"type":"supplied","start":3,"end":9}]}', 9), (1001002, "no json here", "{", 3),
    ]
    words = spark.createDataFrame([(1001001, 0, 0), (1001001, 2, 99)], "verse_id long, word_position_start int, word_position_end int")
    module |= {
        "bible_verse": spark.createDataFrame(bad_verses, "verse_id long, text string, formatting string, word_count int"), "interlinear_word": words, "module_info": info(spark, module_uuid="nope", versification="mt"),
        "verse_link": spark.createDataFrame([(1, 5, None), (2, 9, 3)], "link_id long, verse_id_start long, verse_id_end long"), "commentary_entry": spark.createDataFrame([(1, 5, None, "long enough content here")], "entry_id long, verse_id_start long, verse_id_end long, content string"),
        "user_text_markup": spark.createDataFrame([(1, 2)], "start_verse_id long, end_verse_id long"),
    }
    found = {r["code"]: r["n"] for r in validate.report(module, canon).collect()}
    assert found == {
        "invalid_module_uuid": 1, "wrong_versification": 1, "null_verse_link_end": 1, "inverted_range": 1, "half_populated_anchor": 1, "forbidden_range_column": 2, "bible_text_html": 1, "bible_text_pilcrow": 1, "bible_text_backslash": 1,
        "word_count_mismatch": 1, "invalid_formatting_json": 1, "unknown_formatting_key": 1, "unknown_block_key": 1, "unknown_span_type": 1, "span_out_of_range": 2, "interlinear_position_range": 1, "book_out_of_canon": 1,
        "chapter_count_exceeds_canon": 1, "invalid_chapter": 1, "invalid_verse": 1, "verse_out_of_canon": 1,
    }
    assert validate.exit_code(["warn"]) == 0 and validate.exit_code(["error"]) == 1 and validate.exit_code([], failed=True) == 2
    thin = spark.createDataFrame([(i, "x" if i < 9 else "long enough text") for i in range(10)], "verse_id long, text string")
    assert [r["code"] for r in validate.content_rules("bible_verse", thin)[0].collect()] == ["content_corrupt"]


def test_module_types(spark):
    df = spark.createDataFrame([("a", "bible_verse"), ("a", "topic"), ("b", "x")], "module string, table_name string")
    read = lambda o: {r["module"]: r["module_type"] for r in validate.detect_type(df, o).collect()}
    assert read("validator") == {"a": "bible", "b": "unknown"} and read("query") == {"a": "topical", "b": "unknown"}


def records(spark, rows):
    return spark.createDataFrame([("m", i, o, c, v, raw) for i, (o, c, v, raw) in enumerate(rows)], "module string, i long, osis string, c int, v int, raw string")


def test_conversion_merges_in_order(spark, canon):
    rows = [("Rev", 12, 17, "<i>before</i> it ¶"), ("Rev", 12, 18, "stood <b>on</b> sand"), ("Rev", 13, 1, "and <i>saw</i>"), ("3John", 1, 14, "peace"), ("3John", 1, 15, "friends <i>greet</i>"), ("Tob", 1, 1, "apart"), ("Gen", 1, 31, "good"), ("Gen", 1, 32, "folded"), ("Gen", 2, 1, "  ")]
    out = {r["verse_id"]: r for r in convert.bible_tables(records(spark, rows), canon)["bible_verse"].collect()}
    assert out[66013001]["text"] == "stood on sand and saw"
    f = json.loads(out[66013001]["formatting"])
    assert [(s["type"], s["start"], s["end"]) for s in f["spans"]] == [("emphasis", 1, 1), ("supplied", 4, 4)]
    assert f["block"] == {"paragraph_start": True} and f["source_verses"] == [{"chapter": 12, "verse": 18, "start": 0, "end": 2}, {"chapter": 13, "verse": 1, "start": 3, "end": 4}]
    assert json.loads(out[64001014]["formatting"])["source_verses"] == [{"chapter": 1, "verse": 15, "start": 1, "end": 2}]  # a host that came first leaves no record
    assert out[64001014]["text"] == "peace friends greet" and out[1001031]["text"] == "good folded" and 1002001 not in out and out[66013001]["word_count"] == 5


def test_targets(spark, canon):
    long_chapter = [("Gen", 1, v, "t") for v in (1, 31, 32, 40)] + [("Gen", 0, 0, "intro"), ("Gen", 9, 1, "t"), ("Gen", 2, 0, "t"), ("Xx", 1, 1, "t")]
    rows = convert.targets(convert.with_book(records(spark, long_chapter)), canon).collect()
    got = {(r["osis"], r["c"], r["v"]): (r["target"], r["reason"]) for r in rows}
    assert got[("Gen", 1, 32)] == (None, "addition") and got[("Gen", 0, 0)] == (None, "intro") and got[("Gen", 9, 1)] == (None, "maps outside canon") and got[("Gen", 2, 0)][0] == 1002001 and got[("Xx", 1, 1)] == (None, "outside canon")
    rules = spark.createDataFrame([(1, 2, 1, 5, 1, 20, 1), (1, 2, 4, 9, 1, 0, 2)], "book long, chapter long, low long, high long, to_chapter long, shift long, rule_order long")
    moved = {r["v"]: (r["target"], r["reason"]) for r in convert.targets(convert.with_book(records(spark, [("Gen", 2, v, "t") for v in (1, 5, 6, 12)])), canon, rules).collect()}
    assert moved == {1: (1001021, "moved"), 5: (1001025, "moved"), 6: (1001006, "moved"), 12: (1002012, None)}
    assert convert.gate("KJV") == "plain" and convert.gate("Luther") == "map" and convert.gate("Synodal") == "record"
    with pytest.raises(ValueError):
        convert.gate("Other")


def test_cross_reference_import(spark):
    entries = spark.createDataFrame([(45008028, "things<br/><a>35-39; 5:3,4; Gen 50:20</a><br/>none<br/>good<br/><a>Jude 3</a>"), (1001001, None)], "verse_id long, content string")
    groups = xrefs.group_rows(xrefs.parse_entries(entries, "verse_id", "content"), "verse_id")
    assert [(r["phrase"], r["sort_order"]) for r in groups.orderBy("sort_order").collect()] == [("things", 1), ("good", 2)]
    links = xrefs.link_rows(groups).orderBy("context", "sort_order").collect()
    assert [(r["context"], r["sort_order"], r["verse_id_start"], r["verse_id_end"]) for r in links][1:3] == [("things", 1, 45008035, 45008039), ("things", 2, 45005003, 45005003)]
    g = spark.createDataFrame([(1, 43003016, 43003016, "For God so loved", 1)], "group_id long, verse_id_start long, verse_id_end long, phrase string, sort_order int")
    k = spark.createDataFrame([(1, "cross_reference", 1, 45005008, 45005008, 1), (2, "cross_reference", 1, 47005019, 47005021, 2), (3, "topic", 1, 1, 1, 1)], "link_id long, source_type string, source_id long, verse_id_start long, verse_id_end long, sort_order int")
    hit = xrefs.linked_passages(g, k, 43003016, 43003016).collect()
    assert [BOOKS.format_range(r["verse_id_start"], r["verse_id_end"]) for r in hit] == ["Rom 5:8", "2Cor 5:19-2Cor 5:21"]


def test_verification(spark, canon):
    source = spark.createDataFrame([(1001000 + i, f"Verse {i} has some words") for i in range(1, 11)], "verse_id long, text string")
    result = spark.createDataFrame([(1001000 + i, f"Verse {i} has some words" if i != 3 else "Entirely different <b>text</b>") for i in range(2, 12)], "verse_id long, text string")
    counts = verify.key_counts(verify.compare_keys(source, result, "verse_id"), spark.createDataFrame([(1001001,)], "key long")).first().asDict()
    assert counts == {"matched": 9, "missing": 0, "missing_known": 1, "extra": 1}
    graded = verify.text_fidelity(source, result, "verse_id")
    assert {r["grade"]: r["n"] for r in graded.groupBy("grade").agg(F.count("*").alias("n")).collect()} == {"exact": 8, "material": 1}
    assert {r["code"]: (r["introduced"], r["inherited"]) for r in verify.hygiene(result, source, "verse_id").collect()} == {"html_tag": (1, 0)}
    assert verify.holes(result, canon).count() == 31 + 25 - 10 and verify.number_in_text(spark.createDataFrame([(1001007, "7 In"), (1001008, "9 In")], "verse_id long, text string"), "verse_id").count() == 1
    low = {r["book"]: (r["present"], r["partial"]) for r in verify.presence(result, canon).collect()}
    assert low[1] == (10, True) and low[66] == (0, False)
    assert {r["code"] for r in verify.generic_checks(source, result.limit(5), "text").collect()} == {"row_count", "word_count_delta", "text_html_tag"}
    import random

    rng = random.Random(2)
    size = {k: rng.randint(5, 200) for k in range(1001001, 1001026)}
    reference = spark.createDataFrame([(k, "x" * n) for k, n in size.items()], "verse_id long, text string")
    shifted = spark.createDataFrame([(k + 1, "x" * n) for k, n in size.items()], "verse_id long, text string")
    assert [r["shifted"] for r in verify.length_alignment(shifted, reference, "verse_id").collect()] == [True]
    assert [r["shifted"] for r in verify.length_alignment(reference, reference, "verse_id").collect()] == [False]
    moved = spark.createDataFrame([(k + 1, k) for k in size], "key long, to long")
    assert verify.remapped_alignment(shifted, reference, moved, "verse_id").first()["better"] == 1


CATALOGUE = "repository string, repository_status string, module_id string, sword_module_type string, app_module_type string, conversion_license_verdict string, encrypted string, zip_download_url string, versification_sword string, source_markup string, position long"


def test_catalogue(spark, tmp_path):
    row = lambda repo, state, i, kind="bible", verdict="OK", secret="", url="u": (repo, state, i, "Biblical Texts", kind, verdict, secret, url, "KJV", "OSIS")
    rows = [
        row("Attic", "attic (retired/superseded)", "m1"), row("B", "main", "M1"), row("C", "main", "m1"), row("A", "other", "m2", verdict="NEEDS PERMISSION"), row("A", "other", "m3", kind=None), row("A", "other", "m4", secret="yes"), row("A", "other", "m5", url=" "),
        row("A", "other", "m6", verdict=None), row("A", "other", "m7", verdict="OK IF NON-COMMERCIAL"), row("GENERAL x", "main", "m8"), row("A", "main", ""), row("A", "other", "m9", kind="book"),
    ]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CATALOGUE)
    chosen, left = catalog.select_rows(df)
    assert [(r["repository"], r["module_id"]) for r in chosen.collect()] == [("B", "M1")]
    assert {r["reason"]: r["n"] for r in left.collect()} == {
        "licence: NEEDS PERMISSION": 1, "licence: (none)": 1, "licence tier: OK IF NON-COMMERCIAL": 1, "type: None": 1, "type: book": 1, "encrypted": 1, "no zip url": 1, "duplicate id (other repository preferred)": 2,
    }
    assert [r["repository"] for r in catalog.select_rows(df, repositories=["C", "A"])[0].collect()] == ["C"]
    assert {r["module_id"] for r in catalog.select_rows(df, "noncommercial", ("bible", "book"), ids=["M7", "m9"])[0].collect()} == {"m7", "m9"}
    with pytest.raises(ValueError):
        catalog.select_rows(df, "any")
    many = spark.range(60).select(F.concat(F.lit("R"), (F.col("id") % 3).cast("string")).alias("repository"), F.lit("main").alias("repository_status"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("module_id"), F.lit("t").alias("sword_module_type"), F.lit("bible").alias("app_module_type"), F.lit("OK").alias("conversion_license_verdict"), F.lit("").alias("encrypted"), F.lit("u").alias("zip_download_url"), F.lit(None).cast("string").alias("versification_sword"), F.lit("TEI").alias("source_markup"), F.col("id").alias("position"))
    picked = [r["repository"] for r in catalog.select_rows(many, sample=9)[0].collect()]
    assert sorted(picked) == ["R0"] * 3 + ["R1"] * 3 + ["R2"] * 3 and len(catalog.select_rows(many, sample=9, limit=4)[0].collect()) == 4

    from quire.__main__ import select, summary

    names = [f.split()[0] for f in CATALOGUE.split(", ")[:-1]]
    (tmp_path / "c.csv").write_text("\ufeff" + ",".join(names) + "\n" + "\n".join(",".join("" if x is None else x for x in r) for r in rows) + "\n", encoding="utf-8")
    report, code = select(spark, [], {"catalog": f"{tmp_path}/c.csv", "verbose": "true"})
    assert code == 0 and report.startswith("1 module(s) selected\n  excluded     2  duplicate id") and "B " in report.splitlines()[-1]
    assert select(spark, [], {})[1] == 2 and summary(spark, [], {"work": str(tmp_path)})[1] == 2
    lines = [{"module_id": "a", "repository": "r", "status": s, "codes": c, "stage": "done"} for s, c in (("FAIL", "x y"), ("WARN", "y"))] + [{"module_id": "b", "repository": "r", "status": "NOT CONVERTED", "codes": "", "stage": "cannot open 'foo'"}]
    (tmp_path / "results.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n")
    report, code = summary(spark, [], {"work": str(tmp_path)})
    assert code == 0 and "| WARN | 1 |" in report and "| y | 1 |" in report and "| x | 1 |" not in report and (tmp_path / "summary.md").read_text() == report and (tmp_path / "summary.csv").exists()


def test_summary_of_results(spark):
    log = spark.createDataFrame([("a", "r", 1, "FAIL", "x y", ""), ("a", "r", 2, "PASS", "x", ""), ("b", "r", 3, "WARN", "y", ""), ("c", "r", 4, "NOT CONVERTED", "", "cannot open 'foo'"), ("d", "r", 5, "NOT CONVERTED", "", "cannot open 'bar'")], "module_id string, repository string, line_no long, status string, codes string, stage string")
    s = catalog.summary(log)
    assert {r["status"]: r["n"] for r in s["status"].collect()} == {"PASS": 1, "WARN": 1, "NOT CONVERTED": 2}
    assert [tuple(r) for r in s["codes"].collect()] == [("y", 1)] and [tuple(r) for r in s["reasons"].collect()] == [("cannot open '…'", 2)]


def test_sqlite_modules(spark, tmp_path):
    path = f"{tmp_path}/topical_x.db"
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE topic (topic_id INTEGER PRIMARY KEY, parent_topic_id INTEGER, name TEXT NOT NULL, sort_order INTEGER)")
    con.executemany("INSERT INTO topic VALUES (?, ?, ?, ?)", TOPICS)
    con.execute("INSERT INTO topic VALUES (8, NULL, CAST(x'E9FF' AS TEXT), 9)")
    con.commit()
    con.close()
    df = sqlite.read_table(spark, path, "topic")
    assert df.count() == 8 and df.where("topic_id = 8").first()["name"] == "\ufffd\ufffd" and dict(df.dtypes)["topic_id"] == "bigint"
    assert sqlite.describe(path)[0]["columns"][0]["pk"] and set(sqlite.read_module(spark, path)) == {"topic"}
    assert sqlite.metadata_rules(path, ("idx_a",), {}) == [("missing_verse_link_index", "idx_a")]
    found = files.modules(spark, str(tmp_path))
    assert ids(found, "module") == ["topical_x"] and ids(files.resolve_module(found, "x"), "module") == ["topical_x"] and ids(files.resolve_module(found, "AL_X"), "module") == ["topical_x"]


def test_files(spark, tmp_path):
    (tmp_path / "canon.json").write_text(json.dumps({"books": [{"book_number": 1, "name": "Genesis", "abbreviation": "Gen", "verse_counts": [31, 25]}]}))
    assert [tuple(r) for r in files.canon(spark, f"{tmp_path}/canon.json").select("book", "chapter", "max_verse").collect()] == [(1, 1, 31), (1, 2, 25)]
    (tmp_path / "x.conf").write_text("[X]\nLang=en\nAbout=one \nAbout= two\nUrl=a=b\n")
    assert files.settings(spark, f"{tmp_path}/x.conf").first()["conf"] == {"Lang": "en", "About": "one two", "Url": "a=b"}
    (tmp_path / "base.json").write_text(json.dumps({"rules": [{"b": 1, "c": 2, "from": 1, "to": 9, "dc": 0, "off": 1}]}))
    (tmp_path / "own.json").write_text(json.dumps({"extends": "base.json", "rules": [{"b": 1, "c": 2, "from": 1, "to": 1, "dc": -1, "off": 30}]}))
    assert [(r["to_chapter"], r["shift"], r["rule_order"]) for r in files.verse_map(spark, f"{tmp_path}/own.json").orderBy("rule_order").collect()] == [(1, 30, 0), (2, 1, 1)]
    (tmp_path / "a.sql").write_text("PRAGMA x;\n-- @include b.sql\nEND")
    (tmp_path / "b.sql").write_text("TABLE")
    assert files.schema_text(str(tmp_path), "a.sql") == "TABLE\nEND"
    (tmp_path / "b.sql").write_text("-- @include a.sql")
    with pytest.raises(ValueError):
        files.schema_text(str(tmp_path), "a.sql")
    (tmp_path / "log.txt").write_text("Verses converted: 12\nWARNING: odd\nSkipping book Tob\nError: bad\nVerses converted: 15\n")
    assert {r["kind"]: r["n"] for r in files.convert_log(spark, f"{tmp_path}/log.txt").collect()} == {"warning": 1, "skipped": 1, "error": 1}
    assert [tuple(r) for r in files.log_counters(spark, f"{tmp_path}/log.txt").collect()] == [("Verses converted", 15)]
    (tmp_path / "c.csv").write_text("\ufeffmodule_id,repository\nx,A\n", encoding="utf-8")
    assert files.catalog(spark, f"{tmp_path}/c.csv").first()["module_id"] == "x"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "", 5, 0), (2, "c", 7, 9)], "link_id long, context string, verse_id_start long, verse_id_end long")
    assert [tuple(r) for r in sinks.links(df).collect()] == [(1, None, 5, 5), (2, "c", 7, 9)]
    sinks.write_module({"verse_link": df}, f"{tmp_path}/m")
    with pytest.raises(Exception, match="force is needed"):
        sinks.write_module({"verse_link": df}, f"{tmp_path}/m")
    assert sinks.write_module({"verse_link": df}, f"{tmp_path}/m", force=True) == 2
    assert published(spark, f"{tmp_path}/m")["verse_link"].where("context IS NULL").count() == 1
    assert sinks.formatted(df, "count") == "2" and json.loads(sinks.formatted(df, "json"))[1]["context"] == "c" and "link_id" in sinks.formatted(df, "table")


def test_report(spark, canon):
    from quire.operators import report

    source = spark.createDataFrame([(1001000 + i, f"Verse {i} of the chapter has some words", i % 2 == 0) for i in range(1, 26)], "verse_id long, text string, red boolean")
    same = report.bible_findings(source, source, canon, source)
    assert {r["code"] for r in same.collect()} <= {"holes", "red_letter_unexpected_books"} and report.module_status(same.where("code = 'holes'")).first()["status"] == "PASS"
    bad = source.where("verse_id > 1001005").withColumns({"text": F.when(F.col("verse_id") % 2 == 0, "Something <i>else</i>").otherwise(F.col("text")), "red": F.lit(False)}).unionByName(spark.createDataFrame([(1001099, "out", False)], "verse_id long, text string, red boolean"))
    codes = {r["code"]: r["severity"] for r in report.bible_findings(source, bad, canon, source).collect()}
    assert codes["missing_in_db"] == "error" and codes["canon_violation"] == "error" and codes["text_html_tag"] == "error" and codes["red_letter_lost"] == "error" and codes["text_differs"] == "error" and codes["extra_in_db"] == "error"
    assert "| error | canon_violation | 1 |" in report.markdown("x", report.bible_findings(source, bad, canon).collect(), {"verses": 2})
    w = spark.createDataFrame([(1001000 + i, f"H{i}00{k}") for i in range(1, 20) for k in range(4)], "verse_id long, strongs_number string")
    moved = w.withColumn("verse_id", F.col("verse_id") + 1)
    chapter = spark.createDataFrame([(1001,)], "grp long")
    assert "strongs_tags_offset" in {r["code"] for r in report.strongs_findings(moved, w).collect()}
    assert "strongs_misplaced" in {r["code"] for r in report.strongs_findings(moved, w, shifted=chapter).collect()}
    assert report.strongs_findings(w, w).count() == 0


def test_other_module_types(spark, canon):
    r = spark.createDataFrame([("m", 0, None, "A", "<p>one two</p>"), ("m", 1, 0, "A1", "x"), ("m", 2, 0, "A2", ""), ("m", 3, None, "B", "y"), ("n", 0, None, "C", "z")], "module string, i long, parent_i long, key string, raw string")
    got = {(x["module"], x["section_id"]): (x["section_number"], x["word_count"]) for x in convert.section_table(r).collect()}
    assert got == {("m", 0): ("1", 2), ("m", 1): ("1.1", 1), ("m", 2): ("1.2", 0), ("m", 3): ("2", 1), ("n", 0): ("1", 1)}
    d = spark.createDataFrame([("m", 0, "k", "first"), ("m", 1, " ", "x"), ("m", 2, "k", "second"), ("m", 3, "l", "<b>bold</b> &amp;")], "module string, i long, key string, raw string")
    assert {x["entry_key"]: x["definition"] for x in convert.dictionary_table(d).collect()} == {"k": "first", "l": "bold &"}
    assert [(x["day_number"], x["date_label"]) for x in convert.devotional_table(d).orderBy("day_number").collect()] == [(1, "k"), (2, ""), (3, "k"), (4, "l")]
    t = convert.commentary_tables(records(spark, [("Gen", 1, 0, "<p>chapter note</p>"), ("Gen", 1, 3, "verse"), ("Xx", 1, 1, "out")]))
    assert [(x["entry_level"], x["verse_id_start"], x["word_count"]) for x in t["commentary_entry"].orderBy("entry_id").collect()] == [("chapter", 1001001, 2), ("verse", 1001003, 1)]
    assert t["verse_link"].where("verse_id_end = verse_id_start").count() == 2
    conf = spark.createDataFrame([("X", {"Lang": "he", "DistributionLicense": "Public Domain", "Copyright": "1901", "About": "x"})], "module string, conf map<string,string>")
    row = convert.identity_block(conf, "bible").first()
    assert row["license_spdx"] == "PD" and row["right_to_left"] and row["year_published"] == 1901 and row["abbreviation"] == "X"
    v = spark.createDataFrame([(1, '{"spans":[{"type":"words_of_christ"}]}'), (2, None)], "verse_id long, formatting string")
    w = spark.createDataFrame([("logos",), (None,), ("λόγος",)], "original_word string")
    assert tuple(stats.module_report(v, w).first()) == (2, 1, 1, 3, 2, 1)


def test_overlap_join_of_all_lengths(spark):
    import random

    from quire.operators import ranges

    rng = random.Random(8)
    make = lambda n: [(i, a, a + int(10 ** rng.uniform(0, 7)) - 1) for i, a in ((i, rng.randrange(-(10**6), 10**7)) for i in range(n))]
    a, b = make(150), [*make(150), (900, 5, 4), (901, None, 7), (902, 3, None)]
    left, right = spark.createDataFrame(a, "i long, a0 long, a1 long"), spark.createDataFrame(b, "j long, b0 long, b1 long")
    want = {(i, j) for i, x, y in a for j, u, v in b if u is not None and v is not None and u <= v and x <= v and y >= u}
    for wide in (4, 64):
        got = [(r["i"], r["j"]) for r in ranges.overlap_join(left, right, ("a0", "a1"), ("b0", "b1"), 10, wide).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert ranges.overlap_join(left.limit(0), right, ("a0", "a1"), ("b0", "b1"), 10).count() == 0


def test_walks_of_large_trees(spark):
    from quire.operators import trees

    nodes = spark.range(1_200_000).select("id", F.when(F.col("id") > 0, F.expr("(id - 1) div 1100")).alias("up"))
    assert trees.descendants(nodes, nodes.where("up IS NULL"), "id", "up").count() == 1_200_000


def test_rules_of_metadata_scripts_losses_and_samples(spark):
    import hashlib

    from quire.operators import report

    verses = spark.createDataFrame([("a", 43003016, "For God"), ("a", 43003017, None), ("b", 1001001, "x")], "module string, verse_id long, text string")
    good = hashlib.sha256(b"43003016\tFor God\n43003017\t\n").hexdigest()
    info = [("a", good, "PD", "(c)", "Name", "x", "en", 0), ("b", None, None, None, "<i>N</i>", None, None, None), ("c", hashlib.sha256(b"").hexdigest(), "CC-BY-4.0", "CC BY-NC-ND", "N", "", "he", 1)]
    rows = spark.createDataFrame(info, "module string, content_sha256 string, license_spdx string, copyright string, full_name string, description string, language_code string, right_to_left int")
    entries = spark.createDataFrame([("a", "en", "0"), ("c", "hbo", None)], "module string, app_language_code string, right_to_left string")
    got = {(r["module"], r["code"]) for r in report.metadata_findings(rows, verses, entries).collect()}
    assert got == {("b", "content_sha256"), ("b", "license_unknown"), ("b", "metadata_full_name_markup"), ("c", "license_conflict"), ("c", "language_code"), ("c", "right_to_left")}
    assert report.metadata_findings(rows.where("false"), verses).count() == 0
    assert report.script_findings(verses, "el-GR").first()["code"] == "script_mismatch"
    assert report.script_findings(verses, "en").count() == report.script_findings(verses, "zz").count() == report.script_findings(verses.where("false"), "el").count() == 0
    raw = spark.range(51).selectExpr("'<title>t</title>' AS raw")
    plain = spark.createDataFrame([(None,), ('{"block":{"heading":"H"}}',)], "formatting string")
    assert [r["code"] for r in report.lost_findings(raw, plain.limit(1)).collect()] == ["headings_lost"] and report.lost_findings(raw, plain).count() == 0
    samples = report.review_samples(verses.where("module = 'a'"), verses, {"worst": (verses.where("verse_id = 1001001"), 3)}, random=1).collect()
    assert [sum(r["why"] == w for r in samples) for w in ("key verse", "random", "worst")] == [2, 1, 1]


def test_columns_of_references(spark):
    from quire.functions.refs import reference_columns

    rows = [("1 John 5:7-8", 62005007, 62005008, None, 0), ("Josh.17.1-Josh.17.2", None, None, None, 6017001), ("43003016", None, None, 43003016, 0), ("", None, None, None, 0), (None, None, None, None, None)]
    got = spark.createDataFrame([(r[0],) for r in rows], "t string").select("t", reference_columns(F.col("t")).alias("r")).select("t", "r.*").collect()
    assert {tuple(r) for r in got} == set(rows)


def test_search_reads_the_texts_once_for_places_and_once_for_lengths(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the wine of the east"), (2, "of wine"), (3, "stupid losers lose")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    found = fulltext.search(fulltext.postings(spark.read.parquet(f"{tmp_path}/docs"), "doc_id", "text", stem=True), "(NEAR(the of, 3) NOT losers) OR (stupid loser)", limit=None, stem=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "_stems" not in plan
    assert {r["doc_id"] for r in found.collect()} == {1, 3}


def test_a_word_is_stemmed_once_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(fulltext, "porter", lambda w: calls.append(w) or w)
    assert [list(x) for x in fulltext._stems(iter([pd.Series(["a", "b", "a"]), pd.Series(["b", "a"])]))] == [["a", "b", "a"], ["b", "a"]]
    assert calls == ["a", "b"]


def test_overlap_sums_without_pairs(spark):
    import random

    rng = random.Random(4)
    span = lambda: (a := rng.choice([None, *range(-200_000, 200_000, 9_000)]), None if a is None or rng.random() < 0.1 else a + rng.choice([-1, 0, 9_000, 70_000, 300_000]))
    a, b = [(i, *span()) for i in range(60)], [(i, *span()) for i in range(60)]
    left, right = spark.createDataFrame(a, "k long, c0 long, c1 long"), spark.createDataFrame(b, "id long, s0 long, s1 long")
    found = ranges.overlap_sums(left, right, ("c0", "c1"), ("s0", "s1"), {"n": F.lit(1), "keys": F.col("k")})
    real = lambda rows: [r for r in rows if None not in r and r[1] <= r[2]]
    met = {i: [k for k, x, y in real(a) if x <= t and y >= s] for i, s, t in real(b)}
    assert {r["id"]: (r["n"], r["keys"]) for r in found.collect()} == {i: (len(k), sum(k)) for i, k in met.items() if k}
    # What the join hands on grows with the bounds, never with the pairs.
    same = ranges.overlap_sums(spark.range(3000).selectExpr("id AS k", "0L AS c0", "9L AS c1"), spark.range(3000).selectExpr("id", "5L AS s0", "6L AS s1"), ("c0", "c1"), ("s0", "s1"), {"n": F.lit(1)})
    assert same.agg(F.count("*"), F.sum("n")).first() == (3000, 9_000_000)


def test_the_stop_set_leaves_a_set_before_it_is_compared(spark):
    sets = spark.createDataFrame([(1001001, ["a", "b", "c", "x"]), (1001002, ["a", "x"]), (1001003, ["a", "b", "c", "d"])], "k long, items array<string>")
    near = stats.neighbour_overlap(sets, sets, "k", spark.createDataFrame([("x",)], "item string"), least=3)
    above, join, below = near._jdf.queryExecution().optimizedPlan().toString().partition("Join Inner")
    assert join and "array_except" not in above and "array_except" in below
    got = {(r["k"], r["offset"]): (r["overlap"], r["own"]) for r in near.collect()}
    assert got == {(1001001, 0): (1.0, 3), (1001001, 1): (1 / 3, 3), (1001001, 2): (0.75, 3), (1001003, 0): (1.0, 4), (1001003, -1): (0.25, 4), (1001003, -2): (0.75, 4)}


def test_covers_of_many_rules_are_laid_out_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "TASK_RULES", 100)
    rules = spark.range(0, 1000, 1, 1).selectExpr("id AS rule_order", "id % 2 AS g", "id * 10 AS low", "id * 10 + 500 AS high", "id AS target")
    nodes, _ = ranges.compiled_rules(rules, ("g",))
    plan = nodes._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.rstrip().count(", 10\n") == 1
    rows = spark.range(0, 9000, 37).selectExpr("id AS v", "id % 2 AS g")
    want = {v: min((i for i in range(1000) if i % 2 == v % 2 and i * 10 <= v <= i * 10 + 500), default=None) for v in range(0, 9000, 37)}
    assert {r["v"]: r["target"] for r in ranges.first_rule(rows, rules, ("g",), "v").collect()} == want


def test_texts_reach_python_in_batches_of_bounded_bytes(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rows = spark.range(0, 600, 1, 1).select("id", F.repeat(F.lit("x"), F.lit(20_000)).alias("text"))
    batch = F.pandas_udf(lambda x: pd.Series([len(x)] * len(x)), "long")
    for plan in (verify.text_fidelity, verify.hygiene):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        plan(rows, rows, "id")
        assert rows.select(batch("text").alias("n")).agg(F.max("n")).first()[0] <= 2 * verify.BATCH_BYTES // 20_000


def test_stored_postings_by_hand(spark):
    """Marks are taken off and stems made once a distinct word; batches are taken apart as arrays."""
    texts = ["Élan élan ELAN runs", None, "", "Σας İstanbul ÀB àb", *(f"running w{i % 7} runs ñ{i}" for i in range(150))]
    docs = spark.createDataFrame([(i, t, "Run" if i % 2 else None) for i, t in enumerate(texts)], "id int, text string, lang string")
    for stem in (False, True):
        found = [r.asDict() for r in textindex.postings(docs, "id", ["text", "lang"], stem).collect()]
        want = {}
        rows = docs.select("id", *[F.regexp_extract_all(fulltext.folded(F.col(c)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)).alias(c) for c in ("text", "lang")]).collect()
        for r in rows:
            words = [r["text"] or [], r["lang"] or []]
            for c, column in enumerate(words):
                for at, w in enumerate(column):
                    want.setdefault((r["id"], fulltext.porter(w) if stem else w, c, len(words[0]) + len(words[1])), []).append(at)
        assert {(r["doc_id"], r["token"], r["col"], r["len"]): r["places"] for r in found} == want and len(found) == len(want)
    assert not len(textindex._postings_of(pa.array([1, 2]), pa.array([[[], []], [[], []]], pa.list_(pa.list_(pa.string()))), None))
