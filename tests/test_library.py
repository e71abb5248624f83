"""The commands over module files."""

import sqlite3

import pytest

from quire.__main__ import arguments
from quire.library import COMMANDS, Library, NotFound, run_command
from tests.test_operators import TOPICS

LINK = "CREATE TABLE verse_link (link_id INTEGER PRIMARY KEY, source_type TEXT, source_id INTEGER, verse_id_start INTEGER, verse_id_end INTEGER, sort_order INTEGER)"


def build(path, statements):
    con = sqlite3.connect(path)
    for sql, *rows in statements:
        con.executemany(sql, rows[0]) if rows else con.execute(sql)
    con.commit()
    con.close()


@pytest.fixture(scope="module")
def lib(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("modules")
    put = "INSERT INTO verse_link VALUES (?, ?, ?, ?, ?, ?)"
    build(d / "topical_x.db", [("CREATE TABLE topic (topic_id INTEGER PRIMARY KEY, parent_topic_id INTEGER, name TEXT, sort_order INTEGER)",), ("INSERT INTO topic VALUES (?, ?, ?, ?)", TOPICS), (LINK,), (put, [(1, "topic", 4, 1041050, 1041050, 1), (2, "topic", 6, 6017001, 6017002, 1)])])
    build(d / "bible_x.db", [("CREATE TABLE bible_verse (verse_id INTEGER PRIMARY KEY, text TEXT)",), ("INSERT INTO bible_verse VALUES (?, ?)", [(43003016, "For God so loved the world"), (43003017, "For God sent not")]), ("CREATE TABLE module_info (info_id INTEGER, abbreviation TEXT, metadata TEXT)",), ("INSERT INTO module_info VALUES (?, ?, ?)", [(1, "X", '{"a": 1}')])])
    build(d / "cross_reference_x.db", [("CREATE TABLE cross_reference_group (group_id INTEGER, verse_id_start INTEGER, verse_id_end INTEGER, phrase TEXT, sort_order INTEGER)",), ("INSERT INTO cross_reference_group VALUES (?, ?, ?, ?, ?)", [(1, 43003016, 43003016, "For God so loved", 1)]), (LINK,), (put, [(1, "cross_reference", 1, 45005008, 45005008, 1), (2, "cross_reference", 1, 47005019, 47005021, 2)])])
    build(d / "book_x.db", [("CREATE TABLE book_section (section_id INTEGER, parent_section_id INTEGER, section_number TEXT, sort_order INTEGER, title TEXT, content TEXT)",), ("INSERT INTO book_section VALUES (?, ?, ?, ?, ?, ?)", [(1, None, "1", 1, "Preface", "Text"), (2, 1, "1.10", 10, "J", ""), (3, 1, "1.2", 2, "B", "")]), (LINK,), (put, [(1, "book_section", 1, 43003016, 43003016, 1)])])
    return Library(spark, str(d))


def names(df, column):
    return [r[column] for r in df.collect()]


def test_topic_commands(lib):
    run = lambda c, *a, **o: run_command(lib, c, ["x", *a], o)
    assert names(run("topics"), "name") == ["Israel", "Manasseh"]
    senses = {r["name"]: (r["child_count"], r["verse_count"]) for r in run("topics", parent="Manasseh").collect()}
    assert senses == {"Son of Joseph and Asenath": (0, 1), "Tribe of": (1, 0), "King of Judah": (0, 0)}
    t = run("topic", "Inheritance of")
    assert t["breadcrumb"] == ["Manasseh", "Tribe of"] and t["verses"] == ["Josh 17:1-Josh 17:2"]
    assert names(run("topic-verses", "Manasseh"), "ref") == [] and names(run("topic-verses", "Manasseh", recursive="true"), "ref") == ["Gen 41:50", "Josh 17:1-Josh 17:2"]
    assert sorted(names(run("topic-tree", "Manasseh", depth="1"), "topic_id")) == [3, 4, 5, 7]
    assert [(r["name"], r["parent"]) for r in run("verse-topics", "Josh 17:2").collect()] == [("Inheritance of", "Tribe of")]
    assert sorted(names(run_command(lib, "search", ["topical_x", "Manasseh"]), "topic_id")) == [2, 3]
    assert run_command(lib, "stats", ["topical_x"]) == {"type": "topical", "topics": 7, "roots": 2, "subs": 5, "links": 2}
    with pytest.raises(NotFound):
        run("topic", "Nobody")


def test_bible_and_reference_commands(lib):
    assert [(r["ref"], r["text"]) for r in run_command(lib, "verse", ["x", "John 3:16"]).collect()] == [("John 3:16", "For God so loved the world")]
    assert names(run_command(lib, "verse-lookup", ["x", "43003017", "no"]), "verse_id") == [43003017]
    assert [(r["chapter"], r["n"], r["ref"]) for r in run_command(lib, "chapters", ["x", "John"]).collect()] == [(3, 2, "John 3:16-John 3:17")]
    assert [(r["ref"], r["text"]) for r in run_command(lib, "search", ["bible_x", "loving"]).collect()] == [("John 3:16", "For God so loved the world")]
    assert run_command(lib, "info", ["bible_x"])["metadata"] == '{"a":1}' and "error" in run_command(lib, "info", ["book_x"])
    assert names(run_command(lib, "xref", ["x", "John 3:16"]), "ref") == ["Rom 5:8", "2Cor 5:19-2Cor 5:21"]
    assert run_command(lib, "stats", ["cross_reference_x"]) == {"type": "xref", "groups": 1, "references": 2}
    with pytest.raises(ValueError):
        run_command(lib, "search", ["cross_reference_x", "a"])
    assert names(run_command(lib, "sql", ["bible_x", "SELECT count(*) AS n FROM bible_verse"]), "n") == [2]
    assert {r["table_name"]: r["n"] for r in run_command(lib, "tables", ["bible_x"]).collect()} == {"bible_verse": 2, "module_info": 1}
    assert run_command(lib, "schema", ["bible_x"])["bible_verse"]["columns"][0]["pk"]


def test_section_commands(lib):
    assert names(run_command(lib, "sections", ["x"]), "title") == ["Preface"]
    assert names(run_command(lib, "sections", ["x"], {"parent": "1"}), "section_id") == [3, 2] and names(run_command(lib, "sections", ["x"], {"parent": "1", "order": "text"}), "section_id") == [2, 3]
    assert run_command(lib, "section", ["x", "1"])["scripture_references"] == ["John 3:16"]
    assert names(run_command(lib, "modules", [], {"type": "xref"}), "module") == ["cross_reference_x"]


def test_the_registry(lib):
    assert len(COMMANDS) == 23
    with pytest.raises(ValueError):
        run_command(lib, "verse", ["x"])
    with pytest.raises(NotFound):
        run_command(lib, "nothing", [])
    assert arguments(["topics", "x", "--limit=3", "--recursive"]) == (["topics", "x"], {"limit": "3", "recursive": "true"})


FTS = {
    "commentary_entry": ("entry_id INTEGER PRIMARY KEY, verse_id_start INTEGER, verse_id_end INTEGER, entry_level TEXT, content TEXT", "entry_id UNINDEXED, content", "entry_id"),
    "dictionary_entry": ("entry_id INTEGER PRIMARY KEY, entry_key TEXT, word TEXT, definition TEXT, usage_notes TEXT", "entry_id UNINDEXED, entry_key UNINDEXED, word, definition, usage_notes", "entry_id"),
    "book_section": ("section_id INTEGER PRIMARY KEY, parent_section_id INTEGER, title TEXT, content TEXT", "section_id UNINDEXED, title, content", "section_id"),
    "devotional_entry": ("entry_id INTEGER PRIMARY KEY, day_number INTEGER, date_label TEXT, title TEXT, content TEXT", "entry_id UNINDEXED, title, content", "entry_id"),
    "topic": ("topic_id INTEGER PRIMARY KEY, parent_topic_id INTEGER, name TEXT", "name", "topic_id"),
}


def test_search_of_every_type_against_a_real_text_index(spark, tmp_path):
    import random

    rng = random.Random(4)
    words = ["run", "running", "runs", "faith", "faithful", "house", "Ärger", "the", "of", "1611", "stone"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    kinds = {"commentary_entry": "commentary", "dictionary_entry": "dictionary", "book_section": "book", "devotional_entry": "devotional", "topic": "topical"}
    for table, (columns, indexed, key) in FTS.items():
        con = sqlite3.connect(tmp_path / f"{kinds[table]}_y.db")
        con.execute(f"CREATE TABLE {table} ({columns})")
        con.execute(f"CREATE VIRTUAL TABLE {table}_fts USING fts5({indexed}, content='{table}', content_rowid='{key}', tokenize='porter unicode61')")
        names_ = [c.split()[0] for c in columns.split(", ")]
        for i in range(1, 80):
            row = [i if c == key else (i // 3 or None) if c.startswith("parent") else 1001000 + i if c.startswith("verse_id") else i if c == "day_number" else text(60) if c in ("content", "definition") else text(4) for c in names_]
            con.execute(f"INSERT INTO {table} VALUES ({', '.join('?' * len(row))})", row)
        con.execute(f"INSERT INTO {table}_fts({table}_fts) VALUES ('rebuild')")
        con.commit()
        con.close()
    library = Library(spark, str(tmp_path))
    for stored in (False, True):
        for table, kind in kinds.items():
            if stored == (kind in ("commentary", "topical")):
                continue
            if stored:
                made = run_command(library, "index", [f"{kind}_y"])
                assert made["documents"] == 79 and run_command(library, "index", [f"{kind}_y"]) == made
            for query in ("running", '"faithful house"', "run NOT stone", "faith* AND (house OR argers)") if kind == "dictionary" else ("faith* AND (house OR argers)",):
                con, key = sqlite3.connect(tmp_path / f"{kind}_y.db"), FTS[table][2]
                want = con.execute(f"SELECT rowid, rank FROM {table}_fts WHERE {table}_fts MATCH ? ORDER BY rank, rowid", (query,)).fetchall()
                got = [(r[key], r["rank"]) for r in run_command(library, "search", [f"{kind}_y", query], {"limit": "200"}).collect()]
                assert dict(got) == pytest.approx(dict(want)), (kind, query, stored)
    assert {"snippet", "word", "rank"} <= set(run_command(library, "search", ["dictionary_y", "run"]).columns)
    assert {"name", "parent_name"} <= set(run_command(library, "search", ["topical_y", "run"]).columns)
    with pytest.raises(ValueError):
        run_command(Library(spark, str(tmp_path)), "search", ["topical_y", "(run"])


def test_verse_detail_and_published_modules(spark, tmp_path):
    from quire.sources import sinks

    v = spark.createDataFrame([(1001001, "In the beginning", '{"v": 1}', 3), (1001002, "And", "odd{", 1)], "verse_id long, text string, formatting string, word_count int")
    w = spark.createDataFrame([(1001001, 2, 2, "H2", "b"), (1001001, 0, 1, "H1", None), (1001009, 0, 0, "H9", None)], "verse_id long, word_position_start int, word_position_end int, strongs_number string, gloss string")
    sinks.write_module({"bible_verse": v, "interlinear_word": w}, f"{tmp_path}/bible_p")
    library = Library(spark, str(tmp_path))
    assert names(library.names(), "module") == ["bible_p"] and run_command(library, "tables", ["p"]).count() == 2
    one = run_command(library, "verse-detail", ["p", "1001001"])
    assert one["formatting"] == '{"v":1}' and [(x["position"], x["strongs_number"], x["gloss"], x["lemma"]) for x in one["words"]] == [(0, "H1", None, None), (2, "H2", "b", None)]
    two = run_command(library, "verse-detail", ["p", "1001002"])
    assert two["formatting"] == "odd{" and two["words"] == []
    with pytest.raises(NotFound):
        run_command(library, "verse-detail", ["p", "5"])


def test_an_index_follows_its_module(spark, tmp_path):
    path = tmp_path / "bible_z.db"
    build(path, [("CREATE TABLE bible_verse (verse_id INTEGER PRIMARY KEY, text TEXT)",), ("INSERT INTO bible_verse VALUES (?, ?)", [(i, f"word{i % 7} stone house") for i in range(1, 40)])])
    library = Library(spark, str(tmp_path))
    assert run_command(library, "index", ["z"])["segments"] == 1
    build(path, [("UPDATE bible_verse SET text = 'all other' WHERE verse_id % 7 = 3",), ("DELETE FROM bible_verse WHERE verse_id % 7 = 4",), ("INSERT INTO bible_verse VALUES (?, ?)", [(100, "word3 once more"), (101, "")])])
    found = lambda q: [(r["verse_id"], round(r["rank"], 9)) for r in run_command(library, "search", ["z", q], {"limit": "99"}).collect()]
    assert run_command(library, "index", ["z"])["segments"] == 2
    after = {q: found(q) for q in ("word3", "stone NOT word1", "other", "wo*", "word4")}
    assert [i for i, _ in after["word3"]] == [100] and after["word4"] == []
    assert run_command(library, "index", ["z"], {"compact": "true"})["segments"] == 1
    assert {q: found(q) for q in after} == after
    import shutil

    shutil.rmtree(tmp_path / "_index")
    assert {q: found(q) for q in after} == after  # without an index
    run_command(library, "index", ["z"])
    assert {q: found(q) for q in after} == after  # a new one
