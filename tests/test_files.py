"""SQLite files: pushdown over many files, the sink, the check of a whole library, publication."""

import json
import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quire.__main__ import validate as validate_command
from quire.operators import libcheck
from quire.sources import shared, sqlite, sqlite_sink
from tests.test_library import build

UUID = "12345678-1234-4234-8234-123456789abc"
INFO = ("info_id", *("module_uuid abbreviation full_name format format_version content_version content_sha256 versification license_spdx source_url".split()))


# Source ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("many")
    for m in range(3):
        build(d / f"bible_{m}.db", [("CREATE TABLE bible_verse (verse_id INTEGER PRIMARY KEY, text TEXT, n INTEGER)",), ("INSERT INTO bible_verse VALUES (?, ?, ?)", [(i, f"{m} text {i}", i % 10 if i % 4 else "odd") for i in range(1, 5001)])])
    build(d / "dictionary_x.db", [("CREATE TABLE dictionary_entry (entry_id INTEGER PRIMARY KEY, word TEXT)",)])
    (d / "broken.db").write_bytes(b"this is no database at all" * 100)
    return d


def reader(path, **options):
    schema = StructType([StructField("module", StringType()), StructField("verse_id", LongType()), StructField("n", LongType())])
    return sqlite.TableReader(schema, {"path": str(path), "table": "bible_verse", "module": "module", **options})


def test_a_key_filter_reads_one_range(folder, monkeypatch):
    monkeypatch.setattr(sqlite, "ROWS", 500)
    whole = reader(folder, errors="_e")
    assert [len(p.spans) for p in whole.partitions()] == [1] * (3 * 10 + 1 + 1)  # three files of ten ranges; the broken file and the one of another kind find out in their task
    one = reader(folder / "bible_1.db")
    assert len(list(one.pushFilters([EqualTo(("verse_id",), 1234)]))) == 1  # and Spark tests it again
    parts = one.partitions()
    assert [p.spans for p in parts] == [[(str(folder / "bible_1.db"), 1234, 1234)]] and [r[1] for r in one.read(parts[0])] == [1234]
    some = reader(folder / "bible_1.db")
    list(some.pushFilters([In(("verse_id",), (3, 4, 4000, 9000)), GreaterThan(("n",), 2)]))
    assert sum(len(list(some.read(p))) for p in some.partitions()) == 3  # 3, and 4 and 4000, whose n is no number, so that Spark has to test it
    low = reader(folder / "bible_1.db")
    list(low.pushFilters([LessThanOrEqual(("verse_id",), 900), GreaterThan(("verse_id",), 899)]))
    assert [s[1:] for p in low.partitions() for s in p.spans] == [(900, 900)]
    named = reader(folder)
    list(named.pushFilters([EqualTo(("module",), "bible_2")]))
    assert {s[0] for p in named.partitions() for s in p.spans} == {str(folder / "bible_2.db")}


def test_many_files_as_one_table(spark, folder):
    df = sqlite.read_table(spark, str(folder), "bible_verse", module="module", errors="_error")
    assert df.where("_error IS NULL").count() == 15_000
    assert {r["module"] for r in df.where("_error IS NOT NULL").collect()} == {"broken"}
    rows = df.where("verse_id BETWEEN 10 AND 12 AND module = 'bible_1' AND _error IS NULL").orderBy("verse_id").collect()
    assert [(r["verse_id"], r["text"], r["n"]) for r in rows] == [(10, "1 text 10", 0), (11, "1 text 11", 1), (12, "1 text 12", None)]
    assert df.where("n IS NULL AND _error IS NULL").count() == 3 * 1250
    pruned = sqlite.read_table(spark, str(folder / "bible_0.db"), "bible_verse", columns=["verse_id"])
    assert pruned.columns == ["verse_id"] and pruned.where("verse_id > 4990").count() == 10
    with pytest.raises(Exception, match="not a database"):
        sqlite.read_table(spark, str(folder), "bible_verse").count()
    known = {r["module"]: r for r in sqlite.catalog(spark, str(folder)).collect()}
    assert known["bible_0"]["tables"] == {"bible_verse": ["verse_id", "text", "n"]} and "not a database" in known["broken"]["error"]


# Sink -----------------------------------------------------------------------------


def modules(spark, n, rows=20):
    verses = spark.range(n).select(F.format_string("bible_%04d", F.col("id")).alias("module"), F.explode(F.sequence(F.lit(1), F.lit(rows))).alias("v"))
    verses = verses.select("module", (F.col("v") + 1001000).cast("long").alias("verse_id"), F.concat(F.lit("text number "), F.col("v").cast("string")).alias("text"), F.lit(None).cast("string").alias("formatting"), F.lit(3).alias("word_count"))
    names = verses.select("module").distinct()
    info = names.select("module", F.lit(1).alias("info_id"), F.lit(UUID).alias("module_uuid"), *[F.lit("kjv-english" if c == "versification" else "x").alias(c) for c in INFO[2:]])
    return {"bible_verse": verses, "module_info": info, "schema_version": names.select("module", F.lit(1).alias("version"))}, names


LINKS = "module string, link_id long, source_type string, source_id long, verse_id_start long, verse_id_end long, sort_order long"
AFTER = {"verse_link": [f"CREATE INDEX {i} ON verse_link (verse_id_start)" for i in libcheck.LINK_INDEXES]}


def write(spark, folder, n=5, **options):
    tables, names = modules(spark, n)
    tables["verse_link"] = spark.createDataFrame([("bible_0001", 1, "topic", 4, 1001001, 1001001, None)], LINKS)
    sqlite_sink.write_modules(tables, str(folder), ddl=sqlite_sink.BIBLE_DDL, after=AFTER, modules=names, **options)


def test_modules_go_out_and_come_back(spark, tmp_path):
    write(spark, tmp_path)
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"bible_000{i}.db" for i in range(5)]
    back = sqlite.read_table(spark, str(tmp_path), "bible_verse", module="module")
    want = modules(spark, 5)[0]["bible_verse"]
    assert sorted(map(tuple, back.select("module", "verse_id", "text", "formatting", "word_count").collect())) == sorted(map(tuple, want.collect()))
    con = sqlite3.connect(tmp_path / "bible_0001.db")
    assert [r[0] for r in con.execute("SELECT verse_id FROM bible_verse_fts WHERE bible_verse_fts MATCH 'numbers 7'")] == [1001007]  # kept by its triggers
    assert con.execute("SELECT verse_id_start, sort_order FROM verse_link").fetchall() == [(1001001, None)] and con.execute("PRAGMA integrity_check").fetchone() == ("ok",)
    before = {p.name: p.stat().st_mtime_ns for p in tmp_path.iterdir()}
    with pytest.raises(Exception, match="force is needed"):
        write(spark, tmp_path, n=7)
    assert {p.name: p.stat().st_mtime_ns for p in tmp_path.iterdir()} == before  # neither a new module nor a hidden file
    write(spark, tmp_path, n=7, force=True)
    assert len(list(tmp_path.iterdir())) == 7


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    spec = [{"name": "t", "columns": ["a"], "kinds": ["int"], "before": ["CREATE TABLE t (a INTEGER PRIMARY KEY)"], "after": []}]
    writer = sqlite_sink.ModuleWriter({"path": str(tmp_path), "tables": json.dumps(spec), "job": "j"})
    from pyspark.sql import Row

    row = lambda m, a: Row(module=m, table_no=0, n=1, s=None, cells=[a])

    def rows():
        yield row("a", "1")
        yield row("b", "1")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(rows())
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(sqlite3.IntegrityError):
        writer.write(iter([row("a", "1"), row("b", "1"), row("b", "1")]))
    assert list(tmp_path.iterdir()) == []
    first = writer.write(iter([row("a", "1")]))  # an attempt that nobody commits
    again = writer.write(iter([row("a", "2")]))
    writer.commit([again])
    assert [p.name for p in tmp_path.iterdir()] == ["a.db"] and sqlite3.connect(tmp_path / "a.db").execute("SELECT a FROM t").fetchall() == [(2,)]
    assert first.files[0][0] != again.files[0][0]
    with pytest.raises(ValueError):
        sqlite_sink.ModuleWriter({"path": str(tmp_path), "tables": json.dumps(spec)}).write(iter([row("../a", "1")]))


def test_keep_by_status_and_kinds_of_cells(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1.5, True, b"\x00\xff", "x", [1, 2]), ("b", None, None, None, None, None, None), ("c", 3, float("inf"), False, b"", "", [])], "module string, i long, d double, f boolean, b binary, s string, l array<int>")
    status = spark.createDataFrame([("a", "PASS"), ("b", "WARN")], "module string, status string")
    sqlite_sink.write_modules({"t": df}, str(tmp_path / "none"), keep="none", status=status)
    assert not (tmp_path / "none").exists()
    sqlite_sink.write_modules({"t": df}, str(tmp_path / "flagged"), keep="flagged", status=status)
    assert sorted(p.name for p in (tmp_path / "flagged").iterdir()) == ["b.db", "c.db"]
    sqlite_sink.write_modules({"t": df}, str(tmp_path / "all"), status=status)
    got = {p.stem: sqlite3.connect(p).execute("SELECT * FROM t").fetchall() for p in (tmp_path / "all").iterdir()}
    assert got == {"a": [(1, 1.5, 1, b"\x00\xff", "x", "[1,2]")], "b": [(None,) * 6], "c": [(3, float("inf"), 0, b"", "", "[]")]}
    with pytest.raises(ValueError):
        sqlite_sink.write_modules({"t": df}, str(tmp_path / "x"), keep="some")


# The check of a library ---------------------------------------------------------------


def test_a_library_of_three_hundred_modules(spark, tmp_path):
    write(spark, tmp_path, n=300)
    alter = lambda i, *sql: build(tmp_path / f"bible_{i:04d}.db", [(s,) for s in sql])
    alter(3, "UPDATE bible_verse SET text = 'a <b>bold</b> ¶ \\ text'", "INSERT INTO bible_verse VALUES (1001099, 'far', NULL, 1), (1060001, 'four words in all', '{\"v\":1,\"x\":2,\"spans\":[{\"type\":\"odd\",\"start\":0,\"end\":9}]}', 4), (70001001, 'outside of it', NULL, 3)")
    alter(4, "DROP TABLE verse_link", "DELETE FROM schema_version", "UPDATE module_info SET module_uuid = 'no', versification = 'mt'", "DELETE FROM bible_verse")
    alter(5, "DROP TABLE module_info", "DROP INDEX idx_verse_link_covering", "INSERT INTO verse_link VALUES (9, 't', 1, 5, 4, 0)", "CREATE TABLE interlinear_word (verse_id INTEGER, word_position_start INTEGER, word_position_end INTEGER)", "INSERT INTO interlinear_word VALUES (1001001, 2, 1), (1001001, -1, 0), (1001002, 0, 3), (9, 9, 9)")
    alter(6, "INSERT INTO module_info SELECT 2, module_uuid, abbreviation, full_name, format, format_version, content_version, content_sha256, versification, license_spdx, source_url FROM module_info", "ALTER TABLE module_info DROP COLUMN source_url", "CREATE TABLE note (start_verse_id INTEGER)")
    alter(7, "UPDATE bible_verse SET text = 'short'", "UPDATE bible_verse SET word_count = 1")
    (tmp_path / "bible_0008.db").write_bytes(b"no database" * 500)
    (tmp_path / "bible_0009.db").write_bytes(b"")
    data = bytearray((tmp_path / "bible_0010.db").read_bytes())
    page = int.from_bytes(data[16:18], "big")
    root = sqlite3.connect(tmp_path / "bible_0010.db").execute("SELECT rootpage FROM sqlite_master WHERE name = 'bible_verse'").fetchone()[0]
    data[(root - 1) * page : root * page] = b"\xee" * page  # the catalogue is whole, one table is not
    (tmp_path / "bible_0010.db").write_bytes(bytes(data))
    build(tmp_path / "odd.db", [("CREATE TABLE something (a INTEGER)",)])
    build(tmp_path / "book_y.db", [("CREATE TABLE something (a INTEGER)",)])
    canon = spark.createDataFrame([(1, 1, 31), (1, 2, 25)], "book long, chapter long, max_verse long")
    found, checked = libcheck.check_folder(spark, str(tmp_path), canon)
    by: dict = {}
    for r in found.collect():
        by.setdefault(r["module"], {})[r["code"], r["example"] if r["code"] == "missing_required_table" else None] = r["n"]
    got = {m: {c if e is None else f"{c} {e}": n for (c, e), n in f.items()} for m, f in by.items()}
    required = {"missing_required_table verse_link": 1, "missing_required_table schema_version": 1}
    assert got.pop("bible_0003") == {
        "bible_text_html": 20, "bible_text_pilcrow": 20, "bible_text_backslash": 20, "word_count_mismatch": 20, "unknown_formatting_key": 1, "unknown_span_type": 1, "span_out_of_range": 1,
        "book_out_of_canon": 1, "chapter_count_exceeds_canon": 1, "verse_out_of_canon": 1,
    }
    assert got.pop("bible_0004") == {"missing_required_table verse_link": 1, "empty_schema_version": 1, "invalid_module_uuid": 1, "wrong_versification": 1, "empty_bible": 1}
    assert got.pop("bible_0005") == {"missing_module_info": 1, "missing_verse_link_index": 1, "inverted_range": 1, "interlinear_position_range": 2}
    assert got.pop("bible_0006") == {"multiple_module_info_rows": 2, "missing_info_columns": 1, "forbidden_range_column": 1}
    assert got.pop("bible_0007") == {"content_corrupt": 20}
    assert got.pop("bible_0008") == {"validation_error": 1} and got.pop("bible_0009") == {"empty_database": 1} and got.pop("bible_0010") == {"validation_error": 1}
    assert got.pop("odd") == {"unknown_module_type": 1, "missing_module_info": 1} | required and got.pop("book_y") == {"missing_content_table": 1, "missing_module_info": 1} | required
    assert got == {}
    assert libcheck.totals(checked).first().asDict() == {"total": 302, "passed": 292, "failed": 10, "exit_code": 1}
    kinds = {r["module"]: r["module_type"] for r in checked.collect()}
    assert kinds["bible_0001"] == "bible" and kinds["odd"] is None and kinds["book_y"] == "book"


def test_the_validator_s_command_line(spark, tmp_path):
    d = tmp_path / "modules"
    write(spark, d, n=2)
    canon = tmp_path / "canon.json"
    canon.write_text(json.dumps({"books": [{"book_number": 1, "name": "One", "abbreviation": "1", "testament": "O", "book_group": "g", "verse_counts": [31]}]}))
    run = lambda names, **o: validate_command(spark, names, {"modules": str(d), "canon": str(canon)} | o)
    text, code = run([], all="true")
    assert code == 0 and "All 2 module(s) passed." in text and "data file" in text
    assert run([])[1] == 2 and run(["nobody"])[1] == 2 and run([], all="true", type="book")[1] == 2 and run([], all="true", canon=str(tmp_path / "none"))[1] == 2
    build(d / "bible_0001.db", [("DELETE FROM module_info",)])
    text, code = run([], all="true", quiet="true")
    assert code == 1 and "FAIL bible_0001" in text and "bible_0000" not in text and "missing_module_info_row" in text
    doc = json.loads(run(["0001"], json="true")[0])
    assert (doc["total"], doc["failed"], doc["results"][0]["errors"][0]["code"]) == (1, 1, "missing_module_info_row")
    main = tmp_path / "main.db"
    build(main, [("CREATE TABLE bible_book (book_id INTEGER, book_number INTEGER, book_name TEXT)",), ("INSERT INTO bible_book VALUES (7, 1, 'One')",), ("CREATE TABLE chapter_info (book_id INTEGER, chapter INTEGER, verse_count INTEGER)",), ("INSERT INTO chapter_info VALUES (7, 1, 10)",)])
    text, code = run(["0000"], **{"main-db": str(main)})
    assert code == 1 and "main.db" in text and "verse_out_of_canon" in text
    for change in ("DELETE FROM chapter_info", "DROP TABLE chapter_info"):
        build(main, [(change,)])
        assert libcheck.load_canon(spark, str(main), str(canon))[1].startswith("data file")


def test_files_that_are_not_there(spark, tmp_path):
    found, checked = libcheck.check_folder(spark, "", None, names=[str(tmp_path / "gone.db")])
    assert [(r["module"], r["code"]) for r in found.collect()] == [("gone", "file_not_found")] and libcheck.totals(checked).first()["exit_code"] == 1


# Publication --------------------------------------------------------------------------


def test_a_failure_between_two_tables_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "published")
    a = spark.range(10).withColumn("m", F.create_map(F.lit("k"), F.col("id")))
    assert shared.publish(spark, {"a": a, "b": spark.range(3)}, path) == 1
    with pytest.raises(shared.Conflict):
        shared.publish(spark, {"a": spark.range(1)}, path)
    bad = spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        shared.publish(spark, {"a": spark.range(99), "b": bad}, path, force=True)
    now = shared.published(spark, path)
    assert {n: t.count() for n, t in now.items()} == {"a": 10, "b": 3} and shared.verify_published(spark, path) == []
    assert shared.publish(spark, {"a": spark.range(2)}, path, force=True, note={"why": "new"}) == 2
    assert {n: t.count() for n, t in shared.published(spark, path).items()} == {"a": 2} and shared.published(spark, path, 1)["b"].count() == 3
    with pytest.raises(shared.Conflict):
        shared.publish(spark, {"a": spark.range(2)}, path, force=True, expect=1)
    folder = Path(shared.history(spark, path)[-1]["folder"])
    next(p for p in (folder / "a").glob("part-*") if p.suffix == ".parquet").unlink()
    assert shared.verify_published(spark, path) == ["a"]
    with pytest.raises(LookupError):
        shared.published(spark, str(tmp_path / "nothing"))
