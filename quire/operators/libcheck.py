"""Conformance of a whole library in one plan.

The tables of all modules are one frame each, keyed by ``module``; a rule is a
count inside one grouped aggregate of its table, so a thousand modules are as
many jobs as one. What a file declares (tables, columns, indexes) comes from the
catalogue and needs no shuffle at all. A file that cannot be read is a row of
the catalogue with a reason, or a row of a table with one: it becomes a
``validation_error`` of its module and stops no other.

``findings`` gives (module, code, severity, n, example), ``verdicts`` a row for
each module, ``exit_code`` 0 (all passed), 1 (some failed) or 2 (nothing to
check). A table that a rule needs a column of, and that does not have it, is not
that rule's business: a column that only some modules declare is read as null,
and the catalogue tells for whom.
"""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.text import count_by_spaces, count_web_words
from ..sources import files, shared, sqlite
from . import validate

#: Content tables by type, the indexes of links, text indexes with the column that must come first.
CONTENT_TABLES = {
    "bible": ("bible_verse",), "commentary": ("commentary_entry",), "dictionary": ("dictionary_entry",), "lexicon": ("dictionary_entry",), "book": ("book_section",),
    "devotional": ("devotional_entry",), "topical": ("topic",), "xref": ("cross_reference_group",), "tag_graph": ("tag_association", "person", "place", "object", "theme"),
}
LINK_INDEXES = ("idx_verse_link_source", "idx_verse_link_start", "idx_verse_link_range", "idx_verse_link_covering")
TEXT_INDEXES = {"bible_verse": "verse_id", "commentary_entry": "entry_id", "dictionary_entry": "entry_id", "devotional_entry": "entry_id", "book_section": "section_id"}
REQUIRED = ("verse_link", "schema_version")
FORBIDDEN = ("start_verse_id", "end_verse_id")
MAX_BOOK = 66
FINDING = "array<struct<code:string,severity:string,n:bigint,example:string>>"


def has(table: str) -> Column:
    return F.map_contains_key(F.col("tables"), F.lit(table))


def columns_of(table: str) -> Column:
    return F.coalesce(F.col("tables")[table], F.array().cast("array<string>"))


def module_type() -> Column:
    """By the tables that are there, else by the file's name; null if neither tells."""
    names = F.col("module")
    found = F.lit(None).cast("string")
    both = has("person") & has("place")
    found = F.when(both, "tag_graph").otherwise(found)
    for table, kind in reversed(validate.TYPE_ORDER["validator"]):
        found = F.when(has(table), kind).otherwise(found)
    prefix = F.substring_index(names, "_", 1)
    named = F.when(names.startswith("xref_"), "xref").when(names.startswith("tag_graph"), "tag_graph").when(prefix.isin(*CONTENT_TABLES), prefix)
    return F.coalesce(found, named)


def _found(code: str, severity: str, test: Column, n: Column | int = 1, example: Column | None = None) -> Column:
    shown = F.lit(None) if example is None else example
    count = F.lit(n) if isinstance(n, int) else n
    return F.when(test, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), count.cast("long").alias("n"), shown.cast("string").alias("example")))


def _listed(rows: DataFrame, rules: list[Column]) -> DataFrame:
    each = F.filter(F.array(*rules), lambda f: f.isNotNull() & (f["n"] > 0)).cast(FINDING)
    return rows.select("module", F.explode(each).alias("f")).select("module", "f.*")


def catalog_findings(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(findings, missing identity columns by module) that the catalogue alone shows; a file that cannot be read, or holds nothing, has no other finding."""
    empty = F.size("tables") == 0
    bad = F.col("error").isNotNull()
    out = _listed(
        catalog.where(bad | empty),
        [
            _found("file_not_found", "error", F.col("error") == "file_not_found", example=F.col("file")),
            _found("validation_error", "error", bad & (F.col("error") != "file_not_found"), example=F.col("error")),
            _found("empty_database", "error", ~bad & empty),
        ],
    )
    rows = catalog.where(~bad & ~empty).withColumn("kind", module_type())
    expected = F.create_map(*[x for k, t in CONTENT_TABLES.items() for x in (F.lit(k), F.array(*map(F.lit, t)))])[F.col("kind")]
    missing = F.array_except(F.array(*map(F.lit, validate.INFO_COLUMNS)), columns_of("module_info"))
    absent = F.array_except(F.array(*map(F.lit, LINK_INDEXES)), F.coalesce("indexes", F.array().cast("array<string>")))
    wrong = F.flatten(F.transform(F.map_entries("tables"), lambda t: F.transform(F.array_intersect(t["value"], F.array(*map(F.lit, FORBIDDEN))), lambda c: F.concat(t["key"], F.lit("."), c))))
    rules = [
        _found("unknown_module_type", "error", F.col("kind").isNull()),
        _found("missing_content_table", "error", F.col("kind").isNotNull() & ~F.arrays_overlap(F.map_keys("tables"), expected), example=F.array_join(expected, ", ")),
        _found("missing_module_info", "error", ~has("module_info")),
        *[_found("missing_required_table", "error", ~has(t), example=F.lit(t)) for t in REQUIRED],
        _found("missing_verse_link_index", "error", has("verse_link") & (F.size(absent) > 0), F.size(absent), F.array_join(absent, ", ")),
        *[_found("fts_column_order", "error", has(t) & (F.size(columns_of(f"{t}_fts")) > 0) & (F.get(columns_of(f"{t}_fts"), F.lit(0)) != key), example=F.lit(f"{t}_fts")) for t, key in TEXT_INDEXES.items()],
        _found("forbidden_range_column", "error", F.size(wrong) > 0, F.size(wrong), F.array_join(F.sort_array(wrong), ", ")),
    ]
    out = out.unionByName(_listed(rows, rules))
    # Only a module whose identity row is there is asked for its columns; see info_findings.
    return out, rows.where(has("module_info")).select("module", missing.alias("missing"))


Rule = tuple[str, str, Column, Column | None]


def _counted(df: DataFrame, rules: list[Rule], more: dict[str, Column] | None = None) -> DataFrame:
    """(module, r0, r1, ..., more): all counts of a table in one grouped aggregate."""
    each = [F.struct(F.count_if(F.coalesce(t, F.lit(False))).cast("long").alias("n"), (F.lit(None) if x is None else F.min(F.when(t, x))).cast("string").alias("example")).alias(f"r{i}") for i, (_, _, t, x) in enumerate(rules)]
    return df.groupBy("module").agg(*each, *[c.alias(n) for n, c in (more or {}).items()])


def _of(rules: list[Rule]) -> list[Column]:
    return [_found(code, severity, F.col(f"r{i}.n") > 0, F.col(f"r{i}.n"), F.col(f"r{i}.example")) for i, (code, severity, _, _) in enumerate(rules)]


def first_bad(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(module, code, severity, n, example): how often each rule is broken in each module, with the least example."""
    return _listed(_counted(df, rules), _of(rules))


def info_findings(info: DataFrame, declared: DataFrame) -> DataFrame:
    """Rules on the identity row; without a row of id 1 nothing else is asked of a module."""
    own = F.col("info_id") == 1
    uuid = F.col("module_uuid") if "module_uuid" in info.columns else F.lit(None).cast("string")
    other = F.col("versification") if "versification" in info.columns else F.lit("kjv-english")
    counted = info.groupBy("module").agg(F.count("*").alias("rows"), F.count_if(own).alias("own"), F.min(F.when(own, uuid)).alias("uuid"), F.min(F.when(own, F.struct(other.alias("v")))).alias("kind"))
    rows = declared.withColumn("declares", ~F.array_contains("missing", "versification")).join(counted, "module", "left").na.fill(0, ["rows", "own"])
    there = F.col("own") > 0
    blank = F.coalesce(F.col("uuid"), F.lit("")) == ""
    return _listed(
        rows,
        [
            _found("missing_module_info_row", "error", ~there, example=F.concat(F.col("rows").cast("string"), F.lit(" row(s)"))),
            _found("missing_module_uuid", "error", there & blank),
            _found("invalid_module_uuid", "error", there & ~blank & ~F.col("uuid").rlike(validate.UUID), example=F.col("uuid")),
            _found("wrong_versification", "error", there & F.col("declares") & ~F.col("kind.v").eqNullSafe(F.lit("kjv-english")), example=F.col("kind.v")),
            _found("missing_info_columns", "error", there & (F.size("missing") > 0), F.size("missing"), F.array_join("missing", ", ")),
            _found("multiple_module_info_rows", "warn", there & (F.col("rows") > 1), F.col("rows")),
        ],
    )


def range_rules(name: str) -> list[Rule]:
    a, b = F.col("verse_id_start"), F.col("verse_id_end")
    if name in validate.OPTIONAL_ANCHOR:
        rules = [("half_populated_anchor", "error", a.isNull() != b.isNull(), F.lit(name))]
    else:
        rules = [("null_mandatory_range_end", "error", a.isNotNull() & b.isNull(), F.lit(name))]
    if name == "verse_link":
        rules.append(("null_verse_link_end", "error", b.isNull(), F.lit(name)))
    return [*rules, ("inverted_range", "error", b < a, F.lit(name))]


def text_rules(df: DataFrame) -> list[Rule]:
    """Rules on a verse's text and on its formatting document, row by row."""
    t, v = F.col("text"), F.col("verse_id")
    rules: list[Rule] = [("bible_text_html", "error", t.rlike("(?s)<.*>"), v), ("bible_text_pilcrow", "error", t.contains("¶"), v), ("bible_text_backslash", "error", t.contains("\\"), v)]
    if "word_count" in df.columns:
        rules.append(("word_count_mismatch", "error", F.col("word_count").isNotNull() & (F.btrim(t) != "") & (F.col("word_count") != count_by_spaces(t)), v))
    if "formatting" in df.columns:
        f = F.col("formatting")
        top, block = F.json_object_keys(f), F.json_object_keys(F.get_json_object(f, "$.block"))
        names = lambda x: F.array(*map(F.lit, x))
        rules += [
            ("invalid_formatting_json", "error", f.isNotNull() & (F.try_parse_json(f).isNull() | top.isNull()), v),
            ("unknown_formatting_key", "error", F.size(F.array_except(top, names(validate.TOP_KEYS))) > 0, v),
            ("unknown_block_key", "error", F.size(F.array_except(block, names(validate.BLOCK_KEYS))) > 0, v),
        ]
    return rules


def content_shares(name: str, df: DataFrame) -> dict[str, Column]:
    column = validate.TEXT_COLUMN.get(name)
    if column is None or column not in df.columns:
        return {}
    t = F.coalesce(F.col(column), F.lit(""))
    return {"total": F.count("*"), "short": F.count_if(F.length(F.btrim(t)) < validate.LEAST_CHARS[name]), "damaged": F.count_if(t.contains("�"))}


def content_findings() -> list[Column]:
    s, d, n = F.col("short") / F.col("total"), F.col("damaged") / F.col("total"), F.greatest("short", "damaged")
    corrupt = (s >= 0.8) | (d >= 0.6)
    return [_found("content_corrupt", "error", corrupt, n), _found("content_thin", "warn", ~corrupt & ((s >= 0.2) | (d >= 0.05)), n)]


def span_findings(verses: DataFrame) -> DataFrame:
    spans = verses.where("formatting IS NOT NULL").select(
        "module", "verse_id", count_web_words(F.col("text")).alias("words"), F.explode(F.from_json(F.get_json_object("formatting", "$.spans"), "array<map<string,string>>")).alias("s")
    )
    whole = lambda c: F.when(c.rlike(r"^-?[0-9]{1,9}$"), c.try_cast("int"))
    a, b = whole(F.col("s")["start"]), whole(F.col("s")["end"])
    rules: list[Rule] = [
        ("unknown_span_type", "error", ~F.coalesce(F.col("s")["type"].isin(*validate.SPAN_TYPES), F.lit(False)), F.col("verse_id")),
        ("span_out_of_range", "error", ~F.coalesce((a >= 0) & (a <= b) & (b < F.col("words")), F.lit(False)), F.col("verse_id")),
    ]
    return first_bad(spans, rules)


def canon_findings(verses: DataFrame, canon: DataFrame) -> DataFrame:
    """Chapters of all modules against the canon; least and greatest verse are enough, for a canon's chapters are contiguous."""
    k = F.col("verse_id")
    per = verses.where("verse_id IS NOT NULL").groupBy("module", keys.book_of(k).alias("book"), keys.chapter_of(k).alias("chapter")).agg(F.min(keys.verse_of(k)).alias("low"), F.max(keys.verse_of(k)).alias("high"))
    known = canon.where(F.col("book").between(1, MAX_BOOK))
    sizes = known.groupBy("book").agg(F.max("chapter").alias("allowed"))
    books = per.groupBy("module", "book").agg(F.max("chapter").alias("top")).join(sizes, "book", "left")
    book_rules: list[Rule] = [("book_out_of_canon", "error", F.col("allowed").isNull(), F.col("book")), ("chapter_count_exceeds_canon", "error", F.col("top") > F.col("allowed"), F.col("book"))]
    place = F.concat_ws(":", "book", "chapter")
    rows = per.join(sizes, "book").join(known.select("book", "chapter", "max_verse"), ["book", "chapter"], "left")
    inside = (F.col("chapter") >= 1) & (F.col("chapter") <= F.col("allowed"))
    rules: list[Rule] = [
        ("invalid_chapter", "error", F.col("chapter") < 1, place),
        ("invalid_verse", "error", inside & (F.col("low") < 1), place),
        ("verse_out_of_canon", "error", inside & (F.col("high") > F.col("max_verse")), place),
    ]
    return first_bad(books, book_rules).unionByName(first_bad(rows, rules))


def _declares(table: str, *columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.array_contains(columns_of(table), c)
    return out


def _absent(catalog: DataFrame, table: str, df: DataFrame | None, code: str, kind: str | None = None) -> DataFrame:
    """Modules that declare a table and have no row in it."""
    rows = catalog.where(F.col("error").isNull() & has(table))
    if kind:
        rows = rows.where(module_type() == kind)
    if df is not None:
        rows = rows.join(df.select("module").distinct(), "module", "left_anti")
    return rows.select("module", F.lit(code).alias("code"), F.lit("error").alias("severity"), F.lit(1).cast("long").alias("n"), F.lit(None).cast("string").alias("example"))


def findings(catalog: DataFrame, tables: dict[str, DataFrame], canon: DataFrame | None = None) -> DataFrame:
    """(module, code, severity, n, example) of all modules of a catalogue (see ``sqlite.catalog``).

    ``tables`` are frames with ``module``, and ``_error`` where a file could not
    be read. Modules that stand in a frame but not in the catalogue are ignored.
    """
    out, declared = catalog_findings(catalog)
    known = catalog.where("error IS NULL").select("module")
    sound: dict[str, DataFrame] = {}
    broken = None
    for name, df in sorted(tables.items()):
        if "_error" in df.columns:
            one = df.where("_error IS NOT NULL").select("module", "_error")
            broken = one if broken is None else broken.unionByName(one)
            df = df.where("_error IS NULL").drop("_error")
        sound[name] = df
    if broken is not None:
        why = broken.join(known, "module", "left_semi").groupBy("module").agg(F.min("_error").alias("example"))
        out = out.unionByName(why.select("module", F.lit("validation_error").alias("code"), F.lit("error").alias("severity"), F.lit(1).cast("long").alias("n"), "example"))
        known = known.join(why, "module", "left_anti")
        catalog = catalog.join(why.select("module"), "module", "left_anti")
    kinds = catalog.where("error IS NULL").withColumn("kind", module_type()).select("module", "kind", "tables")
    if "module_info" in sound:
        out = out.unionByName(info_findings(sound["module_info"], declared.join(known, "module", "left_semi")))
    out = out.unionByName(_absent(catalog, "schema_version", sound.get("schema_version"), "empty_schema_version"))
    out = out.unionByName(_absent(catalog, "bible_verse", sound.get("bible_verse"), "empty_bible", "bible"))
    for name, df in sound.items():
        rules: list[Rule] = []
        needs: list[tuple[str, ...]] = []
        if {"verse_id_start", "verse_id_end"} <= set(df.columns) and not name.endswith("_fts"):
            rules += range_rules(name)
            needs += [("verse_id_start", "verse_id_end")] * (len(rules) - len(needs))
        if name == "bible_verse" and {"verse_id", "text"} <= set(df.columns):
            rules += text_rules(df)
            needs += [("text",)] * (len(rules) - len(needs))
        shares = content_shares(name, df)
        if rules or shares:
            counted = _counted(df, rules, shares).join(kinds, "module")
            own = F.col("kind").isin(*[k for k, t in CONTENT_TABLES.items() if name in t and k != "lexicon"]) & _declares(name, validate.TEXT_COLUMN.get(name, ""))
            content = [F.when(own, c) for c in content_findings()] if shares else []
            out = out.unionByName(_listed(counted, [*[F.when(_declares(name, *n), f) for f, n in zip(_of(rules), needs, strict=True)], *content]))
    verses = sound.get("bible_verse")
    if verses is not None:
        if {"formatting", "text"} <= set(verses.columns):
            out = out.unionByName(span_findings(verses).join(known, "module", "left_semi"))
        words = sound.get("interlinear_word")
        if words is not None and "word_count" in verses.columns:
            sizes = verses.select(F.col("module").alias("_m"), F.col("verse_id").alias("_k"), F.col("word_count").alias("_n"))
            met = words.join(sizes, (F.col("module") == F.col("_m")) & (F.col("verse_id") == F.col("_k")))
            rule: list[Rule] = [("interlinear_position_range", "error", (F.col("word_position_start") < 0) | (F.col("word_position_end") >= F.col("_n")), F.col("verse_id"))]
            out = out.unionByName(first_bad(met, rule).join(known, "module", "left_semi"))
        if canon is not None:
            bibles = kinds.where("kind = 'bible'").select("module")
            out = out.unionByName(canon_findings(verses.join(bibles, "module", "left_semi"), canon))
    return out


def verdicts(catalog: DataFrame, found: DataFrame) -> DataFrame:
    """(module, module_type, ok, errors, warnings): one row for each module of the catalogue."""
    counted = found.groupBy("module").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warn").alias("warnings"))
    rows = catalog.select("module", F.when(F.col("error").isNull() & (F.size("tables") > 0), module_type()).alias("module_type"))
    return rows.join(counted, "module", "left").na.fill(0, ["errors", "warnings"]).select("module", "module_type", (F.col("errors") == 0).alias("ok"), "errors", "warnings")


def totals(checked: DataFrame) -> DataFrame:
    """(total, passed, failed, exit_code) of the verdicts: 2 without a module, 1 with one that failed."""
    one = checked.agg(F.count("*").alias("total"), F.count_if("ok").alias("passed"))
    failed = F.col("total") - F.col("passed")
    return one.select("total", "passed", failed.alias("failed"), F.when(F.col("total") == 0, 2).when(failed > 0, 1).otherwise(0).alias("exit_code"))


def load_canon(spark: SparkSession, main_db: str | None = None, path: str | None = None) -> tuple[DataFrame, str]:
    """(canon, source): the reference tables of a main database if it has them, else a canon file."""
    if main_db and Path(main_db).exists():
        try:
            chapters, books = sqlite.read_table(spark, main_db, "chapter_info"), sqlite.read_table(spark, main_db, "bible_book")
            both = chapters.join(books, "book_id").select(F.col("book_number").alias("book"), F.col("book_name").alias("name"), "chapter", F.col("verse_count").alias("max_verse"))
            if both.head(1):
                return both, f"main.db ({main_db})"
        except Exception as e:  # a main database without the reference tables: the file takes its place
            if "no table" not in str(e) and "DatabaseError" not in str(e) and "no such column" not in str(e):
                raise
    if path and Path(path).exists():
        return files.canon(spark, path), f"data file ({path})"
    raise LookupError("no source of the canon: neither a main database with the reference tables nor a canon file")


def check_folder(spark: SparkSession, folder: str, canon: DataFrame | None = None, kind: str | None = None, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, verdicts) of the module files of a folder: all, those of a type by their names, or the named paths."""
    if names is None:
        if not os.path.isdir(folder):
            raise LookupError(f"no folder of modules: {folder}")
        names = [f for f in sqlite.files_of(folder) if kind is None or _kind_of_name(Path(f).stem) == kind]
    if not names:
        raise LookupError("no modules matched")
    # The files are read once, into tables that all rules share; and so are the findings.
    path = shared.scratch(spark, "library-check")
    known, tables = sqlite.read_library(spark, json.dumps(names))
    stored = {"_catalog": known} | tables
    for name, df in stored.items():
        df.write.parquet(f"{path}/{name}")
        stored[name] = spark.read.parquet(f"{path}/{name}")
    known = stored.pop("_catalog")
    findings(known, stored, canon).write.parquet(f"{path}/_findings")
    found = spark.read.parquet(f"{path}/_findings")
    return found, verdicts(known, found)


def _kind_of_name(stem: str) -> str | None:
    if stem.startswith("xref_"):
        return "xref"
    prefix = stem.split("_")[0]
    return "tag_graph" if stem.startswith("tag_graph") else prefix if prefix in CONTENT_TABLES else None
