"""Conformance rules over one module's tables: each rule is an aggregate with a stable code.

A module is a dict of DataFrames by table name. ``report`` unions all rules
into (code, severity, n, example); rows with n = 0 are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.text import count_by_spaces, count_web_words
from .stats import books, chapters

#: Content tables by type, required columns, keys of the formatting document.
CONTENT = {
    "bible": "bible_verse", "commentary": "commentary_entry", "dictionary": "dictionary_entry", "lexicon": "dictionary_entry",
    "book": "book_section", "devotional": "devotional_entry", "topical": "topic", "xref": "cross_reference_group",
}
TEXT_COLUMN = {"bible_verse": "text", "commentary_entry": "content", "dictionary_entry": "definition", "book_section": "content", "devotional_entry": "content"}
INFO_COLUMNS = ("module_uuid", "abbreviation", "full_name", "format", "format_version", "content_version", "content_sha256", "versification", "license_spdx", "source_url")
LEAST_CHARS = {"bible_verse": 8, "commentary_entry": 12, "dictionary_entry": 8, "devotional_entry": 12, "book_section": 12}
OPTIONAL_ANCHOR = ("commentary_entry", "user_note", "pinned_item")
SPAN_TYPES = ("divine_name", "supplied", "words_of_christ", "emphasis", "quotation", "transliteration", "musical_direction")
TOP_KEYS = ("v", "block", "spans", "source_verses")
BLOCK_KEYS = ("paragraph_start", "lines", "heading", "heading_kind")
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: Table names that decide the type, first hit wins: query order and validator order.
TYPE_ORDER = {
    "query": (("topic", "topical"), ("bible_verse", "bible"), ("commentary_entry", "commentary"), ("dictionary_entry", "dictionary"), ("cross_reference_group", "xref"), ("book_section", "book"), ("devotional_entry", "devotional")),
    "validator": (("bible_verse", "bible"), ("commentary_entry", "commentary"), ("dictionary_entry", "dictionary"), ("book_section", "book"), ("devotional_entry", "devotional"), ("topic", "topical"), ("cross_reference_group", "xref"), ("tag_association", "tag_graph"), ("entity_verse_link", "tag_graph")),
}


def detect_type(tables: DataFrame, order: str = "validator") -> DataFrame:
    """(module, module_type) from (module, table_name) rows."""
    names = F.collect_set("table_name")
    kind: Column = F.lit("unknown")
    for table, value in reversed(TYPE_ORDER[order]):
        kind = F.when(F.array_contains(names, table), value).otherwise(kind)
    return tables.groupBy("module").agg(kind.alias("module_type"))


def type_from_name(file: Column) -> Column:
    prefix = F.regexp_extract(file, r"^([a-z]+)_", 1)
    return F.when(prefix.isin(*CONTENT), prefix).when(file.startswith("tag_graph"), "tag_graph").when(file.startswith("cross_reference"), "xref").otherwise("unknown")


def _finding(df: DataFrame, code: str, severity: str, n: Column, example: Column | None = None) -> DataFrame:
    shown = F.lit(None).cast("string") if example is None else example.cast("string")
    return df.agg(n.cast("long").alias("n"), shown.alias("example")).select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), "n", "example").where("n > 0")


def _constant(spark, code: str, severity: str, n: int, example: str | None = None) -> DataFrame:
    return spark.createDataFrame([(code, severity, n, example)], "code string, severity string, n long, example string")


def _several(df: DataFrame, rules: list[tuple[str, str, Column, Column | None]]) -> DataFrame:
    """Many counts over one table in one scan, then one row for each that is not 0."""
    sums = df.agg(*[F.struct(F.count_if(F.coalesce(t, F.lit(False))).cast("long").alias("n"), F.min(F.when(t, x)).cast("string").alias("example") if x is not None else F.lit(None).cast("string").alias("example")).alias(c) for c, _, t, x in rules])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"), F.col(f"{c}.n").alias("n"), F.col(f"{c}.example").alias("example")) for c, s, _, _ in rules]))
    return sums.select(each.alias("f")).select("f.*").where("n > 0")


def info_rules(info: DataFrame) -> list[DataFrame]:
    spark = info.sparkSession
    out = []
    if missing := [c for c in INFO_COLUMNS if c not in info.columns]:
        out.append(_constant(spark, "missing_info_columns", "error", len(missing), ", ".join(missing)))
    out.append(_finding(info, "missing_module_info_row", "error", F.when(F.count_if(F.col("info_id") == 1) == 0, 1).otherwise(0)))
    out.append(_finding(info, "multiple_module_info_rows", "warn", F.when(F.count("*") > 1, F.count("*")).otherwise(0)))
    row = info.where("info_id = 1")
    if "module_uuid" in info.columns:
        u = F.col("module_uuid")
        blank = u.isNull() | (F.btrim(u) == "")
        out.append(_several(row, [("missing_module_uuid", "error", blank, None), ("invalid_module_uuid", "error", ~blank & ~u.rlike(UUID), u)]))
    if "versification" in info.columns:
        v = F.col("versification")
        out.append(_several(row, [("wrong_versification", "error", ~v.eqNullSafe(F.lit("kjv-english")), v)]))
    return out


def range_rules(name: str, df: DataFrame) -> list[DataFrame]:
    if name.endswith("_fts"):
        return []
    out = []
    if wrong := [c for c in ("start_verse_id", "end_verse_id") if c in df.columns]:
        out.append(_constant(df.sparkSession, "forbidden_range_column", "error", len(wrong), f"{name}.{wrong[0]}"))
    if {"verse_id_start", "verse_id_end"} <= set(df.columns):
        a, b = F.col("verse_id_start"), F.col("verse_id_end")
        if name in OPTIONAL_ANCHOR:
            rules = [("half_populated_anchor", "error", a.isNull() != b.isNull(), a)]
        else:
            rules = [("null_verse_link_end" if name == "verse_link" else "null_mandatory_range_end", "error", b.isNull(), a)]
        out.append(_several(df, [*rules, ("inverted_range", "error", b < a, a)]))
    return out


def content_rules(name: str, df: DataFrame, least: int | None = None) -> list[DataFrame]:
    """Corrupt or thin content by the share of very short and of damaged texts."""
    if name not in TEXT_COLUMN:
        return []
    least = least or LEAST_CHARS[name]
    t = F.coalesce(F.col(TEXT_COLUMN[name]), F.lit(""))
    shares = df.agg(F.count("*").alias("total"), F.count_if(F.length(F.btrim(t)) < least).alias("short"), F.count_if(t.contains("\ufffd")).alias("damaged"))
    total = F.nullif("total", F.lit(0))
    s, d = F.col("short") / total, F.col("damaged") / total
    code = F.when((s >= 0.8) | (d >= 0.6), "content_corrupt").when((s >= 0.2) | (d >= 0.05), "content_thin")
    row = shares.select(code.alias("code"), F.greatest("short", "damaged").alias("n"))
    return [row.where("code IS NOT NULL").select("code", F.when(F.col("code") == "content_corrupt", "error").otherwise("warn").alias("severity"), F.col("n").cast("long").alias("n"), F.lit(None).cast("string").alias("example"))]


def text_rules(verses: DataFrame) -> list[DataFrame]:
    t, wc, v = F.col("text"), F.col("word_count"), F.col("verse_id")
    rules = [
        ("bible_text_html", "error", t.rlike("(?s)<.*>"), v),
        ("bible_text_pilcrow", "error", t.contains("\u00b6"), v),
        ("bible_text_backslash", "error", t.contains("\\"), v),
    ]
    if "word_count" in verses.columns:
        rules.append(("word_count_mismatch", "error", wc.isNotNull() & (F.btrim(t) != "") & (wc != count_by_spaces(t)), v))
    return [_several(verses, rules)]


def formatting_rules(verses: DataFrame, span_types: tuple[str, ...] = SPAN_TYPES, block_keys: tuple[str, ...] = BLOCK_KEYS) -> list[DataFrame]:
    """The formatting document: an object of known keys; spans of known types, integer, in range. Counted span by span."""
    if "formatting" not in verses.columns:
        return []
    rows = verses.where("formatting IS NOT NULL").select(
        "verse_id", "formatting", F.try_parse_json("formatting").alias("doc"), count_web_words(F.col("text")).alias("words"), F.json_object_keys("formatting").alias("top")
    )
    block = F.json_object_keys(F.get_json_object("formatting", "$.block"))
    bad = _several(
        rows,
        [
            ("invalid_formatting_json", "error", F.col("doc").isNull() | F.col("top").isNull(), F.col("verse_id")),
            ("unknown_formatting_key", "error", F.size(F.array_except("top", F.array(*map(F.lit, TOP_KEYS)))) > 0, F.col("verse_id")),
            ("unknown_block_key", "error", F.size(F.array_except(block, F.array(*map(F.lit, block_keys)))) > 0, F.col("verse_id")),
        ],
    )
    raw = F.from_json(F.get_json_object("formatting", "$.spans"), "array<map<string,string>>")
    spans = rows.select("verse_id", "words", F.explode(raw).alias("s"))
    whole = lambda c: F.when(c.rlike(r"^-?[0-9]{1,9}$"), c.try_cast("int"))
    a, b = whole(F.col("s")["start"]), whole(F.col("s")["end"])
    inside = F.coalesce((a >= 0) & (a <= b) & (b < F.col("words")), F.lit(False))
    return [
        bad,
        _several(
            spans,
            [
                ("unknown_span_type", "error", ~F.coalesce(F.col("s")["type"].isin(*span_types), F.lit(False)), F.col("verse_id")),
                ("span_out_of_range", "error", ~inside, F.col("verse_id")),
            ],
        ),
    ]


def positions_out_of_bounds(words: DataFrame, verses: DataFrame, key: str = "verse_id", start: str = "word_position_start", end: str = "word_position_end", size: str = "word_count") -> DataFrame:
    """Rows whose position lies outside of their text's words, by the stored number of words; a null on either side is no finding."""
    bounds = verses.select(F.col(key).alias("_k"), F.col(size).alias("_n"))
    return words.join(bounds, F.col(key) == F.col("_k")).where((F.col(start) < 0) | (F.col(end) >= F.col("_n"))).drop("_k", "_n")


def canon_rules(verses: DataFrame, canon: DataFrame, key: str = "verse_id") -> list[DataFrame]:
    """Keys against (book, chapter, max_verse): a subset passes, what lies outside is reported once.

    Least, greatest and count by chapter are enough, since a canon's chapters
    are contiguous: about 1,200 rows meet the canon instead of every verse.
    """
    per = chapters(verses, key).withColumns({"low": keys.verse_of(F.col("first_key")), "high": keys.verse_of(F.col("last_key"))})
    sizes = canon.groupBy("book").agg(F.max("chapter").alias("max_chapter"))
    known = per.join(F.broadcast(sizes), "book", "left")
    out = [_finding(verses, "empty_bible", "error", F.when(F.count("*") == 0, 1).otherwise(0))]
    per_book = books(per).join(F.broadcast(sizes.withColumnRenamed("max_chapter", "allowed")), "book", "left")
    out.append(_several(per_book, [("book_out_of_canon", "error", F.col("allowed").isNull(), F.col("book")), ("chapter_count_exceeds_canon", "error", F.col("max_chapter") > F.col("allowed"), F.col("book"))]))
    inside = known.where("max_chapter IS NOT NULL")
    chapter_name = F.concat_ws(":", "book", "chapter")
    out.append(_several(inside, [("invalid_chapter", "error", F.col("chapter") < 1, chapter_name)]))
    real = inside.where("chapter >= 1 AND chapter <= max_chapter").join(F.broadcast(canon), ["book", "chapter"])
    out.append(_several(real, [("invalid_verse", "error", F.col("low") < 1, chapter_name), ("verse_out_of_canon", "error", F.col("high") > F.col("max_verse"), chapter_name)]))
    return out


def report(module: dict[str, DataFrame], canon: DataFrame | None = None, file: str = "") -> DataFrame:
    """(code, severity, n, example) of every rule that found something."""
    spark = next(iter(module.values())).sparkSession if module else None
    if spark is None:
        raise ValueError("a module without tables: empty_database")
    out: list[DataFrame] = []
    kind = next((v for t, v in TYPE_ORDER["validator"] if t in module), None) or (file.split("_")[0] if file.split("_")[0] in CONTENT else None)
    if kind is None:
        out.append(_constant(spark, "unknown_module_type", "error", 1))
    elif kind in CONTENT and CONTENT[kind] not in module:
        out.append(_constant(spark, "missing_content_table", "error", 1, CONTENT[kind]))
    out += info_rules(module["module_info"]) if "module_info" in module else [_constant(spark, "missing_module_info", "error", 1)]
    for t in ("verse_link", "schema_version"):
        if t not in module:
            out.append(_constant(spark, "missing_required_table", "error", 1, t))
    if "schema_version" in module:
        out.append(_finding(module["schema_version"], "empty_schema_version", "error", F.when(F.count("*") == 0, 1).otherwise(0)))
    for name, df in sorted(module.items()):
        out += range_rules(name, df) + content_rules(name, df)
    if "bible_verse" in module:
        verses = module["bible_verse"]
        out += text_rules(verses) + formatting_rules(verses)
        if "interlinear_word" in module and "word_count" in verses.columns:
            bad = positions_out_of_bounds(module["interlinear_word"], verses)
            out.append(_finding(bad, "interlinear_position_range", "error", F.count("*"), F.min("verse_id")))
        if canon is not None:
            out += canon_rules(verses, canon)
    whole = out[0]
    for f in out[1:]:
        whole = whole.unionByName(f)
    return whole


def format_report(rows: list, most: int = 12) -> str:
    """Findings as text, the first ``most`` in full."""
    if not rows:
        return "OK"
    lines = [f"{r['severity'].upper()} {r['code']}: {r['n']}" + (f" (e.g. {r['example']})" if r["example"] else "") for r in rows[:most]]
    return "\n".join(lines + ([f"... and {len(rows) - most} more"] if len(rows) > most else []))


def exit_code(severities: list[str], failed: bool = False) -> int:
    """2 if the run itself failed, 1 with errors, else 0."""
    return 2 if failed else 1 if "error" in severities else 0
