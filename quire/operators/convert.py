"""Conversion of source records to module tables.

A record table has one row for each source entry: ``module``, ``i`` (order),
``osis``, ``c``, ``v``, ``kjv`` (a translated reference, if the source has
one), ``raw``. Every step is a projection, a window inside a module, or a join
with a small table; nothing is mutated after it is written, so merges happen
before the write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys, markup
from ..functions.refs import Books
from ..functions.text import clean_section_html, deterministic_uuid, first_year, identity_key, is_right_to_left, licence_to_spdx, primary_language, spdx_url, strip_markup, strip_rtf
from . import trees
from .ranges import first_rule
from .scan import segmented

#: Numbering systems (fixed values): taken as they are, translated by the record's own reference, by an outside map.
PLAIN = ("", "kjv", "kjva")
BY_RECORD = ("nrsv", "vulg", "synodal")
BY_MAP = ("mt", "german")
ALIASES = {"nrsva": "nrsv", "synodalprot": "synodal", "leningrad": "mt", "luther": "german"}
#: Verses that another division counts apart: key -> (host, whether the text goes before it).
MOVED = {66012018: (66013001, True), 64001015: (64001014, False)}


def gate(versification: str, allow: bool = False) -> str:
    """How a module's references are read: plain, record or map; refusal is an error."""
    v = ALIASES.get(versification.lower(), versification.lower())
    if v in PLAIN or allow and v not in BY_RECORD + BY_MAP:
        return "plain"
    if v in BY_RECORD:
        return "record"
    if v in BY_MAP:
        return "map"
    raise ValueError(f"numbering system {versification!r} cannot be translated")


def with_book(records: DataFrame, books: Books | None = None, code: str = "osis") -> DataFrame:
    """``records`` with ``book`` (1 to 66, or null): a map literal of 66 codes."""
    table = F.create_map(*[F.lit(x) for b in (books or Books()).books for x in (b.code.lower(), b.number)])
    return records.withColumn("book", table[F.lower(F.regexp_replace(F.col(code), r"[ _.\-]", ""))])


def skipped_books(records: DataFrame, code: str = "osis") -> DataFrame:
    """(code, n) of records outside of the canon."""
    return records.where("book IS NULL").groupBy(code).agg(F.count("*").alias("n"))


def targets(records: DataFrame, canon: DataFrame, rules: DataFrame | None = None, own: str | None = None) -> DataFrame:
    """``records`` (module, book, c, v) with ``target`` key and ``reason``.

    ``rules`` (book, chapter, low, high, to_chapter, shift, rule_order) is an
    outside map, first match wins; ``own`` names a column with the record's own
    translated key. Verse 0 becomes 1. A verse past its chapter's end is an
    addition and goes if it was not moved, no outside map is in use, and the
    source's chapter is longer by three or more; else it folds into the last.
    """
    last = records.where("book IS NOT NULL").groupBy("module", "book", "c").agg(F.max("v").alias("source_max"))
    rows = records.join(last, ["module", "book", "c"], "left")
    if rules is not None:
        named = rules.select(F.col("book").alias("book"), F.col("chapter").alias("c"), "low", "high", "to_chapter", "shift", "rule_order")
        rows = first_rule(rows, named, ("book", "c"), "v", outputs=("to_chapter", "shift"))
        chapter, verse = F.coalesce("to_chapter", "c"), F.col("v") + F.coalesce("shift", F.lit(0))
    elif own is not None:
        chapter, verse = F.coalesce(keys.chapter_of(F.col(own)), F.col("c")), F.coalesce(keys.verse_of(F.col(own)), F.col("v"))
    else:
        chapter, verse = F.col("c"), F.col("v")
    rows = rows.withColumns({"_c": chapter.cast("long"), "_v": F.greatest(verse.cast("long"), F.lit(1).cast("long"))})
    rows = rows.join(canon.select("book", F.col("chapter").alias("_c"), "max_verse"), ["book", "_c"], "left")
    moved = (F.col("_c") != F.col("c")) | (F.col("_v") != F.greatest(F.col("v"), F.lit(1)))
    past = F.col("_v") > F.col("max_verse")
    addition = past & ~moved & F.lit(rules is None) & (F.col("source_max") - F.col("max_verse") >= 3)
    reason = (
        F.when(F.col("book").isNull(), "outside canon")
        .when(F.col("c") == 0, "intro")
        .when(F.col("max_verse").isNull(), "maps outside canon")
        .when(addition, "addition")
        .when(past, "fold")
        .when(moved, "moved")
    )
    out = rows.withColumn("reason", reason)
    dropped = F.col("reason").isin("outside canon", "intro", "maps outside canon", "addition")
    key = keys.pack(F.col("book"), F.col("_c"), F.least("_v", "max_verse"))
    drop = [c for c in ("_c", "_v", "max_verse", "source_max", "to_chapter", "shift") if c in out.columns and c not in records.columns]
    return out.withColumn("target", F.when(~F.coalesce(dropped, F.lit(False)), key)).drop(*drop)


def parsed_rows(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """``rows`` with the parsed fields; entries without text go."""
    return rows.withColumn("_p", markup.parsed(F.col(raw))).select(*rows.columns, "_p.*").where("text <> ''")


def with_variants(rows: DataFrame) -> DataFrame:
    """Verses that another division counts apart go to their host, marked as moved (unless they already were), and as ``held`` if they come before it."""
    key, place = F.col("target"), keys.pack(F.col("book"), F.col("c"), F.col("v"))
    host = F.lit(None).cast("long")
    for k, (to, _) in MOVED.items():
        host = F.when(place == k, F.lit(to).cast("long")).otherwise(host)
    plain = F.col("reason").isNull() | (F.col("reason") == "fold")
    before = place.isin(*[k for k, (_, first) in MOVED.items() if first])
    moved = {"target": F.when(plain, F.coalesce(host, key)).otherwise(key), "reason": F.when(plain & host.isNotNull(), "moved").otherwise(F.col("reason"))}
    return rows.withColumns(moved | {"held": F.coalesce(plain & before, F.lit(False))})


def merge(rows: DataFrame) -> DataFrame:
    """One row for each (module, target): texts joined in source order, offsets shifted by the words before.

    paragraph_start comes from the first part (or a marker that trailed the
    entry before), poetry is the highest level, the heading the first that is
    not empty, selah from any, and moved parts leave a provenance record; so
    does the host of a part that was held for it.
    """
    if "held" not in rows.columns:
        rows = rows.withColumn("held", F.lit(False))
    rows = segmented(rows, ["module"], ["i"], lags={"_carry": F.col("trailing_paragraph")}).withColumn("_carry", F.coalesce("_carry", F.lit(False)))
    before = Window.partitionBy("module", "target").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_at", F.coalesce(F.sum("word_count").over(before), F.lit(0)).cast("int"))
    moved = F.transform("spans", lambda s: F.struct(s["type"].alias("type"), (s["start"] + F.col("_at")).alias("start"), (s["end"] + F.col("_at")).alias("end"), s["ref"].alias("ref")))
    tokens = F.transform("words", lambda w: w.withField("start", w["start"] + F.col("_at")).withField("end", w["end"] + F.col("_at")))
    origin = F.struct(F.col("c").cast("int").alias("chapter"), F.col("v").cast("int").alias("verse"), F.col("_at").alias("start"), (F.col("_at") + F.col("word_count") - 1).alias("end"))
    from_elsewhere = F.coalesce(F.col("reason").isin("moved", "fold"), F.lit(False))
    part = F.struct(
        "i", F.col("text").alias("t"), "word_count", moved.alias("s"), tokens.alias("w"), F.col("block").alias("b"), F.col("_carry").alias("carry"), origin.alias("o"), from_elsewhere.alias("moved"), F.col("held").alias("held"),
    )
    grouped = rows.where("target IS NOT NULL").groupBy("module", "target").agg(F.array_sort(F.collect_list(part)).alias("p"))
    p = F.col("p")
    pick = lambda f: F.transform(p, f)
    block = F.struct(
        (p[0]["b"]["paragraph_start"] | p[0]["carry"]).alias("paragraph_start"),
        F.array_max(pick(lambda x: x["b"]["poetry_level"])).alias("poetry_level"),
        F.coalesce(F.get(F.filter(pick(lambda x: x["b"]["heading"]), lambda h: h != ""), F.lit(0)), F.lit("")).alias("heading"),
        F.exists(p, lambda x: x["b"]["selah"]).alias("selah"),
    )
    return grouped.select(
        "module", F.col("target").alias("verse_id"),
        F.array_join(pick(lambda x: x["t"]), " ").alias("text"),
        F.aggregate(p, F.lit(0), lambda a, x: a + x["word_count"]).alias("word_count"),
        block.alias("block"),
        F.flatten(pick(lambda x: x["s"])).alias("spans"),
        F.flatten(pick(lambda x: x["w"])).alias("words"),
        F.transform(F.filter(p, lambda x: x["moved"] | F.exists(p, lambda y: y["held"] & (y["i"] < x["i"]))), lambda x: x["o"]).alias("source_verses"),
    )


def bible_tables(records: DataFrame, canon: DataFrame, rules: DataFrame | None = None, own: str | None = None) -> dict[str, DataFrame]:
    """Records -> ``bible_verse`` and ``interlinear_word``; linked and repeated entries are skipped."""
    rows = with_book(records)
    if "linked" in rows.columns:
        rows = rows.where(~F.coalesce(F.col("linked"), F.lit(False)))
    placed = targets(rows, canon, rules, own).where("target IS NOT NULL")
    merged = merge(with_variants(parsed_rows(placed)))
    verses = merged.select("module", "verse_id", "text", markup.formatting(F.col("block"), F.col("spans"), F.col("source_verses")).alias("formatting"), "word_count")
    tokens = merged.select("module", "verse_id", F.posexplode("words").alias("place", "w"))
    words = tokens.select(
        "module", "verse_id", F.col("w.start").alias("word_position_start"), F.col("w.end").alias("word_position_end"),
        F.nullif(F.col("w.original_word"), F.lit("")).alias("original_word"), F.col("w.strongs_number").alias("strongs_number"),
        F.nullif(F.col("w.morphology"), F.lit("")).alias("morphology"), F.concat(F.lit("strong:"), F.col("w.strongs_number")).alias("lemma"), F.col("w.gloss").alias("gloss"),
        F.when(F.col("w.all_strongs") != F.col("w.strongs_number"), F.to_json(F.struct(F.col("w.all_strongs").alias("strongs")))).alias("metadata"), "place",
    )
    return {"bible_verse": verses, "interlinear_word": words}


def commentary_tables(records: DataFrame) -> dict[str, DataFrame]:
    """Entries by level (book, chapter, verse), with the words of the stripped text, and their links."""
    rows = with_book(records).where("book IS NOT NULL AND coalesce(raw, '') <> ''")
    level = F.when(F.col("c") == 0, "book").when(F.col("v") == 0, "chapter").otherwise("verse")
    rows = segmented(rows, ["module"], ["i"], number="entry_id")
    words = F.size(F.filter(F.split(strip_markup(F.col("raw")), r"\s+"), lambda w: w != ""))
    key = keys.pack(F.col("book"), F.greatest("c", F.lit(1)), F.greatest("v", F.lit(1)))
    entries = rows.select(
        "module", "entry_id", key.alias("verse_id_start"), key.alias("verse_id_end"), level.alias("entry_level"), F.col("raw").alias("content"), words.alias("word_count")
    )
    links = entries.select("module", F.lit("commentary").alias("source_type"), F.col("entry_id").alias("source_id"), "verse_id_start", keys.range_end(F.col("verse_id_start"), F.col("verse_id_end")).alias("verse_id_end"), F.lit("primary_passage").alias("link_type"))
    return {"commentary_entry": entries, "verse_link": links}


def dictionary_table(records: DataFrame) -> DataFrame:
    """(module, entry_key, definition): blank entries go, the first of a key wins."""
    rows = records.where("coalesce(trim(key), '') <> '' AND coalesce(trim(raw), '') <> ''")
    first = rows.groupBy("module", F.btrim("key").alias("entry_key")).agg(F.min_by("raw", "i").alias("raw"))
    return first.select("module", "entry_key", F.btrim(strip_markup(F.col("raw"))).alias("definition"))


def devotional_table(records: DataFrame) -> DataFrame:
    """(module, day_number, date_label, content): days count the entries that have text."""
    rows = records.where("coalesce(trim(raw), '') <> ''")
    return segmented(rows, ["module"], ["i"], number="day_number").select("module", "day_number", F.btrim("key").alias("date_label"), F.col("raw").alias("content"))


def section_table(records: DataFrame) -> DataFrame:
    """Records with ``parent_i`` (null for roots) -> sections: dotted numbers, cleaned HTML, words of the stripped text.

    Sibling order is source order; nodes deeper than 64 levels have no number and go.
    """
    r = records.select("module", "i", "parent_i")
    up = r.withColumns({"id": F.xxhash64("module", "i"), "up": F.when(F.col("parent_i").isNotNull(), F.xxhash64("module", "parent_i"))})
    rooted = up.withColumn("up", F.coalesce("up", F.xxhash64("module")))
    modules = r.select(F.xxhash64("module").alias("id"), F.lit(None).cast("long").alias("up"), F.lit(-1).cast("long").alias("i")).distinct()
    numbers = trees.dotted_numbers(rooted.select("id", "up", F.col("i").cast("long").alias("i")).unionByName(modules), "id", "up", ["i"])
    number = F.regexp_replace("number", r"^[0-9]+\.", "")  # the first step numbers the module
    html = clean_section_html(F.coalesce("raw", F.lit("")))
    rows = records.withColumn("node", F.xxhash64("module", "i")).join(numbers.withColumn("section_number", number), "node")
    words = F.size(F.filter(F.split(strip_markup(F.coalesce("raw", F.lit(""))), r"\s+"), lambda w: w != ""))
    return rows.select("module", F.col("i").alias("section_id"), F.col("parent_i").alias("parent_section_id"), "section_number", F.col("i").alias("sort_order"), F.col("key").alias("title"), html.alias("content"), words.alias("word_count"))


def identity_block(conf: DataFrame, kind: str) -> DataFrame:
    """Module identity from (module, conf map): fallbacks in order, empty values count as missing."""
    get = lambda *names: F.coalesce(*[F.nullif(F.btrim(F.col("conf")[n]), F.lit("")) for n in names])
    licence = licence_to_spdx(get("DistributionLicense"))
    copyright = strip_rtf(get("ShortCopyright", "Copyright", "CopyrightNotes", "DistributionLicense"))
    year = first_year(F.coalesce(get("CopyrightDate"), F.lit("")))
    language = F.coalesce(primary_language(get("Lang")), F.lit("en"))
    abbreviation = F.coalesce(get("Abbreviation"), F.col("module"))
    return conf.select(
        "module", deterministic_uuid(identity_key(F.lit(kind), abbreviation, language)).alias("module_uuid"), F.lit(kind).alias("module_type"), abbreviation.alias("abbreviation"),
        F.coalesce(get("Description"), F.col("module")).alias("full_name"), F.coalesce(get("Version"), F.lit("1.0")).alias("content_version"),
        strip_rtf(get("About")).alias("description"), copyright.alias("copyright"), get("CopyrightHolder", "Publisher").alias("publisher"), get("Author").alias("author"), F.when(get("TextSource").rlike("^https?://"), get("TextSource")).alias("source_url"),
        F.when(year > 0, year).otherwise(first_year(F.coalesce(copyright, F.lit("")))).alias("year_published"), licence.alias("license_spdx"), spdx_url(licence).alias("license_url"),
        language.alias("language_code"), is_right_to_left(F.coalesce(get("Lang"), F.lit("")), get("Direction")).alias("right_to_left"),
        language.isin("he", "grc", "hbo").alias("is_original_language"),
    )


def module_metadata(records: DataFrame, conf: DataFrame, versification: Column | None = None, override: Column | None = None) -> DataFrame:
    """(module, metadata): a module's JSON record of where it comes from.

    ``records`` have (module, osis, book, stored, merged, linked, transcoded):
    what became of each source entry. Books stand by their code, with the
    entries stored of each (``source_books``), and those outside of the canon
    with all their entries (``skipped_books``).
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    per = records.groupBy("module", "osis").agg(
        F.count_if(F.col("book").isNull()).alias("out"), F.count_if(F.col("book").isNotNull() & flag("stored")).alias("in"), *[F.count_if(flag(c)).alias(c) for c in ("merged", "linked", "transcoded")]
    )
    named = lambda n: F.transform(F.array_sort(F.filter(F.collect_list(F.struct("osis", F.col(n).alias("verses"))), lambda b: b["verses"] > 0)), lambda b: b)
    sums = per.groupBy("module").agg(*[F.sum(c).alias(c) for c in ("merged", "linked", "transcoded")], named("in").alias("source_books"), named("out").alias("skipped_books"))
    get = lambda n: F.coalesce(F.col("conf")[n], F.lit(""))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    books = lambda c: F.coalesce(F.col(c), F.array().cast(sums.schema[c].dataType))
    declared = get("Versification")
    doc = F.struct(
        F.col("module").alias("sword_module"), get("Lang").alias("sword_lang"), get("SourceType").alias("sword_source_type"), (declared if versification is None else versification).alias("sword_versification"),
        get("DistributionLicense").alias("sword_distribution_license"), get("TextSource").alias("sword_text_source"), zero("merged").alias("variant_verse_merges"), zero("linked").alias("linked_verses_skipped"),
        zero("transcoded").alias("latin1_entries_transcoded"), declared.alias("sword_declared_versification"), (F.lit("") if override is None else override).alias("versification_override"),
        books("source_books").alias("source_books"), books("skipped_books").alias("skipped_books"),
    )
    return conf.join(sums, "module", "left").select("module", F.to_json(doc).alias("metadata"))


def content_line(kind: str) -> Column:
    """The line that the content digest takes for one row, by module type."""
    tab = lambda *c: F.concat_ws("\t", *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in c])
    shapes = {
        "bible": ("verse_id", "text"), "commentary": ("verse_id_start", "content"), "dictionary": ("entry_key", "definition"),
        "devotional": ("day_number", "date_label", "content"), "book": ("section_id", "title", "content"),
    }
    return F.concat(tab(*shapes[kind]), F.lit("\n"))
