"""The verification report of one module: every section's findings in one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from . import validate, verify
from .sequence import equal_neighbours
from .stats import quantile, status

_T = verify.THRESHOLDS


def _counted(df: DataFrame, code: str, severity: Column | str, least: int = 1) -> DataFrame:
    """A finding if the rows of ``df`` are at least ``least``; the severity may depend on ``n``."""
    level = F.lit(severity) if isinstance(severity, str) else severity
    return df.agg(F.count("*").alias("n")).where(F.col("n") >= least).select(F.lit(code).alias("code"), level.alias("severity"), F.col("n").cast("long").alias("n"))


def _graded(df: DataFrame, code: str, n: Column, *levels: tuple[str, Column]) -> DataFrame:
    """A finding of the one-row ``df`` with the first severity whose test holds; none if no test does."""
    level = F.lit(None).cast("string")
    for severity, test in reversed(levels):
        level = F.when(F.coalesce(test, F.lit(False)), severity).otherwise(level)
    return df.select(F.lit(code).alias("code"), level.alias("severity"), n.cast("long").alias("n")).where("severity IS NOT NULL")


def count_findings(source: DataFrame, result: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Verses of the source that the result lacks, and the other way round. Source rows without text make no verse, but excuse one."""
    c = F.col
    mapped = source.where(c("verse_id").isNotNull())
    compared = verify.compare_keys(mapped.where(c("text") != ""), result, "verse_id")
    blank = mapped.where(F.coalesce("text", F.lit("")) == "").select(c("verse_id").alias("key")).distinct()
    counts = verify.key_counts(compared.where("in_source").unionByName(compared.where("NOT in_source").join(blank, "key", "left_anti")), known)
    expected = F.greatest(c("matched") + c("missing") + c("missing_known"), F.lit(1))
    out = _graded(counts, "missing_in_db", c("missing"), ("error", (c("missing") >= _T["missing_least"]) | (c("missing") / expected > _T["missing_ratio"])), ("warn", c("missing") > 0))
    out = out.unionByName(_graded(counts, "missing_known_omission", c("missing_known"), ("warn", c("missing_known") > 0)))
    out = out.unionByName(_graded(counts, "extra_in_db", c("extra"), ("error", c("extra") > 0)))
    return out.unionByName(_graded(source.agg(F.count("*").alias("n")), "source_empty", F.lit(1), ("error", c("n") == 0)))


def canon_findings(source: DataFrame, result: DataFrame, canon: DataFrame, known: DataFrame | None = None, linked: DataFrame | None = None, versification: str = "KJV") -> DataFrame:
    """Verses outside the canon, lost books, additions, folds, holes in the books that are there."""
    from .convert import gate

    c = F.col
    inside = result.join(canon, (keys.book_of(c("verse_id")) == c("book")) & (keys.chapter_of(c("verse_id")) == c("chapter")) & keys.verse_of(c("verse_id")).between(1, c("max_verse")), "left_anti")
    out = _counted(inside, "canon_violation", "error")
    books = lambda d: d.where("verse_id IS NOT NULL").select(keys.book_of(c("verse_id")).alias("b")).distinct()
    out = out.unionByName(_counted(books(source).join(canon.select(c("book").alias("b")), "b", "left_semi").join(books(result), "b", "left_anti"), "canonical_book_lost", "error"))
    if "reason" in source.columns:
        out = out.unionByName(_counted(source.where("reason = 'addition'"), "addition_dropped", "info"))
        folds = source.where("reason = 'fold'").groupBy("verse_id").agg(F.count("*").alias("k"))
        sums = folds.agg(F.count_if(c("k") >= 3).alias("big"), F.coalesce(F.sum("k"), F.lit(0)).alias("all"))
        out = out.unionByName(_graded(sums, "canon_fold", c("big"), ("warn", c("big") > 0)))
        out = out.unionByName(_graded(sums, "fold", c("all"), ("info", (c("big") == 0) & (c("all") > 0))))
    try:
        gate(versification)
    except ValueError:
        out = out.unionByName(result.sparkSession.createDataFrame([("versification_unmapped", "warn", 1)], "code string, severity string, n long"))
    but = [d.select(c("key").cast("long").alias("key")) for d in (known, linked) if d is not None]
    excused = but[0].unionByName(but[-1]).distinct() if but else None
    partial = verify.presence(result, canon).agg(F.count_if("partial").alias("partial"))
    both = verify.holes(result, canon, but=excused).agg(F.count("*").alias("n")).join(F.broadcast(partial))
    return out.unionByName(_graded(both, "holes", c("n"), ("info", (c("n") > 0) & ((c("partial") > 0) | (c("n") > 200))), ("warn", c("n") > 0)))


def fidelity_findings(source: DataFrame, result: DataFrame) -> DataFrame:
    """Texts that differ from the source's, and the totals of words."""
    c, graded = F.col, verify.fidelity_summary(verify.text_fidelity(source, result, "verse_id"))
    share, delta = c("material_ratio"), F.abs("word_delta")
    out = _graded(graded, "text_differs", F.round(share * c("n")), ("error", share > _T["differs_fail"]), ("warn", share > _T["differs_warn"]), ("info", share > 0))
    return out.unionByName(_graded(graded, "word_count_delta", c("n"), ("error", delta > _T["words_fail"]), ("warn", delta > _T["words_warn"])))


def red_letter_findings(source: DataFrame, result: DataFrame) -> DataFrame:
    """Words of Christ that only one side marks, and marks in books that have none."""
    c, red = F.col, verify.red_letters(source, result, "verse_id", "red")
    some = c("both") + c("source_only") + c("result_only") > 0
    lost = (c("both") + c("result_only") == 0) & (c("source_only") > 0)
    out = _graded(red, "red_letter_lost", c("source_only"), ("error", lost))
    out = out.unionByName(_graded(red, "red_letter_mismatch", c("source_only") + c("result_only"), ("error", some & ~lost & (c("agreement") < _T["red_fail"])), ("warn", some & ~lost & (c("agreement") < _T["red_warn"]))))
    outside = result.where(c("red") & ~keys.book_of(c("verse_id")).isin(*verify.RED_LETTER_BOOKS)).select("verse_id").distinct()
    theirs = source.where("red").select("verse_id", F.lit(True).alias("was")).distinct()
    sums = outside.join(theirs, "verse_id", "left").agg(F.count("*").alias("n"), F.count_if(c("was").isNull()).alias("added"))
    return out.unionByName(_graded(sums, "red_letter_unexpected_books", c("n"), ("warn", c("added") > 0), ("info", c("n") > 0)))


def hygiene_findings(source: DataFrame, result: DataFrame, headings: DataFrame | None = None) -> DataFrame:
    """Patterns in texts and headings: introduced ones by their own severity, inherited ones as warnings; what is only informative gives none."""
    c, marks = F.col, verify.hygiene(result, source, "verse_id")
    if headings is not None:
        from ..functions.text import hygiene_codes

        titled = headings.select(F.explode(hygiene_codes(c("heading"))).alias("code")).groupBy("code").agg(F.count("*").alias("titles"))
        marks = marks.drop("severity").join(titled, "code", "full_outer").na.fill(0, ["introduced", "inherited", "titles"]).withColumn("severity", verify.pattern_severity(c("code")))
    else:
        marks = marks.withColumn("titles", F.lit(0))
    ours = c("introduced") + c("titles") > 0
    named = F.concat(F.lit("text_"), "code", F.when(ours, "").otherwise("_inherited"))
    level = F.when(ours & (c("severity") == "error"), "error").otherwise("warn")
    return marks.where("severity <> 'info'").select(named.alias("code"), level.alias("severity"), (c("introduced") + c("inherited") + c("titles")).cast("long").alias("n"))


def verse_findings(result: DataFrame) -> DataFrame:
    """Verse numbers in the text, empty verses, equal neighbours."""
    c = F.col
    out = _counted(verify.number_in_text(result, "verse_id"), "verse_number_in_text", "warn", 21)
    out = out.unionByName(_counted(result.where(F.btrim("text") == ""), "empty_verse", "error"))
    return out.unionByName(_counted(equal_neighbours(result, "verse_id", "text"), "duplicate_adjacent", F.when(c("n") >= 20, "error").otherwise("warn")))


def alignment_findings(result: DataFrame, reference: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """Lengths against a reference edition: correlation, shifted chapters, overlong verses, another numbering."""
    c, aligned = F.col, verify.length_alignment(result, reference, "verse_id")
    middle = quantile(aligned, [], F.round("v1", 12), 0.5, "r")
    out = _graded(middle, "versification_alignment", F.lit(1), ("warn", F.round("r", 3) < 0.5))
    out = out.unionByName(_counted(aligned.where("shifted"), "versification_shift", "warn"))
    out = out.unionByName(_counted(verify.overlong(result, reference, "verse_id"), "overlong_verses", "warn"))
    if moved is not None:
        out = out.unionByName(_graded(verify.remapped_alignment(result, reference, moved, "verse_id"), "versification_looks_mt", c("better"), ("warn", c("suspect"))))
    return out


def formatting_findings(result: DataFrame, canon: DataFrame) -> DataFrame:
    """Formatting documents that break their rules, and word counts that are not those of the text."""
    c = F.col
    sums = verify.formatting_problems(result, canon).agg(F.coalesce(F.sum("problems"), F.lit(0)).alias("n"))
    out = _graded(sums, "formatting_invalid", c("n"), ("error", c("n") > 0))
    if "word_count" not in result.columns:
        return out
    return out.unionByName(_counted(result.where(c("word_count") != verify.tokens(c("text"))), "word_count_column", "error"))


#: Needles of licence terms (fixed values): a text that names one while the identifier does not is a conflict.
LICENCE_TERMS = [r"\bNC\b|BY-NC|NON-?COMMERCIAL", r"\bND\b|-ND\b|NO ?DERIV"]
METADATA_MARKUP = r"\\(par|pard|qc|u[0-9]+)|<[a-zA-Z/][^>]*>"
#: Converter warnings that mean lost text (fixed values).
DROPPED_TEXT = ("not in the cache", "had no host verse", "NOT imported")


def metadata_findings(info: DataFrame, result: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """(module, code, severity): modules' own rows against their verses, themselves and the catalogue's row.

    ``info`` has one row a module, ``result`` (module, verse_id, text), ``catalog`` (module, app_language_code,
    right_to_left). Nulls count as empty; the digest is that of a module's verse lines in key order.
    """
    from .sequence import content_hash

    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    line = F.concat(F.concat_ws("\t", F.col("verse_id").cast("string"), F.coalesce("text", F.lit(""))), F.lit("\n"))
    digests = content_hash(result, "module", ["verse_id"], line).withColumnRenamed("content_sha256", "_digest")
    rows = info.join(digests, "module", "left")
    spdx, blurb = F.upper(text("license_spdx")), F.upper(F.concat(text("copyright"), F.lit(" "), text("description")))
    conflict = F.lit(False)
    for needle in LICENCE_TERMS:
        conflict = conflict | (blurb.rlike(needle) & ~spdx.rlike(needle) & ~spdx.contains("NONCOMMERCIAL"))
    rules = [("content_sha256", "error", text("content_sha256") != F.coalesce("_digest", F.sha2(F.lit(""), 256))), ("license_unknown", "warn", text("license_spdx") == ""), ("license_conflict", "warn", conflict)]
    rules += [(f"metadata_{field}_markup", "warn", text(field).rlike(METADATA_MARKUP)) for field in ("full_name", "copyright", "description")]
    if catalog is not None:
        theirs = catalog.select("module", F.btrim(F.coalesce("app_language_code", F.lit(""))).alias("_language"), (F.btrim(F.coalesce("right_to_left", F.lit("0"))) == "1").alias("_rtl"))
        rows = rows.join(theirs, "module", "left")
        rules.append(("language_code", "info", (F.col("_language") != "") & (text("language_code") != "") & (F.col("_language") != text("language_code"))))
        rules.append(("right_to_left", "warn", F.col("_rtl") != F.coalesce(F.col("right_to_left").cast("boolean"), F.lit(False))))
    each = F.array(*[F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, severity, test in rules])
    return rows.select("module", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("f")).select("module", "f.*")


def script_findings(result: DataFrame, language: str) -> DataFrame:
    """Texts whose most frequent script is not the language's; unknown languages and texts without letters give none."""
    from .stats import expected_script, scripts

    wanted = expected_script(language)
    return scripts(result, "text", 1).where(F.lit(wanted).isNotNull() & (F.col("script") != wanted)).select(F.lit("script_mismatch").alias("code"), F.lit("warn").alias("severity"), "n")


def lost_findings(source: DataFrame, result: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Headings and word numbers that the source (raw) has often and the result (formatting) nowhere."""
    raw, heading = F.col("raw"), F.coalesce(F.get_json_object("formatting", "$.block.heading"), F.lit(""))
    sums = source.agg(F.count_if(raw.contains("<title")).alias("titles"), F.count_if(raw.contains("strong:")).alias("strongs"))
    sums = sums.join(F.broadcast(result.agg(F.count_if(heading != "").alias("headings"))))
    sums = sums.join(F.broadcast(words.agg(F.count("*").alias("words")))) if words is not None else sums.withColumn("words", F.lit(0))
    c = F.col
    return verify.findings(sums, [("headings_lost", "warn", (c("titles") > 50) & (c("headings") == 0), c("titles")), ("strongs_lost", "warn", (c("strongs") > 1000) & (c("words") == 0), c("strongs"))])


def conversion_findings(log: DataFrame, validation: DataFrame | None = None, line: str = "value") -> DataFrame:
    """One error for each warning of the converter (text lines) that means lost text, and one if the validator (code, severity) found an error."""
    lost = F.lit(False)
    for part in DROPPED_TEXT:
        lost = lost | F.col(line).contains(part)
    out = log.where(F.lower(line).contains("warn") & lost).select(F.lit("converter_dropped_text").alias("code"), F.lit("error").alias("severity"), F.lit(1).cast("long").alias("n"))
    return out if validation is None else out.unionByName(_counted(validation.where("severity = 'error'"), "validate_module", "error"))


#: Verses that every review looks at (fixed values).
KEY_VERSES = [
    "Gen 1:1", "Gen 2:4", "Gen 31:55", "Exod 20:2", "Ps 3:1", "Ps 23:1", "Ps 51:1", "Isa 9:6", "Dan 3:30", "Esth 10:3", "Joel 2:28", "Mal 4:5", "Matt 5:3", "Matt 17:21",
    "Mark 16:9", "Luke 2:14", "John 1:1", "John 3:16", "John 8:1", "John 11:35", "Acts 8:37", "Rom 8:28", "1 Cor 11:24", "1 John 5:7", "3 John 1:14", "Rev 12:17", "Rev 13:1", "Rev 22:21",
]


def review_samples(source: DataFrame, result: DataFrame, worst: dict[str, tuple[DataFrame, int]] | None = None, random: int = 12, seed: int = 1) -> DataFrame:
    """(why, verse_id, source_text, text): key verses on either side, a seeded sample of the result, and the first rows (verse_id) of each ``worst`` list.

    A report of a bounded number of rows; texts are clipped to 600 characters.
    """
    from ..functions.refs import Books, parse_reference
    from ..functions.text import clip
    from .stats import seeded_sample

    books = Books()
    wanted = [parse_reference(r, books)[0] for r in KEY_VERSES]
    ids = source.select("verse_id").unionByName(result.select("verse_id")).where(F.col("verse_id").isin(wanted)).distinct().select(F.lit("key verse").alias("why"), "verse_id")
    ids = ids.unionByName(seeded_sample(result.select("verse_id").distinct(), "verse_id", random, seed).select(F.lit("random").alias("why"), "verse_id"))
    for why, (rows, most) in (worst or {}).items():
        ids = ids.unionByName(rows.limit(most).select(F.lit(why).alias("why"), "verse_id"))
    theirs = source.select("verse_id", clip(F.col("text"), 600).alias("source_text"))
    return ids.join(theirs, "verse_id", "left").join(result.select("verse_id", clip(F.col("text"), 600).alias("text")), "verse_id", "left").select("why", "verse_id", "source_text", "text")


def bible_findings(source: DataFrame, result: DataFrame, canon: DataFrame, reference: DataFrame | None = None, known: DataFrame | None = None, moved: DataFrame | None = None, linked: DataFrame | None = None, versification: str = "KJV") -> DataFrame:
    """(code, severity, n) over source (verse_id, text, red, reason), result (verse_id, text, red, formatting, word_count) and a reference edition.

    ``known`` holds keys that editions often lack, ``linked`` keys that repeat
    another entry, ``moved`` (key, to) another numbering to try. Columns that
    are absent skip their section.
    """
    kept = source.where((F.col("text") != "") & F.col("verse_id").isNotNull())
    out = [count_findings(source, result, known), canon_findings(source, result, canon, known, linked, versification), fidelity_findings(kept, result)]
    headings = None
    if "formatting" in result.columns:
        out.append(formatting_findings(result, canon))
        headings = result.select(F.get_json_object("formatting", "$.block.heading").alias("heading")).where("heading <> ''")
    if "red" in source.columns and "red" in result.columns:
        out.append(red_letter_findings(kept, result))
    out += [hygiene_findings(kept, result, headings), verse_findings(result)]
    if reference is not None:
        out.append(alignment_findings(result, reference, moved))
    whole = out[0]
    for f in out[1:]:
        whole = whole.unionByName(f)
    return whole


def strongs_findings(result_words: DataFrame, reference_words: DataFrame, key: str = "verse_id", number: str = "strongs_number", shifted: DataFrame | None = None) -> DataFrame:
    """(code, severity, n): word numbers that agree better with a neighbouring verse of the reference than with their own.

    In chapters that the lengths find ``shifted`` (grp) the text is misplaced;
    elsewhere only the tags are. Verses with fewer than three numbers outside
    the reference's 40 most frequent are not judged.
    """
    c = F.col
    near = strongs_overlap(result_words, reference_words, key, number)
    judged = near.where("here IS NOT NULL")
    moved = judged.where((c("there") - c("here") >= 0.25) & (c("here") < 0.35)).withColumn("grp", keys.chapter_key(c(key)))
    off = moved.join(shifted.select("grp", F.lit(True).alias("bad")), "grp", "left") if shifted is not None else moved.withColumn("bad", F.lit(None).cast("boolean"))
    sums = off.agg(F.count_if(c("bad").isNotNull()).alias("text"), F.count_if(c("bad").isNull()).alias("tags")).join(F.broadcast(judged.agg(F.count("*").alias("n"))))
    out = _graded(sums, "strongs_misplaced", c("text"), ("error", c("text") > F.greatest(F.lit(10.0), 0.002 * c("n"))), ("warn", c("text") > 0))
    return out.unionByName(_graded(sums, "strongs_tags_offset", c("tags"), ("warn", c("tags") > 0)))


def strongs_verdicts(near: DataFrame) -> DataFrame:
    """The judged verses of ``strongs_overlap`` with ``verdict``: misplaced (a neighbour fits better), disjoint (nothing in common), or null."""
    here, there = F.col("here"), F.coalesce("there", F.lit(0.0))
    moved = (there - here >= 0.25) & (here < 0.35)
    return near.where("here IS NOT NULL").withColumn("verdict", F.when(moved, "misplaced").when(here == 0, "disjoint"))


def strongs_counts(near: DataFrame) -> DataFrame:
    """(compared, median_overlap, misplaced, no_overlap): one row about all judged verses, for the report beside the findings."""
    judged = strongs_verdicts(near)
    counts = judged.agg(F.count("*").alias("compared"), F.count_if(F.col("verdict") == "misplaced").alias("misplaced"), F.count_if(F.col("verdict") == "disjoint").alias("no_overlap"))
    return counts.join(F.broadcast(quantile(judged, [], F.col("here"), 0.5, "median_overlap")), F.lit(True), "left")


def alignment_counts(result: DataFrame, reference: DataFrame) -> DataFrame:
    """(chapters, median_correlation, low_correlation, shifted, overlong): one row about lengths against the reference."""
    aligned = verify.length_alignment(result, reference, "verse_id")
    counts = aligned.agg(F.count("v1").alias("chapters"), F.count_if(F.col("v1") < 0.3).alias("low_correlation"), F.count_if("shifted").alias("shifted"))
    middle = quantile(aligned, [], F.round("v1", 12), 0.5, "median_correlation")
    long = verify.overlong(result, reference, "verse_id").agg(F.count("*").alias("overlong"))
    return counts.join(F.broadcast(middle), F.lit(True), "left").join(F.broadcast(long), F.lit(True))


def strongs_overlap(result_words: DataFrame, reference_words: DataFrame, key: str = "verse_id", number: str = "strongs_number") -> DataFrame:
    """(key, here, there): overlap with the reference's verse of that key, and the best with a neighbour of its chapter."""
    from ..functions.text import plain_strongs
    from .stats import item_sets, most_frequent, neighbour_overlap

    own = result_words.select(key, plain_strongs(F.col(number)).alias("item"))
    other = reference_words.select(key, plain_strongs(F.col(number)).alias("item"))
    sets = item_sets(other, key, "item")
    often = most_frequent(sets.select(F.explode("items").alias("item")), "item", 40)
    near = neighbour_overlap(item_sets(own, key, "item"), sets, key, often, least=3)
    return near.groupBy(key).agg(F.max(F.when(F.col("offset") == 0, F.col("overlap"))).alias("here"), F.max(F.when(F.col("offset") != 0, F.col("overlap"))).alias("there"))


def module_status(findings: DataFrame) -> DataFrame:
    """One row: the fold of all severities."""
    return findings.agg(status(F.col("severity")).alias("status"), F.count("*").alias("findings"))


def totals(modules: DataFrame, findings: DataFrame) -> DataFrame:
    """(modules, passed, failed) over (module) and (module, severity): a module with an error has failed."""
    bad = findings.where("severity = 'error'").select("module").distinct().withColumn("_bad", F.lit(True))
    marked = modules.select("module").distinct().join(bad, "module", "left")
    return marked.agg(F.count("*").alias("modules"), F.count_if(F.col("_bad").isNull()).alias("passed"), F.count("_bad").alias("failed"))


def validate_all(modules: dict[str, dict[str, DataFrame]], canon: DataFrame | None = None) -> DataFrame:
    """(module, code, severity, n, example) over many modules in the order of their names."""
    out = None
    for name, tables in sorted(modules.items()):
        one = validate.report(tables, canon, name).select(F.lit(name).alias("module"), "code", "severity", "n", "example")
        out = one if out is None else out.unionByName(one)
    return out


def markdown(title: str, rows: list, stats: dict | None = None) -> str:
    """A report as text, errors first."""
    order = {"error": 0, "warn": 1, "info": 2}
    lines = [f"# {title}", ""] + [f"* {k}: {v}" for k, v in (stats or {}).items()] + ([""] if stats else [])
    lines += ["| severity | code | n |", "| --- | --- | --- |"]
    lines += [f"| {r['severity']} | {r['code']} | {r['n']} |" for r in sorted(rows, key=lambda r: (order.get(r["severity"], 3), r["code"]))]
    return "\n".join(lines)
