"""A converted module against its source and a reference edition.

Inputs are ``source`` (target, text, red, i), ``result`` (verse_id, text,
formatting, word_count) and ``reference`` (verse_id, text). Findings are rows
(code, severity, n, detail); their fold is the module's status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.text import HYGIENE, count_lettered_words, hygiene_codes, normal_text, similarity, untagged
from .sequence import equal_neighbours
from .stats import pearson, quantile, shift_correlations

#: Judgement thresholds (fixed values).
THRESHOLDS = {
    "missing_ratio": 0.002, "missing_least": 3, "differs_warn": 0.01, "differs_fail": 0.05, "similar": 0.90, "words_warn": 0.01, "words_fail": 0.03,
    "red_warn": 0.97, "red_fail": 0.85, "overlong_factor": 3.0, "overlong_least": 80, "shift_gain": 0.30, "shift_most_r0": 0.60, "shift_least_best": 0.70,
}
#: Bytes of texts that an Arrow function holds at a time.
BATCH_BYTES = 4 << 20


def compare_keys(source: DataFrame, result: DataFrame, key: str, other: str | None = None) -> DataFrame:
    """(key, in_source, in_result): one full outer join of the two key sets."""
    a = source.select(F.col(key).alias("key")).distinct().withColumn("a", F.lit(True))
    b = result.select(F.col(other or key).alias("key")).distinct().withColumn("b", F.lit(True))
    return a.join(b, "key", "full_outer").select("key", F.coalesce("a", F.lit(False)).alias("in_source"), F.coalesce("b", F.lit(False)).alias("in_result"))


def key_counts(compared: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(matched, missing, missing_known, extra); ``known`` has keys that editions often lack."""
    if known is not None:
        compared = compared.join(known.select("key", F.lit(True).alias("known")), "key", "left")
    else:
        compared = compared.withColumn("known", F.lit(None).cast("boolean"))
    lost = F.col("in_source") & ~F.col("in_result")
    ok = F.coalesce(F.col("known"), F.lit(False))
    return compared.agg(
        F.count_if(F.col("in_source") & F.col("in_result")).alias("matched"), F.count_if(lost & ~ok).alias("missing"),
        F.count_if(lost & ok).alias("missing_known"), F.count_if(~F.col("in_source") & F.col("in_result")).alias("extra"),
    )


def presence(result: DataFrame, canon: DataFrame, key: str = "verse_id") -> DataFrame:
    """(book, expected, present, partial): books with under 90 % of the canon's verses are partial."""
    expected = canon.groupBy("book").agg(F.sum("max_verse").alias("expected"))
    inside = result.select(F.col(key).alias("k")).distinct().select(keys.book_of(F.col("k")).alias("book"), keys.chapter_of(F.col("k")).alias("chapter"), keys.verse_of(F.col("k")).alias("verse"))
    real = inside.join(canon, ["book", "chapter"]).where("verse BETWEEN 1 AND max_verse")
    n = real.groupBy("book").agg(F.count("*").alias("present"))
    both = expected.join(n, "book", "left").withColumn("present", F.coalesce("present", F.lit(0)))
    return both.withColumn("partial", (F.col("present") > 0) & (F.col("present") < 0.9 * F.col("expected")))


def holes(result: DataFrame, canon: DataFrame, key: str = "verse_id", but: DataFrame | None = None) -> DataFrame:
    """Canon verses that the module lacks in books that it has, but for the keys of ``but``."""
    all_keys = canon.withColumn("verse", F.explode(F.sequence(F.lit(1).cast("long"), F.col("max_verse").cast("long")))).select(keys.pack(F.col("book"), F.col("chapter"), F.col("verse")).alias(key))
    books = result.select(keys.book_of(F.col(key)).alias("_b")).distinct()
    out = all_keys.join(result.select(key), key, "left_anti").join(books, keys.book_of(F.col(key)) == F.col("_b"), "left_semi")
    return out if but is None else out.join(but.select(F.col("key").alias(key)), key, "left_anti")


def _short_batches(df: DataFrame) -> None:
    """Bound what an Arrow function of texts holds at a time by bytes, whatever the rows' length."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_fidelity(source: DataFrame, result: DataFrame, key: str, text: str = "text", similar: float = THRESHOLDS["similar"]) -> DataFrame:
    """(key, grade, similarity, source_words, result_words); grades: exact, minor, material.

    Only rows whose normalised texts differ are compared letter by letter.
    """
    _short_batches(source)
    a = source.select(key, F.col(text).alias("a"))
    b = result.select(key, F.col(text).alias("b"))
    both = a.join(b, key).withColumns({"na": normal_text(F.col("a")), "nb": normal_text(F.col("b"))})
    scored = both.withColumn("similarity", similarity(F.col("na"), F.col("nb")))
    grade = F.when(F.col("na") == F.col("nb"), "exact").when(F.col("similarity") >= similar, "minor").otherwise("material")
    return scored.select(key, grade.alias("grade"), "similarity", count_lettered_words(F.col("a")).alias("source_words"), count_lettered_words(F.col("b")).alias("result_words"))


def fidelity_summary(graded: DataFrame) -> DataFrame:
    total = F.count("*")
    words = F.sum("source_words")
    return graded.agg(
        total.alias("n"), (F.count_if(F.col("grade") == "exact") / F.nullif(total, F.lit(0))).alias("exact_ratio"),
        (F.count_if(F.col("grade") == "material") / F.nullif(total, F.lit(0))).alias("material_ratio"),
        ((F.sum("result_words") - words) / F.nullif(words, F.lit(0))).alias("word_delta"),
    )


def red_letters(source: DataFrame, result: DataFrame, key: str, flag: str) -> DataFrame:
    """(both, source_only, result_only, agreement) of flagged keys; agreement is the overlap of the sets."""
    a = source.where(F.col(flag)).select(key).distinct().withColumn("a", F.lit(1))
    b = result.where(F.col(flag)).select(key).distinct().withColumn("b", F.lit(1))
    both, left, right = (F.count_if(c) for c in (F.col("a").isNotNull() & F.col("b").isNotNull(), F.col("b").isNull(), F.col("a").isNull()))
    out = a.join(b, key, "full_outer").agg(both.alias("both"), left.alias("source_only"), right.alias("result_only"))
    return out.withColumn("agreement", F.col("both") / F.nullif(F.col("both") + F.col("source_only") + F.col("result_only"), F.lit(0)))


def pattern_severity(code: Column) -> Column:
    return F.create_map(*[F.lit(x) for c, s, _ in HYGIENE for x in (c, s)])[code]


def hygiene(result: DataFrame, source: DataFrame, key: str, text: str = "text", raw: str = "raw") -> DataFrame:
    """(code, severity, introduced, inherited): texts that hold what clean text must not, by whether the source's did.

    The source's text counts, and, where it has a column of that name, its raw
    markup without tags and entities: what is escaped shows in the raw only.
    """
    _short_batches(source)
    codes = lambda d, x: d.select(F.col(key).alias("k"), F.explode(hygiene_codes(x)).alias("code"))
    was = F.concat(F.coalesce(text, F.lit("")), F.lit(" \u2063 "), F.coalesce(untagged(F.col(raw)), F.lit(""))) if raw in source.columns else F.col(text)
    ours, theirs = codes(result, F.col(text)), codes(source, was).withColumn("was", F.lit(True)).distinct()
    marked = ours.join(theirs, ["k", "code"], "left")
    return marked.groupBy("code").agg(F.count_if(F.col("was").isNull()).alias("introduced"), F.count_if(F.col("was").isNotNull()).alias("inherited")).withColumn("severity", pattern_severity(F.col("code")))


def number_in_text(result: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Rows whose text begins with their own verse number and a space, a full stop or a colon."""
    return result.where(F.regexp_extract(F.col(text), r"^\(?(\d+)\)?[\s.:]", 1) == keys.verse_of(F.col(key)).cast("string"))


def visible(text: Column) -> Column:
    """Characters but for blanks: scripts without spaces compare as well."""
    return F.length(F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit("")))


def sizes(verses: DataFrame, key: str, text: str = "text", headings: bool = False) -> DataFrame:
    """(key, size); with ``headings``, those of the formatting document count as text."""
    size = visible(F.col(text))
    if headings and "formatting" in verses.columns:
        size = size + visible(F.get_json_object("formatting", "$.block.heading"))
    return verses.select(key, size.alias("size"))


def length_alignment(result: DataFrame, reference: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(grp, v0, v1, v2, best, shifted): lengths against the reference by chapter, in place and one verse off."""
    out = shift_correlations(sizes(result, key, text), sizes(reference, key, text, headings=True), key, "size", keys.chapter_key(F.col(key)))
    t = THRESHOLDS
    return out.withColumn("shifted", (F.col("best") - F.col("v1") > t["shift_gain"]) & (F.col("v1") < t["shift_most_r0"]) & (F.col("best") >= t["shift_least_best"]))


def overlong(result: DataFrame, reference: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, size, expected): texts far longer than the reference's, scaled by the median ratio."""
    both = sizes(result, key, text).join(sizes(reference, key, text, headings=True).select(key, F.col("size").alias("other")), key).where("other > 0")
    scale = quantile(both, [], F.col("size") / F.col("other"), 0.5, "scale")
    t = THRESHOLDS
    scaled = both.join(F.broadcast(scale)).withColumn("expected", F.col("other") * F.col("scale"))
    return scaled.where((F.col("size") > t["overlong_factor"] * F.col("expected")) & (F.col("size") - F.col("expected") > t["overlong_least"])).select(key, "size", "expected")


def remapped_alignment(result: DataFrame, reference: DataFrame, moved: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(better, worse, suspect): chapters whose correlation gains or loses 0.3 when keys are read through ``moved`` (key, to).

    Only chapters that a moved key leaves or enters are looked at, over the
    reference's keys; lengths that meet on one key add up, absent ones are 0.
    """
    a = sizes(result, key, text)
    map_ = moved.select(F.col("key").alias(key), "to")
    renamed = a.join(map_, key, "left").groupBy(F.coalesce("to", key).alias(key)).agg(F.sum("size").alias("read"))
    crossed = a.join(map_.where(F.col("to") != F.col(key)), key).select(F.explode(F.array(keys.chapter_key(F.col(key)), keys.chapter_key(F.col("to")))).alias("grp")).distinct()
    b = sizes(reference, key, text, headings=True).select(key, F.col("size").alias("other"), keys.chapter_key(F.col(key)).alias("grp")).join(crossed, "grp", "left_semi")
    rows = b.join(a, key, "left").join(renamed, key, "left").na.fill(0, ["size", "read"])
    per = rows.groupBy("grp").agg(F.count("*").alias("n"), pearson(F.col("size"), F.col("other")).alias("r0"), pearson(F.col("read"), F.col("other")).alias("r1")).where("n >= 4")
    gain = F.col("r1") - F.col("r0")
    out = per.agg(F.count_if(gain > 0.3).alias("better"), F.count_if(gain < -0.3).alias("worse"))
    return out.withColumn("suspect", (F.col("better") >= 3) & (F.col("better") > 3 * F.col("worse")))


#: Span types and block fields of a module's formatting document (fixed values).
SPAN_TYPES = ("divine_name", "supplied", "words_of_christ", "emphasis", "quotation", "transliteration")
BLOCK_KEYS = ("paragraph_start", "poetry_level", "heading", "heading_kind", "selah")
TOP_KEYS = ("v", "block", "spans", "source_verses")
#: Books in which words of Christ are expected (fixed values).
RED_LETTER_BOOKS = (40, 41, 42, 43, 44, 46, 47, 66)


def tokens(text: Column) -> Column:
    """Pieces between single blanks; none in an empty text."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1)


def formatting_problems(result: DataFrame, canon: DataFrame, key: str = "verse_id") -> DataFrame:
    """(key, problems) of rows whose formatting document breaks its rules: keys, version, block fields, poetry level, spans."""
    f = F.col("formatting")
    rows = result.where(F.coalesce(f, F.lit("")) != "").select(key, f, tokens(F.col("text")).alias("tokens"))
    names = lambda x: F.array(*map(F.lit, x))
    top, block = F.json_object_keys(f), F.json_object_keys(F.get_json_object(f, "$.block"))
    level = F.get_json_object(f, "$.block.poetry_level")
    version = F.coalesce(F.get_json_object(f, "$.v"), F.lit(""))
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    of_row = F.when(F.try_parse_json(f).isNull() | top.isNull(), 1).otherwise(
        one((F.size(F.array_except(top, names(TOP_KEYS))) > 0) | (version != "1"))
        + F.greatest(F.coalesce(F.size(F.array_except(block, names(BLOCK_KEYS))), F.lit(0)), F.lit(0))
        + one(level.isNotNull() & ~level.isin("1", "2", "3"))
    )
    spans = rows.select(key, "tokens", F.explode(F.from_json(F.get_json_object(f, "$.spans"), "array<map<string,string>>")).alias("s"))
    s = F.col("s")
    whole = lambda c: F.when(c.rlike(r"^-?[0-9]{1,9}$"), c.try_cast("int"))
    a, b, ref = whole(s["start"]), whole(s["end"]), s["ref"].try_cast("long")
    spans = spans.select(
        key,
        (1 - one(s["type"].isin(*SPAN_TYPES)) + 1 - one((a >= 0) & (a <= b) & (b < F.greatest("tokens", F.lit(1))))).alias("n"),
        F.when((s["type"] == "quotation") & (F.coalesce(s["ref"], F.lit("")) != ""), F.coalesce(ref, F.lit(-1))).alias("ref"),
    )
    real = canon.select(F.col("book").alias("c_book"), F.col("chapter").alias("c_chapter"), F.col("max_verse").alias("c_most"))
    held = spans.join(real, (keys.book_of(F.col("ref")) == F.col("c_book")) & (keys.chapter_of(F.col("ref")) == F.col("c_chapter")) & keys.verse_of(F.col("ref")).between(1, F.col("c_most")), "left")
    of_spans = held.select(key, (F.col("n") + one(F.col("ref").isNotNull() & F.col("c_book").isNull())).alias("n"))
    return rows.select(key, of_row.alias("n")).unionByName(of_spans).groupBy(key).agg(F.sum("n").alias("problems")).where("problems > 0")


def duplicates(result: DataFrame, key: str, text: str = "text") -> DataFrame:
    return equal_neighbours(result, key, text)


def findings(summary: DataFrame, rules: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """(code, severity, n) of the rules (code, severity, test, count) that hold on a one-row summary."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"), n.cast("long").alias("n"), F.coalesce(t, F.lit(False)).alias("hit")) for c, s, t, n in rules]))
    return summary.select(each.alias("f")).select("f.*").where("hit").drop("hit")


#: Patterns that only clean text must be free of: in other modules they are counted, not judged (fixed values).
MARKUP_CODES = ("html_tag", "entity", "angle_bracket", "whitespace", "backslash")


def generic_checks(source: DataFrame, result: DataFrame, text: str) -> DataFrame:
    """(code, severity, n) for any module type: no content column, empty, too few rows, too many, other word totals, bad patterns."""
    if text not in result.columns:
        return result.sparkSession.createDataFrame([("content_column", "error", 1)], "code string, severity string, n long")
    words = lambda d, n: d.agg(F.count("*").alias(f"{n}_rows"), F.coalesce(F.sum(count_lettered_words(F.col(text))), F.lit(0)).alias(f"{n}_words"), F.count_if(F.coalesce(F.btrim(text), F.lit("")) != "").alias(f"{n}_full"))
    one = words(source, "s").join(F.broadcast(words(result, "r")))
    c = F.col
    some = (c("r_rows") > 0) & (c("s_full") > 0)
    out = findings(
        one,
        [
            ("empty", "error", c("r_rows") == 0, F.lit(1)),
            ("row_count", "warn", some & (c("r_rows") < 0.8 * c("s_full")), c("r_rows")),
            ("entries_duplicated", "warn", some & (c("r_rows") > 1.5 * c("s_full")), c("r_rows")),
            ("word_count_delta", "warn", (c("r_rows") > 0) & (c("s_words") > 0) & (F.abs(c("r_words") - c("s_words")) > 0.1 * c("s_words")), c("r_words")),
        ],
    )
    hits = result.select(F.explode(hygiene_codes(F.col(text))).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    bad = hits.where(F.col("code").isin(*[k for k, severity, _ in HYGIENE if severity == "error"]))
    return out.unionByName(bad.select(F.concat(F.lit("text_"), "code").alias("code"), F.when(F.col("code").isin(*MARKUP_CODES), "info").otherwise("warn").alias("severity"), F.col("n").cast("long").alias("n")))
