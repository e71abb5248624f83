"""Bindings of the verifier's and validator's rules, and of text functions, to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import report, stats, validate, verify
from .keyed import LINE_KEY, TURN_KEY, lines, turns
from .registry import query, table

NORMAL = r"regexp_replace(lower(replace(nfc_normalize({}), 'ß', 'ss')), '[^\p{{L}}\p{{N}}\p{{M}}]', '', 'g')"
WORDS = r"len(list_filter(regexp_extract_all({}, '[^ \t\n\v\f\r]+'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]')))"


def _level(*levels: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for name, test in levels) + " END"


def _rows(*parts: tuple[str, str, str]) -> str:
    """(code, severity expression, n) rows of the one-row relation ``c`` with a severity."""
    return " UNION ALL ".join(f"SELECT '{code}' AS code, {level} AS severity, CAST({n} AS BIGINT) AS n FROM c WHERE {level} IS NOT NULL" for code, level, n in parts)


# Verifier ------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 3 THEN '' ELSE 'x' END AS t FROM orders WHERE o_orderkey % 9 <> 4), r AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 40 <> 7),
    c AS (SELECT (SELECT count(*) FROM s WHERE t <> '') AS expected, (SELECT count(*) FROM s WHERE t <> '' AND k NOT IN (SELECT k FROM r) AND k % 80 <> 7) AS lost,
    (SELECT count(*) FROM s WHERE t <> '' AND k NOT IN (SELECT k FROM r) AND k % 80 = 7) AS known, (SELECT count(*) FROM r WHERE k NOT IN (SELECT k FROM s)) AS extra) """
    + _rows(("missing_in_db", _level(("error", "lost >= 3 OR lost > 0.002 * expected"), ("warn", "lost > 0")), "lost"), ("missing_known_omission", _level(("warn", "known > 0")), "known"), ("extra_in_db", _level(("error", "extra > 0")), "extra"))
)
def q2_counts(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("verse_id"))
    k = F.col("verse_id")
    source = o.where(k % 9 != 4).withColumn("text", F.when(k % 50 == 3, "").otherwise("x"))
    return report.count_findings(source, o.where(k % 40 != 7), o.where(k % 80 == 7).select(k.alias("key")))


CANON_SQL = """canon AS (SELECT n_nationkey + 1 AS book, 60 AS most FROM nation WHERE n_nationkey < 20), r AS (SELECT DISTINCT c_nationkey + 1 AS book, c_custkey % 62 AS verse FROM customer WHERE c_nationkey <> 5),
    p AS (SELECT book, count(*) AS present FROM r JOIN canon USING (book) WHERE verse BETWEEN 1 AND 60 GROUP BY 1)"""


@query(
    f"""WITH {CANON_SQL}, h AS (SELECT book, unnest(range(1, 61)) AS verse FROM canon WHERE book IN (SELECT book FROM r)),
    f AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_custkey % 11 = 0 GROUP BY 1),
    c AS (SELECT (SELECT count(*) FROM r LEFT JOIN canon USING (book) WHERE most IS NULL OR verse NOT BETWEEN 1 AND 60) AS outside, (SELECT count(*) FROM canon WHERE book NOT IN (SELECT book FROM r)) AS lost,
    (SELECT count(*) FROM h WHERE (book, verse) NOT IN (SELECT (book, verse) FROM r) AND verse <> 13) AS holes, (SELECT count(*) FROM p WHERE present < 54) AS partial,
    (SELECT count(*) FROM customer WHERE c_custkey % 13 = 0 AND c_custkey % 11 <> 0) AS additions, (SELECT count(*) FROM f WHERE n >= 3) AS big, (SELECT coalesce(sum(n), 0) FROM f) AS folded) """
    + _rows(
        ("canon_violation", _level(("error", "outside > 0")), "outside"), ("canonical_book_lost", _level(("error", "lost > 0")), "lost"), ("addition_dropped", _level(("info", "additions > 0")), "additions"),
        ("canon_fold", _level(("warn", "big > 0")), "big"), ("fold", _level(("info", "big = 0 AND folded > 0")), "folded"), ("holes", _level(("info", "holes > 0 AND (partial > 0 OR holes > 200)"), ("warn", "holes > 0")), "holes"),
    )
)
def q3_canon(spark, d):
    canon = table(spark, d, "nation").where("n_nationkey < 20").select((F.col("n_nationkey") + 1).cast("long").alias("book"), F.lit(1).cast("long").alias("chapter"), F.lit(60).cast("long").alias("max_verse"))
    c = table(spark, d, "customer")
    result = c.where("c_nationkey <> 5").select(keys.pack(F.col("c_nationkey") + 1, F.lit(1), F.col("c_custkey") % 62).alias("verse_id")).distinct()
    fold, added = F.col("c_custkey") % 11 == 0, F.col("c_custkey") % 13 == 0
    source = c.select(F.when(fold | ~added, keys.pack(F.col("c_nationkey") + 1, F.lit(1), F.lit(60))).alias("verse_id"), F.lit("x").alias("text"), F.when(fold, "fold").when(added, "addition").alias("reason"))
    source = source.unionByName(canon.select(keys.pack(F.col("book"), F.lit(1), F.lit(1)).alias("verse_id"), F.lit("x").alias("text"), F.lit(None).cast("string").alias("reason")))
    known = canon.select(keys.pack(F.col("book"), F.lit(1), F.lit(13)).alias("key"))
    return report.canon_findings(source, result, canon, known)


PAIR_SQL = f"""t AS (SELECT {TURN_KEY} AS k, text AS a, CASE conv_id % 4 WHEN 0 THEN regexp_replace(text, '([.,])', ' \\1', 'g') WHEN 1 THEN substr(text, 1, CAST(length(text) - length(text) // 50 AS BIGINT)) WHEN 2 THEN substr(text, 1, length(text) // 2) ELSE '##' END AS b FROM conversations),
    n AS (SELECT k, a, b, {NORMAL.format("a")} AS na, {NORMAL.format("b")} AS nb FROM t)"""


@query(
    f"""WITH {PAIR_SQL} SELECT CASE WHEN na = nb THEN 'exact' WHEN 2.0 * length(nb) / (length(na) + length(nb)) >= 0.9 THEN 'minor' ELSE 'material' END AS grade, count(*) AS n FROM n GROUP BY 1"""
)
def q4_fidelity(spark, d):
    a, b = edited_turns(spark, d)
    return verify.text_fidelity(a, b, "verse_id").groupBy("grade").agg(F.count("*").alias("n"))


def edited_turns(spark, d):
    """Turns, and the same with blanks, with a short piece, half, or all of the text lost."""
    t = turns(spark, d).select(F.col("key").alias("verse_id"), "conv_id", "text")
    n, kind = F.length("text"), F.col("conv_id") % 4
    cut = lambda size: F.substring(F.col("text"), F.lit(1), size.cast("int"))
    other = F.when(kind == 0, F.regexp_replace("text", r"([.,])", " $1")).when(kind == 1, cut(n - F.floor(n / 50))).when(kind == 2, cut(F.floor(n / 2))).otherwise("##")
    return t.select("verse_id", "text"), t.select("verse_id", other.alias("text"))


@query(
    f"""WITH {PAIR_SQL}, g AS (SELECT CASE WHEN na = nb THEN 0 WHEN 2.0 * length(nb) / (length(na) + length(nb)) >= 0.9 THEN 0 ELSE 1 END AS bad, {WORDS.format("a")} AS wa, {WORDS.format("b")} AS wb FROM n),
    c AS (SELECT sum(bad) AS bad, sum(bad) / count(*) AS share, count(*) AS total, abs(sum(wb) - sum(wa)) / sum(wa) AS delta FROM g) """
    + _rows(("text_differs", _level(("error", "share > 0.05"), ("warn", "share > 0.01"), ("info", "share > 0")), "bad"), ("word_count_delta", _level(("error", "delta > 0.03"), ("warn", "delta > 0.01")), "total"))
)
def q4_findings(spark, d):
    return report.fidelity_findings(*edited_turns(spark, d))


@query(
    """WITH s AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 50000), r AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 90000 OR o_orderkey % 100 = 5),
    c AS (SELECT (SELECT count(*) FROM s WHERE k IN (SELECT k FROM r)) AS x, (SELECT count(*) FROM s WHERE k NOT IN (SELECT k FROM r)) AS y, (SELECT count(*) FROM r WHERE k NOT IN (SELECT k FROM s)) AS z, (SELECT count(*) FROM r) AS far) """
    + _rows(
        ("red_letter_lost", _level(("error", "x + z = 0 AND y > 0")), "y"), ("red_letter_mismatch", _level(("error", "x + z > 0 AND x / (x + y + z) < 0.85"), ("warn", "x + z > 0 AND x / (x + y + z) < 0.97")), "y + z"),
        ("red_letter_unexpected_books", _level(("warn", "z > 0"), ("info", "far > 0")), "far"),
    )
)
def q6_red_letters(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("verse_id"), "o_totalprice")
    return report.red_letter_findings(o.withColumn("red", F.col("o_totalprice") > 50000), o.withColumn("red", (F.col("o_totalprice") > 90000) | (F.col("verse_id") % 100 == 5)))


#: White space of all scripts, and the hygiene patterns, as the other engine spells them.
SPACES_SQL = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
HYGIENE_SQL = "p AS (SELECT unnest([" + ", ".join(f"('{c}', '{s}', '{p}')" for c, s, p in [
    ("html_tag", "error", rf"<[{SPACES_SQL}]*/?[{SPACES_SQL}]*[A-Za-z!][^<>]{{0,200}}>"), ("angle_bracket", "warn", "[<>]"), ("entity", "error", r"&(?:[A-Za-z]{2,8}|#\p{Nd}{2,7}|#[xX][0-9A-Fa-f]{2,6});"), ("pilcrow", "error", "\u00b6"), ("backslash", "error", r"\\"),
    ("usfm_attribute", "error", rf"\|[{SPACES_SQL}]*[a-z-]+[{SPACES_SQL}]*=[{SPACES_SQL}]*\""), ("strongs_tag", "error", rf"(?:^|[^\p{{L}}\p{{N}}_])(?:strong|lemma|morph|robinson|strongMorph):[^{SPACES_SQL}]"), ("strongs_number", "warn", r"(?:^|[^A-Za-z0-9])[GH]\p{Nd}{3,5}(?:[^0-9]|$)"),
    ("braces", "warn", "[{}]"), ("control_char", "error", r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}\x{80}-\x{9f}]"), ("replacement_char", "error", r"\x{fffd}"), ("mojibake", "error", r"\x{c3}[\x{80}-\x{bf}]|\x{e2}\x{20ac}|\x{c2}[\x{a0}-\x{bf}]|\x{d0}[\x{80}-\x{bf}]"),
    ("whitespace", "error", rf"^[{SPACES_SQL}]|[{SPACES_SQL}]$|[{SPACES_SQL}]{{2}}|[\t\n\r]"), ("odd_space", "warn", r"[\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"), ("zero_width", "info", r"[\x{200b}\x{2060}\x{feff}]"), ("private_use", "warn", r"[\x{e000}-\x{f8ff}]"), ("note_marker", "info", r"[*\x{2020}\x{2021}]"), ("double_bracket", "info", r"\[\[|\]\]"),
]) + "]) AS p)"
#: What is put after a document's text, by its number: something for every pattern.
MARKS = [" \\", "\u00b6", "{", '|lemma="x"', "\u2003\u2003x", "\u00a0", " <b>", " 5 < 6", " &amp; so", " strong:G12", " (G1234)", "\x7f", "\ufffd", "\u00c3\u00a9", "\u200b", "\ue000", " *", " [[x]]", "\u0085", ""]
MARKED = "text || CASE doc_id % 20 " + " ".join("WHEN %d THEN '%s'" % (i, m) for i, m in enumerate(MARKS)) + " END"


@query(
    f"""WITH {HYGIENE_SQL}, d AS (SELECT doc_id AS k, {MARKED} AS b FROM documents), s AS (SELECT k, b, CASE k % 3 WHEN 0 THEN b WHEN 1 THEN 'x' ELSE 'x' || ' ' || chr(8291) || ' ' || b END AS a FROM d),
    h AS (SELECT p[1] AS code, p[2] AS level, k, regexp_matches(a, p[3]) AND NOT (p[1] = 'angle_bracket' AND regexp_matches(a, (SELECT p[3] FROM p WHERE p[1] = 'html_tag'))) AS was FROM s, p WHERE regexp_matches(b, p[3]) AND NOT (p[1] = 'angle_bracket' AND regexp_matches(b, (SELECT p[3] FROM p WHERE p[1] = 'html_tag')))),
    g AS (SELECT code, level, count(*) AS n, count(*) FILTER (NOT was) AS new FROM h WHERE level <> 'info' GROUP BY 1, 2)
    SELECT 'text_' || code || CASE WHEN new > 0 THEN '' ELSE '_inherited' END AS code, CASE WHEN new > 0 AND level = 'error' THEN 'error' ELSE 'warn' END AS severity, n FROM g"""
)
def q7_findings(spark, d):
    """Every third text has its marks in the source's text, every third in its raw markup only."""
    t = marked_documents(spark, d)
    k = F.col("verse_id")
    source = t.select("verse_id", F.when(k % 3 == 0, F.col("text")).otherwise("x").alias("text"), F.when(k % 3 == 2, F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))).alias("raw"))
    plain = source.where(k % 3 != 2).select("verse_id", "text")
    both = report.hygiene_findings(source.where(k % 3 == 2), t.where(k % 3 == 2))
    rest = report.hygiene_findings(plain, t.where(k % 3 != 2))
    name = F.regexp_replace("code", "_inherited$", "")
    new = F.max((~F.col("code").endswith("_inherited")).cast("int")) == 1
    level = F.when(new, F.min("severity")).otherwise("warn")
    return both.unionByName(rest).groupBy(name.alias("name")).agg(F.concat(F.first(name), F.when(new, "").otherwise("_inherited")).alias("code"), level.alias("severity"), F.sum("n").alias("n")).drop("name")


def marked_documents(spark, d):
    k = F.col("doc_id")
    mark = F.lit("")
    for i, m in enumerate(MARKS):
        mark = F.when(k % 20 == i, m).otherwise(mark)
    return table(spark, d, "documents").select(k.alias("verse_id"), F.concat("text", mark).alias("text"))


@query(
    """WITH t AS (SELECT event_id AS k, CASE event_id % 7 WHEN 0 THEN (event_id % 1000) || '. ' || event_type WHEN 1 THEN '(' || (event_id % 1000) || ') ' || event_type WHEN 2 THEN (event_id % 1000 + 1) || ' x' WHEN 3 THEN ' ' ELSE 'a text that is the same as its neighbour' END AS text FROM events),
    c AS (SELECT (SELECT count(*) FROM t WHERE regexp_matches(text, '^\\(?' || (k % 1000) || '\\)?[\\s.:]')) AS numbered, (SELECT count(*) FROM t WHERE trim(text, ' ') = '') AS blank,
    (SELECT count(*) FROM t JOIN t u ON u.k = t.k + 1 AND u.text = t.text WHERE length(t.text) > 20) AS twice) """.replace("\\\\", "\\")
    + _rows(("verse_number_in_text", _level(("warn", "numbered > 20")), "numbered"), ("empty_verse", _level(("error", "blank > 0")), "blank"), ("duplicate_adjacent", _level(("error", "twice >= 20"), ("warn", "twice > 0")), "twice"))
)
def q8_verses(spark, d):
    k = F.col("event_id")
    kind, number = k % 7, (k % 1000).cast("string")
    made = F.when(kind == 0, F.concat(number, F.lit(". "), "event_type")).when(kind == 1, F.concat(F.lit("("), number, F.lit(") "), "event_type")).when(kind == 2, F.concat((k % 1000 + 1).cast("string"), F.lit(" x"))).when(kind == 3, " ")
    t = table(spark, d, "events").select(k.alias("verse_id"), made.otherwise("a text that is the same as its neighbour").alias("text"))
    return report.verse_findings(t)


#: Sizes of 1 to 200 by key, and the same one key later in every third chapter.
SIZE_SQL = "CAST((c_custkey * 7919 + c_nationkey * 104729) % 199 + 1 AS BIGINT)"
SHIFT_SQL = f"""a AS (SELECT 1000000 + c_custkey AS k, {SIZE_SQL} AS s FROM customer), b AS (SELECT CASE WHEN k // 10 % 3 = 0 THEN k + 1 ELSE k END AS k, s FROM a WHERE k % 1000 < 998),
    l AS (SELECT (k - 1000000) // 10 * 1000 + k % 10 + 1 AS k, s FROM a), r AS (SELECT (k0 - 1000000) // 10 * 1000 + k % 10 + 1 AS k, s FROM (SELECT CASE WHEN k // 10 % 3 = 0 AND k % 10 < 9 THEN k + 1 ELSE k END AS k, k AS k0, s FROM a WHERE NOT (k // 10 % 3 = 0 AND k % 10 = 9)))"""
CORR_SQL = "CASE WHEN count(*) >= 3 AND stddev_pop(x) * stddev_pop(y) > 0 THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END"
ALIGN_SQL = f"""WITH {SHIFT_SQL}, p AS (SELECT l.k // 1000 AS grp, o, CAST(l.s AS DOUBLE) AS x, CAST(v.s AS DOUBLE) AS y FROM l JOIN r ON l.k = r.k CROSS JOIN (VALUES (-1), (0), (1)) AS t(o) JOIN r v ON v.k = l.k + o AND v.k // 1000 = l.k // 1000),
    m AS (SELECT grp, o, {CORR_SQL} AS r, count(*) AS n FROM p GROUP BY 1, 2), q AS (SELECT grp, max(r) FILTER (o = -1) AS v0, max(r) FILTER (o = 0) AS v1, max(r) FILTER (o = 1) AS v2, max(n) FILTER (o = 0) AS n FROM m GROUP BY 1),
    z AS (SELECT *, greatest(coalesce(v0, -2), v1, coalesce(v2, -2)) AS best FROM q WHERE n >= 8 AND v1 IS NOT NULL)"""


def shifted_sizes(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), ((F.col("c_custkey") * 7919 + F.col("c_nationkey") * 104729) % 199 + 1).cast("long").alias("s"))
    k = F.col("k")
    late = (F.expr("(k + 1000000) div 10") % 3) == 0
    place = lambda last: F.expr("k div 10") * 1000 + last + 1
    left = c.select(place(k % 10).alias("verse_id"), "s")
    right = c.where(~(late & (k % 10 == 9))).select(place(F.when(late, k % 10 + 1).otherwise(k % 10)).alias("verse_id"), "s")
    word = F.expr("repeat('x', int(s))").alias("text")
    return left.select("verse_id", word), right.select("verse_id", word)


@query(f"{ALIGN_SQL} SELECT grp, round(v0, 6) AS v0, round(v1, 6) AS v1, round(v2, 6) AS v2 FROM z")
def a11_shifts(spark, d):
    left, right = (verify.sizes(x, "verse_id") for x in shifted_sizes(spark, d))
    out = stats.shift_correlations(left, right, "verse_id", "size", keys.chapter_key(F.col("verse_id")))
    return out.select("grp", *[F.round(c, 6).alias(c) for c in ("v0", "v1", "v2")])


@query(
    f"""{ALIGN_SQL}, pair AS (SELECT l.k, l.s, r.s AS o FROM l JOIN r USING (k)), scale AS (SELECT quantile_cont(s / o, 0.5) AS f FROM pair),
    c AS (SELECT (SELECT round(quantile_cont(round(v1, 12), 0.5), 3) FROM z) AS mid, (SELECT count(*) FROM z WHERE best - v1 > 0.3 AND v1 < 0.6 AND best >= 0.7) AS moved, (SELECT count(*) FROM pair, scale WHERE s > 3 * f * o AND s - f * o > 80) AS overlong) """
    + _rows(("versification_alignment", _level(("warn", "mid < 0.5")), "1"), ("versification_shift", _level(("warn", "moved > 0")), "moved"), ("overlong_verses", _level(("warn", "overlong > 0")), "overlong"))
)
def q9_alignment(spark, d):
    return report.alignment_findings(*shifted_sizes(spark, d))


@query(
    f"""{ALIGN_SQL}, pair AS (SELECT l.k, l.s, r.s AS o FROM l JOIN r USING (k)), scale AS (SELECT quantile_cont(s / o, 0.5) AS f FROM pair)
    SELECT (SELECT count(*) FROM z) AS chapters, (SELECT round(quantile_cont(round(v1, 12), 0.5), 6) FROM z) AS median_correlation, (SELECT count(*) FROM z WHERE v1 < 0.3) AS low_correlation,
    (SELECT count(*) FROM z WHERE best - v1 > 0.3 AND v1 < 0.6 AND best >= 0.7) AS shifted, (SELECT count(*) FROM pair, scale WHERE s > 3 * f * o AND s - f * o > 80) AS overlong"""
)
def q9_counts(spark, d):
    return report.alignment_counts(*shifted_sizes(spark, d)).withColumn("median_correlation", F.round("median_correlation", 6))


@query(
    f"""WITH {SHIFT_SQL}, m AS (SELECT k, k + 1 AS t FROM l WHERE k // 1000 % 3 <> 0 AND k % 1000 < 10), hyp AS (SELECT coalesce(t, k) AS k, sum(s) AS h FROM l LEFT JOIN m USING (k) GROUP BY 1),
    crossed AS (SELECT k // 1000 AS grp FROM m UNION SELECT t // 1000 FROM m), w AS (SELECT r.k // 1000 AS grp, CAST(coalesce(l.s, 0) AS DOUBLE) AS x, CAST(coalesce(h, 0) AS DOUBLE) AS z, CAST(r.s AS DOUBLE) AS y FROM r LEFT JOIN l USING (k) LEFT JOIN hyp USING (k) WHERE r.k // 1000 IN (SELECT grp FROM crossed)),
    g AS (SELECT grp, {CORR_SQL} AS r0, {CORR_SQL.replace("(x", "(z")} AS r1 FROM w GROUP BY 1 HAVING count(*) >= 4)
    SELECT count(*) FILTER (r1 - r0 > 0.3) AS better, count(*) FILTER (r1 - r0 < -0.3) AS worse, count(*) FILTER (r1 - r0 > 0.3) >= 3 AND count(*) FILTER (r1 - r0 > 0.3) > 3 * count(*) FILTER (r1 - r0 < -0.3) AS suspect FROM g"""
)
def q10_remapped(spark, d):
    left, right = shifted_sizes(spark, d)
    k = F.col("verse_id")
    moved = left.where((keys.chapter_key(k) % 3 != 0) & (k % 1000 < 10)).select(k.alias("key"), (k + 1).alias("to"))
    return verify.remapped_alignment(left, right, moved, "verse_id")


STRONGS_SQL = """WITH w AS (SELECT l_orderkey AS k, 'H' || (l_partkey % 400) AS i FROM lineitem), s AS (SELECT k, list_distinct(list(i)) AS x FROM w GROUP BY 1), r AS (SELECT k + 1 AS k, x FROM s WHERE k // 1000 % 2 = 0 UNION ALL SELECT k, x FROM s WHERE k // 1000 % 2 = 1),
    r2 AS (SELECT k, list_distinct(flatten(list(x))) AS x FROM r GROUP BY 1), stop AS (SELECT list(i) AS z FROM (SELECT i, count(*) AS n FROM (SELECT k, unnest(x) AS i FROM r2) GROUP BY 1 ORDER BY n DESC, i LIMIT 40)),
    p AS (SELECT s.k, o, list_filter(s.x, lambda v: NOT list_contains(z, v)) AS x, list_filter(r2.x, lambda v: NOT list_contains(z, v)) AS y FROM s CROSS JOIN (VALUES (0), (-1), (1), (-2), (2)) AS q(o) JOIN r2 ON r2.k = s.k + o AND r2.k // 1000 = s.k // 1000 CROSS JOIN stop),
    j AS (SELECT k, o, CASE WHEN len(x) > 0 AND len(y) > 0 THEN len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) END AS j FROM p WHERE len(x) >= 3),
    g AS (SELECT k, max(j) FILTER (o = 0) AS here, max(j) FILTER (o <> 0) AS there FROM j GROUP BY 1 HAVING max(j) FILTER (o = 0) IS NOT NULL)"""


@query(
    STRONGS_SQL
    + """, c AS (SELECT count(*) AS n, count(*) FILTER (there - here >= 0.25 AND here < 0.35 AND k // 1000 % 4 = 0) AS t, count(*) FILTER (there - here >= 0.25 AND here < 0.35 AND k // 1000 % 4 <> 0) AS g FROM g) """
    + _rows(("strongs_misplaced", _level(("error", "t > greatest(10.0, 0.002 * n)"), ("warn", "t > 0")), "t"), ("strongs_tags_offset", _level(("warn", "g > 0")), "g"))
)
def q11_strongs(spark, d):
    w, other = shifted_numbers(spark, d)
    chapter = keys.chapter_key(F.col("verse_id"))
    shifted = w.select(chapter.alias("grp")).distinct().where("grp % 4 = 0")
    return report.strongs_findings(w, other, shifted=shifted)


@query(
    f"""{STRONGS_SQL}, v AS (SELECT *, coalesce(there, 0) - here >= 0.25 AND here < 0.35 AS bad FROM g)
    SELECT count(*) AS compared, round(quantile_cont(here, 0.5), 9) AS median_overlap, count(*) FILTER (bad) AS misplaced, count(*) FILTER (NOT bad AND here = 0) AS no_overlap FROM v"""
)
def q11_counts(spark, d):
    found = report.strongs_counts(report.strongs_overlap(*shifted_numbers(spark, d)))
    return found.withColumn("median_overlap", F.round("median_overlap", 9))


def shifted_numbers(spark, d):
    """Word numbers of a reference, and the same one verse off in every second chapter."""
    w = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("verse_id"), F.concat(F.lit("H"), (F.col("l_partkey") % 400).cast("string")).alias("strongs_number"))
    chapter = keys.chapter_key(F.col("verse_id"))
    other = w.withColumn("verse_id", F.when(chapter % 2 == 0, F.col("verse_id") + 1).otherwise(F.col("verse_id")))
    return w, other


@query(
    rf"""WITH s AS (SELECT text FROM conversations WHERE turn < 2), r AS (SELECT text FROM conversations),
    c AS (SELECT (SELECT count(*) FROM s WHERE trim(text, ' ') <> '') AS s, (SELECT count(*) FROM r) AS r, (SELECT sum({WORDS.format("text")}) FROM s) AS sw, (SELECT sum({WORDS.format("text")}) FROM r) AS rw, (SELECT count(*) FROM r WHERE contains(text, '\')) AS b) """
    + _rows(
        ("empty", _level(("error", "r = 0")), "1"), ("row_count", _level(("warn", "r > 0 AND r < 0.8 * s")), "r"), ("entries_duplicated", _level(("warn", "s > 0 AND r > 1.5 * s")), "r"),
        ("word_count_delta", _level(("warn", "sw > 0 AND abs(rw - sw) > 0.1 * sw")), "rw"), ("text_backslash", _level(("info", "b > 0")), "b"),
    )
)
def q16_generic(spark, d):
    c = table(spark, d, "conversations")
    found = verify.generic_checks(c.where("turn < 2").select("text"), c.select("text"), "text")
    return found.where(~F.col("code").startswith("text_") | (F.col("code") == "text_backslash"))


@query(
    """WITH t AS (SELECT event_id AS k, event_id % 8 AS m FROM events), c AS (SELECT count(*) FILTER (m = 0) + count(*) FILTER (m = 1) + count(*) FILTER (m = 2) + count(*) FILTER (m = 3) * 2 + count(*) FILTER (m = 4) + count(*) FILTER (m = 5) AS n FROM t)
    SELECT 'formatting_invalid' AS code, 'error' AS severity, CAST(n AS BIGINT) AS n FROM c WHERE n > 0 UNION ALL SELECT 'word_count_column', 'error', count(*) FROM t WHERE k % 10 = 9 HAVING count(*) > 0"""
)
def q5_formatting(spark, d):
    canon = spark.createDataFrame([(1, 1, 31)], "book long, chapter long, max_verse long")
    m = F.col("event_id") % 8
    doc = (
        F.when(m == 0, "{").when(m == 1, '{"v":2,"spans":[]}').when(m == 2, '{"v":1,"block":{"poetry_level":4}}').when(m == 3, '{"v":1,"spans":[{"type":"odd","start":0,"end":9}]}')
        .when(m == 4, '{"v":1,"spans":[{"type":"quotation","start":0,"end":1,"ref":"1001032"}]}').when(m == 5, '{"v":1,"block":{"size":1,"heading":"A"}}')
        .when(m == 6, '{"v":1,"block":{"poetry_level":3,"selah":true},"spans":[{"type":"quotation","start":0,"end":2,"ref":"1001031"}]}')
    )
    words = F.when(F.col("event_id") % 10 == 9, 4).otherwise(3)
    return report.formatting_findings(table(spark, d, "events").select(F.col("event_id").alias("verse_id"), F.lit("one two three").alias("text"), doc.alias("formatting"), words.alias("word_count")), canon)


# Validator -----------------------------------------------------------------------


@query("SELECT 'bible_' || c_custkey AS module, CAST(1 AS BIGINT) AS n, 'source_url' AS example FROM customer WHERE c_custkey % 10 <= 5 AND c_custkey % 6 = 3")
def v6_info_columns(spark, d):
    from ..operators import libcheck
    from .stored import customer_library

    return libcheck.findings(*customer_library(spark, d)).where("code = 'missing_info_columns'").select("module", "n", "example")


@query(
    """SELECT 'multiple_module_info_rows' AS code, count(*) AS n FROM nation HAVING count(*) > 1 UNION ALL SELECT 'missing_module_info_row', 1 FROM (SELECT count(*) FILTER (n_nationkey = 1) AS k FROM nation) WHERE k = 0
    UNION ALL SELECT 'invalid_module_uuid', count(*) FROM nation WHERE n_nationkey = 1 HAVING count(*) > 0 UNION ALL SELECT 'wrong_versification', count(*) FROM nation WHERE n_nationkey = 1 HAVING count(*) > 0"""
)
def v3_info_rows(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("info_id"), *[F.col("n_name").alias(c) for c in validate.INFO_COLUMNS])
    rules = validate.info_rules(n)
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out.select("code", "n")


@query(
    """WITH t AS (SELECT 'dictionary_entry' AS name, 8 AS least, text FROM (SELECT substr(text, 1, CASE WHEN doc_id % 3 = 0 THEN 7 ELSE 10 END) AS text FROM documents) UNION ALL SELECT 'commentary_entry', 12, substr(text, 1, 10) FROM documents UNION ALL SELECT 'book_section', 12, text FROM documents),
    g AS (SELECT name, count(*) AS n, count(*) FILTER (length(trim(text, ' ')) < least) AS s, count(*) FILTER (contains(text, chr(65533))) AS d FROM t GROUP BY 1)
    SELECT name, CASE WHEN s / n >= 0.8 OR d / n >= 0.6 THEN 'content_corrupt' ELSE 'content_thin' END AS code, CASE WHEN s / n >= 0.8 OR d / n >= 0.6 THEN 'error' ELSE 'warn' END AS severity, greatest(s, d) AS n FROM g WHERE s / n >= 0.2 OR d / n >= 0.05"""
)
def v16_content(spark, d):
    t = table(spark, d, "documents")
    cut = F.substring(F.col("text"), F.lit(1), F.when(F.col("doc_id") % 3 == 0, 7).otherwise(10))
    tables = {"dictionary_entry": t.select(cut.alias("definition")), "commentary_entry": t.select(F.substring("text", 1, 10).alias("content")), "book_section": t.select(F.col("text").alias("content"))}
    out = None
    for name, df in tables.items():
        one = validate.content_rules(name, df)[0].select(F.lit(name).alias("name"), "code", "severity", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    r"""WITH d AS (SELECT doc_id, text || CASE doc_id % 8 WHEN 0 THEN ' \' WHEN 1 THEN '¶' WHEN 2 THEN '<b>' ELSE '' END AS text FROM documents), t AS (SELECT doc_id AS k, text, length(trim(text, ' ')) - length(replace(trim(text, ' '), ' ', '')) + 1 + CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS wc FROM d)
    SELECT 'bible_text_html' AS code, count(*) AS n, CAST(min(k) AS VARCHAR) AS example FROM t WHERE regexp_matches(text, '(?s)<.*>') HAVING count(*) > 0 UNION ALL SELECT 'bible_text_pilcrow', count(*), CAST(min(k) AS VARCHAR) FROM t WHERE contains(text, chr(182)) HAVING count(*) > 0
    UNION ALL SELECT 'bible_text_backslash', count(*), CAST(min(k) AS VARCHAR) FROM t WHERE contains(text, '\') HAVING count(*) > 0 UNION ALL SELECT 'word_count_mismatch', count(*), CAST(min(k) AS VARCHAR) FROM t WHERE k % 9 = 0 AND trim(text, ' ') <> '' HAVING count(*) > 0"""
)
def v17_text(spark, d):
    wrong = F.when(F.col("doc_id") % 9 == 0, 1).otherwise(0)
    m = F.col("doc_id") % 8
    mark = F.when(m == 0, " \\").when(m == 1, "¶").when(m == 2, "<b>").otherwise("")
    t = table(spark, d, "documents").withColumn("text", F.concat("text", mark))
    t = t.select(F.col("doc_id").alias("verse_id"), "text", (text.count_by_spaces(F.col("text")) + wrong).alias("word_count"))
    return validate.text_rules(t)[0].select("code", "n", "example")


@query(
    """WITH t AS (SELECT event_id AS k, event_id % 5 AS m FROM events) SELECT 'invalid_formatting_json' AS code, count(*) AS n FROM t WHERE m = 0 HAVING count(*) > 0 UNION ALL SELECT 'unknown_formatting_key', count(*) FROM t WHERE m = 1 HAVING count(*) > 0
    UNION ALL SELECT 'unknown_block_key', count(*) FROM t WHERE m = 2 HAVING count(*) > 0 UNION ALL SELECT 'unknown_span_type', count(*) FROM t WHERE m = 3 HAVING count(*) > 0 UNION ALL SELECT 'span_out_of_range', count(*) FROM t WHERE m = 4 HAVING count(*) > 0"""
)
def v19_formatting(spark, d):
    m = F.col("event_id") % 5
    doc = F.when(m == 0, "[").when(m == 1, '{"v":1,"x":1}').when(m == 2, '{"v":1,"block":{"size":1}}').when(m == 3, '{"v":1,"spans":[{"type":"odd","start":0,"end":1}]}').otherwise('{"v":1,"spans":[{"type":"supplied","start":0,"end":2}]}')
    t = table(spark, d, "events").select(F.col("event_id").alias("verse_id"), F.lit("one  two").alias("text"), doc.alias("formatting"))
    first, rest = validate.formatting_rules(t)
    return first.unionByName(rest).select("code", "n")


@query(
    """SELECT 'half_populated_anchor' AS code, count(*) AS n FROM orders WHERE (o_orderkey % 5 = 0) <> (o_orderkey % 7 = 0) HAVING count(*) > 0 UNION ALL SELECT 'null_verse_link_end', count(*) FROM orders WHERE o_orderkey % 7 = 0 HAVING count(*) > 0
    UNION ALL SELECT 'forbidden_range_column', CAST(2 AS BIGINT) FROM region WHERE r_regionkey = 0"""
)
def v10_anchors(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(F.when(k % 5 != 0, k).alias("verse_id_start"), F.when(k % 7 != 0, k + 1).alias("verse_id_end"))
    link = o.withColumn("verse_id_start", F.lit(0))
    wrong = o.select(F.col("verse_id_start").alias("start_verse_id"), F.col("verse_id_end").alias("end_verse_id"))
    out = validate.range_rules("commentary_entry", o)[0].unionByName(validate.range_rules("verse_link", link)[0]).unionByName(validate.range_rules("user_mark", wrong)[0])
    return out.select("code", "n")


@query(
    """WITH t AS (SELECT user_id AS module, CASE event_type WHEN 'view' THEN 'topic' WHEN 'click' THEN 'bible_verse' WHEN 'error' THEN 'book_section' WHEN 'purchase' THEN 'devotional_entry' ELSE 'note' END AS name FROM events WHERE event_id % 9 = 0)
    SELECT module, CASE WHEN bool_or(name = 'bible_verse') THEN 'bible' WHEN bool_or(name = 'book_section') THEN 'book' WHEN bool_or(name = 'devotional_entry') THEN 'devotional' WHEN bool_or(name = 'topic') THEN 'topical' ELSE 'unknown' END AS validator,
    CASE WHEN bool_or(name = 'topic') THEN 'topical' WHEN bool_or(name = 'bible_verse') THEN 'bible' WHEN bool_or(name = 'book_section') THEN 'book' WHEN bool_or(name = 'devotional_entry') THEN 'devotional' ELSE 'unknown' END AS query FROM t GROUP BY 1"""
)
def s5_module_type(spark, d):
    kind = F.col("event_type")
    name = F.when(kind == "view", "topic").when(kind == "click", "bible_verse").when(kind == "error", "book_section").when(kind == "purchase", "devotional_entry").otherwise("note")
    t = table(spark, d, "events").where("event_id % 9 = 0").select(F.col("user_id").alias("module"), name.alias("table_name"))
    return validate.detect_type(t).withColumnRenamed("module_type", "validator").join(validate.detect_type(t, "query").withColumnRenamed("module_type", "query"), "module")


# Functions ------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'PD' WHEN 1 THEN 'CC-BY-NC-SA-4.0' WHEN 2 THEN 'CC0-1.0' WHEN 3 THEN 'GPL-3.0-or-later' WHEN 4 THEN 'GPL-2.0-or-later' ELSE 'LicenseRef-Proprietary' END AS s FROM documents)
    SELECT doc_id, CASE WHEN s = 'PD' THEN 'https://creativecommons.org/publicdomain/mark/1.0/' WHEN s LIKE 'CC-%' THEN 'https://creativecommons.org/licenses/by-nc-sa/4.0/' WHEN s = 'GPL-3.0-or-later' THEN 'https://www.gnu.org/licenses/gpl-3.0.html'
    WHEN s = 'GPL-2.0-or-later' THEN 'https://www.gnu.org/licenses/old-licenses/gpl-2.0.html' ELSE '' END AS url FROM s"""
)
def f16_licence_url(spark, d):
    m = F.col("doc_id") % 6
    s = F.when(m == 0, "PD").when(m == 1, "CC-BY-NC-SA-4.0").when(m == 2, "CC0-1.0").when(m == 3, "GPL-3.0-or-later").when(m == 4, "GPL-2.0-or-later").otherwise("LicenseRef-Proprietary")
    return table(spark, d, "documents").select("doc_id", text.spdx_url(s).alias("url"))


@query(
    """WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'HE-Latn' WHEN 1 THEN lang || '-Arab' WHEN 2 THEN 'ar_EG' ELSE lang END AS tag, CASE WHEN doc_id % 3 = 0 THEN 'LtoR' WHEN doc_id % 5 = 0 THEN 'rtl' END AS dir, doc_id % 4 AS m FROM documents)
    SELECT doc_id, lower(regexp_extract(tag, '^[^-_]*')) AS language, CASE WHEN dir = 'LtoR' THEN false WHEN dir = 'rtl' THEN true ELSE m <> 3 END AS rtl FROM t"""
)
def f18_language(spark, d):
    m, i = F.col("doc_id") % 4, F.col("doc_id")
    tag = F.when(m == 0, "HE-Latn").when(m == 1, F.concat("lang", F.lit("-Arab"))).when(m == 2, "ar_EG").otherwise(F.col("lang"))
    way = F.when(i % 3 == 0, "LtoR").when(i % 5 == 0, "rtl")
    return table(spark, d, "documents").select("doc_id", text.primary_language(tag).alias("language"), text.is_right_to_left(tag, way).alias("rtl"))


@query("SELECT doc_id, CASE WHEN contains(l, 'a') THEN 'fixed_length' ELSE 'day_of_year' END AS kind FROM (SELECT doc_id, substr(lower(text), 1, 3) AS l FROM documents)")
def f33_devotional(spark, d):
    note = F.when(F.substring(F.lower("text"), 1, 3).contains("a"), "A 40 Day plan").otherwise("A Daily plan of 40 days")
    return table(spark, d, "documents").select("doc_id", text.devotional_kind(note).alias("kind"))


@query(
    """SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'glossary' WHEN 1 THEN 'strongs' WHEN 2 THEN 'greek_lexicon' WHEN 3 THEN 'hebrew_lexicon' ELSE 'bible_dictionary' END AS kind FROM nation"""
)
def f33_dictionary(spark, d):
    m = F.col("n_nationkey") % 5
    name = F.when(m == 1, "StrongsReal").when(m == 2, "Thayer").when(m == 3, "BDBGlosses").otherwise(F.col("n_name"))
    return table(spark, d, "nation").select("n_nationkey", text.dictionary_kind(name, F.when(m == 0, "A Glossary").otherwise(""), F.lit("")).alias("kind"))


@query("SELECT page_id, regexp_matches(lower(html), '<font[^>]*color\\s*=\\s*[\"'']?(red|#ff0000|#f00)\\b') AS red FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '<Font size=2 COLOR=\"#FF0000\">x' WHEN page_id % 3 = 1 THEN '<font color=redder>' ELSE html END AS html FROM pages)".replace("\\\\", "\\"))
def f34_red_font(spark, d):
    m = F.col("page_id") % 3
    return table(spark, d, "pages").select("page_id", text.has_red_font(F.when(m == 0, '<Font size=2 COLOR="#FF0000">x').when(m == 1, "<font color=redder>").otherwise(F.col("html"))).alias("red"))


@query("SELECT c_custkey, CASE WHEN c_nationkey > 20 THEN 'Book' || (c_nationkey + 1) ELSE n_name END || ' ' || (c_custkey % 50 + 1) || ':' || (c_custkey % 30 + 1) AS ref FROM customer JOIN nation ON c_nationkey = n_nationkey")
def f3_full_names(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = keys.pack(F.col("c_nationkey") + 1, F.col("c_custkey") % 50 + 1, F.col("c_custkey") % 30 + 1)
    return c.select("c_custkey", keys.format_full(key, F.when(F.col("c_nationkey") <= 20, F.col("n_name"))).alias("ref"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 ELSE o_orderkey END AS last, lower(o_orderpriority) AS low FROM orders")
def k3_range_end(spark, d):
    return table(spark, d, "orders").select("o_orderkey", keys.range_end(F.col("o_orderkey"), F.col("o_orderkey") % 4).alias("last"), text.ascii_lower(F.col("o_orderpriority")).alias("low"))


@query(
    """SELECT o_orderkey, regexp_replace(regexp_extract('strong:H0' || (o_orderkey % 90 + 10) || ' lemma.TR:' || o_orderstatus || ' x', 'strong:([GH]\\S*)', 1), '^([A-Z])0+', '\\1') AS number, o_orderstatus AS word, 'N-' || o_orderstatus || ' V' AS morph FROM orders""".replace("\\\\", "\\")
)
def f29_strongs(spark, d):
    o = table(spark, d, "orders")
    lemma = F.concat(F.lit("strong:h0"), (F.col("o_orderkey") % 90 + 10).cast("string"), F.lit(" lemma.TR:"), "o_orderstatus", F.lit(" x"))
    morph = F.concat(F.lit("robinson:N-"), "o_orderstatus", F.lit("  packard:V"))
    return o.select("o_orderkey", text.plain_strongs(F.element_at(text.strongs_numbers(lemma), 1)).alias("number"), text.original_word(lemma).alias("word"), text.plain_morphology(morph).alias("morph"))


@query(
    f"""WITH t AS (SELECT {LINE_KEY} AS k, l_quantity AS q FROM lineitem) SELECT k // 1000000 AS module, 'late' AS code, count(*) AS n, CAST(min(k) AS VARCHAR) AS example FROM t WHERE k % 1000 > 6 GROUP BY 1
    UNION ALL SELECT k // 1000000, 'many', count(*), CAST(min(k) AS VARCHAR) FROM t WHERE q > 45 GROUP BY 1"""
)
def w11_first_bad(spark, d):
    from ..operators import libcheck

    k = F.col("key")
    rows = lines(spark, d).withColumn("module", keys.book_of(k))
    return libcheck.first_bad(rows, [("late", "error", keys.verse_of(k) > 6, k), ("many", "warn", F.col("l_quantity") > 45, k), ("none", "error", k < 0, k)]).select("module", "code", "n", "example")


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY md5('1:' || doc_id), doc_id LIMIT 100)")
def a15_seeded_sample(spark, d):
    return stats.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 100)


@query(
    """SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('1:' || doc_id), doc_id) AS n FROM documents) ORDER BY n, md5('1:' || source), source LIMIT 40"""
)
def w9_stratified_sample(spark, d):
    return stats.stratified(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 40)


@query(
    """WITH g AS (SELECT c_nationkey AS module, c_custkey AS group_id, c_custkey AS a, c_custkey + 2 AS b, CASE WHEN c_custkey % 5 > 0 THEN c_name END AS phrase FROM customer), l AS (SELECT c_nationkey AS module, o_custkey AS source_id, o_orderkey AS a, o_orderkey + 1 AS b FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 = 0)
    SELECT g.module, sha256(string_agg(g.a || chr(9) || g.b || chr(9) || coalesce(phrase, '') || chr(9) || coalesce(CAST(l.a AS VARCHAR), '') || chr(9) || coalesce(CAST(l.b AS VARCHAR), ''), chr(10) ORDER BY group_id, l.a)) AS content_sha256
    FROM g LEFT JOIN l ON l.module = g.module AND source_id = group_id GROUP BY 1"""
)
def j8_empty_groups(spark, d):
    from ..operators import xrefs

    c, k = table(spark, d, "customer"), F.col("c_custkey")
    groups = c.select(F.col("c_nationkey").alias("module"), k.alias("group_id"), k.alias("verse_id_start"), (k + 2).alias("verse_id_end"), F.when(k % 5 > 0, F.col("c_name")).alias("phrase"))
    o = table(spark, d, "orders").where("o_orderkey % 3 = 0").join(c, F.col("o_custkey") == k)
    links = o.select(F.col("c_nationkey").alias("module"), F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("verse_id_start"), (F.col("o_orderkey") + 1).alias("verse_id_end"), F.col("o_orderkey").alias("sort_order"))
    return xrefs.content_digest(groups, links)


# Verifier: the modules' own rows, scripts, losses, samples ---------------------------


@query(
    """WITH t AS (SELECT user_id % 25 AS module, sha256(string_agg(event_id || chr(9) || event_type || chr(10), '' ORDER BY event_id)) AS h FROM events GROUP BY 1),
    i AS (SELECT n_nationkey AS module, CASE WHEN n_nationkey % 3 = 0 THEN h ELSE 'other' END AS stored, coalesce(h, sha256('')) AS h FROM nation LEFT JOIN t ON module = n_nationkey)
    SELECT module, 'content_sha256' AS code, 'error' AS severity FROM i WHERE coalesce(stored, '') <> h UNION ALL SELECT module, 'license_unknown', 'warn' FROM i WHERE module % 5 = 0 UNION ALL SELECT module, 'license_conflict', 'warn' FROM i WHERE module % 5 IN (0, 1)
    UNION ALL SELECT module, 'metadata_full_name_markup', 'warn' FROM i WHERE module % 4 = 1 UNION ALL SELECT module, 'metadata_description_markup', 'warn' FROM i WHERE module % 4 = 2
    UNION ALL SELECT module, 'language_code', 'info' FROM i WHERE module % 2 = 1 UNION ALL SELECT module, 'right_to_left', 'warn' FROM i WHERE module % 3 = 1"""
)
def q12_metadata(spark, d):
    from ..operators.sequence import content_hash

    k = F.col("n_nationkey")
    result = table(spark, d, "events").select((F.col("user_id") % 25).alias("module"), F.col("event_id").alias("verse_id"), F.col("event_type").alias("text"))
    line = F.concat(F.concat_ws("\t", F.col("verse_id").cast("string"), "text"), F.lit("\n"))
    info = table(spark, d, "nation").join(content_hash(result, "module", ["verse_id"], line), k == F.col("module"), "left").select(
        k.alias("module"), F.when(k % 3 == 0, F.col("content_sha256")).otherwise("other").alias("content_sha256"), F.when(k % 5 == 0, None).when(k % 5 == 1, "CC-BY-4.0").otherwise("CC-BY-NC-4.0").alias("license_spdx"),
        F.lit("(c) Owner, non-commercial use").alias("copyright"), F.when(k % 4 == 1, "A <b>name</b>").otherwise(F.col("n_name")).alias("full_name"), F.when(k % 4 == 2, r"x\par y").otherwise("").alias("description"),
        F.when(k % 2 == 1, "fr").otherwise("en").alias("language_code"), F.lit(0).alias("right_to_left"),
    )
    entry = table(spark, d, "nation").select(k.alias("module"), F.lit(" en ").alias("app_language_code"), F.when(k % 3 == 1, "1").otherwise("0").alias("right_to_left"))
    return report.metadata_findings(info, result, entry)


@query("SELECT 'ru-RU' AS language, 'script_mismatch' AS code, 'warn' AS severity, CAST(sum(len(regexp_extract_all(text, '\\p{Latin}'))) AS BIGINT) AS n FROM documents".replace("\\\\", "\\"))
def q13_scripts(spark, d):
    docs, out = table(spark, d, "documents").select("text"), None
    for language in ("ru-RU", "en", "xx"):
        one = report.script_findings(docs, language).select(F.lit(language).alias("language"), "code", "severity", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT 'headings_lost' AS code, 'warn' AS severity, count(*) AS n FROM pages WHERE contains(html, '<title') HAVING count(*) > 50 UNION ALL SELECT 'strongs_lost', 'warn', count(*) FROM orders WHERE o_orderkey % 3 > 0 HAVING count(*) > 1000")
def q5_lost(spark, d):
    k = F.col("o_orderkey")
    raw = table(spark, d, "pages").select(F.col("html").alias("raw")).unionByName(table(spark, d, "orders").select(F.when(k % 3 > 0, "<w lemma='strong:G1'>").otherwise("<w>").alias("raw")))
    result = table(spark, d, "orders").select(F.when(k % 2 == 0, '{"v":1,"block":{"selah":true}}').alias("formatting"))
    return report.lost_findings(raw, result, table(spark, d, "region").where("false"))


@query("SELECT 'converter_dropped_text' AS code, 'error' AS severity, CAST(1 AS BIGINT) AS n FROM orders WHERE o_orderkey % 10 IN (1, 2, 3) UNION ALL SELECT 'validate_module', 'error', count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0")
def q15_conversion(spark, d):
    k = F.col("o_orderkey") % 10
    log = table(spark, d, "orders").select(F.when(k == 1, "Warning: key not in the cache").when(k == 2, "WARN 3 entries NOT imported").when(k == 3, "warning: verse had no host verse").when(k == 4, "Warning: odd tag").otherwise("3 verses NOT imported").alias("value"))
    return report.conversion_findings(log, table(spark, d, "events").select(F.col("event_type").alias("code"), F.when(F.col("event_type") == "error", "error").otherwise("warn").alias("severity")))


CLIP = "CASE WHEN length({0}) > 600 THEN left({0}, 600) || '...' ELSE {0} END"


@query(
    f"""WITH r AS (SELECT CASE WHEN conv_id = 0 AND turn = 0 THEN 1001001 WHEN conv_id = 1 AND turn = 0 THEN 43003016 ELSE 70000000 + conv_id * 1000 + turn END AS verse_id, text FROM conversations), s AS (SELECT verse_id, 'S ' || text AS text FROM r WHERE verse_id % 3 <> 0),
    i AS (SELECT DISTINCT 'key verse' AS why, verse_id FROM r WHERE verse_id IN (1001001, 43003016) UNION ALL SELECT * FROM (SELECT 'random', verse_id FROM r ORDER BY md5('1:' || verse_id), verse_id LIMIT 12)
    UNION ALL SELECT * FROM (SELECT 'missing', verse_id FROM r WHERE verse_id % 3 = 0 ORDER BY verse_id LIMIT 3))
    SELECT why, i.verse_id, {CLIP.format("s.text")} AS source_text, {CLIP.format("r.text")} AS text FROM i LEFT JOIN s USING (verse_id) LEFT JOIN r USING (verse_id)"""
)
def q14_samples(spark, d):
    c, t = F.col("conv_id"), F.col("turn")
    key = F.when((c == 0) & (t == 0), 1001001).when((c == 1) & (t == 0), 43003016).otherwise(c * 1000 + t + 70000000)
    r = table(spark, d, "conversations").select(key.alias("verse_id"), "text")
    s = r.where("verse_id % 3 <> 0").withColumn("text", F.concat(F.lit("S "), "text"))
    return report.review_samples(s, r, {"missing": (r.where("verse_id % 3 = 0").orderBy("verse_id"), 3)})


@query("SELECT 25 AS modules, count(*) FILTER (NOT bad) AS passed, count(*) FILTER (bad) AS failed FROM (SELECT n_nationkey AS m, EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND user_id % 40 = n_nationkey) AS bad FROM nation)")
def a21_totals(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 40).alias("module"), F.when(F.col("event_type") == "error", "error").otherwise("warn").alias("severity"))
    return report.totals(table(spark, d, "nation").select(F.col("n_nationkey").alias("module")), e)
