"""Bindings of the text, statistics, rule and search operators to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys, markup, text
from ..operators import catalog, convert, fulltext, stats, validate, verify, xrefs
from .keyed import LINE_KEY, TURN_KEY, day, lines, turns
from .registry import query, table


@query("SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def a2_levels(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))


@query("SELECT (SELECT count(*) FROM nation) AS topics, (SELECT count(*) FROM nation WHERE n_regionkey = 0) AS roots, (SELECT count(*) FROM nation WHERE n_regionkey <> 0) AS subs, (SELECT count(*) FROM supplier) AS links")
def a3_stats(spark, d):
    n = table(spark, d, "nation").withColumn("up", F.nullif("n_regionkey", F.lit(0)))
    return stats.node_stats(n, "up", table(spark, d, "supplier"))


@query("SELECT 'nation' AS table_name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def a4_table_counts(spark, d):
    return stats.table_counts({t: table(spark, d, t) for t in ("orders", "nation", "part")})


@query(
    r"""SELECT count(*) AS total, count(*) FILTER (length(trim(text, ' ')) < 60) AS short, count(*) FILTER (contains(text, chr(65533))) AS replaced,
    count(*) FILTER (regexp_matches(text, '(?s)<.*>')) AS html, count(*) FILTER (contains(text, chr(182))) AS pilcrow, count(*) FILTER (contains(text, '\')) AS backslash FROM documents"""
)
def a5_flags(spark, d):
    return stats.short_flags(table(spark, d, "documents"), "text", 60)


@query(
    """SELECT source, round(median(n_chars), 6) AS mid, round(quantile_cont(n_chars, 0.9), 6) AS high, round(avg(n_chars), 6) AS mean, round(min(n_chars) / max(n_chars), 9) AS ratio FROM documents GROUP BY 1"""
)
def a9_medians(spark, d):
    docs, n = table(spark, d, "documents"), F.col("n_chars")
    means = docs.groupBy("source").agg(F.round(F.avg(n), 6).alias("mean"), F.round(F.min(n) / F.max(n), 9).alias("ratio"))
    mid, high = (stats.quantile(docs, ["source"], n, q, name).withColumn(name, F.round(name, 6)) for q, name in ((0.5, "mid"), (0.9, "high")))
    return means.join(mid, "source").join(high, "source")


@query(
    """SELECT l_orderkey, CASE WHEN count(*) >= 3 AND stddev_pop(l_quantity) * stddev_pop(l_extendedprice) > 0 THEN round(covar_pop(l_quantity, l_extendedprice) / (stddev_pop(l_quantity) * stddev_pop(l_extendedprice)), 6) END AS r
    FROM lineitem GROUP BY 1"""
)
def a10_pearson(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(stats.pearson(F.col("l_quantity"), F.col("l_extendedprice")), 6).alias("r"))


@query("SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT 40")
def a12_most_frequent(spark, d):
    t = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("token"))
    return stats.most_frequent(t, "token", 40)


@query("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_partkey))), ',') AS items FROM lineitem GROUP BY 1")
def a13_item_sets(spark, d):
    return stats.item_sets(table(spark, d, "lineitem"), "l_orderkey", "l_partkey").select("l_orderkey", F.array_join("items", ",").alias("items"))


@query(
    """WITH s AS (SELECT l_orderkey AS k, list_distinct(list(l_suppkey % 20)) AS x FROM lineitem GROUP BY 1), t AS (SELECT list(v) AS stop FROM (SELECT l_suppkey % 20 AS v, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, v LIMIT 3)),
    p AS (SELECT a.k, o, list_filter(a.x, lambda v: NOT list_contains(stop, v)) AS x, list_filter(b.x, lambda v: NOT list_contains(stop, v)) AS y FROM s a CROSS JOIN (VALUES (0), (-1), (1), (-2), (2)) AS q(o) JOIN s b ON b.k = a.k + o CROSS JOIN t WHERE a.k // 1000 = b.k // 1000)
    SELECT k AS key, CAST(o AS INTEGER) AS "offset", CASE WHEN len(x) > 0 AND len(y) > 0 THEN round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 9) END AS overlap FROM p"""
)
def a14_neighbour_overlap(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_suppkey") % 20).alias("item"))
    sets = stats.item_sets(li, "key", "item")
    out = stats.neighbour_overlap(sets, sets, "key", stats.most_frequent(li, "item", 3))
    return out.select("key", "offset", F.round("overlap", 9).alias("overlap"))


@query("SELECT 'LATIN' AS script, CAST(sum(len(regexp_extract_all(text, '\\p{Latin}'))) AS BIGINT) AS n FROM documents")
def a16_scripts(spark, d):
    return stats.scripts(table(spark, d, "documents"), "text")


@query(
    """SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'FAIL' WHEN bool_or(event_type = 'signup') THEN 'WARN' ELSE 'PASS' END AS status FROM events GROUP BY 1"""
)
def a17_status(spark, d):
    s = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "warn").otherwise("info")
    return table(spark, d, "events").groupBy("user_id").agg(stats.status(s).alias("status"))


@query("SELECT code, count(*) AS n FROM (SELECT unnest(string_split(lang || ' ' || source, ' ')) AS code FROM documents WHERE n_chars > 1500) GROUP BY 1")
def a18_summary(spark, d):
    r = table(spark, d, "documents").select(
        F.col("doc_id").alias("module_id"), F.lit("r").alias("repository"), F.col("doc_id").alias("line_no"), F.when(F.col("n_chars") > 1500, "FAIL").otherwise("PASS").alias("status"), F.concat_ws(" ", "lang", "source").alias("codes"), F.lit("x").alias("stage")
    )
    return catalog.summary(r)["codes"]


@query(
    """SELECT conv_id, bool_or(role = 'system') AS flag, string_agg(text, ' ' ORDER BY turn) AS text, array_to_string(list(turn ORDER BY turn), ',') AS refs, array_to_string(list(role ORDER BY turn)[1:3], ',') AS raws FROM conversations GROUP BY 1"""
)
def a20_ordered_merge(spark, d):
    c = table(spark, d, "conversations").withColumn("f", F.col("role") == "system")
    return stats.ordered_merge(c, "conv_id", "turn", "text", "f", "role").select("conv_id", "flag", "text", F.array_join("refs", ",").alias("refs"), F.array_join("raws", ",").alias("raws"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN lang = 'es' THEN 'licence' WHEN source LIKE 'src1%' THEN 'type' WHEN n_chars < 300 THEN 'no url' END AS reason FROM documents) WHERE reason IS NOT NULL GROUP BY 1")
def p14_exclusions(spark, d):
    reason = catalog.first_reason([("licence", F.col("lang") == "es"), ("type", F.col("source").startswith("src1")), ("no url", F.col("n_chars") < 300)])
    return table(spark, d, "documents").select(reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def f12_sha256(spark, d):
    return table(spark, d, "documents").select("doc_id", text.sha256(F.col("text")).alias("digest"))


@query(
    """WITH h AS (SELECT n_nationkey, sha256('urn:bible-module:v0.1:book:' || lower(n_name) || ':en') AS h FROM nation)
    SELECT n_nationkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-8' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (('0x' || substr(h, 17, 1))::INTEGER & 3), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS module_uuid FROM h"""
)
def f13_uuid(spark, d):
    return table(spark, d, "nation").select("n_nationkey", text.deterministic_uuid(text.identity_key(F.lit("book"), F.col("n_name"), F.lit("en"))).alias("module_uuid"))


@query(
    """SELECT doc_id, CASE WHEN l = '' THEN '' WHEN contains(l, 'public domain') THEN 'PD' WHEN contains(l, 'cc0') THEN 'CC0-1.0' WHEN contains(l, 'creative commons') OR contains(l, 'cc-by') OR contains(l, 'cc by') THEN
    'CC-BY' || CASE WHEN contains(l, 'noncommercial') OR contains(l, 'non-commercial') OR contains(l, '-nc') THEN '-NC' ELSE '' END ||
    CASE WHEN contains(l, 'noderiv') OR contains(l, '-nd') THEN '-ND' WHEN contains(l, 'sharealike') OR contains(l, 'share alike') OR contains(l, '-sa') THEN '-SA' ELSE '' END || '-' ||
    CASE WHEN contains(l, '4.0') THEN '4.0' WHEN contains(l, '3.0') THEN '3.0' WHEN contains(l, '2.5') THEN '2.5' WHEN contains(l, '2.0') THEN '2.0' WHEN contains(l, '1.0') THEN '1.0' ELSE '4.0' END
    WHEN contains(l, 'gpl') THEN CASE WHEN contains(l, '3') THEN 'GPL-3.0-or-later' ELSE 'GPL-2.0-or-later' END
    WHEN contains(l, 'free non-commercial') OR contains(l, 'free noncommercial') THEN 'LicenseRef-SWORD-FreeNonCommercial' WHEN contains(l, 'permission to distribute') THEN 'LicenseRef-SWORD-DistributionPermitted'
    WHEN contains(l, 'copyright') THEN 'LicenseRef-Proprietary' ELSE '' END AS spdx FROM (SELECT doc_id, lower(trim(coalesce(text, ''), ' ')) AS l FROM documents)"""
)
def f15_licence(spark, d):
    return table(spark, d, "documents").select("doc_id", text.licence_to_spdx(F.col("text")).alias("spdx"))


@query("SELECT doc_id, CASE WHEN y = '' THEN 0 ELSE CAST(y AS INTEGER) END AS year FROM (SELECT doc_id, regexp_extract(text, '(?:^|[^0-9])([12][0-9]{3})(?:[^0-9]|$)', 1) AS y FROM documents)")
def f17_year(spark, d):
    return table(spark, d, "documents").select("doc_id", text.first_year(F.col("text")).alias("year"))


@query(
    """SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&quot;', '"'), chr(182), ''), '[ \t\n\v\f\r]+', ' ', 'g'), ' ') AS plain FROM pages"""
)
def f22_strip_markup(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_markup_clean(F.col("html")).alias("plain"))


ODD_SPACES = "text || CASE doc_id % 6 WHEN 0 THEN chr(8195) || 'w' || chr(8195) || '*' WHEN 1 THEN chr(160) || '5' WHEN 2 THEN chr(65279) || 'x' WHEN 3 THEN chr(133) || 'y' || chr(28) || 'z' WHEN 4 THEN ' *' || chr(12288) || '*' ELSE '' END"
SPACED = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WEB_SPACED = r"\t-\r\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


@query(
    rf"""WITH d AS (SELECT doc_id, {ODD_SPACES} AS text FROM documents) SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \t\n\v\f\r]+')) AS BIGINT) AS space_words, CAST(length(trim(text, ' ')) - length(replace(trim(text, ' '), ' ', '')) + 1 AS BIGINT) AS by_spaces,
    CAST(len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS BIGINT) AS split_words, CAST(len(list_filter(regexp_extract_all(text, '[^{SPACED}]+'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]'))) AS BIGINT) AS lettered,
    CAST(len(regexp_extract_all(text, '[^{WEB_SPACED}]+')) AS BIGINT) AS web_words FROM d"""
)
def f23_word_counts(spark, d):
    m, t = F.col("doc_id") % 6, F.col("text")
    odd = F.when(m == 0, "\u2003w\u2003*").when(m == 1, "\u00a05").when(m == 2, "\ufeffx").when(m == 3, "\u0085y\x1cz").when(m == 4, " *\u3000*").otherwise("")
    return table(spark, d, "documents").withColumn("text", F.concat("text", odd)).select(
        "doc_id", text.count_space_words(t).alias("space_words"), text.count_by_spaces(t).alias("by_spaces"), text.count_split_words(t).alias("split_words"), text.count_lettered_words(t).alias("lettered"), text.count_web_words(t).alias("web_words")
    )


@query(r"SELECT doc_id, regexp_replace(lower(replace(nfc_normalize(text), 'ß', 'ss')), '[^\p{L}\p{N}\p{M}]', '', 'g') AS norm FROM documents")
def f25_normal_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normal_text(F.col("text")).alias("norm"))


@query()
def f26_similarity(spark, d):
    c = table(spark, d, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other"))
    return c.join(nxt, ["conv_id", "turn"]).select("conv_id", "turn", text.similarity(F.col("text"), F.col("other")).alias("similarity"))


@query("SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS clipped, regexp_replace(source || '-' || lang, '[^A-Za-z0-9]+', '_', 'g') AS slug FROM documents")
def f35_clip(spark, d):
    return table(spark, d, "documents").select("doc_id", text.clip(F.col("text")).alias("clipped"), text.slug(F.concat_ws("-", "source", "lang")).alias("slug"))


@query(
    r"""SELECT code, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN regexp_matches(text, '^[ \t\n\v\f\r]|[ \t\n\v\f\r]$|[ \t\n\v\f\r][ \t\n\v\f\r]|[\t\n\r]') THEN 'whitespace' END, CASE WHEN regexp_matches(text, '[{}]') THEN 'braces' END,
    CASE WHEN regexp_matches(text, '[*†‡]') THEN 'note_marker' END, CASE WHEN contains(text, '\') THEN 'backslash' END, CASE WHEN regexp_matches(text, '[<>]') THEN 'angle' END], lambda x: x IS NOT NULL)) AS code FROM documents) GROUP BY 1"""
)
def q7_hygiene(spark, d):
    codes = table(spark, d, "documents").select(F.explode(text.hygiene_codes(F.col("text"))).alias("code"))
    kept = codes.where(F.col("code").isin("whitespace", "braces", "note_marker", "backslash", "angle_bracket", "html_tag"))
    return kept.select(F.when(F.col("code").isin("angle_bracket", "html_tag"), "angle").otherwise(F.col("code")).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


INDEX = r"idx AS (SELECT doc_id, unnest(regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+')) AS token FROM documents)"


@query(
    f"""WITH {INDEX}, len AS (SELECT doc_id, count(*) AS l FROM idx GROUP BY 1), c AS (SELECT count(*) AS n, avg(l) AS m FROM len),
    h AS (SELECT doc_id, token, count(*) AS f FROM idx WHERE token IN ('the', 'stupid') GROUP BY 1, 2), df AS (SELECT token, count(*) AS df FROM h GROUP BY 1), whole AS (SELECT doc_id FROM h GROUP BY 1 HAVING count(*) = 2)
    SELECT doc_id, round(-sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * l / m))), 9) AS rank FROM h JOIN whole USING (doc_id) JOIN df USING (token) JOIN len USING (doc_id) CROSS JOIN c GROUP BY 1 ORDER BY rank, doc_id LIMIT 25"""
)
def x2_search(spark, d):
    idx = fulltext.postings(table(spark, d, "documents"), "doc_id", "text")
    return fulltext.search(idx, "the stupid").select("doc_id", F.round("rank", 9).alias("rank"))


@query(
    rf"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\p{{L}}\p{{N}}]+') AS w FROM documents), p AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t)
    SELECT DISTINCT doc_id FROM p WHERE w[i] = 'of' AND w[i + 1] = 'the' AND NOT EXISTS (SELECT 1 FROM t u WHERE u.doc_id = p.doc_id AND len(list_filter(u.w, lambda x: starts_with(x, 'stu'))) > 0)"""
)
def x1_match(spark, d):
    idx = fulltext.postings(table(spark, d, "documents"), "doc_id", "text")
    return fulltext.search(idx, '"of the" NOT stu*', limit=None).select("doc_id")


@query(
    rf"""WITH t AS (SELECT doc_id, lang, regexp_extract_all(lower(strip_accents(text)), '[\p{{L}}\p{{N}}]+') AS w FROM documents), h AS (SELECT doc_id, lang, w, unnest(range(1, len(w) + 1)) AS i FROM t),
    n AS (SELECT DISTINCT a.doc_id FROM h a JOIN h b ON a.doc_id = b.doc_id AND b.w[b.i] = 'of' AND abs(b.i - a.i) BETWEEN 0 AND 4 WHERE a.w[a.i] = 'the')
    SELECT doc_id FROM t WHERE (doc_id IN (SELECT doc_id FROM n) AND NOT list_contains(w, 'is')) OR (lang = 'de' AND (list_contains(w, 'und') OR list_contains(w, 'mit')))"""
)
def x1_nested(spark, d):
    idx = fulltext.columns_postings(table(spark, d, "documents"), "doc_id", ["lang", "text"])
    return fulltext.search(idx, "(NEAR(the of, 3) NOT text: is) OR (lang: de {text}: (und OR mit))", limit=None).select("doc_id")


SNIPPET_SQL = r"""h AS (SELECT doc_id, text, regexp_extract_all(text, '[\p{L}\p{N}]+') AS t, string_split_regex(text, '[\p{L}\p{N}]+') AS s FROM documents WHERE regexp_matches(lower(text), 'stupid') AND regexp_matches(lower(text), 'loser')),
    k AS (SELECT *, list_transform(t, lambda w: CASE WHEN regexp_matches(lower(strip_accents(w)), '^stupid(s|ed|ing)?$') THEN 1 WHEN regexp_matches(lower(strip_accents(w)), '^losers?$') THEN 2 ELSE 0 END) AS c FROM h),
    w AS (SELECT doc_id, unnest(range(0, greatest(1, len(t) - 39))) AS i FROM k), best AS (SELECT doc_id, arg_max(w.i, (len(list_distinct(list_filter(c[w.i + 1 : w.i + 40], lambda x: x > 0))), len(list_filter(c[w.i + 1 : w.i + 40], lambda x: x > 0)), -w.i)) AS i FROM w JOIN k USING (doc_id) WHERE list_contains(c, 1) AND list_contains(c, 2) GROUP BY 1),
    cut AS (SELECT doc_id, CASE WHEN i > 0 THEN '...' ELSE '' END || list_aggregate(list_transform(range(i, least(len(t), i + 40)), lambda j: CASE WHEN j = i AND i > 0 THEN '' ELSE s[j + 1] END || CASE WHEN c[j + 1] > 0 THEN '>>>' || t[j + 1] || '<<<' ELSE t[j + 1] END), 'string_agg', '')
        || CASE WHEN i + 40 >= len(t) THEN s[len(t) + 1] ELSE '...' END AS snippet FROM best JOIN k USING (doc_id)),
    idx AS (SELECT doc_id, unnest(regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+')) AS token FROM documents), len AS (SELECT doc_id, count(*) AS l FROM idx GROUP BY 1), corpus AS (SELECT count(*) AS n, avg(l) AS m FROM len),
    hit AS (SELECT doc_id, CASE WHEN regexp_matches(token, '^stupid(s|ed|ing)?$') THEN 1 ELSE 2 END AS c, count(*) AS f FROM idx WHERE regexp_matches(token, '^stupid(s|ed|ing)?$|^losers?$') GROUP BY 1, 2), df AS (SELECT c, count(*) AS df FROM hit GROUP BY 1)"""


@query(
    f"""WITH {SNIPPET_SQL} SELECT * FROM (SELECT doc_id, round(-sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * l / m))), 9) AS rank FROM hit JOIN df USING (c) JOIN len USING (doc_id) CROSS JOIN corpus
    GROUP BY 1 HAVING count(*) = 2 ORDER BY rank, doc_id LIMIT 25) JOIN cut USING (doc_id)"""
)
def x3_snippets(spark, d):
    docs = table(spark, d, "documents")
    hits = fulltext.search(fulltext.postings(docs, "doc_id", "text", stem=True), "stupid losers", stem=True)
    return fulltext.snippets(hits.join(docs.select("doc_id", "text"), "doc_id"), "text", "stupid losers", stem=True).select("doc_id", F.round("rank", 9).alias("rank"), "snippet")


@query(
    f"""WITH v AS (SELECT {LINE_KEY} AS k FROM lineitem), c AS (SELECT k // 1000000 AS book, (k % 1000000) // 1000 AS chapter, min(k % 1000) AS low, max(k % 1000) AS high FROM v GROUP BY 1, 2),
    b AS (SELECT book, max(chapter) AS m FROM c GROUP BY 1)
    SELECT 'book_out_of_canon' AS code, count(*) AS n FROM b WHERE book > 10 HAVING count(*) > 0 UNION ALL SELECT 'chapter_count_exceeds_canon', count(*) FROM b WHERE book <= 10 AND m > 900 HAVING count(*) > 0
    UNION ALL SELECT 'invalid_chapter', count(*) FROM c WHERE book <= 10 AND chapter < 1 HAVING count(*) > 0 UNION ALL SELECT 'invalid_verse', count(*) FROM c WHERE book <= 10 AND chapter BETWEEN 1 AND 900 AND low < 1 HAVING count(*) > 0
    UNION ALL SELECT 'verse_out_of_canon', count(*) FROM c WHERE book <= 10 AND chapter BETWEEN 1 AND 900 AND high > 6 HAVING count(*) > 0"""
)
def v21_canon(spark, d):
    canon = spark.range(1, 11).select(F.col("id").alias("book")).withColumn("chapter", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(900).cast("long")))).withColumn("max_verse", F.lit(6).cast("long"))
    out = None
    for f in validate.canon_rules(lines(spark, d), canon, "key"):
        out = f if out is None else out.unionByName(f)
    return out.select("code", "n")


@query(
    """SELECT 'inverted_range' AS code, count(*) AS n FROM lineitem WHERE l_partkey < l_suppkey HAVING count(*) > 0 UNION ALL
    SELECT 'null_mandatory_range_end', count(*) FROM lineitem WHERE l_partkey % 97 = 0 HAVING count(*) > 0"""
)
def v15_ranges(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("verse_id_start"), F.col("l_partkey").alias("p"))
    r = r.select("verse_id_start", F.when(F.col("p") % 97 != 0, F.col("p")).alias("verse_id_end"), "p")
    found = validate.range_rules("range_table", r)[0]
    rest = validate.range_rules("range_table", r.select("verse_id_start", F.col("p").alias("verse_id_end")))[0]
    return found.where("code <> 'inverted_range'").unionByName(rest.where("code = 'inverted_range'")).select("code", "n")


@query(
    """SELECT count(*) FILTER (a AND b) AS "both", count(*) FILTER (a AND NOT b) AS source_only, count(*) FILTER (b AND NOT a) AS result_only, round(count(*) FILTER (a AND b) / count(*), 9) AS agreement
    FROM (SELECT o_orderkey, o_totalprice > 200000 AS a, o_orderstatus = 'F' AS b FROM orders) WHERE a OR b"""
)
def j10_red_letters(spark, d):
    o = table(spark, d, "orders")
    out = verify.red_letters(o.withColumn("f", F.col("o_totalprice") > 200000), o.withColumn("f", F.col("o_orderstatus") == "F"), "o_orderkey", "f")
    return out.withColumn("agreement", F.round("agreement", 9))


@query(
    f"""WITH r AS (SELECT {TURN_KEY} AS k, length(replace(text, ' ', '')) AS s, length(text) % 90 + 30 AS o FROM conversations), m AS (SELECT quantile_cont(s / o, 0.5) AS scale FROM r)
    SELECT k AS key, s AS size, round(o * scale, 6) AS expected FROM r, m WHERE s > 3 * o * scale AND s - o * scale > 80"""
)
def q9_overlong(spark, d):
    t = turns(spark, d).select("key", "text")
    other = t.select("key", F.repeat(F.lit("x"), (F.length("text") % 90 + 30).cast("int")).alias("text"))
    out = verify.overlong(t, other, "key")
    return out.select("key", F.col("size").cast("long").alias("size"), F.round("expected", 6).alias("expected"))


@query()
def c5_parse_markup(spark, d):
    p = table(spark, d, "pages").select("page_id", markup.parsed(F.col("html")).alias("p"))
    return p.select("page_id", "p.text", "p.word_count", markup.formatting(F.col("p.block"), F.col("p.spans")).alias("formatting"))


@query(
    r"""WITH r AS (SELECT conv_id * 8 + turn AS i, conv_id % 50 + 1 AS c, turn AS v, trim(regexp_replace(text, '[ \t\n]+', ' ', 'g')) AS t FROM conversations), w AS (SELECT *, len(string_split(t, ' ')) AS n, 1000000 + c * 1000 + least(greatest(v, 1), 6) AS verse_id FROM r WHERE t <> ''),
    o AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY verse_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a FROM w)
    SELECT 'm' AS module, verse_id, string_agg(t, ' ' ORDER BY i) AS text, '{"v":1,"spans":[' || string_agg('{"type":"words_of_christ","start":' || a || ',"end":' || (a + n - 1) || '}', ',' ORDER BY i) || ']' ||
    coalesce(',"source_verses":[' || string_agg('{"chapter":' || c || ',"verse":' || v || ',"start":' || a || ',"end":' || (a + n - 1) || '}', ',' ORDER BY i) FILTER (v > 6) || ']', '') || '}' AS formatting, CAST(sum(n) AS BIGINT) AS word_count FROM o GROUP BY verse_id"""
)
def c9_convert(spark, d):
    c = table(spark, d, "conversations")
    records = c.select(F.lit("m").alias("module"), F.expr("conv_id * 8 + turn").alias("i"), F.lit("Gen").alias("osis"), (F.col("conv_id") % 50 + 1).cast("int").alias("c"), F.col("turn").cast("int").alias("v"), F.concat(F.lit("<q who='Jesus'>"), "text", F.lit("</q>")).alias("raw"))
    canon = spark.range(1, 51).select(F.lit(1).cast("long").alias("book"), F.col("id").alias("chapter"), F.lit(6).cast("long").alias("max_verse"))
    return convert.bible_tables(records, canon)["bible_verse"]


@query(
    """WITH p AS (SELECT page_id AS n, (page_id // 998001 + 1) * 1000000 + (page_id // 999 % 999 + 1) * 1000 AS chapter, page_id % 999 + 1 AS v FROM pages),
    l AS (SELECT n, chapter, v, unnest([(1, chapter + 35, chapter + 39), (2, chapter // 1000000 * 1000000 + 5003, chapter // 1000000 * 1000000 + 5003), (3, chapter // 1000000 * 1000000 + 5004, chapter // 1000000 * 1000000 + 5004), (4, 1050020, 1050020), (5, 65001003, 65001003)]) AS x FROM p)
    SELECT (chapter + v) || ':0' AS group_key, x[1] AS sort_order, x[2] AS verse_id_start, x[3] AS verse_id_end, 'phrase ' || n AS context FROM l"""
)
def c19_import_xrefs(spark, d):
    # Every page is an entry of its own: page_id spread over book, chapter and verse; its html, then a list of references.
    n = F.col("page_id")
    key = keys.pack(F.expr("page_id div 998001 + 1"), F.expr("page_id div 999 % 999 + 1"), n % 999 + 1)
    listed = F.concat(F.lit("<br/>phrase "), n.cast("string"), F.lit("<br/><a href='x'>35-39; 5:3,4; Gen 50:20</a><br/><a>Jude 3</a>"))
    p = table(spark, d, "pages").select(key.alias("verse_id"), F.concat(F.coalesce("html", F.lit("")), listed).alias("content"))
    return xrefs.link_rows(xrefs.group_rows(xrefs.parse_entries(p, "verse_id", "content"), "verse_id"))


@query("SELECT date_part('year', o_orderdate)::BIGINT AS year, count(*) AS n, CAST(sum(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) AS BIGINT) AS days FROM orders GROUP BY 1")
def a7_counters(spark, d):
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum(day("o_orderdate")).alias("days"))


@query(
    """WITH e AS (SELECT n_nationkey AS book, 60 AS expected FROM nation), p AS (SELECT c_nationkey AS book, count(DISTINCT c_custkey % 60) AS present FROM customer GROUP BY 1)
    SELECT CAST(book + 1 AS BIGINT) AS book, CAST(60 AS BIGINT) AS expected, coalesce(present, 0) AS present, coalesce(present, 0) > 0 AND coalesce(present, 0) < 54 AS partial FROM e LEFT JOIN p USING (book)"""
)
def a8_presence(spark, d):
    canon = table(spark, d, "nation").select((F.col("n_nationkey") + 1).cast("long").alias("book"), F.lit(1).cast("long").alias("chapter"), F.lit(60).cast("long").alias("max_verse"))
    c = table(spark, d, "customer").select(keys.pack(F.col("c_nationkey") + 1, F.lit(1), F.col("c_custkey") % 60 + 1).alias("verse_id"))
    return verify.presence(c, canon)
