"""Bindings of stored things to the driver's tables: text indexes, module files, published tables, the check of a library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..library import Held, run_command
from ..operators import libcheck, textindex, validate
from ..sources import shared, sqlite, sqlite_sink
from .commands import ORDER_KEY, library
from .registry import query, table

# Text index -----------------------------------------------------------------------

#: BM25 over ``idx`` (doc_id, token), ``docs`` (doc_id) and ``hit`` (doc_id, c, f): all documents count, with or without tokens.
BM25 = """len AS (SELECT doc_id, count(*) AS l FROM idx GROUP BY 1), corpus AS (SELECT (SELECT count(*) FROM docs) AS n, (SELECT count(*) FROM idx) / (SELECT count(*) FROM docs) AS m), df AS (SELECT c, count(*) AS df FROM hit GROUP BY 1)"""
RANK = "-sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * l / m)))"
TOKENS = r"regexp_extract_all(lower(strip_accents({})), '[\p{{L}}\p{{N}}]+')"


def updated_index(spark, d) -> textindex.TextIndex:
    """An index of other texts, brought up to the documents but every fifth; those were in it at first."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    kind = F.col("doc_id") % 5
    old = docs.where(kind != 1).withColumn("text", F.when(kind == 2, F.concat(F.lit("stupid the the old "), F.substring("text", 1, 50))).otherwise(F.col("text")))
    index = textindex.build(old, "doc_id", ["text", "lang"], shared.scratch(spark, "index"), stem=False)
    return index.update(docs.where(kind.isin(1, 2)), docs.where(kind == 3))


SEARCHED = f"""docs AS (SELECT doc_id, text, lang FROM documents WHERE doc_id % 5 <> 3), idx AS (SELECT doc_id, unnest({TOKENS.format("text")}) AS token, 'text' AS col FROM docs UNION ALL SELECT doc_id, unnest({TOKENS.format("lang")}), 'lang' FROM docs)"""


@query(
    f"""WITH {SEARCHED}, hit AS (SELECT doc_id, token AS c, count(*) AS f FROM idx WHERE token IN ('the', 'stupid') GROUP BY 1, 2), {BM25}, whole AS (SELECT doc_id FROM hit GROUP BY 1 HAVING count(*) = 2)
    SELECT doc_id, round({RANK}, 9) AS rank FROM hit JOIN whole USING (doc_id) JOIN df USING (c) JOIN len USING (doc_id) CROSS JOIN corpus GROUP BY 1 ORDER BY rank, doc_id LIMIT 25"""
)
def x7_updated_index(spark, d):
    return textindex.search(updated_index(spark, d), "the stupid").select("doc_id", F.round("rank", 9).alias("rank"))


@query(
    f"""WITH {SEARCHED}, w AS (SELECT doc_id, {TOKENS.format("text")} AS w FROM docs), p AS (SELECT doc_id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS f FROM w), hit AS (SELECT doc_id, 'phrase' AS c, f FROM p WHERE f > 0
    UNION ALL SELECT doc_id, 'prefix', count(*) FROM idx WHERE col = 'lang' AND starts_with(token, 'e') GROUP BY 1), {BM25}, whole AS (SELECT doc_id FROM hit GROUP BY 1 HAVING count(*) = 2 AND doc_id NOT IN (SELECT doc_id FROM idx WHERE token = 'stupid'))
    SELECT doc_id, round({RANK}, 9) AS rank FROM hit JOIN whole USING (doc_id) JOIN df USING (c) JOIN len USING (doc_id) CROSS JOIN corpus GROUP BY 1"""
)
def x8_compacted_columns(spark, d):
    index = updated_index(spark, d).compact()
    return textindex.search(index, 'text: "of the" AND lang: e* NOT stupid', limit=None).select("doc_id", F.round("rank", 9).alias("rank"))


#: Rows of the modules that are searched, by what the reader sees first.
MODULES = """parts AS (SELECT p_partkey AS k, p_name AS a, p_brand AS b FROM part), places AS (SELECT r_regionkey + 1 AS k, r_name AS a, '' AS b FROM region UNION ALL SELECT n_nationkey + 101, n_name, '' FROM nation UNION ALL SELECT c_custkey + 1001, c_name, '' FROM customer)"""


def _module_search(name: str, rows: str, columns: str, tests: dict[str, str]) -> str:
    hits = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS c, count(*) AS f FROM idx WHERE {test} GROUP BY 1" for c, test in tests.items())
    return f"""SELECT * FROM (WITH docs AS (SELECT k AS doc_id FROM {rows}), idx AS (SELECT k AS doc_id, unnest({TOKENS.format(columns)}) AS token FROM {rows}), hit AS ({hits}), {BM25}
    SELECT '{name}' AS module, doc_id AS k, round({RANK}, 9) AS rank FROM hit JOIN df USING (c) JOIN len USING (doc_id) CROSS JOIN corpus GROUP BY 2 HAVING count(*) = {len(tests)} ORDER BY rank, k LIMIT 30)"""


@query(
    f"""WITH {MODULES} SELECT h.module, h.k, h.rank, parts.a AS shown, regexp_replace(b, '(?i)(brand)', '>>>\\1<<<') AS snippet FROM ({_module_search("dictionary_parts", "parts", "a || ' ' || b", {"w": "regexp_matches(token, '^widget(s|ed|ing)?$')", "b": "token = 'brand'"})}) h JOIN parts USING (k)
    UNION ALL SELECT h.module, h.k, h.rank, a, regexp_replace(a, '(?i)(nation)', '>>>\\1<<<') FROM ({_module_search("book_places", "places", "a || ' ' || a", {"w": "regexp_matches(token, '^nation(s|ed|ing)?$')"})}) h JOIN places USING (k)
    UNION ALL SELECT h.module, h.k, h.rank, a, CASE WHEN k > 1000 THEN (SELECT n_name FROM nation JOIN customer ON n_nationkey = c_nationkey WHERE c_custkey = h.k - 1001) END FROM ({_module_search("topical_places", "places", "a", {"w": "regexp_matches(token, '^customer(s|ed|ing)?$')"})}) h JOIN places USING (k)"""
)
def cmd_search(spark, d):
    """A dictionary through a stored index, a book's sections and topics without one: snippets, titles, parents."""
    lib = library(spark, d)
    stored = Held(spark, lib.modules, indexes=shared.scratch(spark, "indexes"))
    run_command(stored, "index", ["parts"])
    c = F.col
    one = run_command(stored, "search", ["parts", "widgets brand"], {"limit": "30"}).select(F.lit("dictionary_parts").alias("module"), c("entry_id").alias("k"), "rank", c("word").alias("shown"), "snippet")
    two = run_command(lib, "search", ["book_places", "nations"], {"limit": "30"}).select(F.lit("book_places").alias("module"), c("section_id").alias("k"), "rank", c("title").alias("shown"), "snippet")
    three = run_command(lib, "search", ["topical_places", "customer"], {"limit": "30"}).select(F.lit("topical_places").alias("module"), c("topic_id").alias("k"), "rank", c("name").alias("shown"), c("parent_name").alias("snippet"))
    return one.unionByName(two).unionByName(three).withColumn("rank", F.round("rank", 9))


# Module files -----------------------------------------------------------------------


def local_path(url: str) -> str:
    """A path that files are opened by: the shared folder, mounted on every executor."""
    if ":" in url.split("/", 1)[0] and not url.startswith("file:"):
        raise ValueError(f"module files need a mounted folder, not {url}")
    return "/" + url.removeprefix("file:").lstrip("/")


def customer_modules(spark, d) -> tuple[str, DataFrame]:
    """A module file for each nation: its customers and their orders."""
    folder = local_path(shared.scratch(spark, "modules"))
    module = F.concat(F.lit("bible_n"), F.col("c_nationkey").cast("string"))
    c = table(spark, d, "customer").select(module.alias("module"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").cast("double").alias("balance"), (F.col("c_acctbal") > 0).alias("paid"))
    o = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey", module.alias("module")), F.col("o_custkey") == F.col("c_custkey"))
    orders = o.select("module", F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("text"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("customer"))
    status = table(spark, d, "nation").select(F.concat(F.lit("bible_n"), F.col("n_nationkey").cast("string")).alias("module"), F.when(F.col("n_nationkey") % 4 == 0, "PASS").otherwise("WARN").alias("status"))
    ddl = {"customer": ["CREATE TABLE customer (id INTEGER PRIMARY KEY, name TEXT NOT NULL, balance REAL, paid INTEGER)"], "orders": ["CREATE TABLE orders (id INTEGER PRIMARY KEY, text TEXT, customer INTEGER)"]}
    sqlite_sink.write_modules({"customer": c, "orders": orders}, folder, ddl=ddl, after={"orders": ["CREATE INDEX by_customer ON orders (customer)"]}, status=status, keep="flagged")
    return folder, status


@query("SELECT 'bible_n' || c_nationkey AS module, c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(c_acctbal > 0 AS BIGINT) AS paid FROM customer WHERE c_nationkey % 4 <> 0")
def k1_module_files(spark, d):
    folder, _ = customer_modules(spark, d)
    return sqlite.read_table(spark, folder, "customer", module="module")


@query("SELECT 'bible_n' || c_nationkey AS module, o_orderkey AS id, o_orderpriority AS text FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (5, 6) AND o_orderkey BETWEEN 100 AND 4000 AND o_orderkey % 3 > 0 AND o_custkey > 20")
def s3_pushed_ranges(spark, d):
    folder, _ = customer_modules(spark, d)
    rows = sqlite.read_table(spark, folder, "orders", module="module")
    return rows.where("module IN ('bible_n5', 'bible_n6') AND id BETWEEN 100 AND 4000 AND customer > 20").select("module", "id", "text")


@query(
    """SELECT 'bible_n' || n_nationkey AS module, 'customer: id, name, balance, paid; orders: id, text, customer' AS tables, 'by_customer' AS indexes FROM nation WHERE n_nationkey % 4 <> 0 AND n_nationkey IN (SELECT c_nationkey FROM customer)"""
)
def s1_catalog(spark, d):
    folder, _ = customer_modules(spark, d)
    known = sqlite.catalog(spark, folder)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("tables")), lambda t: F.concat(t["key"], F.lit(": "), F.array_join(t["value"], ", "))), "; ")
    return known.select("module", shown.alias("tables"), F.array_join("indexes", ", ").alias("indexes"))


# Publication -----------------------------------------------------------------------


@query(
    f"""SELECT 2 AS version, (SELECT count(*) FROM customer) AS "groups", (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) AS links, (SELECT CAST(sum({ORDER_KEY}) AS BIGINT) FROM orders WHERE o_orderkey % 5 = 0) AS keys, '' AS wrong"""
)
def k6_published_xrefs(spark, d):
    """Cross-reference tables as a second version; one that does not follow the first is refused."""
    tables = library(spark, d).modules["cross_reference_orders"]
    path = shared.scratch(spark, "published")
    shared.publish(spark, {"verse_link": tables["verse_link"].limit(0), "cross_reference_group": tables["cross_reference_group"].limit(0)}, path)
    links = tables["verse_link"].where("source_type = 'cross_reference'")
    version = shared.publish(spark, {"verse_link": links, "cross_reference_group": tables["cross_reference_group"]}, path, force=True, expect=1)
    now = shared.published(spark, path)
    counts = shared.history(spark, path)[-1]["counts"]
    return now["verse_link"].agg(F.sum("verse_id_start").alias("keys")).select(
        F.lit(version).alias("version"), F.lit(counts["cross_reference_group"]).alias("groups"), F.lit(counts["verse_link"]).alias("links"), "keys", F.lit(", ".join(shared.verify_published(spark, path))).alias("wrong")
    )


# The check of a library ----------------------------------------------------------------

GOOD = "12345678-1234-4234-8234-123456789abc"


def customer_library(spark, d) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """A module for each customer, with faults by the number's remainders; its orders are verses and links."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    k = F.col("k")
    name = F.concat(F.when(k % 10 == 7, "odd_").when(k % 10 == 6, "book_").otherwise("bible_"), k.cast("string"))
    names = lambda *x: F.array(*map(F.lit, x))
    info = names("info_id", *[i for i in validate.INFO_COLUMNS if i != "source_url"])
    entry = lambda n, cols: F.struct(F.lit(n).alias("key"), cols.alias("value"))
    bible = F.array(
        entry("bible_verse", names("verse_id", "text", "word_count")), entry("bible_verse_fts", F.when(k % 17 == 0, names("text", "verse_id")).otherwise(names("verse_id", "text"))),
        entry("module_info", F.when(k % 3 == 0, info).otherwise(F.concat(info, names("source_url")))), entry("verse_link", names("verse_id_start", "verse_id_end")),
    )
    schema = F.array(entry("schema_version", names("version")))
    tables = (
        F.when(k % 10 >= 8, F.create_map().cast("map<string,array<string>>")).when(k % 10 == 7, F.map_from_entries(F.array(entry("notes", names("id", "start_verse_id")))))
        .when(k % 10 == 6, F.map_from_entries(F.array(entry("notes", names("id"))))).when(k % 4 == 1, F.map_from_entries(bible)).otherwise(F.map_from_entries(F.concat(bible, schema)))
    )
    indexes = F.slice(names(*libcheck.LINK_INDEXES), F.lit(1), F.when(k % 5 == 2, 2).otherwise(4))
    catalog = c.select(name.alias("module"), F.concat("k", F.lit(".db")).alias("file"), tables.alias("tables"), indexes.alias("indexes"), F.when(k % 10 == 9, "not a database").alias("error"))
    real = c.where(k % 10 <= 5).withColumn("module", name)
    uuid = F.when(k % 11 == 0, "").when(k % 13 == 0, "bad").otherwise(GOOD)
    row = real.select("module", F.explode(F.when(k % 6 == 0, F.array().cast("array<int>")).when(k % 6 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("info_id"), uuid.alias("module_uuid"), F.when(k % 7 == 0, "kjv").otherwise("kjv-english").alias("versification"))
    o = table(spark, d, "orders").join(real, F.col("o_custkey") == k)
    n = F.col("o_orderkey")
    text = F.when(n % 19 == 0, "a <b> c").when(n % 23 == 0, "¶ a b").when(n % 29 == 0, "a \\ b").otherwise("some plain words")
    verses = o.select("module", ((n % 3 + 1) * 1000000 + n % 4 * 1000 + n % 9).alias("verse_id"), text.alias("text"), F.when(n % 31 == 0, 2).otherwise(3).alias("word_count"))
    links = o.select("module", n.alias("verse_id_start"), F.when(n % 37 > 0, n - F.when(n % 41 == 0, 1).otherwise(0)).alias("verse_id_end"))
    version = real.where((k % 4 != 1) & (k % 8 != 3)).select("module", F.lit(1).alias("version"))
    canon = spark.range(1, 3).select(F.col("id").alias("book"), F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("chapter"), F.lit(7).cast("long").alias("max_verse"))
    return catalog, {"module_info": row, "bible_verse": verses, "verse_link": links, "schema_version": version}, canon


LIBRARY = """m AS (SELECT c_custkey AS k, CASE c_custkey % 10 WHEN 7 THEN 'odd_' WHEN 6 THEN 'book_' ELSE 'bible_' END || c_custkey AS module, c_custkey % 10 AS t FROM customer), r AS (SELECT * FROM m WHERE t <= 5), i AS (SELECT * FROM r WHERE k % 6 <> 0),
    o AS (SELECT module, o_orderkey AS n, (o_orderkey % 3 + 1) AS book, o_orderkey % 4 AS c, o_orderkey % 9 AS v FROM orders JOIN r ON o_custkey = k), p AS (SELECT module, book, c, min(v) AS low, max(v) AS high FROM o GROUP BY 1, 2, 3),
    f AS (SELECT module, 'validation_error' AS code, 'error' AS severity, 1 AS n FROM m WHERE t = 9 UNION ALL SELECT module, 'empty_database', 'error', 1 FROM m WHERE t = 8 UNION ALL SELECT module, 'unknown_module_type', 'error', 1 FROM m WHERE t = 7
    UNION ALL SELECT module, 'missing_content_table', 'error', 1 FROM m WHERE t = 6 UNION ALL SELECT module, 'missing_module_info', 'error', 1 FROM m WHERE t IN (6, 7) UNION ALL SELECT module, 'missing_required_table', 'error', 1 FROM m WHERE t IN (6, 7) UNION ALL SELECT module, 'missing_required_table', 'error', 1 FROM m WHERE t IN (6, 7)
    UNION ALL SELECT module, 'missing_required_table', 'error', 1 FROM r WHERE k % 4 = 1 UNION ALL SELECT module, 'forbidden_range_column', 'error', 1 FROM m WHERE t = 7 UNION ALL SELECT module, 'missing_verse_link_index', 'error', 2 FROM r WHERE k % 5 = 2 UNION ALL SELECT module, 'fts_column_order', 'error', 1 FROM r WHERE k % 17 = 0
    UNION ALL SELECT module, 'missing_module_info_row', 'error', 1 FROM r WHERE k % 6 = 0 UNION ALL SELECT module, 'multiple_module_info_rows', 'warn', 2 FROM i WHERE k % 6 = 1 UNION ALL SELECT module, 'missing_info_columns', 'error', 1 FROM i WHERE k % 3 = 0 UNION ALL SELECT module, 'wrong_versification', 'error', 1 FROM i WHERE k % 7 = 0
    UNION ALL SELECT module, 'missing_module_uuid', 'error', 1 FROM i WHERE k % 11 = 0 UNION ALL SELECT module, 'invalid_module_uuid', 'error', 1 FROM i WHERE k % 13 = 0 AND k % 11 <> 0 UNION ALL SELECT module, 'empty_schema_version', 'error', 1 FROM r WHERE k % 4 <> 1 AND k % 8 = 3
    UNION ALL SELECT module, 'empty_bible', 'error', 1 FROM r WHERE module NOT IN (SELECT module FROM o) UNION ALL SELECT module, 'bible_text_html', 'error', count(*) FROM o WHERE n % 19 = 0 GROUP BY 1 UNION ALL SELECT module, 'bible_text_pilcrow', 'error', count(*) FROM o WHERE n % 23 = 0 AND n % 19 <> 0 GROUP BY 1
    UNION ALL SELECT module, 'bible_text_backslash', 'error', count(*) FROM o WHERE n % 29 = 0 AND n % 23 <> 0 AND n % 19 <> 0 GROUP BY 1 UNION ALL SELECT module, 'word_count_mismatch', 'error', count(*) FROM o WHERE n % 31 = 0 GROUP BY 1
    UNION ALL SELECT module, 'null_mandatory_range_end', 'error', count(*) FROM o WHERE n % 37 = 0 GROUP BY 1 UNION ALL SELECT module, 'null_verse_link_end', 'error', count(*) FROM o WHERE n % 37 = 0 GROUP BY 1 UNION ALL SELECT module, 'inverted_range', 'error', count(*) FROM o WHERE n % 41 = 0 AND n % 37 <> 0 GROUP BY 1
    UNION ALL SELECT module, CASE WHEN s >= 0.8 THEN 'content_corrupt' ELSE 'content_thin' END, CASE WHEN s >= 0.8 THEN 'error' ELSE 'warn' END, x FROM (SELECT module, count(*) FILTER (n % 19 = 0 OR n % 23 = 0 OR n % 29 = 0) AS x, x / count(*) AS s FROM o GROUP BY 1) WHERE s >= 0.2
    UNION ALL SELECT module, 'book_out_of_canon', 'error', count(DISTINCT book) FROM p WHERE book = 3 GROUP BY 1 UNION ALL SELECT module, 'chapter_count_exceeds_canon', 'error', count(DISTINCT book) FROM p WHERE book < 3 AND c > 2 GROUP BY 1
    UNION ALL SELECT module, 'invalid_chapter', 'error', count(*) FROM p WHERE book < 3 AND c < 1 GROUP BY 1 UNION ALL SELECT module, 'invalid_verse', 'error', count(*) FROM p WHERE book < 3 AND c IN (1, 2) AND low < 1 GROUP BY 1
    UNION ALL SELECT module, 'verse_out_of_canon', 'error', count(*) FROM p WHERE book < 3 AND c IN (1, 2) AND high > 7 GROUP BY 1)"""


@query(f"WITH {LIBRARY} SELECT module, code, severity, CAST(n AS BIGINT) AS n FROM f")
def v22_library(spark, d):
    return libcheck.findings(*customer_library(spark, d)).select("module", "code", "severity", "n")


@query(
    f"""WITH {LIBRARY}, g AS (SELECT module, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warn') AS warnings FROM f GROUP BY 1)
    SELECT module, CASE WHEN t <= 5 THEN 'bible' WHEN t = 6 THEN 'book' END AS module_type, coalesce(errors, 0) = 0 AS ok, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings FROM m LEFT JOIN g USING (module)"""
)
def v1_verdicts(spark, d):
    catalog, tables, canon = customer_library(spark, d)
    return libcheck.verdicts(catalog, libcheck.findings(catalog, tables, canon))
