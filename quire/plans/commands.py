"""Bindings of the commands, the converter's tables and the reference parser to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, refs, text
from ..library import Held, Library, run_command
from ..operators import convert, lookup
from .keyed import TREE, TURN_KEY, geography, turns
from .registry import query, table

NAMES = "names AS (SELECT * FROM (VALUES " + ", ".join(f"({b.number}, '{b.short}')" for b in refs.standard_books()) + ") AS t(b, short))"
#: Keys of orders: book by thousands, chapter by twenties.
ORDER_KEY = "((o_orderkey // 1000 + 1) * 1000000 + (o_orderkey % 1000) // 20 * 1000 + o_orderkey % 20 + 1)"
SHAPES = f"""{NAMES}, {TREE}, bible_verse AS (SELECT {TURN_KEY} AS verse_id, text FROM conversations),
    commentary_entry AS (SELECT o_orderkey AS entry_id, {ORDER_KEY} AS verse_id_start, {ORDER_KEY} + o_orderkey % 4 AS verse_id_end, CASE o_orderkey % 3 WHEN 0 THEN 'book' WHEN 1 THEN 'chapter' ELSE 'verse' END AS entry_level, o_orderpriority AS content FROM orders),
    topic AS (SELECT id AS topic_id, up AS parent_topic_id, name, id % 7 AS sort_order FROM tree),
    verse_link AS (SELECT o_orderkey + 1 AS link_id, CASE o_orderkey % 5 WHEN 0 THEN 'cross_reference' WHEN 1 THEN 'book_section' ELSE 'topic' END AS source_type,
        CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 25 + 101 ELSE o_custkey + 1001 END AS source_id, {ORDER_KEY} AS verse_id_start, {ORDER_KEY} + o_orderkey % 3 AS verse_id_end, o_orderkey % 6 AS sort_order FROM orders),
    cross_reference_group AS (SELECT c_custkey + 1001 AS group_id, (c_custkey // 100 + 1) * 1000000 + (c_custkey % 100) // 10 * 1000 + c_custkey % 10 + 1 AS verse_id_start,
        (c_custkey // 100 + 1) * 1000000 + (c_custkey % 100) // 10 * 1000 + c_custkey % 10 + 1 + c_custkey % 3 AS verse_id_end, c_name AS phrase, c_custkey % 5 AS sort_order FROM customer),
    book_section AS (SELECT id AS section_id, up AS parent_section_id, (id % 3) || '.' || (id % 13) AS section_number, id % 11 AS sort_order, name AS title FROM tree)"""


def _point(key: str) -> str:
    return f"(SELECT short FROM names WHERE b = {key} // 1000000) || ' ' || ({key} // 1000 % 1000) || ':' || ({key} % 1000)"


def _ref(start: str, end: str) -> str:
    return f"CASE WHEN {start} = {end} THEN {_point(start)} ELSE {_point(start)} || '-' || {_point(end)} END"


def library(spark, d) -> Held:
    """The driver's tables as modules of every type."""
    k, o, c, n = F.col("o_orderkey"), table(spark, d, "orders"), table(spark, d, "customer"), F.col("c_custkey")
    at = keys.pack(F.expr("o_orderkey div 1000 + 1"), F.expr("o_orderkey % 1000 div 20"), k % 20 + 1)
    group = keys.pack(F.expr("c_custkey div 100 + 1"), F.expr("c_custkey % 100 div 10"), n % 10 + 1)
    tree = geography(spark, d)
    entries = o.select(k.alias("entry_id"), at.alias("verse_id_start"), (at + k % 4).alias("verse_id_end"), F.when(k % 3 == 0, "book").when(k % 3 == 1, "chapter").otherwise("verse").alias("entry_level"), F.col("o_orderpriority").alias("content"))
    source = F.when(k % 5 == 0, "cross_reference").when(k % 5 == 1, "book_section").otherwise("topic")
    link = o.select((k + 1).alias("link_id"), source.alias("source_type"), F.when(k % 3 == 0, F.col("o_custkey") % 25 + 101).otherwise(F.col("o_custkey") + 1001).alias("source_id"), at.alias("verse_id_start"), (at + k % 3).alias("verse_id_end"), (k % 6).alias("sort_order"))
    topic = tree.select(F.col("id").alias("topic_id"), F.col("up").alias("parent_topic_id"), "name", (F.col("id") % 7).alias("sort_order"))
    groups = c.select((n + 1001).alias("group_id"), group.alias("verse_id_start"), (group + n % 3).alias("verse_id_end"), F.col("c_name").alias("phrase"), (n % 5).alias("sort_order"))
    number = F.concat_ws(".", (F.col("id") % 3).cast("string"), (F.col("id") % 13).cast("string"))
    sections = tree.select(F.col("id").alias("section_id"), F.col("up").alias("parent_section_id"), number.alias("section_number"), (F.col("id") % 11).alias("sort_order"), F.col("name").alias("title"), F.col("name").alias("content"))
    p, q = F.col("p_partkey"), table(spark, d, "documents")
    words = table(spark, d, "part").select(p.alias("entry_id"), F.concat(F.lit("K"), p.cast("string")).alias("entry_key"), F.col("p_name").alias("word"), F.col("p_brand").alias("definition"))
    days = q.select(F.col("doc_id").alias("entry_id"), (F.col("doc_id") + 1).alias("day_number"), F.concat(F.lit("Day "), F.col("doc_id").cast("string")).alias("date_label"))
    info = table(spark, d, "region").where("r_regionkey = 1").select(F.lit(1).alias("info_id"), F.col("r_name").alias("abbreviation"), F.lit('{"a": 1}').alias("metadata"))
    return Held(spark, {
        "bible_turns": {"bible_verse": turns(spark, d).select(F.col("key").alias("verse_id"), "text"), "module_info": info}, "commentary_orders": {"commentary_entry": entries}, "dictionary_parts": {"dictionary_entry": words},
        "devotional_days": {"devotional_entry": days}, "topical_places": {"topic": topic, "verse_link": link}, "cross_reference_orders": {"cross_reference_group": groups, "verse_link": link},
        "book_places": {"book_section": sections, "verse_link": link},
    })


def one_row(spark, values: dict) -> DataFrame:
    """Text values as a table of one row; nulls stay."""
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in values.values())], ", ".join(f"`{k}` string" for k in values))


# Commands -------------------------------------------------------------------------


@query("SELECT 'bible_n' || n_nationkey AS module, true AS sized FROM nation WHERE n_nationkey % 4 <> 0 AND n_nationkey IN (SELECT c_nationkey FROM customer)")
def cmd_modules(spark, d):
    """The folder of module files that are made of customers and orders."""
    from .stored import customer_modules

    found = run_command(Library(spark, customer_modules(spark, d)[0]), "modules", [], {"type": "bible"})
    return found.select("module", (F.col("size_mb") >= 0).alias("sized"))


@query("SELECT '1' AS info_id, r_name AS abbreviation, '{\"a\":1}' AS metadata, 'bible_turns' AS _file FROM region WHERE r_regionkey = 1")
def cmd_info(spark, d):
    return one_row(spark, run_command(library(spark, d), "info", ["bible_turns"]))


@query(
    """SELECT * FROM (VALUES ('customer', 'id INTEGER key, name TEXT required, balance REAL, paid INTEGER'), ('orders', 'id INTEGER key, text TEXT, customer INTEGER')) AS t(table_name, names) WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 5)"""
)
def cmd_schema(spark, d):
    """Tables of one of the files that are made of customers and orders, as the file declares them."""
    from .stored import customer_modules

    found = run_command(Library(spark, customer_modules(spark, d)[0]), "schema", ["n5"])
    shown = lambda c: f"{c['name']} {c['type']}" + (" key" if c["pk"] else "") + (" required" if c["notnull"] else "")
    return spark.createDataFrame([(n, ", ".join(map(shown, t["columns"]))) for n, t in found.items()], "table_name string, names string")


@query("SELECT 'topic' AS table_name, (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'verse_link', count(*) FROM orders")
def cmd_tables(spark, d):
    return run_command(library(spark, d), "tables", ["topical_places"])


@query(
    f"""WITH {SHAPES} SELECT (SELECT count(*) FROM bible_verse) AS verses, (SELECT count(DISTINCT verse_id // 1000000) FROM bible_verse) AS books, (SELECT count(*) FROM topic) AS topics,
    (SELECT count(*) FROM topic WHERE parent_topic_id IS NULL) AS roots, (SELECT count(*) FROM topic WHERE parent_topic_id IS NOT NULL) AS subs, (SELECT count(*) FROM verse_link WHERE source_type = 'topic') AS links,
    (SELECT count(*) FROM cross_reference_group) AS "groups", (SELECT count(*) FROM verse_link WHERE source_type = 'cross_reference') AS "references", (SELECT count(*) FROM commentary_entry) AS entries,
    (SELECT count(*) FROM commentary_entry WHERE entry_level = 'verse') AS verse_entries"""
)
def cmd_stats(spark, d):
    lib, all_ = library(spark, d), {}
    for module in ("bible_turns", "topical_places", "cross_reference_orders", "commentary_orders"):
        all_ |= run_command(lib, "stats", [module])
    all_["verse_entries"] = all_.pop("levels").get("verse", 0)
    all_.pop("type")
    return spark.createDataFrame([tuple(all_.values())], ", ".join(f"`{k}` long" for k in all_))


@query("SELECT entry_level, count(*) AS n FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'book' WHEN 1 THEN 'chapter' ELSE 'verse' END AS entry_level FROM orders) GROUP BY 1")
def cmd_sql(spark, d):
    return run_command(library(spark, d), "sql", ["commentary_orders", "SELECT entry_level, count(*) AS n FROM commentary_entry GROUP BY entry_level"])


@query(f"WITH {SHAPES} SELECT verse_id, {_point('verse_id')} AS ref, text FROM bible_verse WHERE verse_id BETWEEN 1005001 AND 1005003")
def cmd_verse(spark, d):
    return run_command(library(spark, d), "verse", ["turns", "Genesis 5:1-3"])


@query(f"WITH {SHAPES} SELECT verse_id, {_point('verse_id')} AS ref, text FROM bible_verse WHERE verse_id IN (1005001, 1007002, 1009000)")
def cmd_verse_lookup(spark, d):
    return run_command(library(spark, d), "verse-lookup", ["turns", "1005001", "x", "1007002", "1009000"])


@query(f"WITH {SHAPES} SELECT *, {_ref('first_key', 'last_key')} AS ref FROM (SELECT verse_id // 1000000 AS book, verse_id // 1000 % 1000 AS chapter, count(*) AS n, min(verse_id) AS first_key, max(verse_id) AS last_key FROM bible_verse WHERE verse_id // 1000000 = 1 GROUP BY 1, 2)")
def cmd_chapters(spark, d):
    return run_command(library(spark, d), "chapters", ["turns", "genesis"])


@query(f"WITH {SHAPES} SELECT *, {_ref('verse_id_start', 'verse_id_end')} AS ref FROM commentary_entry WHERE verse_id_start <= 2003007 AND verse_id_end >= 2003005")
def cmd_commentary(spark, d):
    return run_command(library(spark, d), "commentary", ["orders", "Exod 3:5-7"])


WORDS_SQL = "(SELECT p_partkey AS entry_id, 'K' || p_partkey AS entry_key, p_name AS word, p_brand AS definition FROM part)"


@query(
    f"""SELECT 'k7' AS term, * FROM {WORDS_SQL} WHERE entry_key = 'K7' UNION ALL SELECT 'RED Widget', * FROM (SELECT * FROM {WORDS_SQL} WHERE word = 'red widget' ORDER BY entry_id LIMIT 1)
    UNION ALL SELECT 'idge', * FROM (SELECT * FROM {WORDS_SQL} WHERE contains(word, 'idge') ORDER BY entry_id LIMIT 5)"""
)
def cmd_define(spark, d):
    lib, out = library(spark, d), None
    for term in ("k7", "RED Widget", "idge"):
        one = run_command(lib, "define", ["parts", term]).select(F.lit(term).alias("term"), "entry_id", "entry_key", "word", "definition")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT label, doc_id AS entry_id, doc_id + 1 AS day_number, 'Day ' || doc_id AS date_label FROM documents JOIN (VALUES ('7', 6), ('DAY 12', 12)) AS t(label, wanted) ON doc_id = wanted")
def cmd_devotional(spark, d):
    lib, out = library(spark, d), None
    for label in ("7", "DAY 12"):
        one = run_command(lib, "devotional", ["days", label]).select(F.lit(label).alias("label"), "entry_id", "day_number", "date_label")
        out = one if out is None else out.unionByName(one)
    return out


COUNTED = "(SELECT count(*) FROM topic c WHERE c.parent_topic_id = t.topic_id) AS child_count, (SELECT count(*) FROM verse_link WHERE source_type = 'topic' AND source_id = t.topic_id) AS verse_count"


@query(f"WITH {SHAPES} SELECT *, {COUNTED} FROM topic t WHERE parent_topic_id = 2 ORDER BY sort_order, name, topic_id LIMIT 3 OFFSET 1")
def cmd_topics(spark, d):
    return run_command(library(spark, d), "topics", ["places"], {"parent": "2", "limit": "3", "offset": "1"})


@query(
    f"""WITH {SHAPES}, l AS (SELECT *, {_ref("verse_id_start", "verse_id_end")} AS ref FROM verse_link WHERE source_type = 'topic' AND source_id = 103)
    SELECT CAST(topic_id AS VARCHAR) AS topic_id, name, (SELECT name FROM topic u WHERE u.topic_id = t.parent_topic_id) AS breadcrumb, (SELECT string_agg(topic_id, ', ' ORDER BY sort_order, topic_id) FROM topic WHERE parent_topic_id = 103) AS children,
    (SELECT string_agg(ref, ', ' ORDER BY verse_id_start, link_id) FROM l) AS verses FROM topic t WHERE topic_id = 103"""
)
def cmd_topic(spark, d):
    t = run_command(library(spark, d), "topic", ["places", "103"])
    return one_row(spark, {"topic_id": t["topic_id"], "name": t["name"], "breadcrumb": " > ".join(t["breadcrumb"]), "children": ", ".join(str(c["topic_id"]) for c in t["children"]), "verses": ", ".join(t["verses"])})


@query(
    f"""WITH {SHAPES} SELECT CASE WHEN topic_id = 2 THEN 0 ELSE 1 END AS depth, topic_id, parent_topic_id, name, sort_order, (SELECT count(*) FROM verse_link WHERE source_type = 'topic' AND source_id = t.topic_id) AS verse_count
    FROM topic t WHERE topic_id = 2 OR parent_topic_id = 2"""
)
def cmd_topic_tree(spark, d):
    return run_command(library(spark, d), "topic-tree", ["places", "2"], {"depth": "1"}).drop("path")


@query(
    f"""WITH {SHAPES} SELECT DISTINCT verse_id_start, verse_id_end, {_ref("verse_id_start", "verse_id_end")} AS ref FROM verse_link JOIN topic ON source_id = topic_id WHERE source_type = 'topic' AND (topic_id = 103 OR parent_topic_id = 103)"""
)
def cmd_topic_verses(spark, d):
    return run_command(library(spark, d), "topic-verses", ["places", "103"], {"recursive": "true"})


@query(
    f"""WITH {SHAPES} SELECT topic_id, name, (SELECT name FROM topic u WHERE u.topic_id = t.parent_topic_id) AS parent FROM topic t WHERE topic_id IN (SELECT source_id FROM verse_link WHERE source_type = 'topic' AND verse_id_start <= 1003999 AND verse_id_end >= 1003001)"""
)
def cmd_verse_topics(spark, d):
    return run_command(library(spark, d), "verse-topics", ["places", "Gen 3"])


@query(
    f"""WITH {SHAPES} SELECT l.link_id, g.group_id, l.verse_id_start, l.verse_id_end, l.sort_order AS l_order, phrase, g.sort_order AS g_order, {_ref("l.verse_id_start", "l.verse_id_end")} AS ref FROM cross_reference_group g
    JOIN verse_link l ON source_type = 'cross_reference' AND source_id = group_id WHERE g.verse_id_start <= 1003999 AND g.verse_id_end >= 1003001 ORDER BY g_order, l_order, link_id LIMIT 50"""
)
def cmd_xref(spark, d):
    return run_command(library(spark, d), "xref", ["orders", "Gen 3"])


@query(f"WITH {SHAPES} SELECT * FROM book_section WHERE parent_section_id = 103")
def cmd_sections(spark, d):
    return run_command(library(spark, d), "sections", ["places"], {"parent": "103", "order": "text"})


@query(
    f"""WITH {SHAPES}, l AS (SELECT *, {_ref("verse_id_start", "verse_id_end")} AS ref FROM verse_link WHERE source_type = 'book_section' AND source_id = 103)
    SELECT CAST(section_id AS VARCHAR) AS section_id, section_number, title, (SELECT coalesce(string_agg(ref, ', ' ORDER BY sort_order, link_id), '') FROM l) AS scripture_references FROM book_section WHERE section_id = 103"""
)
def cmd_section(spark, d):
    s = run_command(library(spark, d), "section", ["places", "103"])
    return one_row(spark, {"section_id": s["section_id"], "section_number": s["section_number"], "title": s["title"], "scripture_references": ", ".join(s["scripture_references"])})


@query(
    """WITH t AS (SELECT conv_id * 1000 + turn AS verse_id, text, '{"turn":' || turn || ',"v":1}' AS formatting FROM conversations), w AS (SELECT l_orderkey % 100 * 1000 + l_linenumber % 8 AS verse_id, l_orderkey AS p, 'H' || l_partkey AS s, l_returnflag AS g FROM lineitem)
    SELECT t.verse_id, text, formatting, coalesce((SELECT string_agg(p || ' ' || s || ' ' || coalesce(g, ''), '; ' ORDER BY p, s, g) FROM w WHERE w.verse_id = t.verse_id), '') AS words FROM t WHERE t.verse_id % 3 = 0"""
)
def p19_verse_details(spark, d):
    v = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("verse_id"), "text", F.concat(F.lit('{"v": 1, "turn": '), F.col("turn").cast("string"), F.lit("}")).alias("formatting"))
    w = table(spark, d, "lineitem").select((F.col("l_orderkey") % 100 * 1000 + F.col("l_linenumber") % 8).alias("verse_id"), F.col("l_orderkey").alias("word_position_start"), F.concat(F.lit("H"), F.col("l_partkey").cast("string")).alias("strongs_number"), F.col("l_returnflag").alias("gloss"))
    found = lookup.verse_details(v, w, v.where("verse_id % 3 = 0"))
    shown = F.array_join(F.transform("words", lambda x: F.concat_ws(" ", x["position"].cast("string"), x["strongs_number"], F.coalesce(x["gloss"], F.lit("")))), "; ")
    return found.select("verse_id", "text", lookup.parse_or_keep(F.col("formatting")).alias("formatting"), shown.alias("words"))


@query(
    """WITH r AS (SELECT n_name AS module, CASE c_custkey % 4 WHEN 0 THEN 'Gen' WHEN 1 THEN 'Exod' WHEN 2 THEN 'Tob' ELSE 'Sir' END AS osis, c_custkey % 4 < 2 AS known, c_custkey % 7 > 0 AS stored, c_custkey % 5 = 0 AS merged, c_custkey % 6 = 0 AS linked, c_custkey % 9 = 0 AS coded FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey <> 3),
    b AS (SELECT module, osis, count(*) FILTER (known AND stored) AS i, count(*) FILTER (NOT known) AS o, count(*) FILTER (merged) AS m, count(*) FILTER (linked) AS l, count(*) FILTER (coded) AS c FROM r GROUP BY 1, 2),
    s AS (SELECT module, sum(m) AS m, sum(l) AS l, sum(c) AS c, string_agg('{"osis":"' || osis || '","verses":' || i || '}', ',' ORDER BY osis) FILTER (i > 0) AS i, string_agg('{"osis":"' || osis || '","verses":' || o || '}', ',' ORDER BY osis) FILTER (o > 0) AS o FROM b GROUP BY 1)
    SELECT n_name AS module, '{"sword_module":"' || n_name || '","sword_lang":"en","sword_source_type":"","sword_versification":"KJV","sword_distribution_license":"Public \\"Domain\\"","sword_text_source":"","variant_verse_merges":' || coalesce(m, 0) || ',"linked_verses_skipped":' || coalesce(l, 0) ||
    ',"latin1_entries_transcoded":' || coalesce(c, 0) || ',"sword_declared_versification":"KJV","versification_override":"","source_books":[' || coalesce(i, '') || '],"skipped_books":[' || coalesce(o, '') || ']}' AS metadata FROM nation LEFT JOIN s ON module = n_name""".replace("\\\\", "\\")
)
def c18_metadata(spark, d):
    k, n = F.col("c_custkey"), table(spark, d, "nation")
    osis = F.when(k % 4 == 0, "Gen").when(k % 4 == 1, "Exod").when(k % 4 == 2, "Tob").otherwise("Sir")
    r = table(spark, d, "customer").where("c_nationkey <> 3").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    r = convert.with_book(r.select(F.col("n_name").alias("module"), osis.alias("osis"), (k % 7 > 0).alias("stored"), (k % 5 == 0).alias("merged"), (k % 6 == 0).alias("linked"), (k % 9 == 0).alias("transcoded")))
    conf = n.select(F.col("n_name").alias("module"), F.create_map(F.lit("Lang"), F.lit("en"), F.lit("Versification"), F.lit("KJV"), F.lit("DistributionLicense"), F.lit('Public "Domain"')).alias("conf"))
    return convert.module_metadata(r, conf)


@query(
    """WITH c AS (SELECT o_orderkey AS position, CASE o_orderkey % 4 WHEN 0 THEN 'Alpha' WHEN 1 THEN 'Beta' WHEN 2 THEN 'GENERAL x' ELSE 'Gamma' END AS repository, CASE o_orderkey % 4 WHEN 0 THEN 'publisher' WHEN 1 THEN 'main' ELSE 'odd' END AS state, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE 'M' || (o_custkey % 300) END AS id,
        CASE o_orderkey % 7 WHEN 0 THEN 'MANUAL REVIEW' WHEN 1 THEN '' WHEN 2 THEN 'OK IF NON-COMMERCIAL' WHEN 3 THEN ' OK (verbatim; attribution) ' ELSE 'OK' END AS verdict, CASE WHEN o_orderkey % 11 = 0 THEN 'book' WHEN o_orderkey % 11 <> 1 THEN 'bible' END AS kind, CASE WHEN o_orderkey % 13 = 0 THEN 'yes' ELSE ' ' END AS secret,
        CASE WHEN o_orderkey % 17 > 0 THEN 'http' END AS url FROM orders), r AS (SELECT *, trim(verdict) AS v FROM c WHERE id <> '' AND repository NOT LIKE 'GENERAL%'),
    m AS (SELECT *, CASE WHEN v IN ('MANUAL REVIEW', '') THEN 'licence: ' || CASE WHEN v = '' THEN '(none)' ELSE v END WHEN v = 'OK IF NON-COMMERCIAL' THEN 'licence tier: ' || v WHEN kind = 'book' THEN 'type: book' WHEN kind IS NULL THEN 'type: None' WHEN secret = 'yes' THEN 'encrypted'
        WHEN repository = 'Gamma' AND position % 3 = 0 THEN NULL WHEN url IS NULL THEN 'no zip url' END AS reason FROM r), p AS (SELECT *, row_number() OVER (PARTITION BY lower(id) ORDER BY CASE state WHEN 'main' THEN 1 WHEN 'publisher' THEN 3 ELSE 10 END, position) AS n FROM m WHERE reason IS NULL)
    SELECT 'chosen' AS what, id || ' ' || repository AS name, position AS n FROM p WHERE n = 1 UNION ALL SELECT 'excluded', reason, count(*) FROM m WHERE reason IS NOT NULL GROUP BY 2 UNION ALL SELECT 'excluded', 'duplicate id (other repository preferred)', count(*) FROM p WHERE n > 1 HAVING count(*) > 0""".replace("WHEN repository = 'Gamma' AND position % 3 = 0 THEN NULL ", "")
)
def q17_select(spark, d):
    from ..operators import catalog

    k = F.col("o_orderkey")
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (k % n + 1).cast("int"))
    rows = table(spark, d, "orders").select(
        k.alias("position"), pick(4, "Alpha", "Beta", "GENERAL x", "Gamma").alias("repository"), pick(4, "publisher", "main", "odd", "odd").alias("repository_status"), F.when(k % 29 == 0, "").otherwise(F.concat(F.lit("M"), (F.col("o_custkey") % 300).cast("string"))).alias("module_id"),
        pick(7, "MANUAL REVIEW", "", "OK IF NON-COMMERCIAL", " OK (verbatim; attribution) ", "OK", "OK", "OK").alias("conversion_license_verdict"), F.when(k % 11 == 0, "book").when(k % 11 != 1, "bible").alias("app_module_type"), F.lit("Biblical Texts").alias("sword_module_type"),
        F.when(k % 13 == 0, "yes").otherwise(" ").alias("encrypted"), F.when(k % 17 > 0, "http").alias("zip_download_url"), F.lit("KJV").alias("versification_sword"), F.lit("OSIS").alias("source_markup"),
    )
    chosen, excluded = catalog.select_rows(rows, "verbatim")
    one = chosen.select(F.lit("chosen").alias("what"), F.concat_ws(" ", "module_id", "repository").alias("name"), F.col("position").alias("n"))
    return one.unionByName(excluded.select(F.lit("excluded").alias("what"), F.col("reason").alias("name"), "n"))


# References -----------------------------------------------------------------------


@query(
    f"""WITH {NAMES}, r AS (SELECT o_orderkey, o_orderkey % 66 + 1 AS book, o_orderkey % 40 + 1 AS c, o_orderkey % 30 + 1 AS v FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN book * 1000000 + c * 1000 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE v END END AS low,
    CASE WHEN o_orderkey % 7 <> 0 THEN book * 1000000 + c * 1000 + CASE o_orderkey % 3 WHEN 0 THEN 999 WHEN 1 THEN v ELSE v + 2 END END AS high FROM r"""
)
def f5_references(spark, d):
    k = F.col("o_orderkey")
    names = F.create_map(*[F.lit(x) for b in refs.standard_books() for x in (b.number, b.name if b.number % 2 else b.short.upper())])
    c, v = (k % 40 + 1).cast("string"), k % 30 + 1
    verses = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit(":"), v.cast("string"))).otherwise(F.concat(F.lit(" : "), v.cast("string"), F.lit(" - "), (v + 2).cast("string")))
    name = F.when(k % 7 == 0, "Nobody").otherwise(names[(k % 66 + 1).cast("int")])
    r = table(spark, d, "orders").select("o_orderkey", refs.reference_columns(F.concat(name, F.lit(" "), c, verses)).alias("r"))
    return r.select("o_orderkey", "r.low", "r.high")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey WHEN 1 THEN (o_orderkey % 66 + 1) * 1000000 + (o_orderkey % 40 + 1) * 1000 + o_orderkey % 30 + 1 END AS loose FROM orders")
def f6_loose_references(spark, d):
    k = F.col("o_orderkey")
    names = F.create_map(*[F.lit(x) for b in refs.standard_books() for x in (b.number, b.name)])
    place = F.concat(names[(k % 66 + 1).cast("int")], F.lit(" "), (k % 40 + 1).cast("string"), F.lit("."), (k % 30 + 1).cast("string"))
    r = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, place).otherwise("J 1:1")
    return table(spark, d, "orders").select("o_orderkey", refs.reference_columns(r).alias("r")).select("o_orderkey", "r.loose")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE (o_orderkey % 66 + 1) * 1000000 + (o_orderkey % 40 + 1) * 1000 + o_orderkey % 30 + 1 END AS start FROM orders")
def f10_code_references(spark, d):
    k = F.col("o_orderkey")
    codes = F.create_map(*[F.lit(x) for b in refs.standard_books() for x in (b.number, b.code)])
    head = F.concat(codes[(k % 66 + 1).cast("int")], F.lit("."), (k % 40 + 1).cast("string"), F.lit("."))
    r = F.when(k % 4 == 0, "Tob.1.1").when(k % 4 == 1, F.concat(F.lit("Bible:"), head, (k % 30 + 1).cast("string"))).otherwise(F.concat(head, (k % 30 + 1).cast("string"), F.lit("-"), head, F.lit("99")))
    return table(spark, d, "orders").select("o_orderkey", refs.reference_columns(r).alias("r")).select("o_orderkey", "r.start")


# Converter ------------------------------------------------------------------------


def coded(spark, d) -> DataFrame:
    """Customers as records: a book's code by nation, in odd spellings; one nation is outside of the canon."""
    codes = F.create_map(*[F.lit(x) for b in refs.standard_books()[:25] for x in (b.number - 1, b.code)])
    code = codes[F.col("c_nationkey")]
    osis = F.when(F.col("c_nationkey") == 7, "Tob").when(F.col("c_custkey") % 2 == 0, F.upper(code)).otherwise(F.concat_ws(" ", F.substring(code, 1, 1), F.substring(code, 2, 99)))
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", osis.alias("osis"))


@query("SELECT c_custkey, CASE WHEN c_nationkey <> 7 THEN c_nationkey + 1 END AS book FROM customer")
def f9_book_codes(spark, d):
    return convert.with_book(coded(spark, d)).select("c_custkey", "book")


@query("SELECT 'Tob' AS osis, count(*) AS n FROM customer WHERE c_nationkey = 7 HAVING count(*) > 0")
def c1_skipped(spark, d):
    return convert.skipped_books(convert.with_book(coded(spark, d)))


def placed(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders as records of two modules, and a canon of five books."""
    k = F.col("o_orderkey")
    records = table(spark, d, "orders").select(
        k.alias("i"), F.when(k % 2 == 0, "a").otherwise("b").alias("module"), F.when(k % 11 != 0, k % 3 + 1).alias("book"), (F.expr("o_orderkey div 3") % 7).alias("c"), (F.expr("o_orderkey div 21") % F.when(k % 3 == 1, 32).otherwise(37)).alias("v")
    )
    n = F.col("n_nationkey")
    canon = table(spark, d, "nation").select((n % 5 + 1).cast("long").alias("book"), F.expr("n_nationkey div 5 + 1").alias("chapter"), (30 + n % 3 * 3).cast("long").alias("max_verse"))
    return records, canon


PLACED = """r AS (SELECT o_orderkey AS i, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS module, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 3 + 1 END AS book, o_orderkey // 3 % 7 AS c,
    o_orderkey // 21 % CASE WHEN o_orderkey % 3 = 1 THEN 32 ELSE 37 END AS v FROM orders), canon AS (SELECT n_nationkey % 5 + 1 AS book, n_nationkey // 5 + 1 AS chapter, 30 + n_nationkey % 3 * 3 AS max_verse FROM nation)"""


@query(
    f"""WITH {PLACED}, m AS (SELECT module, book, c, max(v) AS source_max FROM r WHERE book IS NOT NULL GROUP BY 1, 2, 3), j AS (SELECT r.*, source_max, max_verse, greatest(v, 1) AS w FROM r LEFT JOIN m USING (module, book, c) LEFT JOIN canon ON canon.book = r.book AND chapter = c),
    k AS (SELECT *, CASE WHEN book IS NULL THEN 'outside canon' WHEN c = 0 THEN 'intro' WHEN max_verse IS NULL THEN 'maps outside canon' WHEN w > max_verse AND source_max - max_verse >= 3 THEN 'addition' WHEN w > max_verse THEN 'fold' END AS reason FROM j)
    SELECT i, reason, CASE WHEN reason IS NULL OR reason = 'fold' THEN book * 1000000 + c * 1000 + least(w, max_verse) END AS target FROM k"""
)
def c3_targets(spark, d):
    return convert.targets(*placed(spark, d)).select("i", "reason", "target")


@query(
    f"""WITH {PLACED}, s AS (SELECT *, CASE WHEN book = 1 AND c = 2 AND v BETWEEN 1 AND 10 THEN 3 ELSE c END AS c2, CASE WHEN book = 1 AND c = 2 AND v BETWEEN 1 AND 10 THEN v + 5 WHEN book = 2 AND c = 1 THEN v - 2 ELSE v END AS v2 FROM r),
    j AS (SELECT s.*, max_verse, greatest(v2, 1) AS w FROM s LEFT JOIN canon ON canon.book = s.book AND chapter = c2),
    k AS (SELECT *, CASE WHEN book IS NULL THEN 'outside canon' WHEN c = 0 THEN 'intro' WHEN max_verse IS NULL THEN 'maps outside canon' WHEN w > max_verse THEN 'fold' WHEN c2 <> c OR w <> greatest(v, 1) THEN 'moved' END AS reason FROM j)
    SELECT i, reason, CASE WHEN coalesce(reason, '') IN ('', 'fold', 'moved') THEN book * 1000000 + c2 * 1000 + least(w, max_verse) END AS target FROM k"""
)
def c2_mapped(spark, d):
    rules = spark.createDataFrame([(1, 2, 1, 10, 3, 5, 0), (2, 1, 0, 99, 1, -2, 1)], "book long, chapter long, low long, high long, to_chapter long, shift long, rule_order long")
    return convert.targets(*placed(spark, d), rules=rules).select("i", "reason", "target")


@query(
    """WITH r AS (SELECT o_orderkey AS i, CASE WHEN o_orderkey % 2 = 0 THEN 66 ELSE 64 END AS book, CASE WHEN o_orderkey % 2 = 0 THEN 12 ELSE 1 END AS c, o_orderkey % 19 AS v, CASE o_orderkey % 3 WHEN 0 THEN 'fold' WHEN 1 THEN 'moved' END AS reason FROM orders),
    h AS (SELECT *, CASE WHEN book = 66 AND v = 18 THEN 66013001 WHEN book = 64 AND v = 15 THEN 64001014 END AS host FROM r)
    SELECT i, CASE WHEN coalesce(reason, '') <> 'moved' AND host IS NOT NULL THEN host ELSE book * 1000000 + c * 1000 + v END AS target, CASE WHEN host IS NOT NULL THEN 'moved' ELSE reason END AS reason FROM h"""
)
def c8_variants(spark, d):
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").select(k.alias("i"), F.when(k % 2 == 0, 66).otherwise(64).alias("book"), F.when(k % 2 == 0, 12).otherwise(1).alias("c"), (k % 19).alias("v"), F.when(k % 3 == 0, "fold").when(k % 3 == 1, "moved").alias("reason"))
    return convert.with_variants(r.withColumn("target", keys.pack(F.col("book"), F.col("c"), F.col("v")))).select("i", "target", "reason")


STRIPPED = "replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&quot;', '\"')"


@query(
    f"""WITH r AS (SELECT role AS module, {TURN_KEY} AS i, CASE conv_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS book, conv_id % 4 AS c, turn % 3 AS v, '<b>' || text || '</b>&nbsp;end' AS raw FROM conversations)
    SELECT module, row_number() OVER (PARTITION BY module ORDER BY i) AS entry_id, book * 1000000 + greatest(c, 1) * 1000 + greatest(v, 1) AS verse_id_start, CASE WHEN c = 0 THEN 'book' WHEN v = 0 THEN 'chapter' ELSE 'verse' END AS entry_level,
    len(regexp_extract_all({STRIPPED.format("raw")}, '[^ \\t\\n\\v\\f\\r]+')) AS word_count FROM r WHERE book IS NOT NULL"""
)
def c13_commentary(spark, d):
    m = F.col("conv_id") % 3
    r = turns(spark, d).select(F.col("role").alias("module"), F.col("key").alias("i"), F.when(m == 0, "Gen").when(m == 1, "Exod").otherwise("Tob").alias("osis"), (F.col("conv_id") % 4).alias("c"), (F.col("turn") % 3).alias("v"), F.concat(F.lit("<b>"), "text", F.lit("</b>&nbsp;end")).alias("raw"))
    return convert.commentary_tables(r)["commentary_entry"].select("module", "entry_id", "verse_id_start", "entry_level", "word_count")


@query(
    f"""WITH r AS (SELECT lang AS module, doc_id AS i, CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE ' ' || source || ' ' END AS key, text AS raw FROM documents)
    SELECT module, trim(key, ' ') AS entry_key, trim({STRIPPED.format("arg_min(raw, i)")}, ' ') AS definition FROM r WHERE trim(key, ' ') <> '' AND trim(coalesce(raw, ''), ' ') <> '' GROUP BY 1, 2"""
)
def c14_dictionary(spark, d):
    i = F.col("doc_id")
    r = table(spark, d, "documents").select(F.col("lang").alias("module"), i.alias("i"), F.when(i % 17 == 0, "  ").otherwise(F.concat(F.lit(" "), "source", F.lit(" "))).alias("key"), F.col("text").alias("raw"))
    return convert.dictionary_table(r)


@query(
    f"""WITH r AS (SELECT role AS module, {TURN_KEY} AS i, CASE WHEN turn % 4 = 2 THEN ' ' ELSE text END AS raw, conv_id FROM conversations)
    SELECT module, row_number() OVER (PARTITION BY module ORDER BY i) AS day_number, 'Day ' || conv_id AS date_label, raw AS content FROM r WHERE trim(raw, ' ') <> ''"""
)
def c15_devotional(spark, d):
    raw = F.when(F.col("turn") % 4 == 2, " ").otherwise(F.col("text"))
    r = turns(spark, d).select(F.col("role").alias("module"), F.col("key").alias("i"), F.concat(F.lit(" Day "), F.col("conv_id").cast("string")).alias("key"), raw.alias("raw"))
    return convert.devotional_table(r)


@query(
    f"""WITH {TREE}, o AS (SELECT id, up, name, row_number() OVER (PARTITION BY up ORDER BY id) AS n FROM tree), s AS (SELECT id, up, name, CAST(n AS VARCHAR) AS section_number FROM o WHERE up IS NULL
    UNION ALL SELECT n.id, n.up, n.name, r.n || '.' || n.n FROM o n JOIN o r ON n.up = r.id WHERE r.up IS NULL UNION ALL SELECT c.id, c.up, c.name, r.n || '.' || n.n || '.' || c.n FROM o c JOIN o n ON c.up = n.id JOIN o r ON n.up = r.id WHERE r.up IS NULL)
    SELECT id AS section_id, up AS parent_section_id, section_number, name AS title, '<p>' || name || ' x</p>' || chr(10) || '<p>y</p>' AS content, len(string_split(name, ' ')) + 2 AS word_count FROM s"""
)
def c16_sections(spark, d):
    raw = F.concat(F.lit("<!P><br/>"), "name", F.lit("  x<!/P> <br /><!P><br>y"))
    r = geography(spark, d).select(F.lit("m").alias("module"), F.col("id").alias("i"), F.col("up").alias("parent_i"), F.col("name").alias("key"), raw.alias("raw"))
    return convert.section_table(r).select("section_id", "parent_section_id", "section_number", "title", "content", "word_count")


@query(
    """SELECT n_name AS module, CASE WHEN n_nationkey % 2 = 0 THEN 'A' || n_nationkey ELSE n_name END AS abbreviation, 'Full ' || n_name AS full_name, '1.0' AS content_version, CASE n_nationkey % 4 WHEN 0 THEN 'Short 2001' WHEN 1 THEN 'Long 1999' WHEN 2 THEN 'Note' ELSE CASE WHEN n_nationkey % 3 = 0 THEN 'Public Domain' ELSE 'Copyrighted' END END AS copyright,
    CASE WHEN n_nationkey % 5 = 0 THEN 'Press' ELSE 'Owner' END AS publisher, CASE WHEN n_nationkey % 6 > 0 THEN 1990 + n_nationkey WHEN n_nationkey % 4 = 0 THEN 2001 WHEN n_nationkey % 4 = 1 THEN 1999 ELSE 0 END AS year_published, CASE WHEN n_nationkey % 7 = 0 THEN 'https://x/' || n_nationkey END AS source_url,
    CASE WHEN n_nationkey % 3 = 0 THEN 'PD' ELSE 'LicenseRef-Proprietary' END AS license_spdx, CASE n_nationkey % 3 WHEN 0 THEN 'he' WHEN 1 THEN 'pt' ELSE 'en' END AS language_code, n_nationkey % 3 = 0 AS right_to_left, n_nationkey % 3 = 0 AS is_original_language FROM nation"""
)
def c17_identity(spark, d):
    k = F.col("n_nationkey")
    pairs = {
        "Abbreviation": F.when(k % 2 == 0, F.concat(F.lit("A"), k.cast("string"))).otherwise(" "), "Description": F.concat(F.lit("Full "), "n_name"), "CopyrightHolder": F.when(k % 5 > 0, " Owner "), "Publisher": F.lit("Press"),
        "ShortCopyright": F.when(k % 4 == 0, r"Short\par 2001"), "Copyright": F.when(k % 4 <= 1, "Long 1999"), "CopyrightNotes": F.when(k % 4 <= 2, "Note"), "TextSource": F.when(k % 7 == 0, F.concat(F.lit("https://x/"), k.cast("string"))).otherwise("A library"),
        "CopyrightDate": F.when(k % 6 > 0, F.concat(F.lit("c 12345, "), (1990 + k).cast("string"))).otherwise("long ago"), "DistributionLicense": F.when(k % 3 == 0, "Public Domain").otherwise("Copyrighted"), "Lang": F.when(k % 3 == 0, "he").when(k % 3 == 1, "pt-BR").otherwise(""),
    }
    conf = table(spark, d, "nation").select(F.col("n_name").alias("module"), F.create_map(*[x for name, v in pairs.items() for x in (F.lit(name), v)]).alias("conf"))
    shown = ("module", "abbreviation", "full_name", "content_version", "copyright", "publisher", "year_published", "source_url", "license_spdx", "language_code", "right_to_left", "is_original_language")
    return convert.identity_block(conf, "bible").select(*shown)


# Text -----------------------------------------------------------------------------


#: Bytes put after a name, and whether they are UTF-8 in structure: surrogates and long overlong forms are, stray bytes and short ones are not.
BYTE_CASES = [("C3A9", True), ("EDA080", True), ("E08080", True), ("F0808080", True), ("F4BFBFBF", True), ("F5808080", False), ("C080", False), ("C3", False), ("E282", False), ("80", False), ("E9", False), ("", True)]


@query("SELECT p_partkey, CASE p_partkey % 12 " + " ".join(f"WHEN {i} THEN {str(ok).lower()}" for i, (_, ok) in enumerate(BYTE_CASES)) + " END AS structural FROM part")
def f19_structure(spark, d):
    more = F.lit("")
    for i, (hexes, _) in enumerate(BYTE_CASES):
        more = F.when(F.col("p_partkey") % 12 == i, hexes).otherwise(more)
    return table(spark, d, "part").select("p_partkey", text.is_structural_utf8(F.concat(F.encode("p_name", "UTF-8"), F.unhex(more))).alias("structural"))


@query("SELECT p_partkey, p_name || ' {a} & ' || p_brand || ' \"q\"' AS plain FROM part")
def f14_strip_rtf(spark, d):
    raw = F.concat(F.lit(r"\b "), "p_name", F.lit(r"\par \{a\} &amp; {\i0 "), "p_brand", F.lit(r"}<br/>&quot;q&quot;\line "))
    return table(spark, d, "part").select("p_partkey", text.strip_rtf(raw).alias("plain"))


@query("SELECT p_partkey, p_name || '€ é' AS latin, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' é ü' ELSE p_name || ' é €' END AS repaired FROM part")
def f20_encodings(spark, d):
    even = F.col("p_partkey") % 2 == 0
    raw = F.when(even, F.concat(F.encode("p_name", "UTF-8"), F.unhex(F.lit("20C3A920C3BC")))).otherwise(F.concat(F.encode("p_name", "UTF-8"), F.unhex(F.lit("20C3A92080"))))
    latin = F.concat(F.encode("p_name", "UTF-8"), F.unhex(F.lit("8020E9")))
    return table(spark, d, "part").select("p_partkey", text.latin1_to_text(latin).alias("latin"), text.repaired(raw).alias("repaired"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '<h2>' || p_name || '</h2></p>' ELSE '<p>' || p_name || ' see it</p>' END AS html FROM part")
def f32_section_html(spark, d):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<!P><br><h2>"), "p_name", F.lit("</h2>\t\t"))).otherwise(F.concat(F.lit(""), "p_name", F.lit('   <a href="passagestudy.jsp?x=1">see it</a><!/P>')))
    return table(spark, d, "part").select("p_partkey", text.clean_section_html(raw).alias("html"))
