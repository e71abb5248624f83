"""Point, range and cascade lookups; counts beside rows; paging.

Filters are plain predicates on the key columns, so they reach the scan
(``PushedFilters``); a long key list becomes a semi-join instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.text import ascii_lower

#: Keys up to which a list stays an IN list.
MAX_IN = 200


def point(df: DataFrame, key: str, value: int) -> DataFrame:
    return df.where(F.col(key) == value)


def key_range(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Inclusive; an inverted range is empty."""
    return df.where(F.col(key).between(low, high))


def key_list(df: DataFrame, key: str, values: Sequence[str | int]) -> DataFrame:
    """Rows of the given keys; arguments that are no numbers are dropped, and none left is an error."""
    wanted = sorted({int(v) for v in values if str(v).strip().lstrip("-").isdigit()})
    if not wanted:
        raise ValueError("no numeric key given")
    if len(wanted) <= MAX_IN:
        return df.where(F.col(key).isin(wanted))
    ids = df.sparkSession.createDataFrame([(v,) for v in wanted], f"{key} long")
    return df.join(ids, key, "left_semi")


def overlapping(df: DataFrame, start: str, end: str, low: int, high: int) -> DataFrame:
    return df.where(keys.overlaps(F.col(start), F.col(end), low, high))


def holding(df: DataFrame, start: str, end: str, key: int) -> DataFrame:
    return df.where(keys.contains_key(F.col(start), F.col(end), key))


def book_ranges(df: DataFrame, key: str, spec: str) -> DataFrame:
    """``1-1,43-45``: books of any of the ranges; empty spec keeps all."""
    test: Column | None = None
    for part in filter(None, (p.strip() for p in spec.split(","))):
        a, _, b = part.partition("-")
        one = keys.book_of(F.col(key)).between(int(a), int(b or a))
        test = one if test is None else test | one
    return df if test is None else df.where(test)


def cascade(df: DataFrame, tiers: Sequence[tuple[Column, int | None]], order: Sequence[Column]) -> DataFrame:
    """Rows of the first tier that matches anything, each tier with its own limit.

    One pass: a row's rank is its first matching tier; the least rank over the
    table (an aggregate of one row) picks the tier. Limits need a total order.
    """
    rank = F.lit(None).cast("int")
    for i in range(len(tiers) - 1, -1, -1):
        rank = F.when(tiers[i][0], i).otherwise(rank)
    ranked = df.withColumn("_tier", rank).where("_tier IS NOT NULL")
    best = ranked.agg(F.min("_tier").alias("_best"))
    limit = F.lit(None).cast("int")
    for i, (_, n) in enumerate(tiers):
        limit = F.when(F.col("_tier") == i, F.lit(n)).otherwise(limit)
    chosen = ranked.join(F.broadcast(best), F.col("_tier") == F.col("_best")).drop("_best")
    if all(n is None for _, n in tiers):
        return chosen.drop("_tier")
    # The numbering runs over at most the largest limit: a top-k cuts first.
    most = max((n for _, n in tiers if n is not None), default=0)
    if all(n is not None for _, n in tiers):
        chosen = chosen.orderBy(*order).limit(most)
    numbered = chosen.withColumn("_n", F.row_number().over(Window.partitionBy("_tier").orderBy(*order)))
    return numbered.where(limit.isNull() | (F.col("_n") <= limit)).drop("_tier", "_n")


def define(df: DataFrame, term: str, key: str = "entry_key", word: str = "word", ident: str = "entry_id") -> DataFrame:
    """Key as it is, key without regard to case, word, then words that contain the term (five)."""
    low = term.lower()
    tiers = [
        (F.col(key) == term, 1),
        (ascii_lower(F.col(key)) == low, 1),
        (ascii_lower(F.col(word)) == low, 1),
        (ascii_lower(F.col(word)).contains(low), 5),
    ]
    return cascade(df, tiers, [F.col(ident)])


def devotional(df: DataFrame, label: str, day: str = "day_number", name: str = "date_label", ident: str = "entry_id") -> DataFrame:
    """A canonical number is a day; else a label without regard to case, else a label that contains it."""
    tiers: list[tuple[Column, int | None]] = []
    if label.isdigit() and str(int(label)) == label:
        tiers.append((F.col(day) == int(label), 1))
    tiers += [(ascii_lower(F.col(name)) == label.lower(), 1), (ascii_lower(F.col(name)).contains(label.lower()), 1)]
    return cascade(df, tiers, [F.col(ident)])


def resolve_node(df: DataFrame, name: str, ident: str = "topic_id", parent: str = "parent_topic_id", label: str = "name", order: str = "sort_order") -> DataFrame:
    """Id, then name, then part of a name; among equals roots come first."""
    roots_first = [F.col(parent).isNull().desc(), F.col(order), F.col(ident)]
    tiers: list[tuple[Column, int | None]] = [(F.col(ident) == int(name), 1)] if name.isdigit() else []
    tiers += [(ascii_lower(F.col(label)) == name.lower(), 1), (ascii_lower(F.col(label)).contains(name.lower()), 1)]
    return cascade(df, tiers, roots_first)


def children(df: DataFrame, parent: str, of: int | None) -> DataFrame:
    return df.where(F.col(parent).isNull() if of is None else F.col(parent) == of)


def with_counts(df: DataFrame, key: str, others: DataFrame, other_key: str, name: str) -> DataFrame:
    """``df`` with the number of rows of ``others`` for each key; grouped before the join."""
    n = others.where(F.col(other_key).isNotNull()).groupBy(F.col(other_key).alias("_k")).agg(F.count("*").alias(name))
    return df.join(n, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def page(df: DataFrame, order: Sequence[Column], limit: int = 50, offset: int = 0) -> DataFrame:
    """``order`` must end in a unique key."""
    return df.orderBy(*order).offset(offset).limit(limit)


def parse_or_keep(text: Column) -> Column:
    """Valid JSON in its compact form, anything else as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def read_only_sql(spark, query: str, views: dict[str, DataFrame]) -> DataFrame:
    """Only SELECT and WITH reach Spark; ``PRAGMA table_info(t)`` describes a table."""
    text = query.strip()
    head = text.split(None, 1)[0].upper() if text else ""
    if head not in ("SELECT", "WITH", "PRAGMA"):
        raise ValueError("only SELECT, WITH and PRAGMA table_info are allowed")
    if head == "PRAGMA":
        name = text[text.index("(") + 1 : text.index(")")].strip(" '\"")
        fields = [(i, f.name, f.dataType.simpleString(), not f.nullable) for i, f in enumerate(views[name].schema)]
        return spark.createDataFrame(fields, "cid int, name string, type string, notnull boolean")
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def verse_details(verses: DataFrame, words: DataFrame | None, keys: DataFrame, key: str = "verse_id") -> DataFrame:
    """Rows of the wanted keys with ``words``: their interlinear words by position; an empty list without any."""
    wanted = keys.select(F.col(key).alias("_k")).distinct()
    rows = verses.join(wanted, F.col(key) == F.col("_k"), "left_semi")
    fields = ("strongs_number", "original_word", "gloss", "lemma")
    if words is None:
        return rows.withColumn("words", F.array().cast("array<struct<position:bigint,strongs_number:string,original_word:string,gloss:string,lemma:string>>"))
    word = F.struct(F.col("word_position_start").cast("long").alias("position"), *[F.col(f).cast("string").alias(f) if f in words.columns else F.lit(None).cast("string").alias(f) for f in fields])
    listed = words.join(wanted, F.col(key) == F.col("_k"), "left_semi").groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(word)).alias("words"))
    return rows.join(listed, F.col(key) == F.col("_k"), "left").drop("_k").withColumn("words", F.coalesce("words", F.array().cast(listed.schema["words"].dataType)))
