"""Aggregations: per chapter, per type, ratios, correlation, set overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys


def chapters(df: DataFrame, key: str) -> DataFrame:
    """(book, chapter, n, first_key, last_key): one partial and one final hash aggregation."""
    return df.groupBy(keys.book_of(F.col(key)).alias("book"), keys.chapter_of(F.col(key)).alias("chapter")).agg(
        F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )


def books(per_chapter: DataFrame) -> DataFrame:
    """Second level over ``chapters``: (book, chapters, max_chapter, total)."""
    return per_chapter.groupBy("book").agg(F.count("*").alias("chapters"), F.max("chapter").alias("max_chapter"), F.sum("n").alias("total"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n): the union of one count for each table."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def node_stats(nodes: DataFrame, parent: str, links: DataFrame) -> DataFrame:
    """(topics, roots, subs, links) in one row, without a join of the tables."""
    a = nodes.agg(F.count("*").alias("topics"), F.count_if(F.col(parent).isNull()).alias("roots"), F.count_if(F.col(parent).isNotNull()).alias("subs"))
    return a.join(F.broadcast(links.agg(F.count("*").alias("links"))))


def short_flags(df: DataFrame, text: str, least: int) -> DataFrame:
    """(total, short, replaced, html, pilcrow, backslash) of one text column; null counts as short."""
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda c: F.count_if(c)
    return df.agg(
        F.count("*").alias("total"),
        count(F.length(F.btrim(t)) < least).alias("short"),
        count(t.contains("\ufffd")).alias("replaced"),
        count(t.rlike("(?s)<.*>")).alias("html"),
        count(t.contains("\u00b6")).alias("pilcrow"),
        count(t.contains("\\")).alias("backslash"),
    )


def pearson(x: Column, y: Column) -> Column:
    """Pearson's r; null for fewer than three pairs or a constant side (plain ``corr`` would raise)."""
    pair = x.isNotNull() & y.isNotNull()
    a, b = F.when(pair, x.cast("double")), F.when(pair, y.cast("double"))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when((F.count(a) >= 3) & (spread > 0), F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)))


def shift_correlations(left: DataFrame, right: DataFrame, key: str, value: str, group: Column, shifts: tuple[int, ...] = (-1, 0, 1), least: int = 8) -> DataFrame:
    """(grp, v0, v1, ..., best): correlation of both sides' values by group, in place and at shifted keys of the same group.

    Keys count that stand on both sides; a shifted pair needs a value above 0.
    Groups with fewer than ``least`` such keys, or without a correlation in
    place, are left out. The right side is dealt out once to all shifts: one
    equi-join on the key, and its partitioning serves the aggregate by key.
    """
    names = {s: f"v{i}" for i, s in enumerate(shifts)}
    dealt = right.select(F.col(key).alias("_k"), F.col(value).alias("_v")).withColumn("_s", F.explode(F.array(*[F.lit(s) for s in shifts])))
    dealt = dealt.select((F.col("_k") - F.col("_s")).alias("_k"), F.col("_k").alias("_from"), "_s", "_v")
    met = left.select(F.col(key), F.col(value), group.alias("grp")).join(dealt, F.col(key) == F.col("_k"))
    near = keys.chapter_key(F.col("_from")) == keys.chapter_key(F.col(key))
    at = [F.max(F.when((F.col("_s") == s) & ((F.col("_s") == 0) | ((F.col("_v") > 0) & near)), F.col("_v"))).alias(f"_{n}") for s, n in names.items()]
    rows = met.groupBy(key, "grp", value).agg(*at).where(F.col(f"_{names[0]}").isNotNull())
    out = rows.groupBy("grp").agg(F.count("*").alias("_n"), *[pearson(F.col(value), F.col(f"_{n}")).alias(n) for n in names.values()])
    out = out.where((F.col("_n") >= least) & F.col(names[0]).isNotNull()).drop("_n")
    return out.withColumn("best", F.greatest(*[F.coalesce(F.col(n), F.lit(-2.0)) for n in names.values()]))


def most_frequent(df: DataFrame, item: str, n: int = 40) -> DataFrame:
    """The ``n`` most frequent values, ties by the value."""
    return df.groupBy(item).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(item)).limit(n)


def item_sets(df: DataFrame, key: str, item: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items"))


def jaccard(a: Column, b: Column, without: Column | None = None) -> Column:
    """Overlap of two sets (arrays without repeats) after leaving out a common stop set; null if either is empty then."""
    if without is not None:
        a, b = F.array_except(a, without), F.array_except(b, without)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both))


def neighbour_overlap(sets: DataFrame, other: DataFrame, key: str, stop: DataFrame | None = None, item: str = "item", offsets: tuple[int, ...] = (0, -1, 1, -2, 2), least: int = 0) -> DataFrame:
    """(key, offset, overlap, own) of each key's set with the sets at neighbouring keys of the same chapter; ``own``: its items outside the stop set.

    The stop set leaves a set once, before it is compared; sets with fewer than ``least`` items of their own are not compared.
    """
    if stop is not None:
        words = F.broadcast(stop.agg(F.collect_list(item).alias("_stop")))
        sets, other = (d.join(words).select(key, F.array_except("items", "_stop").alias("items")) for d in (sets, other))
    probes = sets.where(F.size("items") >= least).select(key, "items").withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets])))
    probes = probes.withColumn("_at", F.col(key) + F.col("offset")).where(keys.chapter_key(F.col("_at")) == keys.chapter_key(F.col(key)))
    met = probes.join(other.select(F.col(key).alias("_at"), F.col("items").alias("_other")), "_at")
    return met.select(key, "offset", jaccard(F.col("items"), F.col("_other")).alias("overlap"), F.size("items").alias("own"))


def ordered_merge(df: DataFrame, group: str, order: str, text: str, flag: str, raw: str, first: int = 3) -> DataFrame:
    """(group, flag, text, refs, raws): OR of the flag, text joined in order, all places, the first raws."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), F.col(text).alias("t"), F.col(raw).alias("r"))))
    return df.groupBy(group).agg(F.bool_or(flag).alias("flag"), rows.alias("_rows")).select(
        group, "flag",
        F.array_join(F.transform("_rows", lambda x: x["t"]), " ").alias("text"),
        F.transform("_rows", lambda x: x["i"]).alias("refs"),
        F.slice(F.transform("_rows", lambda x: x["r"]), 1, first).alias("raws"),
    )


#: Scripts that letters are counted by, and the first word of their letters' names (fixed values).
SCRIPTS = {
    "Latin": "LATIN", "Greek": "GREEK", "Cyrillic": "CYRILLIC", "Armenian": "ARMENIAN", "Hebrew": "HEBREW", "Arabic": "ARABIC", "Syriac": "SYRIAC", "Devanagari": "DEVANAGARI", "Bengali": "BENGALI",
    "Tamil": "TAMIL", "Telugu": "TELUGU", "Thai": "THAI", "Lao": "LAO", "Tibetan": "TIBETAN", "Myanmar": "MYANMAR", "Georgian": "GEORGIAN", "Ethiopic": "ETHIOPIC", "Khmer": "KHMER",
    "Hangul": "HANGUL", "Hiragana": "HIRAGANA", "Katakana": "KATAKANA", "Han": "CJK",
}
#: The script that texts of a language are written in (fixed values).
EXPECTED_SCRIPTS = {
    "LATIN": "en de fr es it pt nl sv da no nb nn fi et lv lt pl cs sk sl hr hu ro sq tr id ms tl vi sw la eo ga cy is mt af eu ca gl",
    "CYRILLIC": "ru uk bg be mk kk ky tg mn cu",
    "GREEK": "el grc", "HEBREW": "he hbo", "ARABIC": "ar fa ur", "CJK": "zh ja", "HANGUL": "ko", "ARMENIAN": "hy", "GEORGIAN": "ka", "DEVANAGARI": "hi mr ne", "THAI": "th", "ETHIOPIC": "am", "SYRIAC": "syr",
}


def scripts(df: DataFrame, text: str, top: int = 3) -> DataFrame:
    """(script, n): letters by script over all rows, the ``top`` most frequent.

    ASCII letters are counted at once, so the scripts' patterns run over what is left of a text.
    """
    rows = df.select(F.length(F.regexp_replace(text, r"[^A-Za-z]+", "")).alias("plain"), F.regexp_replace(text, r"[\x00-\x7F]+", "").alias("rest"))
    letters = lambda s: F.length("rest") - F.length(F.regexp_replace("rest", f"\\p{{Is{s}}}+", ""))
    counts = {s: letters(s) + (F.col("plain") if s == "Latin" else F.lit(0)) for s in SCRIPTS}
    sums = rows.agg(*[F.sum(n).alias(s) for s, n in counts.items()])
    long = sums.select(F.explode(F.array(*[F.struct(F.lit(name).alias("script"), F.coalesce(F.col(s), F.lit(0)).cast("long").alias("n")) for s, name in SCRIPTS.items()])).alias("x")).select("x.*")
    return long.where("n > 0").orderBy(F.desc("n"), "script").limit(top)


def expected_script(language: str) -> str | None:
    """The script of a language tag's first part, if it is known."""
    primary = language.split("-")[0].lower()
    return next((script for script, languages in EXPECTED_SCRIPTS.items() if primary in languages.split()), None)


def status(severity: Column) -> Column:
    """FAIL if any error, WARN if any warning, else PASS; over a group of findings."""
    rank = F.max(F.when(severity == "error", 2).when(severity == "warn", 1).otherwise(0))
    return F.when(rank == 2, "FAIL").when(rank == 1, "WARN").otherwise("PASS")


def _digest(seed: int, key: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key: the same on every run."""
    return df.orderBy(_digest(seed, key), key).limit(n)


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: int = 1) -> DataFrame:
    """Round-robin over strata, in hash order inside each, until ``n`` rows are taken."""
    inside = Window.partitionBy(stratum).orderBy(_digest(seed, key), key)
    return df.withColumn("_turn", F.row_number().over(inside)).orderBy("_turn", _digest(seed, stratum), stratum).limit(n).drop("_turn")


def module_report(verses: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(verses, formatted, red, words, with_original, latin_original): one row about a converted module."""
    red = F.get_json_object("formatting", "$.spans[*].type").contains("words_of_christ")
    out = verses.agg(F.count("*").alias("verses"), F.count("formatting").alias("formatted"), F.count_if(F.coalesce(red, F.lit(False))).alias("red"))
    if words is None:
        return out
    o = F.coalesce("original_word", F.lit(""))
    w = words.agg(F.count("*").alias("words"), F.count_if(o != "").alias("with_original"), F.count_if(o.rlike("^[A-Za-z][A-Za-z ]*$") & (F.length(o) > 1)).alias("latin_original"))
    return out.join(F.broadcast(w))


#: Buckets of a histogram pass, and rows of a group that are sorted in the end.
BUCKETS, FINAL_ROWS = 1024, 10_000
#: Groups up to this number are broadcast to the rows.
FEW_GROUPS = 100_000


def quantile(df: DataFrame, group: list[str], value: Column, q: float, name: str = "quantile") -> DataFrame:
    """(group, name): the exact quantile of each group, interpolated between neighbours; null and NaN values do not count.

    Each pass counts the values between a group's bounds in ``BUCKETS`` buckets
    and narrows the bounds to the bucket that holds the rank, until few enough
    are left to be sorted. State is a few numbers a bucket, whatever the number
    of different values; a pass removes at least the bounds themselves.
    """
    from ..sources import shared

    spark = df.sparkSession
    x = F.col("_x")
    named = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)] or [F.lit(0).alias("_g0")]
    rows = df.select(*named, value.cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    path = shared.scratch(spark, "quantile")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    keys = [f"_g{i}" for i in range(len(named))]

    def met(bounds: DataFrame, few: bool) -> DataFrame:
        other = bounds.select(*[F.col(k).alias(f"_b{k}") for k in keys], *[c for c in bounds.columns if c not in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_b{k}"))
        return rows.join(F.broadcast(other) if few else other, same).drop(*[f"_b{k}" for k in keys])

    def stored(df: DataFrame) -> DataFrame:
        at = shared.scratch(spark, "quantile-bounds")
        df.write.parquet(at)
        return spark.read.parquet(at)

    rank = F.floor((F.col("n") - 1) * F.lit(q)).cast("long")
    bounds = stored(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")).where("n > 0").select(*keys, "n", "low", "high", rank.alias("rank"), F.lit(0).cast("long").alias("below"), F.col("n").alias("within")))
    few = bounds.count() <= FEW_GROUPS
    while (row := bounds.where("low < high").agg(F.max("within").alias("m")).first()) and (row["m"] or 0) > FINAL_ROWS:
        inside = met(bounds, few).where(x.between(F.col("low"), F.col("high")))
        share = (x / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        bucket = F.when(F.col("low") < F.col("high"), F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0).cast("int")
        counted = inside.groupBy(*keys, "n", "rank", "below", bucket.alias("bucket")).agg(F.count("*").alias("within"), F.min("_x").alias("low"), F.max("_x").alias("high"))
        w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        ahead = counted.withColumn("below", F.col("below") + F.coalesce(F.sum("within").over(w), F.lit(0)))
        bounds = stored(ahead.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("within"))).select(*keys, "n", "low", "high", "rank", "below", "within"))
    left = met(bounds.where("low < high"), few).where(x.between(F.col("low"), F.col("high")))
    placed = left.withColumn("_at", F.col("below") + F.row_number().over(Window.partitionBy(*keys).orderBy("_x")) - 1)
    exact = placed.where("_at = rank").select(*keys, "n", "rank", x.alias("here"))
    exact = stored(exact.unionByName(bounds.where("low = high").select(*keys, "n", "rank", F.col("low").alias("here"))))
    after = met(exact, few).groupBy(*keys, "n", "rank", "here").agg(F.count_if(x <= F.col("here")).alias("upto"), F.min(F.when(x > F.col("here"), x)).alias("next"))
    there = F.when((F.col("rank") + 1 < F.col("upto")) | F.col("next").isNull(), F.col("here")).otherwise(F.col("next"))
    part = (F.col("n") - 1) * F.lit(q) - F.col("rank")
    return after.select(*[F.col(k).alias(g) for k, g in zip(keys, group, strict=False)], (F.col("here") + (there - F.col("here")) * part).alias(name))
