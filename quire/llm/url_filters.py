"""URL rules as a sort-merge range join over reversed-host keys (native).

A rule ``host/path`` becomes the interval of all keys that start with its
canonical key: the host's labels from the last to the first, then the path.
A url has one probe key for its host and for each parent domain of it, with
the url's path. Within one reversed host the intervals nest like brackets, so
one sweep over the sorted keys, keeping the stack of open rules, finds each
probe's innermost (longest) rule. The sweep is a window function; hot domains
are dealt over ``salts`` parts (at least as many as the session has shuffle
partitions), each of which sees that domain's rules. Which rules enclose a
rule comes from a join on its path's own prefixes, not from pairs of rules.

Defined results: a url that is null or lacks ``://`` has empty host and path
and no rule; empty tables give empty results; repeated urls are judged once
and every row of theirs gets the verdict; repeated rules count once; of rules
of one host and path, ``block`` wins. Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the query: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: The least number of parts over which the probes of one domain are dealt.
SALTS = 64


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reverse_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rules_frame(spark, rules=RULES) -> DataFrame:
    """Rules with their reversed host; a small table, or pass one of your own."""
    df = spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")
    return df.select("verdict", "rule_host", "rule_path")


def events(rules: DataFrame) -> DataFrame:
    """The sweep's events: at an opening or closing key, the rule on top afterwards.

    The stack's top after a closing is the innermost rule that still stands
    open: the longest proper prefix of the path among the host's rules.
    """
    r = rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL").groupBy("rule_host", "rule_path").agg(
        F.max("verdict").alias("verdict")
    )
    r = r.select(
        reverse_host(F.col("rule_host")).alias("zone"),
        "rule_path",
        "verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    outer = r.select("zone", F.col("rule_path").alias("o_path"), F.struct("rule", "verdict").alias("o_top"))
    cuts = F.when(F.length("rule_path") > 0, F.sequence(F.lit(0), F.length("rule_path") - 1))
    prefixes = r.withColumn("cut", F.explode_outer(cuts)).withColumn("o_path", F.expr("substring(rule_path, 1, cut)"))
    depth = F.struct(F.length("o_path"), F.col("o_top.rule"), F.col("o_top.verdict"))
    nested = (
        prefixes.join(outer, ["zone", "o_path"], "left")
        .groupBy("zone", "rule_path", "rule", "verdict")
        .agg(F.max(F.when(F.col("o_top").isNotNull(), depth)).alias("under"))
    )
    opening = nested.select(
        "zone", F.col("rule_path").alias("path"), F.lit(0).alias("turn"), F.length("rule_path").alias("size"),
        F.struct("rule", "verdict").alias("top"),
    )
    # Every key with this prefix sorts before the prefix followed by the largest code point.
    closing = nested.select(
        "zone", F.concat("rule_path", F.lit("\U0010ffff\U0010ffff")).alias("path"), F.lit(2).alias("turn"),
        (-F.length("rule_path")).alias("size"), F.struct(F.col("under.rule").alias("rule"), F.col("under.verdict").alias("verdict")).alias("top"),
    )
    return opening.unionByName(closing)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int | None = None) -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict.

    Columns of ``pages`` that bear those names give way.
    """
    salts = salts or max(SALTS, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = pages.drop("host", "path", "rule", "verdict")
    urls = rows.select(F.col(url).alias("u")).where(F.col("u").contains("://")).distinct()
    parsed = urls.select("u", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    swept = events(rules)
    labels = F.split("host", r"\.", -1)
    level = F.explode(F.sequence(F.lit(1), F.size(labels)))
    probes = (
        parsed.select("u", "path", labels.alias("labels"), level.alias("n"))
        .select("u", "path", F.array_join(F.reverse(F.slice("labels", -F.col("n"), F.col("n"))), ".").alias("zone"))
        .join(swept.select("zone").distinct(), "zone", "left_semi")
        .select(
            "zone", F.pmod(F.xxhash64("u"), F.lit(salts)).alias("salt"), "path", F.lit(1).alias("turn"), F.lit(0).alias("size"),
            F.lit(None).cast("struct<rule:string,verdict:string>").alias("top"), "u",
        )
    )
    dealt = swept.select(
        "zone", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), "path", "turn", "size", "top",
        F.lit(None).cast("string").alias("u"),
    )
    sweep = Window.partitionBy("zone", "salt").orderBy("path", "turn", "size").rowsBetween(Window.unboundedPreceding, 0)
    best = (
        probes.unionByName(dealt)
        .withColumn("found", F.last("top", ignorenulls=True).over(sweep))
        .where("u IS NOT NULL AND found.rule IS NOT NULL")
        .groupBy("u")
        .agg(F.max(F.struct(F.length("found.rule").alias("n"), F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"))).alias("best"))
    )
    judged = rows.join(best, rows[url] == best["u"], "left")
    return judged.select(
        *[rows[c] for c in rows.columns],
        host_of(rows[url]).alias("host"),
        path_of(rows[url]).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


ORACLE = """
WITH p AS (SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages)
SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'allow'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'block'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'allow'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'block' ELSE 'allow' END AS verdict
FROM p
"""
