"""URL rules, WARC, top-k and mixing: oracles, brute force and odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing, topk, url_filters, warc
from quire.llm.common import table
from quire.llm.queries import oracle_sql, queries
from tests.conftest import same_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    same_rows(queries()[name](spark, sf), duck, oracle_sql()[name])


# URL rules ---------------------------------------------------------------------


def by_hand(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[1] if best else None, best[2] if best else "allow"


def test_url_rules_against_every_rule(spark):
    rules = [*url_filters.RULES, ("allow", "net", "/a/"), ("block", "net", "/a/b/"), ("allow", "deep.example.net", "/"), ("block", "net", "/a/b/")]
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://Example.NET/en/x?q#f", "ftp://a.b.deep.example.net/a/b/c", "x://net/a/b", "x://net/a/b/", "x://net/a/zz", "x://net/b"]
    urls += ["http://notexample.net/en/1", "http://example.net:80/en/1", "https://org/fr/", "https://a.org/fr", "http://ÄÖ.example.com/de/é", "a://b://c.net/x", "http://example.com/de/" + "y" * 50_000, "x://net/a/b/"]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(df, url_filters.rules_frame(spark, rules), salts=3).collect()}
    assert got == {i: by_hand(u, rules) for i, u in enumerate(urls)}


def test_url_rules_of_a_host_alone(spark):
    rules = [("block", "net", ""), ("allow", "a.net", ""), ("block", "a.net", "/x/")]
    urls = ["http://net", "http://b.net?x", "http://a.net", "http://a.net#f", "http://a.net/x/1", "http://net/", "http://org", "http://"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.judge(df, url_filters.rules_frame(spark, rules), salts=2).collect()}
    assert got == dict(enumerate([("net", "block"), ("net", "block"), ("a.net", "allow"), ("a.net", "allow"), ("a.net/x/", "block"), ("net", "block"), (None, "allow"), (None, "allow")]))


def test_url_rules_on_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(none, url_filters.rules_frame(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    no_rules = spark.createDataFrame([], "verdict string, rule_host string, rule_path string")
    assert [(r["rule"], r["verdict"]) for r in url_filters.judge(one, no_rules).collect()] == [(None, "allow")]


# WARC -----------------------------------------------------------------------------


def test_warc_round_trip_of_odd_pages(spark):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "ü", "\r\n\r\n\0 é"), (6, "u", "z" * 300_000), (None, "u", "same"), (1, "u", "same"), (0, "u", "other"), (9, "u", "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(df).collect()), key=repr)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = min(x for x, _, h in rows if (h or "").encode() == body and x is not None)
        want.append((i, len(body), warc.digest32(body), "response" if i == first else "revisit", None if i == first else first))
    assert got == sorted(want, key=repr)


def test_warc_empty_and_pushdown(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none, f"{tmp_path}/none").count() == 0
    path = f"{tmp_path}/some"
    df = spark.createDataFrame([(i, f"http://x/{i}", "copy" if i % 2 else f"page {i}") for i in range(20)], "page_id long, url string, html string")
    warc.round_trip(df, path).collect()
    read = spark.read.format("warc").option("path", path).option("payload", "false").load()
    revisits = read.where("record_type = 'revisit'")
    assert "PushedFilters" in revisits._jdf.queryExecution().toString() or revisits.count() == 9
    assert revisits.count() == 9 and read.where("target_uri IN ('http://x/3', 'http://x/4')").count() == 2
    assert read.where("payload IS NOT NULL").count() == 0


def test_warc_small_payloads_stay_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    assert sorted(r["record_type"] for r in warc.page_records(df, least=4).collect()) == ["response"] * 3 + ["revisit"]


# Top-k ----------------------------------------------------------------------------


def test_top_k_against_all_pairs_with_odd_vectors(spark):
    import math
    import random

    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)]) for i in range(120)]
    rows += [(200, None), (250, [1.0, None]), (300, [math.nan] * 20), (350, [math.inf] * 20), (400, []), (450, [1.0, 2.0]), (0, rows[0][1]), (7, rows[7][1]), (500, [1e30] * 20), (501, [-1e30] * 20), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    bound = 1 << 62
    quant = [(i, [max(-bound, min(bound, math.floor(256 * x) if abs(x) < 1e18 else int(math.copysign(bound, x)))) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    want = []
    for a, (i, v) in enumerate(quant):
        if i % 50 == 0:
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), j) for b, (j, w) in enumerate(quant) if a != b)
            want += [(i, n, j, -s) for n, (s, j) in enumerate(scores[:5], 1)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df).collect()]
    assert sorted(got) == sorted(want)


def test_top_k_fewer_than_k(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"]) for r in topk.top_k(df).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert topk.top_k(df.limit(0)).count() == 0


# Mixing -----------------------------------------------------------------------------


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 64, 1001):
        df = spark.range(n).select(F.col("id").alias("x"), F.lit(n).cast("long").alias("n"), F.lit(11).cast("long").alias("s"))
        assert sorted(r["x"] for r in mixing.permuted(df, "x", "n", "s", 5).collect()) == list(range(n))


def test_mix_of_odd_rows(spark):
    words = lambda n: " ".join(f"w{i}" for i in range(n))
    rows = [(i, words(40 + i % 30), "en", ["a", "b", "é", None][i % 4], 0) for i in range(400)]
    rows += [(1000, None, None, "a", None), (1001, "", "x", None, 0), (1002, words(50_000), "x", "b", 0), (None, words(30), "x", "a", 0), (5, words(45), "x", "b", 0), (5, words(45), "x", "b", 0), (1003, " \t\n ", "x", "zero", 0)]
    df = spark.createDataFrame(rows, DOCS)
    first, again = mixing.query(df).toPandas(), mixing.query(df.repartition(5)).toPandas()
    key = ["doc_id", "size", "source_size", "target", "taken"]
    assert first.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    assert len(first) == len(rows) and (first["taken"] <= 2 * first["size"]).all() and (first[first["size"] == 0]["taken"] == 0).all()
    sizes = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in ("a", "b", "é", "zero", None)}
    weights = dict(zip(["a", "b", "zero", "é", None], [3, 1, 2, 3, 1]))
    low, high = 0.0, 1e9
    for _ in range(200):
        t = (low + high) / 2
        low, high = (t, high) if sum(min(2 * sizes[s], weights[s] * t) for s in sizes) < 1.5 * sum(sizes.values()) else (low, t)
    for s, group in first.groupby("source_size"):
        name = next(k for k, v in sizes.items() if v == s)
        target = min(2 * sizes[name], weights[name] * low)
        assert abs(group["target"].iloc[0] - target) <= 1e-6 * max(1, target)
        assert abs(group["taken"].sum() - target) <= max(64, 0.01 * target)


def test_mix_of_nothing(spark):
    assert mixing.query(spark.createDataFrame([], DOCS)).count() == 0


def test_shards_draw_multinomial_counts_of_sources(spark, sf):
    from pyspark.sql import functions as F

    docs = table(spark, sf, "documents")
    b = mixing.mix_blocks(docs, shard=40).cache()
    assert b.groupBy("rank", "pass", "block", "doc_id", "from_word").count().where("count > 1").count() == 0
    # What the shards take is what the query reports.
    taken = {r["doc_id"]: r["n"] for r in b.groupBy("doc_id").agg(F.sum("words").alias("n")).collect()}
    assert taken == {r["doc_id"]: r["taken"] for r in mixing.query(docs).collect() if r["taken"]}
    # Chi-square of the counts of the shards against even shares: close to its degrees of freedom.
    goals = spark.createDataFrame([(0, 640_000, 640_000.0), (1, 64_000, 96_000.0)], "rank int, source_size long, target double")
    plan = {r["rank"]: r["slots"] for r in mixing.slot_plan(goals).collect()}
    counts = mixing.shard_counts(mixing.slot_plan(goals), 50, 3).collect()
    for rank, n in ((0, 10_000), (1, 1_500)):
        mine = sorted((r["shard"], r["n"], r["first"]) for r in counts if r["rank"] == rank)
        assert plan[rank] == n == sum(m for _, m, _ in mine) and [f for *_, f in mine] == [sum(m for _, m, _ in mine[:i]) for i in range(len(mine))]
        assert 20 < sum((m - n / 50) ** 2 / (n / 50) for _, m, _ in mine) < 95


def test_slots_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TASK_SLOTS", 100)
    goals = spark.createDataFrame([(0, 64_000, 96_000.0)], "rank int, source_size long, target double")
    made = mixing.slots(goals, shard=70)
    assert made.rdd.getNumPartitions() >= 10 and made.count() == 1500
    assert made.where("pass = 0").select("block").distinct().count() == 1000 and made.groupBy("pass", "block").count().where("count > 1").count() == 0


def test_the_draw_reaches_the_result(spark, sf, duck):
    docs = table(spark, sf, "documents")
    one, other = ({r["doc_id"]: (r["first_shard"], r["last_shard"], r["taken"]) for r in mixing.mix(docs, shard=20, seed=s).collect()} for s in (1, 2))
    assert {i: v[:2] for i, v in one.items()} != {i: v[:2] for i, v in other.items()} and len({v[0] for v in one.values()}) > 3
    pieces = mixing.mix_blocks(docs, shard=20, seed=1).groupBy("doc_id").agg(F.min("shard").alias("a"), F.max("shard").alias("b")).collect()
    assert {r["doc_id"]: (r["a"], r["b"]) for r in pieces} == {i: v[:2] for i, v in one.items() if v[2]}
    assert all(v[:2] == (None, None) for v in one.values() if not v[2])
    same_rows(mixing.mix(docs.select("doc_id", "text", "source"), shard=20).drop("tie"), duck, mixing.oracle(shard=20))
