"""Mixing sources to target weights (native: DataFrame functions only).

Targets. Sources in code-point order (null last) weigh ``WEIGHTS`` in turn and
share ``share`` times all words; a source's target stops at ``cap`` times its
size and the excess is shared again by weight. That is a water level ``t``
with ``target = min(cap * size, weight * t)``, found from running sums over the
sources ordered by ``cap * size / weight``.

Draw. Each source's documents form one word stream, cut into blocks of
``block`` words. Output shards hold about ``shard`` blocks. How many blocks a
shard takes of a source is drawn: the counts of a source over the shards are
multinomial, given their sum, which is what the source's target needs (so even
a small source comes within a block of its target). Running sums of the counts
number a shard's slots in each source; slot ``j`` of a source takes block
``perm(j mod blocks)`` of pass ``j div blocks``, where ``perm`` is a
pseudorandom permutation of the block indexes for each source and pass
(swap-or-not rounds, exact on any range, computed row by row). The shards'
slots and the document pieces meet in an equi-join on (source, block). A block
is drawn at most once a pass, so no document exceeds ``cap`` times its size.

Streams are laid out with two-level prefix sums (hash buckets of documents,
then documents in a bucket), so neither a hot source nor a hot id is ordered
in one task. Slots are drawn and made by as many tasks as their number asks
for, whatever the number of sources. Only ids and sizes are shuffled, never
texts; nothing that grows with the documents is broadcast.

Defined results: null text has size 0 and is taken 0 times; null sources form
one source; equal rows are rows of their own; empty tables give empty results.
The draw depends on the data and ``seed`` alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK = 64
#: Blocks that an output shard holds on average.
SHARD = 4_096
ROUNDS = 12
#: Slots that one task draws or makes.
TASK_SLOTS = 1 << 16
#: Documents that one bucket of a word stream is meant to hold.
BUCKET_ROWS = 20_000
SEED = 20_261
_P = 2_147_483_647


def constants(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int, int]]:
    """Four multipliers and offsets below 2**31 for each round, from a Lehmer generator."""
    x, out = seed, []
    for _ in range(rounds):
        row = []
        for _ in range(4):
            x = x * 48_271 % _P
            row.append(x)
        out.append(tuple(row))
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> rank, weight, target as well.

    One row for each source: the windows run over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    turn = F.col("rank") % len(weights)
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(turn == i, F.lit(w)).otherwise(weight)
    ranked = ranked.withColumn("weight", weight.cast("long"))
    # Sources fill in the order of cap * size / weight.
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.lit(share) * F.col("total") - F.col("full_before")) / F.col("open_weight")
    marked = ranked.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "full_before": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap,
            "open_weight": F.sum("weight").over(rest),
        }
    ).withColumn("fits", F.col("source_size") * cap > F.col("weight") * level)
    # The water level is that of the first source, in this order, that does not fill up.
    first_open = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"), "rank", level.alias("level")))).over(everything)
    levelled = marked.withColumn("level", first_open["level"])
    target = F.when(F.col("fits") & F.col("level").isNotNull(), F.col("weight") * F.col("level")).otherwise(F.col("source_size") * F.lit(float(cap)))
    return levelled.select("source", "source_size", "rank", "weight", target.alias("target"))


def permuted(df: DataFrame, index: str, domain: str, stream: str, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """``df`` with ``index`` mapped through a permutation of ``[0, domain)`` chosen by ``stream``.

    Swap-or-not: each round pairs x with (key - x) mod domain and swaps the two
    if a bit that depends on the larger of them is set. All arithmetic stays
    below 2**62 as long as indexes do below 2**62.
    """
    n, s = F.col(domain), F.col(stream)
    keys = F.array(*[F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip("abcd", row, strict=True)]) for row in constants(seed, rounds)])

    def swap(x: Column, k: Column) -> Column:
        key = ((s % _P) * k["a"] + k["b"]) % _P * (s % 65_521 + 1) % n
        pair = (key - x + n) % n
        high = F.greatest(x, pair)
        mixed = (((high % _P) * k["c"] + s % _P) % _P * k["d"] + k["b"]) % _P
        return F.when(F.shiftright(mixed, 13).bitwiseAND(F.lit(1).cast("long")) == 1, pair).otherwise(x)

    return df.withColumn(index, F.aggregate(keys, F.col(index).cast("long"), swap))


def streams(sized: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, tie, spread) of documents with words -> start: their place in the source's stream."""
    rows = sized.where("size > 0")
    total = rows.count()
    buckets = max(16, -(-total // bucket_rows))
    mixed = (F.coalesce(F.pmod(F.col("doc_id").cast("long"), F.lit(_P)), F.lit(0)) * 48_271 + F.col("spread")) % _P
    rows = rows.withColumn("bucket", F.pmod(mixed, F.lit(buckets)))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    ahead = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0))).select(
        F.col("rank").alias("b_rank"), F.col("bucket").alias("b_bucket"), "base"
    )
    inside = Window.partitionBy("rank", "bucket").orderBy("doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(sums.hint("merge"), (F.col("rank") == F.col("b_rank")) & (F.col("bucket") == F.col("b_bucket")))
    return joined.withColumn("start", F.col("base") + F.col("inner")).drop("b_rank", "b_bucket", "base", "inner", "bucket")


def slot_plan(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rank, blocks, slots): how many blocks a source has, and how many the mix takes.

    Whole passes take every block; the rest of the target takes as many blocks
    of the last pass as come nearest to it.
    """
    n = F.expr(f"(source_size + {block - 1}) div {block}")
    whole = F.floor(F.col("target") / F.col("source_size")).cast("long")
    rest = F.round((F.col("target") - F.col("whole") * F.col("source_size")) * F.col("blocks") / F.col("source_size")).cast("long")
    plan = goals.where("source_size > 0").select("rank", "source_size", "target", n.alias("blocks"), whole.alias("whole"))
    return plan.select("rank", "blocks", (F.col("whole") * F.col("blocks") + rest).alias("slots")).where("slots > 0")


def _chunks(rows: DataFrame, first: str, last, tasks: int) -> DataFrame:
    """``rows`` with ``j`` from ``first`` up to (not with) ``last``; long runs are cut up and dealt over ``tasks`` first."""
    cut_up = rows.withColumn("_at", F.explode(F.sequence(F.col(first), last - 1, F.lit(TASK_SLOTS).cast("long")))).withColumn("_to", F.least(F.col("_at") + TASK_SLOTS, last) - 1)
    return cut_up.repartition(tasks, "rank", "_at").withColumn("j", F.explode(F.sequence("_at", "_to"))).drop("_at", "_to")


def shard_of(rank: Column, j: Column, shards: int, seed: int = SEED) -> Column:
    """The shard that a slot draws: two squarings modulo a prime, below 2**62 throughout."""
    a, b, c, d = (F.lit(v).cast("long") for v in constants(seed + 1, 1)[0])
    x = ((j % _P) * a + (rank + 1) * b) % _P
    y = (x * x % _P + d) % _P
    return (F.shiftright((y * y % _P * c + x) % _P, 5) % shards).cast("long")


def shard_counts(plan: DataFrame, shards: int, tasks: int, seed: int = SEED) -> DataFrame:
    """(rank, blocks, shard, n, first): the blocks that a shard takes of a source, and where its slots begin.

    Every slot draws its shard (see ``shard_of``), so a source's counts are
    multinomial. A task adds up its draws before anything is shuffled.
    """
    drawn = _chunks(plan.withColumn("_zero", F.lit(0).cast("long")), "_zero", F.col("slots"), tasks)
    shard = shard_of(F.col("rank"), F.col("j"), shards, seed)
    counts = drawn.groupBy("rank", "blocks", shard.alias("shard")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))


def slots(goals: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(rank, pass, block, shard): the blocks of every source that each output shard takes."""
    plan = slot_plan(goals, block)
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    tasks = max(1, -(-total // TASK_SLOTS))
    counts = shard_counts(plan, max(1, -(-total // shard)), tasks, seed)
    each = _chunks(counts, "first", F.col("first") + F.col("n"), tasks).select(
        "rank", F.expr("j div blocks").alias("pass"), F.expr("j % blocks").alias("block"), "blocks", "shard",
        (F.col("rank") * 2 + F.expr("j div blocks") + 1).cast("long").alias("stream"),
    )
    return permuted(each, "block", "blocks", "stream", seed).select("rank", "pass", "block", "shard")


def pieces_of(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each stretch of a document in a block: block, words, and where it starts in the document."""
    last = F.expr(f"(start + size - 1) div {block}")
    rows = placed.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), last)))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return rows.withColumns({"from_word": low - F.col("start"), "words": high - low})


def sized_rows(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """``tie`` tells texts apart; ``spread`` (31 bits of the text's MD5) deals the rows of one id over the buckets."""
    spread = F.coalesce(F.conv(F.substring(F.md5(F.col(text).cast("binary")), 1, 7), 16, 10).cast("long"), F.lit(0))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("tie"), spread.alias("spread")
    )


def _parts(docs: DataFrame, doc_id: str, text: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Sized rows with their source's goal, and the goals."""
    from .common import cut

    sized = cut(sized_rows(docs, doc_id, text, source))
    goals = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    g = goals.select(F.col("source").alias("g_source"), "source_size", "rank", "target")
    return sized.join(g, sized["source"].eqNullSafe(g["g_source"])).drop("g_source"), goals


def mix_blocks(docs: DataFrame, shard: int = SHARD, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: shard, source rank, pass, block, doc_id, from_word, words."""
    rows, goals = _parts(docs, doc_id, text, source)
    pieces = pieces_of(streams(rows)).select("rank", "block", "doc_id", "from_word", "words")
    return slots(goals, shard=shard, seed=seed).hint("merge").join(pieces, ["rank", "block"])


def mix(docs: DataFrame, shard: int = SHARD, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, first_shard, last_shard: one row for each document row.

    The shards are those that hold some of a document's words; null if none does.
    """
    rows, goals = _parts(docs, doc_id, text, source)
    drawn = slots(goals, shard=shard, seed=seed).groupBy("rank", "block").agg(F.count("*").alias("draws"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"))
    taken = (
        pieces_of(streams(rows))
        .join(drawn.hint("merge"), ["rank", "block"], "left")
        .groupBy("rank", "start", "doc_id", "size", "source_size", "target", "tie")
        .agg(F.sum(F.col("words") * F.coalesce(F.col("draws"), F.lit(0))).alias("taken"), F.min("first_shard").alias("first_shard"), F.max("last_shard").alias("last_shard"))
    )
    columns = ["doc_id", "size", "source_size", "target", "taken", "first_shard", "last_shard", "tie"]
    none = F.lit(None).cast("long")
    empty = rows.where("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_shard": none, "last_shard": none})
    return taken.select(*columns).unionByName(empty.select(*columns))


def query(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).drop("tie")


def take(docs: DataFrame) -> DataFrame:
    """Documents of the mix with their columns, ``size``, ``target`` and ``taken``; those never drawn go.

    Rows that agree in id and text are drawn alike: each gets its group's mean.
    """
    from .common import aside

    rows, back = aside(docs.drop("size", "target", "taken"), "doc_id", "text", "source")
    drawn = mix(rows).groupBy(F.col("doc_id").alias("m_id"), F.col("tie").alias("m_tie"), "size", "target").agg(F.avg("taken").alias("taken"))
    hit = rows["doc_id"].eqNullSafe(drawn["m_id"]) & F.xxhash64(rows["text"]).eqNullSafe(drawn["m_tie"])
    met = rows.join(drawn.where("taken > 0"), hit)
    own = back(met).columns
    named = {c: p for c, p in zip(own, [c for c in met.columns if c not in ("m_id", "m_tie", "size", "target", "taken")], strict=True)}
    return met.select(*[F.col(p).alias(c) for c, p in named.items()], "size", "target", "taken")


def oracle(seed: int = SEED, block: int = BLOCK, bucket_rows: int = BUCKET_ROWS, shard: int = SHARD) -> str:
    """DuckDB SQL for ``query``: the same rule, for tables whose doc_id is unique."""
    a, b, c, d = constants(seed + 1, 1)[0]
    body = "drawn0"
    ctes = []
    for i, (e, f, g, h) in enumerate(constants(seed), 1):
        ctes.append(
            f"""pair{i} AS (SELECT *, ((((s % {_P}) * {e} + {f}) % {_P}) * (s % 65521 + 1) % n - x + n) % n AS pair FROM {body}),
drawn{i} AS (SELECT rank, shard, s, n, CASE WHEN ((((((greatest(x, pair) % {_P}) * {g} + s % {_P}) % {_P}) * {h} + {f}) % {_P}) >> 13) & 1 = 1 THEN pair ELSE x END AS x FROM pair{i})"""
        )
        body = f"drawn{i}"
    weight = " ".join(f"WHEN rank % {len(WEIGHTS)} = {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    coalesce(('0x' || substr(md5(text), 1, 7))::BIGINT, 0) AS spread FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS BIGINT) AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(CASE {weight} END AS BIGINT) AS weight FROM sums),
levels AS (SELECT *, ({SHARE} * sum(source_size) OVER () - coalesce(sum(source_size) OVER w1, 0) * {CAP}) / (sum(weight) OVER w2) AS level FROM weighed
    WINDOW w1 AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           w2 AS (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
opened AS (SELECT *, source_size * {CAP} > weight * level AS fits FROM levels),
water AS (SELECT level FROM opened WHERE fits ORDER BY source_size / weight, rank LIMIT 1),
goals AS (SELECT source, source_size, rank, CASE WHEN fits THEN weight * (SELECT level FROM water) ELSE source_size * CAST({CAP} AS DOUBLE) END AS target,
    (source_size + {block - 1}) // {block} AS n FROM opened),
plan AS (SELECT *, CAST(floor(target / source_size) AS BIGINT) AS whole FROM goals WHERE source_size > 0),
slotted AS (SELECT *, whole * n + CAST(round((target - whole * source_size) * n / source_size) AS BIGINT) AS slots FROM plan),
cast_ AS (SELECT rank, n, unnest(range(slots)) AS j FROM slotted), mixed AS (SELECT *, ((j % {_P}) * {a} + (rank + 1) * {b}) % {_P} AS q FROM cast_), again AS (SELECT *, (q * q % {_P} + {d}) % {_P} AS y FROM mixed),
sharded AS (SELECT rank, n, ((y * y % {_P} * {c} + q) % {_P} >> 5) % greatest(1, CAST(ceil((SELECT sum(slots) FROM slotted) / {shard}.0) AS BIGINT)) AS shard FROM again),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY shard) - 1 AS j FROM sharded),
drawn0 AS (SELECT rank, shard, rank * 2 + j // n + 1 AS s, n, j % n AS x FROM numbered),
{", ".join(ctes)},
draws AS (SELECT rank, x AS block, count(*) AS draws, min(shard) AS low, max(shard) AS high FROM {body} GROUP BY rank, x),
bucketed AS (SELECT doc_id, d.size, rank, g.source_size, g.target,
    ((((doc_id % {_P}) + {_P}) % {_P}) * 48271 + spread) % {_P} % greatest(16, ceil((SELECT count(*) FROM sized WHERE size > 0) / {bucket_rows}.0)::BIGINT) AS bucket
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
placed AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY rank ORDER BY bucket, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM bucketed WHERE size > 0),
pieces AS (SELECT doc_id, rank, start, size, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS block FROM placed),
taken AS (SELECT p.doc_id, sum((least(start + size, (p.block + 1) * {block}) - greatest(start, p.block * {block})) * coalesce(draws, 0)) AS taken, min(low) AS first_shard, max(high) AS last_shard
    FROM pieces p LEFT JOIN draws USING (rank, block) GROUP BY p.doc_id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_shard, last_shard FROM bucketed LEFT JOIN taken USING (doc_id)
"""
