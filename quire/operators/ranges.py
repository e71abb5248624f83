"""Range joins without a nested loop: bins, an equi-join, and the exact test.

``a.start <= b.end AND a.end >= b.start`` alone plans as a nested loop. Here a
range goes to every bin that it touches, bins meet in an equi-join, and a pair
is kept only in the first bin that both touch, so no DISTINCT is needed. Bins
come in levels, each ``wide`` times as wide as the one below; a range's own
level is the lowest on which it touches at most ``wide + 1`` bins, and two
ranges meet on the higher of their levels. So a row makes at most ``wide + 1``
copies on its own level and two on each higher one that occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import scan

#: Bins up to which a range is dealt out.
WIDE = 64


def _bin(x: Column, width: int) -> Column:
    return F.floor(x / F.lit(width)).cast("long")


def overlap_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], width: int, wide: int = WIDE) -> DataFrame:
    """Pairs of inclusive ranges that share a point; null or inverted ranges match nothing.

    The sides must not share column names. The levels that occur (at most a
    dozen numbers) are found by one small aggregate on either side.
    """
    keep = lambda d, s, e: d.where(F.col(s).isNotNull() & F.col(e).isNotNull() & (F.col(s) <= F.col(e)))
    left, right = keep(left, *left_range), keep(right, *right_range)
    level = lambda r: F.coalesce(*[F.when(_bin(F.col(r[1]), w) - _bin(F.col(r[0]), w) <= wide, F.lit(i)) for i, w in enumerate(widths)], F.lit(len(widths) - 1))
    widths = [width]
    while widths[-1] < 1 << 56 and len(widths) < 12:
        widths.append(widths[-1] * wide)
    found = left.select(level(left_range).alias("_l")).union(right.select(level(right_range).alias("_l"))).distinct()
    used = sorted(r["_l"] for r in found.collect())
    a = _binned(left, left_range, level(left_range), used, widths, "_la", "_fa")
    b = _binned(right, right_range, level(right_range), used, widths, "_lb", "_fb")
    met = a.join(b, ["_level", "_bin"]).where((F.col("_level") == F.greatest("_la", "_lb")) & (F.col("_bin") == F.greatest("_fa", "_fb")))
    met = met.where((F.col(left_range[0]) <= F.col(right_range[1])) & (F.col(left_range[1]) >= F.col(right_range[0])))
    return met.select(*left.columns, *right.columns)


def _binned(d: DataFrame, r: tuple[str, str], level: Column, used: list[int], widths: list[int], own: str, first: str) -> DataFrame:
    """One row for each bin that a range touches on its own level and on each higher one in use."""
    steps = F.array(*[F.struct(F.lit(i).alias("l"), F.lit(widths[i]).cast("long").alias("w")) for i in used]) if used else F.array().cast("array<struct<l:int,w:bigint>>")
    d = d.withColumn(own, level).withColumn("_step", F.explode(F.filter(steps, lambda x: x["l"] >= F.col(own))))
    low, high = (F.floor(F.col(x) / F.col("_step.w")).cast("long") for x in r)
    return d.withColumns({"_level": F.col("_step.l"), first: low}).withColumn("_bin", F.explode(F.sequence(F.col(first), high))).drop("_step")


def overlap_sums(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], sums: dict[str, Column]) -> DataFrame:
    """``right`` with ``sums`` over the rows of ``left`` whose inclusive range shares a point with its own; those that meet none are left out.

    No pair is made: of all ranges, those that begin by the end of a range and have
    not ended before its start meet it. So a sum is the difference of two
    running sums over the distinct bounds. Null or inverted ranges match nothing.
    """
    keep = lambda d, s, e: d.where(F.col(s).isNotNull() & F.col(e).isNotNull() & (F.col(s) <= F.col(e)))
    left, right = keep(left, *left_range), keep(right, *right_range)
    own = {f"_{i}": c for i, c in enumerate([F.lit(1).cast("long"), *sums.values()])}
    none = {n: F.lit(None) for n in own}

    def points(d: DataFrame, bound: str, tie: int, opened: dict[str, Column], closed: dict[str, Column]) -> DataFrame:
        return d.select(F.col(bound).alias("_bound"), F.lit(tie).alias("_tie"), *[c.alias(f"_open{n}") for n, c in opened.items()], *[c.alias(f"_shut{n}") for n, c in closed.items()])

    # At one place the starts come first, then the bounds that ask, then the ends.
    bounds = points(left, left_range[0], 0, own, none).unionByName(points(left, left_range[1], 2, none, own))
    for bound in right_range:
        bounds = bounds.unionByName(points(right, bound, 1, none, none))
    names = [f"_{side}{n}" for side in ("open", "shut") for n in own]
    merged = bounds.groupBy("_bound", "_tie").agg(*[F.sum(n).alias(n) for n in names])
    asked = scan.segmented(merged, [], ["_bound", "_tie"], {n: F.col(n) for n in names}).where("_tie = 1")
    begun = asked.select(F.col("_bound").alias(right_range[1]), *[f"_open{n}" for n in own])
    over = asked.select(F.col("_bound").alias(right_range[0]), *[f"_shut{n}" for n in own])
    met = right.join(begun, right_range[1]).join(over, right_range[0])
    total = lambda i: F.col(f"_open_{i}") - F.col(f"_shut_{i}")
    return met.where(total(0) > 0).select(*right.columns, *[total(i).alias(n) for i, n in enumerate(sums, 1)])


#: A node of the cover is split into this many of the level below.
FAN = 4
#: Rules whose covers one task lays out.
TASK_RULES = 20_000


def _node(level: int):
    return lambda n: F.struct(F.lit(level).alias("level"), n.alias("node"))


def cover(low: Column, high: Column, top: int) -> Column:
    """The fewest nodes that make up an inclusive range: ``array<struct<level, node>>``.

    A node of level ``l`` is a range of ``FAN ** l`` numbers that begins at a
    multiple of that; levels go up to ``top``. Below the top a level has at most
    ``2 * (FAN - 1)`` of them.
    """
    end = high + 1  # the first number past the range
    floor = lambda x, w: F.call_function("div", x - F.pmod(x, F.lit(w)), F.lit(w)) if w > 1 else x
    ceil = lambda x, w: -floor(-x, w)
    parts = []
    for level in range(top + 1):
        a, b = ceil(low, FAN**level), floor(end, FAN**level)
        if level == top:
            spans = [(a, b)]
        else:  # what the level above does not hold
            up, down = ceil(low, FAN ** (level + 1)) * FAN, floor(end, FAN ** (level + 1)) * FAN
            spans = [(a, F.when(up < down, up).otherwise(b)), (F.when(up < down, down).otherwise(b), b)]
        nodes = F.concat(*[F.when(x < y, F.sequence(x, y - 1)).otherwise(F.array().cast("array<bigint>")) for x, y in spans])
        parts.append(F.transform(nodes, _node(level)))
    return F.flatten(F.array(*parts))


def compiled_rules(rules: DataFrame, group: tuple[str, ...], low: str = "low", high: str = "high", order: str = "rule_order", outputs: tuple[str, ...] = ("target",), scale: int = 1) -> tuple[DataFrame, int]:
    """((group, level, node, rule), top level): the first rule of every node that some rule's cover has.

    However the rules overlap, a group has at most a few dozen nodes for each of
    its rules, and a number lies in one node of each level; so a look-up is an
    equi-join, also in a group of a million rules. Bounds are whole numbers.
    """
    a, b = F.col(low).cast("long") * scale, F.col(high).cast("long") * scale
    real = rules.where(F.col(low) <= F.col(high))
    widest, n = real.agg(F.max(b - a), F.count("*")).first()
    top = 0
    while widest is not None and FAN ** (top + 1) <= widest + 1 and top < 30:
        top += 1
    if n > TASK_RULES:  # a small file is one task, and a rule makes dozens of nodes
        real = real.repartition(-(-n // TASK_RULES), *group, order)
    nodes = real.select(*group, F.explode(cover(a, b, top)).alias("n"), F.struct(order, *outputs).alias("_rule"))
    return nodes.groupBy(*group, F.col("n.level").alias("_level"), F.col("n.node").alias("_node")).agg(F.min("_rule").alias("_rule")), top


def first_rule(rows: DataFrame, rules: DataFrame, group: tuple[str, ...], value: str, low: str = "low", high: str = "high", order: str = "rule_order", outputs: tuple[str, ...] = ("target",)) -> DataFrame:
    """``rows`` with ``outputs`` of the first rule (by ``order``) of its group whose range holds ``value``; null if none.

    Rows sharing (group, value) are resolved once: the aggregate runs over the
    distinct keys, not over the rows. No rule is tested against a value: both
    meet on the nodes of ``compiled_rules``. A value between two whole numbers
    has a place of its own between theirs.
    """
    whole = isinstance(rows.schema[value].dataType, IntegralType)
    compiled, top = compiled_rules(rules, group, low, high, order, outputs, 1 if whole else 2)
    v = F.col(value)
    place = v.cast("long") if whole else F.floor(v).cast("long") * 2 + (v > F.floor(v)).cast("long")
    at = F.col("_place")
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("l"), F.call_function("div", at - F.pmod(at, F.lit(FAN**i)), F.lit(FAN**i)).alias("n")) for i in range(top + 1)]))
    probes = rows.select(*group, value).distinct().withColumn("_place", place).where("_place IS NOT NULL").withColumn("_at", levels)
    found = probes.select(*group, value, F.col("_at.l").alias("_level"), F.col("_at.n").alias("_node")).join(compiled, [*group, "_level", "_node"]).groupBy(*group, value).agg(F.min("_rule").alias("_rule"))
    return rows.join(found, [*group, value], "left").withColumns({o: F.col(f"_rule.{o}") for o in outputs}).drop("_rule")
