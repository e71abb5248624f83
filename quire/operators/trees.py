"""Trees by parent pointer: closure, ancestors, bounded trees, ordinals.

Pointer doubling: every node first knows its parent; in each round it takes over
what its farthest known ancestor knows, so after ``k`` rounds it knows ``2**k``
ancestors, and a tree of 64 levels takes six joins of all nodes with themselves,
whatever its shape. A round is written to the shared folder; rounds end when all
chains have come to a root. What goes round in a cycle is cut where it meets
itself. Ids are unique; parents that are not there end a chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import shared

#: Roots up to this number are broadcast to the chains.
FEW_ROOTS = 100_000


def ancestry(nodes: DataFrame, ident: str, parent: str, label: Column | None = None, max_depth: int = 64) -> DataFrame:
    """(node, line): each node and its ancestors, nearest first, at most ``max_depth`` of them: ``array<struct<id, label, root>>``.

    ``root`` tells whether a node has no parent at all; the line of a node under
    a missing parent, in a cycle or too deep does not end in one.
    """
    spark = nodes.sparkSession
    own = nodes.where(F.col(ident).isNotNull()).select(
        F.col(ident).cast("long").alias("node"), F.col(parent).cast("long").alias("up"), F.struct(F.col(ident).cast("long").alias("id"), (F.lit(None).cast("string") if label is None else label).alias("label"), F.col(parent).isNull().alias("root")).alias("self")
    )
    above = own.select(F.col("node").alias("_node"), F.array("self").alias("chain"))
    state = own.join(above, F.col("up") == F.col("_node"), "left").select("node", "self", F.col("_node").alias("far"), F.coalesce("chain", F.array().cast(own.select(F.array("self").alias("c")).schema["c"].dataType)).alias("chain"))
    known = 1
    while True:
        path = shared.scratch(spark, "ancestry")
        state.write.parquet(path)
        state = spark.read.parquet(path)
        if known >= max_depth or not state.where("far IS NOT NULL").head(1):
            break
        other = state.select(F.col("node").alias("_node"), F.col("far").alias("_far"), F.col("chain").alias("_chain")).where(F.size("_chain") > 0)
        state = state.join(other, F.col("far") == F.col("_node"), "left").select("node", "self", F.col("_far").alias("far"), F.when(F.col("_node").isNull(), F.col("chain")).otherwise(F.concat("chain", "_chain")).alias("chain"))
        known *= 2
    line = F.concat(F.array("self"), F.col("chain"))
    # A chain that meets itself goes round from there on, so its different nodes come first.
    apart = F.size(F.array_distinct(F.transform(line, lambda n: n["id"])))
    return state.select("node", F.slice(line, F.lit(1), F.least(apart, F.lit(max_depth + 1))).alias("line"))


def _of(pairs: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Pairs whose ``column`` is one of the wanted ids."""
    ids = wanted.select(F.col(wanted.columns[0]).cast("long").alias("_wanted")).distinct()
    few = ids.limit(FEW_ROOTS + 1).count() <= FEW_ROOTS
    return pairs.join(F.broadcast(ids) if few else ids, F.col(column) == F.col("_wanted"), "left_semi")


def descendants(nodes: DataFrame, roots: DataFrame, ident: str, parent: str, max_depth: int = 64) -> DataFrame:
    """(root, node, depth, path): every node under each root, the root itself at depth 0."""
    lines = ancestry(nodes, ident, parent, max_depth=max(1, max_depth))
    ids = F.transform("line", lambda n: n["id"])
    pairs = lines.select("node", ids.alias("ids")).select("node", "ids", F.posexplode(F.slice("ids", F.lit(1), F.lit(max_depth + 1))).alias("depth", "root"))
    return _of(pairs, roots.select(ident), "root").select("root", "node", "depth", F.reverse(F.slice("ids", F.lit(1), F.col("depth") + 1)).alias("path"))


def ancestors(nodes: DataFrame, start: DataFrame, ident: str, parent: str, max_depth: int = 64) -> DataFrame:
    """(start, node, distance): the way up from each start, itself excluded; missing parents end it."""
    lines = _of(ancestry(nodes, ident, parent, max_depth=max_depth), start.select(ident), "node")
    return lines.select(F.col("node").alias("start"), F.posexplode(F.transform("line", lambda n: n["id"])).alias("distance", "node")).select("start", "node", "distance").where("distance > 0")


def breadcrumb(nodes: DataFrame, start: DataFrame, ident: str, parent: str, label: str) -> DataFrame:
    """(start, crumb): ancestors' labels from the root down, in one array; none for a root."""
    lines = _of(ancestry(nodes, ident, parent, F.col(label)), start.select(ident), "node")
    return lines.where(F.size("line") > 1).select(F.col("node").alias("start"), F.reverse(F.transform(F.slice("line", F.lit(2), F.size("line")), lambda n: n["label"])).alias("crumb"))


def ordinals(nodes: DataFrame, ident: str, parent: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``ordinal``: 1-based among siblings."""
    return nodes.withColumn("ordinal", F.row_number().over(Window.partitionBy(parent).orderBy(*order, ident)))


def dotted_numbers(nodes: DataFrame, ident: str, parent: str, order: list[str], max_depth: int = 64) -> DataFrame:
    """(node, number): ``2.1.3`` from sibling ordinals down from the roots; nodes in cycles or under missing parents have none."""
    lines = ancestry(ordinals(nodes, ident, parent, order), ident, parent, F.col("ordinal").cast("string"), max_depth)
    return lines.where(F.element_at("line", -1)["root"]).select("node", F.array_join(F.reverse(F.transform("line", lambda n: n["label"])), ".").alias("number"))


def render(rows: list[dict], root: int, ident: str = "topic_id", parent: str = "parent_topic_id", label: str = "name", counts: str | None = None) -> str:
    """A tree as text: four spaces a level, siblings numbered; for a bounded result on the driver."""
    kids: dict[int | None, list[dict]] = {}
    for r in rows:
        kids.setdefault(r[parent], []).append(r)
    head = next(r for r in rows if r[ident] == root)
    lines = [f"{head[label]}  (#{root})"]

    def walk(at: int, depth: int) -> None:
        for i, r in enumerate(kids.get(at, []), 1):
            note = f" [{r[counts]}v]" if counts and r.get(counts) else ""
            lines.append("    " * (depth - 1) + f"  {i}. {r[label]}{note}")
            walk(r[ident], depth + 1)

    walk(root, 1)
    return "\n".join(lines)
