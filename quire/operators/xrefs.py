"""Import of cross-reference entries: phrases, their links, and what the links name."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.refs import Books, parse_reference_list, phrase_groups

GROUPS = "array<struct<phrase:string,refs:array<struct<start:bigint,end:bigint>>>>"
from .sequence import content_hash


def parse_entries(entries: DataFrame, verse_id: str, content: str, books: Books | None = None) -> DataFrame:
    """``entries`` with ``groups``; one Arrow pass, since reading a list of references is stateful."""
    table = books or Books()

    def run(key: pd.Series, html: pd.Series) -> pd.Series:
        out = []
        for k, h in zip(key, html, strict=True):
            found = []
            for phrase, lists in phrase_groups(h) if k is not None and not pd.isna(k) else []:
                refs = [r for text in lists for r in parse_reference_list(text, int(k) // 1_000_000, int(k) // 1000 % 1000, table)]
                found.append({"phrase": phrase, "refs": [{"start": a, "end": b} for a, b in refs]})
            out.append(found)
        return pd.Series(out)

    return entries.withColumn("groups", F.pandas_udf(run, GROUPS)(F.col(verse_id), F.col(content)))


def group_rows(parsed: DataFrame, verse_id: str) -> DataFrame:
    """(group_key, verse_id_start, verse_id_end, phrase, sort_order, refs): groups that keep a valid link.

    ``sort_order`` restarts for each verse; links outside of the 66 books go.
    """
    each = parsed.select(F.col(verse_id).alias("verse_id_start"), F.posexplode("groups").alias("place", "g"))
    valid = F.filter("g.refs", lambda r: keys.book_of(r["start"]).between(1, 66) & keys.book_of(r["end"]).between(1, 66))
    kept = each.select("verse_id_start", "place", F.col("g.phrase").alias("phrase"), valid.alias("refs")).where(F.size("refs") > 0)
    order = Window.partitionBy("verse_id_start").orderBy("place")
    return kept.select(
        F.concat_ws(":", "verse_id_start", "place").alias("group_key"), "verse_id_start", F.col("verse_id_start").alias("verse_id_end"), "phrase",
        F.row_number().over(order).alias("sort_order"), "refs",
    )


def link_rows(groups: DataFrame) -> DataFrame:
    """(group_key, verse_id_start, verse_id_end, sort_order, context) of every link, in its group's order."""
    each = groups.select("group_key", F.col("phrase").alias("context"), F.posexplode("refs").alias("place", "r"))
    return each.select("group_key", F.col("r.start").alias("verse_id_start"), keys.range_end(F.col("r.start"), F.col("r.end")).alias("verse_id_end"), (F.col("place") + 1).alias("sort_order"), "context")


def rejected(parsed: DataFrame, most: int = 20) -> DataFrame:
    """(start, end) of links outside of the 66 books, the first ``most`` for the report."""
    each = parsed.select(F.explode("groups").alias("g")).select(F.explode("g.refs").alias("r")).select("r.*")
    return each.where(~(keys.book_of(F.col("start")).between(1, 66) & keys.book_of(F.col("end")).between(1, 66))).orderBy("start", "end").limit(most)


def linked_passages(groups: DataFrame, links: DataFrame, low: int, high: int, limit: int = 50) -> DataFrame:
    """Links of the groups that overlap a range: groups are filtered before the join."""
    hit = groups.where(keys.overlaps(F.col("verse_id_start"), F.col("verse_id_end"), low, high)).select("group_id", "phrase", F.col("sort_order").alias("g_order"))
    own = links.where("source_type = 'cross_reference'").select("link_id", F.col("source_id").alias("group_id"), "verse_id_start", "verse_id_end", F.col("sort_order").alias("l_order"))
    return own.join(hit, "group_id").orderBy("g_order", "l_order", "link_id").limit(limit)


def content_digest(groups: DataFrame, links: DataFrame, module: str = "module") -> DataFrame:
    """(module, content_sha256): a line for each link of a group, and one for a group without links; lines are parted, not ended, by a line feed."""
    own = links.select(F.col(module).alias("_m"), F.col("source_id").alias("_g"), F.col("verse_id_start").alias("_a"), F.col("verse_id_end").alias("_b"), F.col("sort_order").alias("_o"))
    both = groups.join(own, (F.col(module) == F.col("_m")) & (F.col("group_id") == F.col("_g")), "left")
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("verse_id_start", "verse_id_end", "phrase", "_a", "_b")])
    return content_hash(both, module, ["group_id", "_o"], line, "\n")
