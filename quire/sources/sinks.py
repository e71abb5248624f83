"""Writers: module tables, reports and formatted results."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from . import shared


def links(df: DataFrame) -> DataFrame:
    """Link rows as they are stored: the end never null or 0, an empty context null."""
    return df.withColumn("verse_id_end", keys.range_end(F.col("verse_id_start"), F.col("verse_id_end"))).withColumn("context", F.nullif("context", F.lit("")))


def write_module(tables: dict[str, DataFrame], path: str, force: bool = False) -> int:
    """A module's tables as one published version (all of them or none); one that is there is only replaced with ``force``."""
    stored = {}
    for name, df in tables.items():
        text = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
        stored[name] = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})
    return shared.publish(next(iter(tables.values())).sparkSession, stored, path, force)


def append_results(df: DataFrame, path: str) -> None:
    """Results of one batch, appended; readers take the last line of a module."""
    df.write.mode("append").json(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def formatted(df: DataFrame, style: str = "pretty", width: int = 80) -> str:
    """A (bounded) result as text: json, pretty, table or count."""
    if style == "count":
        return str(df.count())
    rows = [json.loads(r) for r in df.toJSON().collect()]
    if style == "json":
        return json.dumps(rows, ensure_ascii=False)
    if style == "pretty":
        return json.dumps(rows, ensure_ascii=False, indent=2)
    cut = lambda s: s if len(s) <= width else s[: width - 1] + "…"
    lines = [[cut(str(r.get(c, ""))) for c in df.columns] for r in rows]
    sizes = [max([len(c), *(len(x[i]) for x in lines)]) for i, c in enumerate(df.columns)]
    return "\n".join("  ".join(v.ljust(s) for v, s in zip(x, sizes, strict=True)).rstrip() for x in [df.columns, *lines])
