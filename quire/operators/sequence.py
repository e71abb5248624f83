"""Ordered state as segmented scans and shifted equi-joins over a source's order column ``i``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import segmented


def repeats_previous(df: DataFrame, group: str, order: str, raw: str) -> DataFrame:
    """``df`` with ``repeats``: the same non-empty value as the row before it in its group."""
    rows = segmented(df, [group], [order], lags={"_before": F.col(raw)})
    return rows.withColumn("repeats", F.coalesce((F.col(raw) != "") & (F.col("_before") == F.col(raw)), F.lit(False))).drop("_before")


def carried(df: DataFrame, group: str, order: str, flag: str, name: str = "carried") -> DataFrame:
    """The flag of the row before, handed to the next row that is there (filter skipped rows first)."""
    return segmented(df, [group], [order], lags={name: F.col(flag)}).withColumn(name, F.coalesce(name, F.lit(False)))


def first_of_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; as an aggregate, so duplicates go on the map side already."""
    others = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return best.select(*key, *[F.col(f"_first.{c}").alias(c) for c in others]).select(*df.columns)


def until_duplicates(df: DataFrame, group: str, key: str, order: str, most: int = 100) -> DataFrame:
    """First row of each key, and nothing from the ``most + 1``-th duplicate of the group on."""
    seen = Window.partitionBy(group, key).orderBy(order)
    marked = df.withColumn("_again", (F.row_number().over(seen) > 1).cast("int"))
    late = marked.where("_again = 1").withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    stop = late.where(F.col("_n") == most + 1).select(F.col(group).alias("_g"), F.col(order).alias("_stop"))
    kept = marked.join(stop, F.col(group) == F.col("_g"), "left")
    return kept.where((F.col("_again") == 0) & (F.col("_stop").isNull() | (F.col(order) < F.col("_stop")))).drop("_again", "_g", "_stop")


def running_offset(df: DataFrame, group: str, order: str, size: str, name: str = "offset") -> DataFrame:
    """The sum of the sizes before each row of its group."""
    return segmented(df, [group], [order], sums={name: F.col(size)})


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """1-based place in its group (no group: over all)."""
    return segmented(df, group, order, number=name)


def best_copy(df: DataFrame, key: Column, rank: Column, order: str) -> DataFrame:
    """The row of the best rank for each key; ties go to the first in ``order``."""
    others = F.struct(*df.columns)
    return df.groupBy(key.alias("_key")).agg(F.min_by(others, F.struct(rank, F.col(order))).alias("_best")).select("_best.*")


def latest(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("_last")).select("_last.*")


def equal_neighbours(df: DataFrame, key: str, text: str, least: int = 20) -> DataFrame:
    """(key, next_key) of rows whose successor ``key + 1`` has the same text of over ``least`` characters; gaps never match."""
    rows = df.where(F.length(text) > least).select(F.col(key).alias("a_key"), F.col(text).alias("a_text"))
    after = rows.select((F.col("a_key") - 1).alias("a_key"), F.col("a_text").alias("b_text"))
    return rows.join(after, "a_key").where("a_text = b_text").select(F.col("a_key").alias(key), (F.col("a_key") + 1).alias("next_key"))


def content_hash(df: DataFrame, group: str, order: list[str], line: Column, between: str = "") -> DataFrame:
    """(group, content_sha256): SHA-256 of all lines in order, ``between`` between two; null lines add nothing, ties go by the line.

    A digest needs one sequence, so a group is one task; but it is never held:
    its lines come sorted (on disk, if need be) and a batch at a time.
    """
    rows = df.select(F.col(group).alias("_group"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.encode(line, "UTF-8").alias("_line"))
    laid = rows.repartition("_group").sortWithinPartitions("_group", *[f"_o{i}" for i in range(len(order))], "_line").select("_group", "_line")

    gap = between.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, kind, begun = None, None, None, False

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()], pa.string())], names=["_group", "content_sha256"])

        for batch in batches:
            groups, lines, kind = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.schema.field(0).type
            at = 0
            while at < len(groups):
                end = at + 1
                while end < len(groups) and groups[end] == groups[at]:
                    end += 1
                if state is None or groups[at] != now:
                    if state is not None:
                        yield closed()
                    now, state, begun = groups[at], hashlib.sha256(), False
                if part := [x for x in lines[at:end] if x is not None]:
                    state.update((gap if begun else b"") + gap.join(part))
                    begun = True
                at = end
        if state is not None:
            yield closed()

    schema = T.StructType([T.StructField("_group", df.schema[group].dataType), T.StructField("content_sha256", T.StringType())])
    return laid.mapInArrow(run, schema).withColumnRenamed("_group", group)
