"""Running numbers, sums and neighbours over long sequences, in segments.

A window over a module is one task, however long the module is. Here a sequence
is cut by its order column into segments of ``size`` values. Every segment's
count, sums and last row are one small aggregate; a window over these (one row a
segment) gives what each segment begins with, and the rows are windowed inside
their segment only. So no task holds more than ``size`` different orders, and
what is handed from segment to segment is a row.

The order column is a whole number, not null; rows of equal order are told apart
by the further columns of ``order``. With another type of order column there are
no segments, and a plain window does the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

SIZE = 1 << 16


def segmented(df: DataFrame, group: list[str], order: list[str], sums: dict[str, Column] | None = None, lags: dict[str, Column] | None = None, number: str | None = None, size: int = SIZE) -> DataFrame:
    """``df`` with, inside its group: ``sums`` over the rows before (0 for the first), ``lags`` of the row before (null for the first), and ``number`` from 1."""
    sums, lags = sums or {}, lags or {}
    whole = isinstance(df.schema[order[0]].dataType, IntegralType)
    inputs = {f"_s{i}": F.coalesce(c, F.lit(0)) for i, c in enumerate(sums.values())} | {f"_l{i}": c for i, c in enumerate(lags.values())}
    segment = F.floor(F.col(order[0]) / size).cast("long") if not whole else F.expr(f"(`{order[0]}` - pmod(`{order[0]}`, {size})) div {size}")
    rows = df.withColumns({"_segment": segment if whole else F.lit(0).cast("long")} | inputs)
    w = Window.partitionBy(*group, "_segment").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    if not whole:
        plain = {n: F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)) for i, n in enumerate(sums)} | {n: F.lag(f"_l{i}").over(w) for i, n in enumerate(lags)}
        return rows.withColumns(plain | ({number: F.row_number().over(w).cast("long")} if number else {})).select(*df.columns, *_new(df, sums, lags, number))
    last = [F.max_by(F.struct(*[F.col(f"_l{i}").alias(f"l{i}") for i in range(len(lags))]), F.struct(*order)).alias("_last")] if lags else []
    per = rows.groupBy(*group, "_segment").agg(F.count("*").alias("_n"), *[F.sum(f"_s{i}").alias(f"_t{i}") for i in range(len(sums))], *last)
    up = Window.partitionBy(*group).orderBy("_segment")
    past = up.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_n"), *[F.coalesce(F.sum(f"_t{i}").over(past), F.lit(0)).alias(f"_t{i}") for i in range(len(sums))]]
    carry = per.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_segment").alias("_at"), *carried, *([F.lag("_last").over(up).alias("_last")] if lags else []))
    same = F.col("_segment") == F.col("_at")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    met = rows.join(carry, same)
    place = F.row_number().over(w)
    out = {n: F.col(f"_t{i}") + F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)) for i, n in enumerate(sums)}
    out |= {n: F.when(place == 1, F.col(f"_last.l{i}")).otherwise(F.lag(f"_l{i}").over(w)) for i, n in enumerate(lags)}
    if number:
        out[number] = F.col("_n") + place
    new = met.withColumns({f"_out{i}": c for i, c in enumerate(out.values())})
    return new.select(*[c for c in df.columns if c not in out], *[F.col(f"_out{i}").alias(n) for i, n in enumerate(out)]).select(*df.columns, *_new(df, sums, lags, number))


def _new(df: DataFrame, sums: dict, lags: dict, number: str | None) -> list[str]:
    return [n for n in (*sums, *lags, *([number] if number else [])) if n not in df.columns]
