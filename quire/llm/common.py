"""Shared plumbing: row-wise Arrow passes, scratch space, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import scratch, shared_dir  # noqa: F401  (operators take them from here)

#: Rows in one Arrow batch. Texts reach hundreds of KB, so batches are kept
#: short to bound a worker's memory.
BATCH_ROWS = 256

_ALNUM_FOLD = bytes(
    b + 32
    if 0x41 <= b <= 0x5A
    else b
    if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def space_words(text: bytes | None) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; null has none.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is exactly the
    case folding and the white space that the contracts name.
    """
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased."""
    return text.translate(_ALNUM_FOLD).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short for text columns (see ``BATCH_ROWS``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def binaries(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def strings(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def annotate(
    df: DataFrame,
    fields: list[T.StructField],
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
) -> DataFrame:
    """Append columns computed batch by batch; a narrow pass with no shuffle.

    ``start`` runs once in each task and returns the function that maps a
    batch to the new columns. An input column that bears the name of a new
    one gives way to it; all other columns pass through untouched.
    """
    short_batches(df.sparkSession)
    new = {f.name for f in fields}
    kept = [f.name for f in df.schema if f.name not in new]
    schema = T.StructType([T.StructField(df.schema[k].name, df.schema[k].dataType) for k in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if batch.num_rows:
                old = [batch.column(batch.schema.get_field_index(k)) for k in kept]
                yield pa.RecordBatch.from_arrays(old + work(batch), names=kept + [f.name for f in fields])

    return df.mapInArrow(run, schema)


def aside(docs: DataFrame, *kept: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(``docs`` with private names for all but the kept columns, what gives them their own names back).

    A stage's own columns can then bear any name: none of the user's is in its way.
    """
    shown = docs.columns
    plain = lambda c: F.col("`" + c.replace("`", "``") + "`")
    private = {c: c if c in kept else f"__aside_{i}" for i, c in enumerate(shown)}
    return docs.select(*[plain(c).alias(private[c]) for c in shown]), lambda df: df.select(*[plain(private[c]).alias(c) for c in shown])


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))
