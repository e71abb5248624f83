"""A training corpus in five stages, each read from what the one before has written.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.

1. quality: documents that the classifier rejects go.
2. near_duplicates: one document of each class of near copies stays.
3. decontamination: documents that hold a benchmark window go.
4. pii: personal data is replaced in ``text``; ``n_chars`` follows; all stay.
5. mixing: documents of the mix, with ``size``, ``target`` (of their source)
   and ``taken`` (words that the mix takes of them); those never drawn go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontamination, mixing, pii, quality, simhash
from quire.llm.common import scratch, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.remove_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
]
#: No SQL can express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last goes through a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            path = scratch(spark, f"pipeline-{number}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
