"""Folders that all executors share, and tables that are published in one step."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a local session gets a folder of its own; on a cluster
    that is an error, for no local folder is shared.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Conflict(ValueError):
    """A version is published already, or was published meanwhile."""


# Publication ------------------------------------------------------------------------
#
# ``<path>/versions/<id>/<table>`` holds the tables of a version, and
# ``<path>/manifest`` one row for each version. The row is appended when all
# tables are there: what fails before leaves the last version as it was, and
# what it has written is seen by nobody.

MANIFEST = "version long, folder string, counts map<string,long>, digest string, note string"


def history(spark: SparkSession, path: str) -> list:
    """Rows of the manifest, the newest last: one for each version."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    return sorted(rows, key=lambda r: (r["version"], r["folder"]))


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, force: bool = False, note: dict | Callable[[dict[str, DataFrame]], dict] | None = None, expect: int | None = None, partition_by: dict[str, str] | None = None) -> int:
    """Write the tables as a new version and make it the current one; the version's number.

    Without ``force`` a path that has a version is refused before anything is
    written. ``expect`` is the version that the writer has read: if another one
    has come meanwhile, the new one is not published. Counts and an
    order-independent digest of each table are read back from what was written,
    and so is a ``note`` that is a function of the tables.
    """
    path = path.rstrip("/")
    before = history(spark, path)
    current = before[-1]["version"] if before else 0
    if before and not force:
        raise Conflict(f"{path} has version {current}; force is needed to replace it")
    if expect is not None and expect != current:
        raise Conflict(f"{path} has version {current}, not {expect}")
    folder = f"{path}/versions/{uuid.uuid4().hex}"
    counts, digests, written = {}, [], {}
    for name, df in tables.items():
        writer = df.write.partitionBy(partition_by[name]) if partition_by and name in partition_by else df.write
        writer.parquet(f"{folder}/{name}")
        written[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        row = digest_of(written[name]).first()
        counts[name] = row["n"]
        digests.append(f"{name}:{row['n']}:{row['digest']}")
    latest = history(spark, path)
    if (latest[-1]["version"] if latest else 0) != current:
        raise Conflict(f"{path} was published by another writer")
    entry = [(current + 1, folder, counts, ",".join(sorted(digests)), json.dumps((note(written) if callable(note) else note) or {}, sort_keys=True))]
    spark.createDataFrame(entry, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return current + 1


def digest_of(df: DataFrame) -> DataFrame:
    """(n, digest): the number of rows, and the exclusive or of their hashes with the sum of these; no order is needed."""
    shown = [F.to_json(F.col(f"`{c.name}`")) if c.dataType.typeName() in ("map", "variant") else F.col(f"`{c.name}`") for c in sorted(df.schema, key=lambda c: c.name)]
    h = F.xxhash64(*shown) if shown else F.lit(0).cast("long")
    return df.agg(F.count("*").alias("n"), F.concat_ws("-", F.hex(F.coalesce(F.bit_xor(h), F.lit(0).cast("long"))), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")).alias("digest"))


def published(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the current version, or of a given one."""
    rows = [r for r in history(spark, path) if version is None or r["version"] == version]
    if not rows:
        raise LookupError(f"nothing is published at {path}" + ("" if version is None else f" as version {version}"))
    return {name: spark.read.parquet(f"{rows[-1]['folder']}/{name}") for name in sorted(rows[-1]["counts"])}


def verify_published(spark: SparkSession, path: str) -> list[str]:
    """Names of the current version's tables that are not what was published."""
    row = history(spark, path)[-1]
    wrong = []
    for entry in row["digest"].split(","):
        name, n, digest = entry.split(":")
        try:
            found = digest_of(spark.read.parquet(f"{row['folder']}/{name}")).first()
        except AnalysisException:
            found = None
        if found is None or (str(found["n"]), found["digest"]) != (n, digest):
            wrong.append(name)
    return wrong
