"""A stored text index: postings by term, written once, kept up to date by segments.

A segment has ``postings`` (a row for each token of a document's column: its
places, and the length of the document) and ``docs`` (a row for each document:
its length, and a digest of its text by which ``refresh`` finds what changed).
Postings are partitioned by a hash of the term's first two letters and sorted by
term inside; a partition is dealt over ``SALTS`` files by document, so a frequent
term is no single task, and a query reads the partitions of its terms only; so
does a prefix of two letters or more. As every posting carries its document's length,
and the manifest the number of documents and tokens, a query's rank needs no
other table.

``update`` appends a segment with the changed documents and the ids that no
longer count in the segments before it (triggers would do that row by row);
``compact`` merges all segments into one. A segment counts from the moment its
row stands in the manifest. Ids are unique; rows without an id are left out;
a document without tokens counts for the corpus as any other.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import shared
from . import fulltext

BUCKETS, SALTS = 64, 16
#: Postings that a task hands over at a time, and documents that it takes apart at a time.
CHUNK, SLICE = 20_000, 64


def bucket_of(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.substring(token, 1, 2)), F.lit(buckets)).cast("int")


def postings(docs: DataFrame, ident: str, columns: list[str], stem: bool = True) -> DataFrame:
    """(doc_id, token, col, places, len): one row for each token of a document's column; a narrow pass.

    Marks are taken off the distinct words, not the texts: that maps letters to letters, so the tokens' bounds are the same.
    """
    lists = F.array(*[F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), F.array().cast("array<string>")) for c in columns])
    rows = docs.where(F.col(ident).isNotNull()).select(F.col(ident).alias("doc_id"), lists.alias("tokens"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)]).add("token", T.StringType()).add("col", T.IntegerType()).add("places", T.ArrayType(T.IntegerType())).add("len", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                out = _postings_of(batch.column(0).slice(at, SLICE), batch.column(1).slice(at, SLICE), known if stem else None)
                for i in range(0, len(out), CHUNK):
                    yield out.slice(i, CHUNK)
                if len(known) > 200_000:
                    known.clear()

    return rows.mapInArrow(run, schema)


def _postings_of(ids: pa.Array, lists: pa.Array, known: dict[str, str] | None) -> pa.RecordBatch:
    """Rows of the postings from the token lists of each document's columns; with ``known`` words are stemmed, each distinct one once."""
    each = lists.flatten()  # a document's columns follow one another
    columns = len(each) // max(1, len(ids))
    sizes = each.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = each.flatten().dictionary_encode()
    names, code = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
    words = [w if w.isascii() else fulltext.unmarked(w) for w in names.to_pylist()]
    if known is not None:
        words = [known[w] if w in known else known.setdefault(w, fulltext.porter(w)) for w in words]
    merged = pa.array(words, pa.string()).dictionary_encode()
    names, code = merged.dictionary, merged.indices.to_numpy().astype(np.int64)[code]
    place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = np.repeat(np.arange(len(each)), sizes) * max(1, len(names)) + code
    order = np.argsort(key, kind="stable")  # leaves a word's places in order
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    where, code = np.divmod(key[first], max(1, len(names)))
    row, col = np.divmod(where, max(1, columns))
    arrays = [
        ids.take(pa.array(row)), names.take(pa.array(code)), pa.array(col, pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), pa.array(place[order], pa.int32())),
        pa.array(sizes.reshape(len(ids), columns).sum(axis=1)[row], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "token", "col", "places", "len"])


def _segment(docs: DataFrame, ident: str, columns: list[str], stem: bool, buckets: int) -> dict[str, DataFrame]:
    rows = postings(docs, ident, columns, stem)
    size = sum((F.regexp_count(F.coalesce(F.lower(c), F.lit("")), F.lit(r"[\p{L}\p{N}]+")) for c in columns), F.lit(0))
    named = docs.where(F.col(ident).isNotNull()).select(F.col(ident).alias("doc_id"), size.cast("long").alias("len"), _digest(columns).alias("digest"))
    return {"postings": _laid_out(rows, buckets), "docs": named}


def _digest(columns: list[str]) -> Column:
    """Tells whether a document is as it was: of its own old and new text, so 64 bits do."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _laid_out(rows: DataFrame, buckets: int) -> DataFrame:
    placed = rows.withColumn("bucket", bucket_of(F.col("token"), buckets))
    return placed.repartition("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).sortWithinPartitions("bucket", "token", "doc_id", "col")


def _totals(docs: DataFrame) -> tuple[int, int]:
    row = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum("len"), F.lit(0)).alias("total")).first()
    return row["n"], row["total"]


def build(docs: DataFrame, ident: str, columns: list[str], path: str, stem: bool = True, buckets: int = BUCKETS, force: bool = False) -> TextIndex:
    """Index ``columns`` of ``docs`` at ``path``; an index that is there is only replaced with ``force``."""
    spark = docs.sparkSession
    shape = {"columns": columns, "stem": stem, "buckets": buckets, "base": True}
    parts = _segment(docs, ident, columns, stem, buckets)
    note = lambda written: shape | dict(zip(("n", "total"), _totals(written["docs"]), strict=True))
    shared.publish(spark, parts, path, force, note, partition_by={"postings": "bucket"})
    return TextIndex(spark, path)


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str
    version: int = field(init=False, default=0)
    segments: tuple = field(init=False, default=())
    shape: dict = field(init=False, default_factory=dict)
    allowed: tuple[int, ...] | None = None

    def __post_init__(self):
        rows = shared.history(self.spark, self.path)
        if not rows:
            raise LookupError(f"no index at {self.path}")
        notes = [json.loads(r["note"]) for r in rows]
        first = max(i for i, n in enumerate(notes) if n["base"])
        for name, value in (("version", rows[-1]["version"]), ("segments", tuple((r["version"], r["folder"]) for r in rows[first:])), ("shape", notes[-1])):
            object.__setattr__(self, name, value)

    def restricted(self, names: tuple[str, ...], without: bool = False) -> TextIndex:
        """The same over some columns only (or all but these)."""
        columns = self.shape["columns"]
        if unknown := [n for n in names if n not in columns]:
            raise ValueError(f"no such column: {unknown[0]}")
        hit = {i for i, c in enumerate(columns) if (c in names) != without}
        return replace(self, allowed=tuple(sorted(hit if self.allowed is None else hit & set(self.allowed))))

    def _live(self, table: str, test: Column | None = None) -> DataFrame:
        """Rows of all segments but those of documents that a later segment has replaced or removed."""
        out = None
        for number, folder in self.segments:
            rows = self.spark.read.parquet(f"{folder}/{table}").withColumn("_segment", F.lit(number).cast("long"))
            rows = rows if test is None else rows.where(test)
            out = rows if out is None else out.unionByName(rows)
        if len(self.segments) > 1:
            gone = None
            for number, folder in self.segments[1:]:
                one = self.spark.read.parquet(f"{folder}/gone").select(F.col("doc_id").alias("_gone"), F.lit(number).cast("long").alias("_at"))
                gone = one if gone is None else gone.unionByName(one)
            last = gone.groupBy("_gone").agg(F.max("_at").alias("_at"))
            out = out.join(last, (F.col("doc_id") == F.col("_gone")) & (F.col("_segment") < F.col("_at")), "left_anti")
        return out.drop("_segment")

    def term(self, term: str) -> DataFrame:
        """(doc_id, pos, token, len) of a term or a ``prefix*``; reads the term's partitions only."""
        prefix = term.endswith("*")
        word = term[:-1] if prefix else fulltext.porter(term) if self.shape["stem"] else term
        test = F.col("token").startswith(word) if prefix else F.col("token") == word
        if not prefix or len(word) >= 2:
            test = (F.col("bucket") == bucket_of(F.lit(word), self.shape["buckets"])) & test
        if self.allowed is not None:
            test = test & F.col("col").isin(*self.allowed)
        rows = self._live("postings", test)
        return rows.select("doc_id", F.explode(F.transform("places", lambda p: F.col("col") * F.lit(fulltext.APART) + p)).alias("pos"), "token", "len")

    def update(self, changed: DataFrame | None = None, removed: DataFrame | None = None, ident: str = "doc_id") -> TextIndex:
        """A new segment: ``changed`` documents (new ones too) and ids of ``removed`` ones; the index after it."""
        s = self.shape
        if changed is None and removed is None:
            return self
        spark = self.spark
        if changed is None:
            changed = spark.createDataFrame([], T.StructType([T.StructField(ident, removed.schema[ident].dataType), *[T.StructField(c, T.StringType()) for c in s["columns"]]]))
        parts = _segment(changed, ident, s["columns"], s["stem"], s["buckets"])
        gone = parts["docs"].select("doc_id")
        if removed is not None:
            gone = gone.union(removed.where(F.col(ident).isNotNull()).select(ident))
        parts["gone"] = gone.distinct()

        def note(written: dict[str, DataFrame]) -> dict:
            lost, lost_total = _totals(self._live("docs").join(written["gone"], "doc_id", "left_semi"))
            n, total = _totals(written["docs"])
            return s | {"base": False, "n": s["n"] - lost + n, "total": s["total"] - lost_total + total}

        shared.publish(spark, parts, self.path, True, note, expect=self.version, partition_by={"postings": "bucket"})
        return TextIndex(spark, self.path)

    def refresh(self, docs: DataFrame, ident: str = "doc_id") -> TextIndex:
        """The index of ``docs`` as they are now: only new and changed ones are read into postings; equal tables add no segment."""
        now = docs.where(F.col(ident).isNotNull())
        was = self._live("docs").select(F.col("doc_id").alias("_was"), F.col("digest").alias("_digest"))
        changed = now.join(was, (F.col(ident) == F.col("_was")) & (_digest(self.shape["columns"]) == F.col("_digest")), "left_anti")
        removed = was.join(now.select(F.col(ident).alias("_now")), F.col("_was") == F.col("_now"), "left_anti").select(F.col("_was").alias(ident))
        if not changed.head(1) and not removed.head(1):
            return self
        return self.update(changed, removed, ident)

    def compact(self) -> TextIndex:
        """One segment in place of all; texts are not read again."""
        rows = self._live("postings").drop("bucket")
        shared.publish(
            self.spark, {"postings": _laid_out(rows, self.shape["buckets"]), "docs": self._live("docs")}, self.path, True, self.shape | {"base": True}, expect=self.version, partition_by={"postings": "bucket"}
        )
        return TextIndex(self.spark, self.path)


def search(index: TextIndex, query: str, limit: int | None = 25) -> DataFrame:
    """(doc_id, rank): minus BM25, smaller is better; ties by doc_id. Number and mean length of documents are literals."""
    node = fulltext.parse_query(query)
    s = index.shape
    hits = None
    for c, (clause, columns) in enumerate(fulltext.phrases(node)):
        places = fulltext.clause_places(fulltext.within_columns(index, columns), clause)
        one = places.groupBy("doc_id").agg(F.count("*").alias("hits"), F.max("len").alias("len")).withColumn("c", F.lit(c))
        hits = one if hits is None else hits.unionByName(one)
    if hits is None:
        kind = index.spark.read.parquet(f"{index.segments[0][1]}/docs").schema["doc_id"].dataType
        return index.spark.createDataFrame([], T.StructType([T.StructField("doc_id", kind), T.StructField("rank", T.DoubleType())]))
    freq = hits.groupBy("c").agg(F.count("*").alias("df"))  # a row for each phrase of the query
    n, mean = F.lit(float(s["n"])), F.lit(s["total"] / s["n"] if s["n"] else 0.0)
    idf = F.greatest(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    k1, b = fulltext.K1, fulltext.B
    weight = F.col("hits") * (k1 + 1) / (F.col("hits") + k1 * (1 - b + b * F.col("len") / mean))
    matched = fulltext.matching(index, node) if node[0] not in ("phrase",) else None
    kept = hits if matched is None else hits.join(matched, "doc_id", "left_semi")
    scored = kept.join(F.broadcast(freq), "c").groupBy("doc_id").agg((-F.sum(idf * weight)).alias("rank"))
    return scored if limit is None else scored.orderBy("rank", "doc_id").limit(limit)
