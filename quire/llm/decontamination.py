"""Benchmark decontamination as a prefix-filtered set join.

Benchmark items are cut into windows of ``n`` consecutive words (an item of
fewer words is one window), and windows into shingles of up to ``SHINGLE`` words.
Shingles are ordered by their rarity in the whole corpus. Containment of a
window needs all of its shingles, so the necessary prefix is its single rarest
one: windows and documents meet in an equi-join on that shingle, and nowhere
else. The shingle's offset and the window's length bound the position, and the
window is then verified word by word against the words around the place.

The corpus is read twice, however large the benchmark is: once to count the
benchmark's shingles, once for the places of those chosen. In either pass a bit
filter of the shingles that matter goes to the executors (16 bits a shingle, 16
MB at most: past that it spares less, and the join decides all the same). A
place is a row of its document's id and text hash, the shingle, and the words
around it; texts are not shuffled. The windows are broadcast while they are
counted to be few, else the join is a merge of both sides.

Documents are known by id and text together, so repeated ids and equal rows have
results of their own, and a text that many rows share joins by its rows.

Inputs of any shape have a defined result: null or empty text has no words
and no hits; items without words have no windows; the windows of items without
an id make hits, but no entry in the list of ids; ids of any type are read as
text; repeated items and documents count as they stand, one result row for each
document row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, annotate, aside, binaries, field, scratch, short_batches

#: Words of a shingle; a shorter window is one shingle.
SHINGLE = 3
#: Windows, and documents with hits, up to which a side of a join is broadcast.
FEW_WINDOWS, FEW_DOCS = 100_000, 500_000
#: Bits of a filter: least and most, and probes.
LEAST_BITS, MOST_BITS, PROBES = 1 << 16, 1 << 27, 4
#: Different shingles that a task counts before it hands them over.
COUNTED = 500_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


# Windows and shingles ------------------------------------------------------------------


def item_windows(words: list[bytes], n: int) -> list[tuple[bytes, ...]]:
    """All runs of ``n`` words, or the whole if there are fewer but some."""
    if len(words) <= n:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


class WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], np.uint64)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, as signed numbers."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ hashes[i : i + n]) * _FACTORS[i]
        out ^= out >> np.uint64(29)
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def windows(benchmark: DataFrame, n: int, item_id: str, item_text: str) -> DataFrame:
    """(item, body): every window of every item, its words joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, b" ".join(w)) for i, x in zip(batch.column(0).to_pylist(), binaries(batch, "body"), strict=True) for w in set(item_windows(alnum_words(x), n))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.string()), pa.array([b for _, b in found], pa.binary())], names=["item", "body"])

    named = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("body"))
    return named.where("body IS NOT NULL").mapInArrow(run, "item string, body binary").distinct()


def window_shingles(bodies: DataFrame) -> DataFrame:
    """(body, shingle, at, size): the shingles of each window, each where it first stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            rows = []
            for body in binaries(batch, "body"):
                words = body.split(b" ")
                size = min(SHINGLE, len(words))
                seen = set()
                for at, s in enumerate(shingles(memory.of(words), size).tolist()):
                    if s not in seen:
                        seen.add(s)
                        rows.append((body, s, at, size))
            body, s, at, size = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(body, pa.binary()), pa.array(s, pa.int64()), pa.array(at, pa.int32()), pa.array(size, pa.int32())], names=["body", "shingle", "at", "size"])

    return bodies.mapInArrow(run, "body binary, shingle long, at int, size int")


# A filter of bits -----------------------------------------------------------------------


def _places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    k = keys.view(np.uint64)
    step = (k >> np.uint64(33)) | np.uint64(1)
    for i in range(PROBES):
        yield (k + np.uint64(i) * step) & np.uint64(bits - 1)


def bit_filter(keys: DataFrame) -> np.ndarray:
    """A filter of the distinct ``shingle`` values; tasks put their bits together, and the driver gets at most ``MOST_BITS`` of them."""
    n = keys.count()
    bits = LEAST_BITS
    while bits < 16 * n and bits < MOST_BITS:
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(own[used].view(np.int64), pa.int64())], names=["place", "word"])

    table = keys.select("shingle").mapInArrow(run, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table["place"].to_numpy()] = table["word"].to_numpy().view(np.uint64)
    return out


def holds(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key; never a wrong no."""
    out = np.ones(len(keys), bool)
    for at in _places(keys, len(words) * 64):
        out &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    return out


# The two passes ---------------------------------------------------------------------------


def shingle_counts(docs: DataFrame, sizes: list[int], sent: Broadcast, text: str) -> DataFrame:
    """(shingle, n): how often the filter's shingles stand in the corpus (all documents, whole texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, seen = WordHashes(), Counter()

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["shingle", "n"])

        for batch in batches:
            for x in binaries(batch, text):
                hashes = memory.of(alnum_words(x))
                for size in sizes:
                    s = shingles(hashes, size)
                    for key, n in zip(*(v.tolist() for v in np.unique(s[holds(sent.value, s)], return_counts=True)), strict=True):
                        seen[key] += n
            if len(seen) > COUNTED:
                yield handed()
                seen.clear()
        yield handed()

    return docs.select(text).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, sizes: list[int], sent: Broadcast, n: int) -> DataFrame:
    """(doc_id, tie, shingle, place, first, around): where the filter's shingles stand, with the words around: ``around`` begins at word ``first``."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            rows: list[tuple] = []
            ids, ties = batch.column(0), batch.column(1).to_pylist()
            for row, x in enumerate(binaries(batch, "text")):
                words = alnum_words(x)
                hashes = memory.of(words)
                for size in sizes:
                    s = shingles(hashes, size)
                    for at in np.flatnonzero(holds(sent.value, s)).tolist():
                        first = max(0, at + size - n)
                        rows.append((row, ties[row], int(s[at]), at, first, b" ".join(words[first : at + n])))
            row, tie, s, at, first, around = zip(*rows, strict=True) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int64())), pa.array(tie, pa.binary()), pa.array(s, pa.int64()), pa.array(at, pa.int32()), pa.array(first, pa.int32()), pa.array(around, pa.binary())],
                names=["doc_id", "tie", "shingle", "place", "first", "around"],
            )

    return docs.select("doc_id", "tie", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, tie binary, shingle long, place int, first int, around binary")


def verified(met: DataFrame) -> DataFrame:
    """(doc_id, tie, start, end, body) of the pairs (place, window) whose words are the same, word by word."""
    kind = met.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in ("place", "first", "around", "at", "body")}
            kept, start, end = [], [], []
            for row, (place, first, around, at, body) in enumerate(zip(*(c.to_pylist() for c in columns.values()), strict=True)):
                words, wanted = around.split(b" "), body.split(b" ")
                low = place - at - first  # the window's first word, among those around
                if low >= 0 and words[low : low + len(wanted)] == wanted:
                    kept.append(row)
                    start.append(place - at)
                    end.append(place - at + len(wanted))
            take = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(start, pa.int32()), pa.array(end, pa.int32()), columns["body"].take(take)], names=["doc_id", "tie", "start", "end", "body"]
            )

    return met.select("doc_id", "tie", "place", "first", "around", "at", "body").mapInArrow(run, f"doc_id {kind.simpleString()}, tie binary, start int, end int, body binary")


def hits(docs: DataFrame, benchmark: DataFrame, n: int, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """((doc_id, tie, start, end, body) distinct, (item, body)): the windows that documents hold, and whose they are."""
    spark = docs.sparkSession
    short_batches(spark)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch(spark, f"decontamination-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    owned = stored(windows(benchmark, n, item_id, item_text), "windows")
    each = stored(window_shingles(owned.select("body").distinct()), "shingles")
    sizes = sorted(r["size"] for r in each.select("size").distinct().collect())  # 1 to SHINGLE
    distinct = each.select("shingle").distinct()
    counts = shingle_counts(docs, sizes, spark.sparkContext.broadcast(bit_filter(distinct)), "text")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at")).alias("rarest")
    chosen = stored(each.join(counts, "shingle", "left").groupBy("body").agg(rarest).select("body", F.col("rarest.shingle").alias("shingle"), F.col("rarest.at").alias("at")), "chosen")
    few = chosen.count() <= FEW_WINDOWS
    found = places(docs, sizes, spark.sparkContext.broadcast(bit_filter(chosen.select("shingle").distinct())), n)
    met = found.join(F.broadcast(chosen) if few else chosen.hint("merge"), "shingle")
    return stored(verified(met).distinct(), "hits"), owned


# Results ------------------------------------------------------------------------------------


def tie_of(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b""))))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, tie, items, spans): a row for each document with a hit, known by its id and the hash of its text.

    Spans are merged word intervals, end exclusive; items are ids as text, sorted.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), tie_of(text).alias("tie"), F.col(text).alias("text"))
    found, owned = hits(rows, benchmark, n, item_id, item_text)
    order = F.array_sort(F.collect_set(F.struct("start", "end")))
    apart = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"))
    empty = F.array(apart).cast("array<struct<start:int,end:int>>")

    def joined(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(s["start"] <= last["end"], longer).otherwise(F.concat(done, F.array(s)))

    merged = F.aggregate("all", empty, joined)
    spans = found.groupBy("doc_id", "tie").agg(order.alias("all")).select("doc_id", "tie", F.slice(merged, F.lit(2), F.greatest(F.size(merged) - 1, F.lit(0))).alias("spans"))
    named = found.select("doc_id", "tie", "body").distinct().join(owned.where("item IS NOT NULL"), "body")
    items = named.groupBy(F.col("doc_id").alias("i_id"), F.col("tie").alias("i_tie")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    both = spans.join(items, F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("tie") == F.col("i_tie")), "left")
    return both.select("doc_id", "tie", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, n_words) of rows (doc_id, tie, text)."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(alnum_words(x)) for x in binaries(batch, "text")], pa.int64())], names=["doc_id", "tie", "n_words"])

    return docs.select("doc_id", "tie", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, tie binary, n_words long")


def _small(found: DataFrame) -> DataFrame:
    return F.broadcast(found) if found.count() <= FEW_DOCS else found.hint("merge")


def _stored(found: DataFrame) -> DataFrame:
    path = scratch(found.sparkSession, "decontamination-found")
    found.withColumnsRenamed({"doc_id": "f_id", "tie": "f_tie"}).write.parquet(path)
    return found.sparkSession.read.parquet(path)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids as text, sorted) and spans (word intervals); these take the place of columns of their names."""
    found = _stored(contaminated(docs, benchmark, n, text, doc_id, item_id, item_text))
    rows = docs.drop("n_words", "n_hit", "items", "spans")
    met = rows.join(_small(found), rows[doc_id].eqNullSafe(found["f_id"]) & (tie_of(text) == found["f_tie"]), "left")
    kind = found.schema["spans"].dataType
    out = met.select(*rows.columns, F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast(kind)).alias("spans"))
    out = annotate(out, [field("n_words", "long")], lambda: lambda batch: [pa.array([len(alnum_words(x)) for x in binaries(batch, text)], pa.int64())])
    return out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"])))


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The query's digest: one row for each document row; texts stay where they are read."""
    found = _stored(contaminated(docs, benchmark, n))
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"])), F.lit(0))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    rows = word_counts(docs.select("doc_id", tie_of().alias("tie"), "text"))
    met = rows.join(_small(found), rows["doc_id"].eqNullSafe(found["f_id"]) & (F.col("tie") == found["f_tie"]), "left")
    return met.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Documents without a hit, with their own columns."""
    rows, back = aside(docs, "doc_id", "text")
    found = _stored(contaminated(rows, benchmark, n).select("doc_id", "tie"))
    return back(rows.join(_small(found), rows["doc_id"].eqNullSafe(found["f_id"]) & (tie_of() == found["f_tie"]), "left_anti"))


ORACLE = r"""
WITH low AS (SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS body
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT k FROM windows),
places AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM low),
shingles AS (SELECT rid, k, p, array_to_string(w[p : p + k - 1], ' ') AS body FROM places, lengths WHERE p + k - 1 <= len(w)),
hits AS (SELECT rid, s.k, p, item_id FROM shingles s JOIN windows v ON s.k = v.k AND s.body = v.body),
words AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + k)) AS q FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM low LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""
