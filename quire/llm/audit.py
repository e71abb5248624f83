"""Filter interaction audit: what each filter removes, in every order of the filters.

A row's filters that fail make a mask of bits. Rows are counted once by (part,
mask); everything else follows from these at most ``2**n`` counts a part. A
subset-zeta transform turns them into the survivors of every set of filters; a
step of an order is the difference between the survivors of two neighbouring
sets, for all rows and for the labelled ones alike, and the Shapley sum weighs
the same differences over all sets.

Filters of the query, on whole texts (words are ``[^\\x20\\x09-\\x0D]+``): A
under 200 words; B fewer than half of the words distinct; C capitals over 2 % of
the characters; D one of ``#$%&*|``; E the text of a row of smaller id,
wherever that row is and whatever happened to it.

Texts are read once. What is written for the second look is a row of an id, a
digest, a part and a mask; equal ones are counted together first, so a text that
a third of all rows share is a few rows. The first id of each digest is joined
by (id, digest), never by the digest alone.

Defined results: a null text is empty; an empty text fails A and no other (but E
as any text does); a null part is the empty string; a row without an id is
never a repetition, makes none, and has no label; rows that share id and text
are not repetitions of one another; of several labels of an id the largest
counts; an empty table has no parts and no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import annotate, binaries, field, scratch

LEAST_WORDS = 200
_CAPITALS = bytes(range(0x41, 0x5B))
_SIGNS = b"#$%&*|"
#: Bytes that go on a character; all others begin one.
_CONTINUED = bytes(range(0x80, 0xC0))
#: A filter says of a text (UTF-8) whether it fails; the repetition of a text is the last filter.
FILTERS: tuple[tuple[str, Callable[[bytes, list[bytes]], bool]], ...] = (
    ("A", lambda text, words: len(words) < LEAST_WORDS),
    ("B", lambda text, words: 100 * len(set(words)) < 50 * len(words)),
    ("C", lambda text, words: 100 * _count(text, _CAPITALS) > 2 * len(text.translate(None, _CONTINUED))),
    ("D", lambda text, words: _count(text, _SIGNS) > 0),
)
REPEATED = "E"


def _count(text: bytes, these: bytes) -> int:
    return len(text) - len(text.translate(None, these))


def masks(docs: DataFrame, text: str = "text", filters=FILTERS, name: str = "mask") -> DataFrame:
    """``docs`` with the bits of the filters that fail, the first filter's lowest; a narrow pass."""

    def one(x: bytes | None) -> int:
        x = x or b""
        words = x.split()
        return sum(1 << i for i, (_, fails) in enumerate(filters) if fails(x, words))

    return annotate(docs, [field(name, "int")], lambda: lambda batch: [pa.array([one(x) for x in binaries(batch, text)], pa.int32())])


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source", filters=FILTERS) -> DataFrame:
    """(part, mask, n, good, toxic): rows of each part and mask, the repetition's bit the highest."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    path = scratch(docs.sparkSession, "audit")
    masks(rows.withColumn("digest", F.unhex(F.sha2("text", 256))), filters=filters).drop("text").write.parquet(path)
    marked = docs.sparkSession.read.parquet(path)
    nameless = marked.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count("*").alias("n"))
    named = marked.where("doc_id IS NOT NULL").groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    firsts = marked.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("digest", "first_digest")
    first = (F.col("doc_id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    bit = F.when(F.col("first_id").isNull(), 1 << len(filters)).otherwise(0)
    named = named.join(firsts, first, "left").select("doc_id", "part", F.col("mask").bitwiseOR(bit).alias("mask"), "n")
    wanted = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").alias("label_id"))
    wanted = wanted.agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    known = named.join(wanted, F.col("doc_id") == F.col("label_id"), "left")
    zero = F.lit(0).cast("long")
    of = lambda flag: F.when(F.col(flag) == 1, F.col("n")).otherwise(zero)
    counted = known.select("part", "mask", "n", of("is_good").alias("good"), of("is_toxic").alias("toxic"))
    both = counted.unionByName(nameless.select("part", "mask", "n", zero.alias("good"), zero.alias("toxic")))
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def zeta(counts: np.ndarray) -> np.ndarray:
    """Sums over the subsets of every mask, along the last axis (of ``2**n`` counts)."""
    out = counts.copy()
    step = 1
    while step < out.shape[-1]:
        pairs = out.reshape(*out.shape[:-1], -1, 2, step)  # masks without the bit, and with it
        pairs[..., 1, :] += pairs[..., 0, :]
        step *= 2
    return out


def survivors(counts: np.ndarray) -> np.ndarray:
    """At each set of filters: rows that fail none of it, that is, whose mask lies in the complement."""
    return zeta(counts)[..., ::-1]


FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def steps(counts: np.ndarray, letters: str) -> tuple[list[str], np.ndarray]:
    """(orders, numbers[part, order, step, FIELDS]) from counts[part, (n, good, toxic), mask]."""
    size = len(letters)
    orders = list(permutations(range(size)))
    alive = survivors(counts)
    every = (1 << size) - 1
    total, fails, alone, shapley = alive[:, 0, 0], [], [], []
    for f in range(size):
        bit = 1 << f
        fails.append(total - alive[:, 0, bit])
        alone.append(alive[:, 0, every ^ bit] - alive[:, 0, every])
        sets = [s for s in range(every + 1) if not s & bit]
        ways = np.array([factorial(s.bit_count()) * factorial(size - 1 - s.bit_count()) for s in sets])
        shapley.append(((alive[:, 0, sets] - alive[:, 0, [s | bit for s in sets]]) * ways).sum(axis=1))
    out = np.zeros((len(counts), len(orders), size, len(FIELDS)), np.int64)
    for o, order in enumerate(orders):
        before = 0
        for k, f in enumerate(order):
            after = before | 1 << f
            lost = alive[:, :, before] - alive[:, :, after]
            out[:, o, k] = np.stack([alive[:, 0, after], lost[:, 0], fails[f] - lost[:, 0], alone[f], lost[:, 1], lost[:, 2], shapley[f]], axis=1)
            before = after
    return ["".join(letters[f] for f in order) for order in orders], out


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", filters=FILTERS) -> DataFrame:
    """(part, filter_order, step, ``FIELDS``): a row for each part, order and step; the counts of a part are one row of arrays."""
    letters = "".join(name for name, _ in filters) + REPEATED
    size = 1 << len(letters)
    counted = mask_counts(docs, labels, part, filters)
    whole = counted.groupBy("part").agg(*[F.array(*[_at(c, m) for m in range(size)]).alias(c) for c in ("n", "good", "toxic")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                counts = np.array([[batch.column(c)[row].as_py() for c in (1, 2, 3)]], np.int64)
                orders, numbers = steps(counts, letters)
                flat = numbers[0].reshape(-1, len(FIELDS))
                n = len(letters)
                columns = [
                    pa.array([batch.column(0)[row].as_py()] * len(flat), pa.string()), pa.array([o for o in orders for _ in range(n)], pa.string()), pa.array(list(range(1, n + 1)) * len(orders), pa.int32()),
                    *[pa.array(flat[:, j]) for j in range(len(FIELDS))],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *FIELDS])

    return whole.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIELDS))


def _at(count: str, mask: int) -> Column:
    return F.coalesce(F.sum(F.when(F.col("mask") == mask, F.col(count))), F.lit(0).cast("long"))


ORACLE = r"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
spans AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM rows),
label AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
flags AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words), 'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
         'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(s.doc_id > first_id, false)} AS f
    FROM spans s LEFT JOIN label l ON s.doc_id = l.doc_id),
fails AS (SELECT part, good, toxic, concat(if(f.A, 'A', ''), if(f.B, 'B', ''), if(f.C, 'C', ''), if(f.D, 'D', ''), if(f.E, 'E', '')) AS failed FROM flags),
kinds AS (SELECT part, failed, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM fails GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
placed AS (
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, toxic, failed,
        len(failed) > 0 AND translate(failed, substr(filter_order, 1, step - 1), '') <> failed AS gone
    FROM kinds, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
out AS (
    SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (NOT gone AND NOT contains(failed, letter)), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND contains(failed, letter)), 0) AS removed,
        coalesce(sum(n) FILTER (gone AND contains(failed, letter)), 0) AS redundant, coalesce(sum(n) FILTER (failed = letter), 0) AS unique_fails,
        coalesce(sum(good) FILTER (NOT gone AND contains(failed, letter)), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND contains(failed, letter)), 0) AS toxic_lost
    FROM placed GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM out
"""
