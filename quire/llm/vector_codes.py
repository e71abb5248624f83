"""Vector code compression: a codebook for each part of a vector, and one byte a part.

Components become whole numbers (``floor(scale * x)``), vectors are cut into
equal parts, and each part position has a codebook that begins as that part of
the vectors of the smallest ids. In a round every part goes to the nearest entry
and each entry becomes the floor of its parts' mean. All sums are whole numbers,
so the result depends neither on the partitioning nor on the order of rows.

Each round broadcasts a kd-tree per codebook (``entries`` points each, whatever
the number of rows). A batch of parts first descends to a leaf, which gives every
part a bound; then it walks the tree, and a part leaves a node whose box is
further than its best entry so far. A box that is just as far is visited, so of
equally near entries the one of the lowest index wins. A task adds up its own
counts and sums and hands over one row for each entry in use; Spark adds these.

The input is read once a round and once at the end: give a stored table. Only
codebooks come to the driver. Labels' sums are joined by a broadcast while they
are counted to be few, else dealt over ``SALTS`` copies, so a label that a third
of all rows bear is not one task.

Defined results: vectors that are null or hold a null or non-finite component
go; so do those of another length than that of the smallest id (the smallest
vector of these); a length that is no multiple of ``parts`` gives the first
parts one component more. Equal ids seed in the order of their components; null
ids seed last. Fewer rows than entries make a smaller codebook; unused entries
stay. Whole numbers end at 2**62 on either side, and errors at 2**63 - 1. An
empty table has no rows. Other columns pass through ``encode``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, scratch

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LEAF = 2
LIMIT = 1 << 62
#: Label sums up to this number are broadcast; beyond it they are dealt over SALTS.
FEW_LABELS, SALTS = 100_000, 64
ROWS = 8192


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(x.astype(np.float64) * scale), -float(LIMIT), float(LIMIT)).astype(np.int64)


def room(*arrays: np.ndarray) -> type:
    """int64 where squared distances surely fit, else Python's own numbers."""
    most = max((max(abs(int(a.min())), abs(int(a.max()))) for a in arrays if a.size), default=0)
    width = max((a.shape[-1] for a in arrays), default=1)
    return np.int64 if max(1, width) * (2 * most + 1) ** 2 < 1 << 63 else object


@dataclass
class Node:
    low: np.ndarray
    high: np.ndarray
    entries: np.ndarray | None = None  # of a leaf
    axis: int = 0
    at: int = 0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Tree:
    """A kd-tree over the entries of one codebook."""

    points: np.ndarray
    root: Node | None = field(default=None)

    def __post_init__(self):
        self.root = self._build(np.arange(len(self.points)))

    def _build(self, ids: np.ndarray) -> Node:
        p = self.points[ids]
        node = Node(p.min(axis=0), p.max(axis=0))
        spread = node.high.astype(object) - node.low if p.shape[1] else np.zeros(0, object)
        if len(ids) <= LEAF or not spread.any():
            node.entries = ids
            return node
        node.axis = int(np.argmax(spread))
        ids = ids[np.argsort(p[:, node.axis], kind="stable")]
        column = self.points[ids, node.axis]
        half = len(ids) // 2
        if column[half] == column[0]:  # what is equal stays together
            half = int(np.searchsorted(column, column[0], side="right"))
        else:
            half = int(np.searchsorted(column, column[half], side="left"))
        node.at = int(column[half])
        node.left, node.right = self._build(ids[:half]), self._build(ids[half:])
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``x``; the lowest of equally near entries."""
        kind = room(x, self.points)
        x, points = x.astype(kind), self.points.astype(kind)
        best = np.full(len(x), (1 << 63) - 1 if kind is np.int64 else 1 << 200, kind)
        found = np.full(len(x), len(points), np.int64)

        def compare(node: Node, rows: np.ndarray) -> None:
            for e in node.entries:
                d = ((x[rows] - points[e]) ** 2).sum(axis=1)
                better = (d < best[rows]) | (d == best[rows]) & (e < found[rows])
                best[rows[better]], found[rows[better]] = d[better], e

        def descend(node: Node, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if node.entries is not None:
                return compare(node, rows)
            left = x[rows, node.axis] < node.at
            descend(node.left, rows[left])
            descend(node.right, rows[~left])

        def walk(node: Node, rows: np.ndarray) -> None:
            part = x[rows]
            out = np.maximum(np.maximum(node.low.astype(kind) - part, part - node.high.astype(kind)), 0)
            rows = rows[(out**2).sum(axis=1) <= best[rows]]
            if not len(rows):
                return
            if node.entries is not None:
                return compare(node, rows)
            walk(node.left, rows)
            walk(node.right, rows)

        rows = np.arange(len(x))
        descend(self.root, rows)
        walk(self.root, rows)
        return found, best


@dataclass(frozen=True)
class Codebooks:
    """``books[part]`` is an array of entries; ``edges`` are the parts' places in a vector."""

    books: list[np.ndarray]
    edges: list[int]
    scale: int

    def text(self) -> str:
        return ",".join(str(int(c)) for book in self.books for entry in book for c in entry)

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def edges_of(length: int, parts: int) -> list[int]:
    base, more = divmod(length, parts)
    return [p * base + min(p, more) for p in range(parts + 1)]


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds finite numbers only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return df.where(F.col(vector).isNotNull() & ~F.exists(vector, bad))


def _ordered(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def seeds(df: DataFrame, ident: str, vector: str, entries: int, parts: int, scale: int) -> Codebooks | None:
    """The codebooks before the first round; None for a table without vectors."""
    first = usable(df, vector).select(F.col(ident).alias("i"), F.col(vector).alias("v")).orderBy(*_ordered("i", "v")).limit(1).collect()
    if not first:
        return None
    length = len(first[0]["v"])
    rows = same_length(df, vector, length).select(F.col(ident).alias("i"), F.col(vector).alias("v")).orderBy(*_ordered("i", "v")).limit(entries).collect()
    x = whole_numbers(np.array([r["v"] for r in rows], np.float64).reshape(len(rows), length), scale)
    edges = edges_of(length, parts)
    return Codebooks([x[:, a:b] for a, b in zip(edges, edges[1:], strict=False)], edges, scale)


def same_length(df: DataFrame, vector: str, length: int) -> DataFrame:
    return usable(df, vector).where(F.size(vector) == length)


def _parts(batch: pa.RecordBatch, vector: str, books: Codebooks) -> Iterator[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(vector))
    x = whole_numbers(column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, books.edges[-1]), books.scale)
    return (x[:, a:b] for a, b in zip(books.edges, books.edges[1:], strict=False))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ROWS rows, whatever the session's own bound is."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _sums(trees, books: Codebooks, vector: str) -> Callable:
    kind = pa.list_(pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[0] * len(b) for b in books.books]
        sums = [np.zeros(b.shape, object) for b in books.books]
        for batch in _slices(batches):
            for p, x in enumerate(_parts(batch, vector, books)):
                entry, _ = trees.value[p].nearest(x)
                for e in np.unique(entry):
                    of = x[entry == e]
                    counts[p][e] += len(of)
                    # halves, so that a batch's sum fits whatever the components are
                    sums[p][e] += (of >> 31).sum(axis=0).astype(object) * (1 << 31) + (of & (1 << 31) - 1).sum(axis=0).astype(object)
        used = [(p, e) for p, c in enumerate(counts) for e, n in enumerate(c) if n]
        if used:
            values = [[Decimal(int(v)) for v in sums[p][e]] for p, e in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()), pa.array([counts[p][e] for p, e in used], pa.int64()), pa.array(values, kind)],
                names=["part", "entry", "n", "sums"],
            )

    return run


def train(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """The codebooks after ``rounds`` rounds over all vectors; None for a table without vectors."""
    books = seeds(df, ident, vector, entries, parts, scale)
    if books is None:
        return None
    context = df.sparkSession.sparkContext
    rows = same_length(df, vector, books.edges[-1]).select(vector)
    for _ in range(rounds):
        trees = context.broadcast([Tree(b) for b in books.books])
        partial = rows.mapInArrow(_sums(trees, books, vector), "part int, entry int, n long, sums array<decimal(38,0)>")
        width = max(b.shape[1] for b in books.books)
        total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("sums"))
        new = [b.copy() for b in books.books]
        for r in total.collect():  # at most parts x entries rows
            book = new[r["part"]]
            book[r["entry"]] = [int(s) // r["n"] for s in r["sums"][: book.shape[1]]]
        trees.destroy()
        books = Codebooks(new, books.edges, scale)
    return books


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding", code: str = "code", error: str = "error") -> DataFrame:
    """Usable rows of ``df`` with ``code`` (a byte for each part) and ``error`` (squared distances, summed over parts)."""
    trees = df.sparkSession.sparkContext.broadcast([Tree(b) for b in books.books])
    kept = [f for f in df.schema if f.name not in (code, error)]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], T.StructField(code, T.BinaryType()), T.StructField(error, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = [trees.value[p].nearest(x) for p, x in enumerate(_parts(batch, vector, books))]
            codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            total = sum(d.astype(object) for _, d in found)
            old = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            new = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([min(int(t), (1 << 63) - 1) for t in total], pa.int64())]
            yield pa.RecordBatch.from_arrays(old + new, names=schema.names)

    return same_length(df, vector, books.edges[-1]).mapInArrow(run, schema)


def decode(coded: DataFrame, books: Codebooks, code: str = "code", name: str = "vector") -> DataFrame:
    """``coded`` with the vector that a code stands for; the codebooks are a literal of bounded size."""
    table = F.array(*[F.array(*[F.array(*[F.lit(float(c) / books.scale) for c in entry]) for entry in book]) for book in books.books])
    at = lambda p: F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int")
    return coded.withColumn(name, F.concat(*[table[p][at(p)] for p in range(len(books.books))]))


def with_group_error(coded: DataFrame, group: str, error: str = "error", name: str = "label_error") -> DataFrame:
    """``coded`` (stored) with the sum of its errors over rows of an equal group, nulls together."""
    sums = coded.groupBy(F.col(group).alias("_group")).agg(F.sum(F.col(error).cast("decimal(38,0)")).alias("_sum"))
    sums = cut(sums.select("_group", F.least("_sum", F.lit((1 << 63) - 1)).cast("long").alias("_sum")))
    if sums.count() <= FEW_LABELS:
        met = coded.join(F.broadcast(sums), F.col(group).eqNullSafe(F.col("_group")))
    else:
        salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*[c for c in coded.columns if c != group]), F.lit(SALTS)).cast("int")
        met = coded.withColumn("_own", salt).join(salted, (F.col("_own") == F.col("_salt")) & F.col(group).eqNullSafe(F.col("_group"))).drop("_own", "_salt")
    return met.withColumnRenamed("_sum", name).drop("_group")


def report(embeddings: DataFrame) -> DataFrame:
    """The query's rows: vec_id, code, error, label_error, codebooks_sha256."""
    rows = embeddings.select("vec_id", "embedding", "label")
    books = train(rows)
    if books is None:
        return rows.sparkSession.createDataFrame([], rows.select("vec_id").schema.add("code", "string").add("error", "long").add("label_error", "long").add("codebooks_sha256", "string"))
    path = scratch(rows.sparkSession, "vector-codes")
    encode(rows, books).drop("embedding").write.parquet(path)
    coded = with_group_error(rows.sparkSession.read.parquet(path), "label")
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> str:
    """The same in SQL: every part against every entry, in as many rounds."""
    near = """dist{r} AS (SELECT x.row_id, x.p, b.e, list_sum(list_transform(list_zip(x.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d FROM pieces x JOIN book{r} b USING (p)),
at{r} AS MATERIALIZED (SELECT row_id, p, min(d) AS d, arg_min(e, (d, e)) AS e FROM dist{r} GROUP BY row_id, p)"""
    step = """sums{r} AS (SELECT p, e, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c FROM (SELECT a.p, a.e, unnest(x.x) AS c, unnest(range(len(x.x))) AS i FROM at{r} a JOIN pieces x USING (row_id, p)) GROUP BY p, e, i),
book{n} AS MATERIALIZED (SELECT p, e, coalesce(s.x, b.x) AS x FROM book{r} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS x FROM sums{r} GROUP BY p, e) s USING (p, e))"""
    body = ",\n".join(near.format(r=r) + (",\n" + step.format(r=r, n=r + 1) if r < rounds else "") for r in range(rounds + 1))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER (ORDER BY vec_id, embedding) AS row_id
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (SELECT row_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS p)),
book0 AS MATERIALIZED (SELECT p, row_id - 1 AS e, x FROM pieces WHERE row_id <= {entries}),
{body},
coded AS (SELECT row_id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM at{rounds} GROUP BY row_id),
final AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded JOIN kept USING (row_id), final
"""
