"""Exact top-k by integer inner product: columnar branch and bound.

Vectors are quantised to ``floor(scale * x)`` and packed into blocks, stored
dimension by dimension. A block of queries meets a block of candidates; the
inner products are summed one slab of dimensions after another. After each
slab a candidate's best possible score is its partial sum plus the product of
the norms of what remains on either side; where that is below the query's
k-th best so far the candidate is dropped, and the survivors are compacted
before the next slab. Bounds are rounded outwards, so the result is exact.

Defined results: vectors that are null, or hold a null or a non-finite
component, take no part; of vectors of different length the missing
components count as 0; repeated rows are rows of their own, and a query
leaves out its own row only; ties go to the smaller ``vec_id``; fewer
candidates than k give all. Scores beyond 64 bits saturate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK = 4096
SLAB = 16
QUERY_ROWS = 256
_BOUND = float(1 << 62)


def pack(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """Blocks of quantised vectors, dimension-major, with the rows' ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if v is not None and i is not None and None not in v and np.isfinite(a := np.asarray(v, np.float64)).all():
                    ids.append(i)
                    rows.append(np.clip(np.floor(scale * a), -_BOUND, _BOUND))
            for at in range(0, len(ids), BLOCK):
                part = rows[at : at + BLOCK]
                wide = np.zeros((max(map(len, part)), len(part)), np.int64)
                for j, r in enumerate(part):
                    wide[: len(r), j] = r
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([np.asarray(ids[at : at + BLOCK], np.int64).tobytes()], pa.binary()),
                        pa.array([wide.tobytes()], pa.binary()),
                        pa.array([wide.shape[0]], pa.int32()),
                    ],
                    names=["ids", "planes", "dims"],
                )

    packed = df.select(F.col(vec_id).cast("long"), embedding).mapInArrow(run, "ids binary, planes binary, dims int")
    return packed.withColumn("block", F.monotonically_increasing_id())


def _unpack(ids: bytes, planes: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    who = np.frombuffer(ids, np.int64)
    return who, np.frombuffer(planes, np.int64).reshape(dims, len(who))


def _rest(planes: np.ndarray) -> np.ndarray:
    """Norms of what remains from each slab's start on, rounded up."""
    squares = planes.astype(np.float64) ** 2
    starts = range(0, planes.shape[0], SLAB)
    return np.array([np.sqrt(squares[s:].sum(axis=0)) * (1 + 1e-9) for s in starts] + [np.zeros(planes.shape[1])])


def search(queries: np.ndarray, cands: np.ndarray, ids: np.ndarray, skip: np.ndarray, k: int):
    """For each query (column) the k best ``(score, id)``; skip: the candidate row to leave out, or -1."""
    dims = max(queries.shape[0], cands.shape[0])
    pad = lambda m: np.pad(m, ((0, dims - m.shape[0]), (0, 0)))
    queries, cands = pad(queries), pad(cands)
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(cands).max(initial=0)) * max(dims, 1)
    if largest >= 2**53:  # beyond exact doubles: whole numbers of any size
        exact = queries.T.astype(object) @ cands.astype(object) if dims else np.zeros((queries.shape[1], cands.shape[1]), object)
        full = [[max(-(2**63), min(2**63 - 1, int(x))) for x in row] for row in exact]
        return [sorted(((s, int(i)) for j, (s, i) in enumerate(zip(row, ids, strict=True)) if j != skip[q]), key=lambda x: (-x[0], x[1]))[:k] for q, row in enumerate(full)]
    q_rest, c_rest = _rest(queries), _rest(cands)
    qf, cf = queries.astype(np.float64), cands.astype(np.float64)
    # A first threshold: the k-th best among a few candidates, scored in full.
    few = min(cands.shape[1], 8 * k + 1)
    probe = qf.T @ cf[:, :few]
    inside = (skip >= 0) & (skip < few)
    probe[np.flatnonzero(inside), skip[inside]] = -np.inf
    floor = np.partition(probe, few - k, axis=1)[:, few - k] if few > k else np.full(len(probe), -np.inf)
    out = []
    for q in range(queries.shape[1]):
        alive = np.arange(cands.shape[1])
        alive = alive[alive != skip[q]]
        partial = np.zeros(len(alive))
        for s, lo in enumerate(range(0, dims, SLAB)):
            slab = cf[lo : lo + SLAB]
            partial = partial + qf[lo : lo + SLAB, q] @ (slab if len(alive) == cands.shape[1] else slab[:, alive])
            keep = partial + q_rest[s + 1, q] * c_rest[s + 1, alive] + 1 >= floor[q]
            if keep.mean() < 0.9:
                alive, partial = alive[keep], partial[keep]
        best = np.lexsort((ids[alive], -partial))[:k]
        out.append([(int(partial[i]), int(ids[alive[i]])) for i in best])
    return out


def top_k(df: DataFrame, every: int = 50, k: int = 5, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row whose id ``every`` divides.

    Packed blocks are few and even; each block of queries visits each block of
    candidates, and only k results for each query and block are shuffled.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    blocks = cut(pack(df, vec_id, embedding, scale))
    total = blocks.count()
    parts = max(1, min(total, 4096))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, raw, planes, dims in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids, wide = _unpack(raw, planes, dims)
                rows = np.flatnonzero(ids % every == 0)
                for at in range(0, len(rows), QUERY_ROWS):
                    mine = rows[at : at + QUERY_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in ((b, pa.int64()), (mine.astype(np.int64).tobytes(), pa.binary()), (ids[mine].tobytes(), pa.binary()), (np.ascontiguousarray(wide[:, mine]).tobytes(), pa.binary()), (dims, pa.int32()))],
                        names=["q_block", "q_rows", "q_ids", "q_planes", "q_dims"],
                    )

    asked = blocks.select("block", "ids", "planes", "dims").mapInArrow(ask, "q_block long, q_rows binary, q_ids binary, q_planes binary, q_dims int")
    # The stated query set goes to all blocks: one copy of a query block for each candidate block.
    placed = blocks.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    visits = asked.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = visits.join(placed, "cell")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                q_ids, queries = _unpack(col["q_ids"][r], col["q_planes"][r], col["q_dims"][r])
                c_ids, cands = _unpack(col["ids"][r], col["planes"][r], col["dims"][r])
                own = np.frombuffer(col["q_rows"][r], np.int64)
                skip = own if col["q_block"][r] == col["block"][r] else np.full(len(own), -1)
                found = search(queries, cands, c_ids, skip, k)
                flat = [(col["q_block"][r], int(own[i]), int(q_ids[i]), v, s) for i, best in enumerate(found) for s, v in best]
                if flat:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat, strict=True)], names=["q_block", "q_row", "query_id", "vec_id", "score"])

    found = met.select("q_block", "q_rows", "q_ids", "q_planes", "q_dims", "block", "ids", "planes", "dims").mapInArrow(
        answer, "q_block long, q_row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.rid AS qr, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
