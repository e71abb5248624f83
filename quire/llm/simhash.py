"""SimHash near-duplicates with a bit-sliced comparison.

A fingerprint has one bit for each of ``bits`` hash bits: it is 1 if the bit is
set in over half of the text's shingle hashes. Distinct fingerprints are
compared inside buckets that share a band of bits. In a bucket the
fingerprints stand vertically, one bit plane for each bit position and 64
fingerprints in a machine word; the distances of one fingerprint to a whole
bucket grow plane by plane in carry-save bitwise counters, and a block of 64
is abandoned once all of its distances exceed the radius.

Candidates. The fingerprint is cut into ``radius + size`` bands: two
fingerprints within the radius agree on at least ``size`` of them, so keys of
``size`` bands lose no link. ``size`` is the least whose keys tell the distinct
fingerprints apart (``key_size``), so buckets stay short as tables grow.
Buckets of over ``CHUNK`` members are dealt over cells (chunk against chunk),
so no task holds an unbounded group, and a cell returns a spanning forest of
its links, never all pairs. Components follow by alternating large-star and
small-star rounds on tables in the shared folder.

Defined results: null and empty texts have fingerprint zero and link like any
other; equal fingerprints are one node whatever their number, and a node is
never anything but its fingerprint, so rows that share an id but not a text
are judged apart; rows without an id get a fingerprint and, as component, the
smallest id of their class (null if it has none).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import annotate, aside, binaries, cut, field, short_batches, space_words

CHUNK = 2048
#: Shingle hashes whose bits are counted at a time.
SLICE = 1 << 15
#: Pairs of a query and a word of 64 fingerprints that are compared at a time.
PAIRS = 1 << 15
_U64 = np.uint64


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``width`` words, or of all if there are fewer."""
    if not words:
        return np.zeros(0, _U64)
    if len(words) <= width:
        return np.array([xxh64_intdigest(b" ".join(words), 42)], _U64)
    runs = zip(*(words[i:] for i in range(width)), strict=False)
    return np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(42)), _U64, len(words) - width + 1)


def _spread(h: np.ndarray, lane: int) -> np.ndarray:
    """An independent 64-bit hash for each further lane of 64 fingerprint bits."""
    if lane == 0:
        return h
    with np.errstate(over="ignore"):
        x = h + _U64((lane * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


def fingerprint(words: list[bytes], width: int, lanes: int = 1) -> bytes:
    """``8 * lanes`` big-endian bytes."""
    h = shingle_hashes(words, width)
    out = b""
    for lane in range(lanes):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(h), SLICE):
            part = _spread(h[at : at + SLICE], lane).astype(">u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out += np.packbits(2 * counts > len(h)).tobytes()
    return out


def with_fingerprints(docs: DataFrame, width: int = 4, lanes: int = 1, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with a binary fingerprint column; a narrow pass over whole texts."""

    def start():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([fingerprint(space_words(x), width, lanes) for x in binaries(batch, text)], pa.binary())]

        return work

    return annotate(docs, [field(name, "binary")], start)


# Bit-sliced comparison ------------------------------------------------------


def bit_rows(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count exceeds ``radius``, compared from the highest bit down."""
    more, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for j in range(len(counters) - 1, -1, -1):
        if radius >> j & 1:
            same &= counters[j]
        else:
            more |= same & counters[j]
            same &= ~counters[j]
    return more


def near_lanes(planes: np.ndarray, masks: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (query, word of 64 fingerprints): the pairs left, and a mask of the lanes within ``radius``.

    ``planes[i]`` holds bit i of all fingerprints, 64 in a word; ``masks[i]``
    is all ones where bit i of a query is set. Distances are kept in vertical
    counters: counter j holds bit j of 64 distances. Four difference planes at
    a time are summed carry-save into (ones, twos, fours), which ripple into
    the counters. A pair is abandoned once all of its 64 distances exceed the
    radius; the pairs left are then compacted.
    """
    bits = planes.shape[0]
    alive = np.arange(len(query))
    counters = [np.zeros(len(query), _U64) for _ in range(bits.bit_length())]
    full = ~_U64(0)
    for at in range(0, bits, 4):
        diff = [planes[i][word] ^ masks[i][query] for i in range(at, min(at + 4, bits))]
        diff += [np.zeros(len(query), _U64)] * (4 - len(diff))
        a, b = diff[0] ^ diff[1], diff[0] & diff[1]
        c, d = diff[2] ^ diff[3], diff[2] & diff[3]
        ones, carry = a ^ c, a & c
        twos = b ^ d ^ carry
        fours = (b & d) | (carry & (b ^ d))
        for value, j in ((ones, 0), (twos, 1), (fours, 2)):
            while j < len(counters):
                counters[j], value = counters[j] ^ value, counters[j] & value
                j += 1
                if j > 3 and not value.any():
                    break
        if at + 4 > radius and at // 4 % 2:
            kept = np.flatnonzero(_above(counters, radius) != full)
            if len(kept) < 0.8 * len(alive):
                alive, query, word, counters = alive[kept], query[kept], word[kept], [x[kept] for x in counters]
                if not len(kept):
                    break
    return alive, ~_above(counters, radius)


def links(cells: list[tuple[np.ndarray, np.ndarray | None]], radius: int) -> list[list[tuple[int, int]]]:
    """For each cell, a spanning forest of its links.

    A cell is fingerprints as rows of bytes, compared among themselves, or two
    sets compared with each other (the second numbered after the first). Many
    small cells are compared in one go.
    """
    q_parts, t_parts, q_at, w_at = [], [], 0, 0
    bounds = []
    query, word = [], []
    for left, right in cells:
        target = left if right is None else right
        words = -(-len(target) // 64)
        bounds.append((q_at, w_at * 64, len(left)))
        q_parts.append(np.unpackbits(left, axis=1))
        wide = np.zeros((words * 64, target.shape[1] * 8), np.uint8)
        wide[: len(target)] = np.unpackbits(target, axis=1)
        t_parts.append(wide)
        query.append(np.repeat(np.arange(q_at, q_at + len(left)), words))
        word.append(np.tile(np.arange(w_at, w_at + words), len(left)))
        q_at, w_at = q_at + len(left), w_at + words
    planes = np.ascontiguousarray(np.packbits(np.concatenate(t_parts).T, axis=1, bitorder="little")).view("<u8")
    masks = np.where(np.ascontiguousarray(np.concatenate(q_parts).T) == 1, ~_U64(0), _U64(0))
    cell = np.repeat(np.arange(len(cells)), [len(q) for q in query])
    query, word = np.concatenate(query), np.concatenate(word)
    edges: list[list[tuple[int, int]]] = [[] for _ in cells]
    labels: dict[int, np.ndarray] = {}
    for at in range(0, len(query), PAIRS):
        part = slice(at, at + PAIRS)
        q, w, k = query[part], word[part], cell[part]
        alive, lanes = near_lanes(planes, masks, q, w, radius)
        some = np.flatnonzero(lanes)
        if not len(some):
            continue
        alive = alive[some]
        row, lane = np.nonzero(np.unpackbits(np.ascontiguousarray(lanes[some]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        row = alive[row]
        k, source, target = k[row], q[row], w[row] * 64 + lane
        q0, t0, n = (np.array([b[i] for b in bounds])[k] for i in range(3))
        own = np.array([right is None for _, right in cells])[k]
        size = np.array([len(left) if right is None else len(right) for left, right in cells])[k]
        source, target = source - q0, target - t0
        real = (target < size) & (~own | (target > source))
        k, source, target = k[real], source[real], np.where(own, target, target + n)[real]
        if not len(k):
            continue
        turns = np.flatnonzero(np.diff(k * (1 << 32) + source, prepend=-1))
        for a, b in zip(turns, np.append(turns[1:], len(k)), strict=True):
            c, i = int(k[a]), int(source[a])
            if c not in labels:
                left, right = cells[c]
                labels[c] = np.arange(len(left) + (0 if right is None else len(right)))
            _hook(labels[c], i, target[a:b], edges[c])
    return edges


def _hook(label: np.ndarray, i: int, near: np.ndarray, edges: list[tuple[int, int]]) -> None:
    """Join ``i`` with the classes of ``near``: one edge for each class that it did not belong to."""
    found, first = np.unique(label[near], return_index=True)
    for other, j in zip(found, near[first], strict=True):
        if other != label[i]:
            edges.append((i, int(j)))
            label[label == other] = label[i]


# Buckets and cells ----------------------------------------------------------


def band_keys(prints: np.ndarray, bands: int, size: int) -> list[list[bytes]]:
    """For each fingerprint, one key for each choice of ``size`` of its ``bands`` bands."""
    bits = np.unpackbits(prints, axis=1)
    edges = np.linspace(0, bits.shape[1], bands + 1).round().astype(int)
    cut_up = [np.packbits(bits[:, a:b], axis=1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    out = []
    for number, chosen in enumerate(combinations(range(bands), size)):
        joined = np.concatenate([cut_up[c] for c in chosen], axis=1)
        out.append([number.to_bytes(2, "big") + row.tobytes() for row in joined])
    return [list(x) for x in zip(*out, strict=True)]


def pair_links(prints: DataFrame, radius: int, bands: int, size: int = 1) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``), a spanning forest of each bucket."""
    spark = prints.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_pylist()
            if fps:
                rows = np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1)
                keys = band_keys(rows, bands, size)
                flat, who = [k for ks in keys for k in ks], [f for f, ks in zip(fps, keys, strict=True) for _ in ks]
                yield pa.RecordBatch.from_arrays([pa.array(flat, pa.binary()), pa.array(who, pa.binary())], names=["key", "fp"])

    spread = prints.select("fp").mapInArrow(keyed, "key binary, fp binary")
    sizes = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    # Hash chunks of a long bucket meet pairwise: a member of chunk c goes to every cell (c, x) and (x, c).
    placed = (
        spread.join(sizes.select("key", chunks.alias("chunks")), "key")
        .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", F.least("c", "x").alias("i"), F.greatest("c", "x").alias("j"), "c", "fp")
    )
    dealt = placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "c", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        left: list[bytes] = []
        right: list[bytes] = []
        waiting: list[tuple[list[bytes], list[bytes]]] = []
        load = 0

        def close() -> int:
            """Queue the cell just read, and return the pairs of a query and a word that it adds."""
            if current is None or (len(left) < 2 if current[1] == current[2] else not (left and right)):
                return 0
            waiting.append((left, right))
            return len(left) * -(-len(right or left) // 64)

        def work() -> pa.RecordBatch | None:
            cells = [(bit_rows(a), bit_rows(b) if b else None) for a, b in waiting]
            made = [(both[i], both[j]) for (a, b), found in zip(waiting, links(cells, radius) if cells else [], strict=True) if found for both in [a + b] for i, j in found]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*made, strict=True)], names=["a", "b"]) if made else None

        for batch in batches:
            for key, i, j, c, fp in zip(*(batch.column(n).to_pylist() for n in range(5)), strict=True):
                if (key, i, j) != current:
                    load += close()
                    current, left, right = (key, i, j), [], []
                    if load >= PAIRS:
                        if out := work():
                            yield out
                        load = 0
                (left if c == i else right).append(fp)
        close()
        if out := work():
            yield out

    return dealt.mapInArrow(compare, "a binary, b binary").distinct()


def key_size(distinct: int, bits: int, radius: int, bucket: int = CHUNK) -> int:
    """The least number of bands in a key by which ``distinct`` random fingerprints fall into buckets of at most ``bucket``."""
    size = 1
    while size < 3 and distinct / 2 ** (bits * size // (radius + size)) > bucket:
        size += 1
    return size


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes on ``edges`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star; every round is cut by a reliable
    checkpoint. Only the number and a digest of the edges reach the driver.
    """
    state = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: larger neighbours of u point to the smallest of u and its neighbours.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours point to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("w"), "u", "m")
        state_next = small.select(F.col("w").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        state = cut(state_next)
        mark = state.agg(F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("u", "v"), 20)).alias("s")).first()
        if mark == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark


def classes(prints: DataFrame, radius: int, bands: int, size: int = 1) -> DataFrame:
    """(fp, component_id) from (fp, first_id): classes of fingerprints linked within ``radius``.

    ``component_id`` is the smallest ``first_id`` of the class, null if none has one.
    """
    return joined_classes(prints, pair_links(prints, radius, bands, size))


def joined_classes(prints: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` by the links (a, b) of ``found``: most fingerprints have none and meet nothing but one narrow join."""
    roots = components(found).withColumnRenamed("node", "fp")
    joined = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.where("root <> fp OR first_id IS NULL").select("root").distinct()
    linked = joined.join(least, "root", "left_semi").groupBy("root").agg(F.min("first_id").alias("least"))
    return joined.join(linked, "root", "left").select("fp", F.coalesce("least", "first_id").alias("component_id"))


def near_duplicates(
    docs: DataFrame, width: int = 4, lanes: int = 1, radius: int = 4, size: int | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (hex), component_id for every row.

    ``size`` bands make a key; None: by the number of distinct fingerprints.
    No link is lost in either case.
    """
    prints = cut(with_fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body")), width, lanes, "body").select("doc_id", "fp"))
    firsts = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    size = size or key_size(firsts.count(), 64 * lanes, radius)
    found = classes(firsts, radius, radius + size, size)
    return prints.join(found, "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


# The pipeline's stage -------------------------------------------------------

#: Shingles of five words; texts are linked by an exact Jaccard similarity of at
#: least 4 / 5 of their shingle sets. Candidates are all texts of a class of
#: fingerprints within ``RADIUS`` bits, found by the bit-sliced comparison, and,
#: as texts at 0.8 differ in some ten bits, those that share all ``KEY_ROWS``
#: min-hashes of one of ``KEYS`` keys: two texts at 0.8, long or short, with
#: probability 1 - (1 - 0.8 ** 4) ** 14 = 0.9994.
RADIUS = 4
SHINGLE, KEYS, KEY_ROWS = 5, 14, 4
#: Rows of an id and a hash that may be broadcast: some 25 MB.
SMALL_ROWS = 500_000


def min_hash_keys(shingles: np.ndarray) -> list[int]:
    """One key for each choice of ``KEY_ROWS`` min-hashes; an empty set has none."""
    if not len(shingles):
        return []
    least = np.array([_spread(shingles, lane).min() for lane in range(1, KEYS * KEY_ROWS + 1)], _U64)
    return [xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(least.reshape(KEYS, KEY_ROWS))]


def set_links(left: list[np.ndarray], right: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links of a cell: ``left`` among itself, or with ``right`` (numbered after it)."""
    sets = left + right
    sizes = np.array([len(x) for x in sets])
    kinds, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    label, edges, mark = np.arange(len(sets)), [], np.zeros(len(kinds), bool)
    for i in range(len(left)):
        first = len(left) if right else i + 1
        if (label[first:] == label[i]).all():
            continue
        own = codes[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        common = np.add.reduceat(mark[codes[starts[first] :]], starts[first:] - starts[first], dtype=np.int64)
        mark[own] = False
        near = first + np.flatnonzero(5 * common >= 4 * (sizes[i] + sizes[first:] - common))
        if len(near):
            _hook(label, i, near, edges)
    return edges


def pack_set(shingles: np.ndarray) -> bytes:
    """A sorted set of 40-bit hashes, five bytes each."""
    return shingles.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def unpack_set(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, 3:] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view(">u8").ravel().astype(_U64)


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(shingle_hashes(space_words(text), SHINGLE) >> _U64(24))


def similar_links(texts: DataFrame, nodes: DataFrame, more: DataFrame) -> DataFrame:
    """(a, b): links between distinct shingle sets, a spanning forest of each cell.

    ``nodes`` has fp, keys, and (n_id, n_tie) of one row of ``texts`` (doc_id,
    tie, body) that bears the set; ``more`` has further keys. Buckets with the same members are compared
    once; long ones are dealt over cells as in ``pair_links``. Only texts whose
    set shares a bucket are read again, and only their sets are moved.
    """
    spread = nodes.select("fp", F.posexplode("keys").alias("place", "key")).unionByName(more)
    member = F.xxhash64("fp")
    buckets = spread.groupBy("place", "key").agg(F.count("*").alias("n"), F.sum(F.shiftright(member, 20)).alias("s"), F.sum(F.hash("fp").cast("long")).alias("t")).where("n > 1")
    once = buckets.groupBy("n", "s", "t").agg(F.min(F.struct("place", "key")).alias("b"))
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int").alias("chunks")
    members = cut(spread.join(once.select("b.place", "b.key", chunks), ["place", "key"]))
    named = nodes.select("fp", "n_id", "n_tie").join(members.select("fp").distinct(), "fp", "left_semi")
    read = texts.join(named, texts["doc_id"].eqNullSafe(named["n_id"]) & (texts["tie"] == named["n_tie"])).select("fp", "body")

    def start():
        return lambda batch: [pa.array([pack_set(shingle_set(x)) for x in binaries(batch, "body")], pa.binary())]

    needed = annotate(read, [field("shingles", "binary")], start).select("fp", "shingles").dropDuplicates(["fp"])
    placed = (
        members.withColumn("c", F.pmod(member, F.col("chunks")).cast("int"))
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("place", "key", F.least("c", "x").alias("i"), F.greatest("c", "x").alias("j"), "c", "fp")
    )
    dealt = placed.join(needed, "fp").repartition("place", "key", "i", "j").sortWithinPartitions("place", "key", "i", "j", "c", "fp")
    short_batches(texts.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        left: list[tuple[bytes, np.ndarray]] = []
        right: list[tuple[bytes, np.ndarray]] = []

        def close() -> Iterator[pa.RecordBatch]:
            if current is not None and (len(left) > 1 if current[2] == current[3] else left and right):
                names = [fp for fp, _ in left + right]
                if made := [(names[i], names[j]) for i, j in set_links([x for _, x in left], [x for _, x in right])]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*made, strict=True)], names=["a", "b"])

        for batch in batches:
            for place, key, i, j, c, fp, shingles in zip(*(batch.column(n).to_pylist() for n in range(7)), strict=True):
                if (place, key, i, j) != current:
                    yield from close()
                    current, left, right = (place, key, i, j), [], []
                (left if c == i else right).append((fp, unpack_set(shingles)))
        yield from close()

    return dealt.select("place", "key", "i", "j", "c", "fp", "shingles").mapInArrow(compare, "a binary, b binary").distinct()


def class_keys(sets: DataFrame) -> DataFrame:
    """(fp, place, key): for each shingle set (fp, keys, print) the classes of its texts' fingerprints, as one more place of keys.

    Texts of one set may differ in what they repeat, and so in their fingerprints. Sets of no shingle have no key.
    """
    borne = cut(sets.where(F.size("keys") > 0).select("fp", "print").distinct())
    prints = cut(borne.select(F.col("print").alias("fp")).distinct())
    size = key_size(prints.count(), 64, RADIUS)
    roots = components(pair_links(prints, RADIUS, RADIUS + size, size)).withColumnRenamed("node", "print")
    return borne.join(roots, "print", "left").select("fp", F.lit(KEYS).alias("place"), F.xxhash64(F.coalesce("root", "print")).alias("key")).distinct()


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, tie, fp, root for every row: classes linked by a similarity of at least 0.8 of the shingle sets.

    ``tie`` is a hash of the text, ``fp`` a digest of its shingle set, ``root``
    the smallest digest of its class.
    """

    def start():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = binaries(batch, "body")
            sets = [shingle_set(x) for x in texts]
            return [
                pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary()),
                pa.array([min_hash_keys(x) for x in sets], pa.list_(pa.int64())),
                pa.array([fingerprint(space_words(x), 4) for x in texts], pa.binary()),
            ]

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_tie(), F.col("text").alias("body"))
    sets = cut(annotate(rows, [field("fp", "binary"), field("keys", "array<long>"), field("print", "binary")], start).drop("body"))
    one = F.min(F.struct("tie", F.col("doc_id").isNull(), "doc_id")).alias("one")
    nodes = cut(sets.groupBy("fp").agg(F.first("keys").alias("keys"), one).select("fp", "keys", F.col("one.doc_id").alias("n_id"), F.col("one.tie").alias("n_tie")))
    roots = components(similar_links(rows, nodes, class_keys(sets))).withColumnRenamed("node", "fp")
    return sets.select("doc_id", "tie", "fp").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def text_tie():
    return F.xxhash64("text").alias("tie")


def remove_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns: the row of the smallest doc_id, of those the one of the smallest text hash.

    Rows are judged by id and text together: a row is never taken for another
    that bears the same id. Equal rows count as one document, of which one
    row stays; rows without an id come after all others of their class.
    """
    docs, restored = aside(docs, "doc_id", "text")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie"))
    marked = cut(similar(docs).groupBy("doc_id", "tie", "root").agg(F.count("*").alias("n")))
    # Only classes of several documents have rows that go, and only they are looked at.
    several = marked.groupBy("root").agg(F.min(order).alias("first"), F.sum("n").alias("n")).where("n > 1")
    first = several.select("root", F.col("first.doc_id").alias("f_id"), F.col("first.tie").alias("f_tie"))
    stays = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("tie") == F.col("f_tie"))
    judged = cut(marked.join(first, "root").select("doc_id", "tie", stays.alias("stays"), "n"))
    here = lambda d: docs["doc_id"].eqNullSafe(d["j_id"]) & (F.xxhash64(docs["text"]) == d["j_tie"])
    named = judged.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("j_id"), F.col("tie").alias("j_tie"), "stays", "n")
    # Rows that go, and rows that stand there several times, leave the table; of the latter one comes back.
    gone, twice = named.where("NOT stays OR n > 1").select("j_id", "j_tie"), named.where("stays AND n > 1").select("j_id", "j_tie")
    rest = docs.join(_small(gone), here(gone), "left_anti").select(*docs.columns)
    if twice.isEmpty():
        return restored(rest)
    back = docs.join(_small(twice), here(twice), "left_semi").withColumn("_tie", F.xxhash64("text")).dropDuplicates(["doc_id", "_tie"])
    return restored(rest.unionByName(back.select(*docs.columns)))


def _small(marks: DataFrame) -> DataFrame:
    """``marks`` (an id and a hash a row), broadcast if they have at most ``SMALL_ROWS`` rows, else for a merge join."""
    return F.broadcast(marks) if marks.count() <= SMALL_ROWS else marks.hint("merge")
