"""Byte-level BPE: texts to token ids and back, with the tiktoken library.

The rank file is read on the driver (``RANKS``, a path; never copied) and goes
to the executors as a broadcast of at most ``MOST_BYTES``; each Python worker
builds its encoder once. Encoding and decoding are narrow passes.

A long text is cut before it is encoded, and only where no match of the pattern
reaches across, so the ids are those of the whole text:

* between a character that is no white space and white space: a match begins
  with at most one space and never goes on into one, and the look-ahead of a
  white-space match only looks at the character after white space;
* after an ASCII letter or digit before an ASCII character of another class:
  letters, digits and signs never share a match but for the contractions, which
  begin at an apostrophe and end in a letter.

A run of white space longer than ``RUN``, which the library's own splitter
cannot take, is split by rule: all of it is one match at the end of a text;
before a word its last character stands apart.

Defined results: null and empty texts have no ids; bytes that are no UTF-8 count
as U+FFFD; special tokens are ordinary text; a null list of ids, or one that
holds a null or an id outside of the ranks, decodes to null; an empty one to no
bytes. Repeated rows are encoded each, other columns pass through, and one that
bears the name of the new column gives way to it.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, binaries, field

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters that are encoded at a time, and those of a run of white space that the library is given.
PIECE, RUN = 1 << 16, 4096
#: Bound of a rank file, and so of the broadcast.
MOST_BYTES = 64 << 20
_CUT = regex.compile(r"\P{White_Space}(?=\p{White_Space})|[A-Za-z](?=[!-@\[-`{-~])|[0-9](?=[!-/:-~])")
_BUILT: dict[bytes, tiktoken.Encoding] = {}


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"a rank file of over {MOST_BYTES} bytes: {path}")
    return data


def encoder(data: bytes, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The library's encoder of a rank file's content; built once in each process."""
    key = hashlib.sha256(pattern.encode() + b"\0" + data).digest()
    if key not in _BUILT:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
        _BUILT.clear()
        _BUILT[key] = tiktoken.Encoding(key.hex(), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _BUILT[key]


def pieces(text: str, piece: int = PIECE, run: int = RUN):
    """(part of the text, whether it is one match): their ids follow one another as those of the text."""
    at = 0
    for m in regex.finditer(r"\p{White_Space}{%d,}" % (run + 1), text):
        yield from ((p, False) for p in _cut(text[at : m.start()], piece))
        at = m.end() if m.end() == len(text) else m.end() - 1
        yield text[m.start() : at], True
    yield from ((p, False) for p in _cut(text[at:], piece))


def _cut(text: str, piece: int):
    at = 0
    while len(text) - at > piece and (m := _CUT.search(text, at + piece - 1)):
        yield text[at : m.end()]
        at = m.end()
    if at < len(text):
        yield text[at:]


def ids_of(enc: tiktoken.Encoding, text: str, piece: int = PIECE, run: int = RUN) -> list[int]:
    if len(text) <= min(piece, run):
        return enc.encode_ordinary(text)
    out: list[int] = []
    for part, whole in pieces(text, piece, run):
        out += enc._core_bpe.encode_single_piece(part.encode()) if whole else enc.encode_ordinary(part)
    return out


def bytes_of(enc: tiktoken.Encoding, ids: list[int | None] | None) -> bytes | None:
    if ids is None or any(i is None or i < 0 for i in ids):
        return None
    try:
        return enc.decode_bytes(ids)
    except (KeyError, OverflowError):
        return None


def encode(docs: DataFrame, text: str = "text", name: str = "ids", ranks: str = RANKS) -> DataFrame:
    """``docs`` with the token ids of whole texts (``array<int>``)."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def start():
        enc = encoder(sent.value)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            each = [np.array(ids_of(enc, (x or b"").decode("utf-8", "replace")), np.int32) for x in binaries(batch, text)]
            offsets = np.cumsum([0, *map(len, each)], dtype=np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(each)))]

        return work

    return annotate(docs, [field(name, "array<int>")], start)


def decode(df: DataFrame, ids: str = "ids", name: str = "bytes", ranks: str = RANKS) -> DataFrame:
    """``df`` with the bytes of its ids (``binary``): raw, for a token may end inside a character."""
    sent = df.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def start():
        enc = encoder(sent.value)
        return lambda batch: [pa.array([bytes_of(enc, x) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()], pa.binary())]

    return annotate(df, [field(name, "binary")], start)


def report(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """The query's rows: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(docs.select("doc_id", "text"), ranks=ranks).drop("text"), ranks=ranks)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256")
    )
