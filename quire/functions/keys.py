"""Packed hierarchical keys: ``book * 1_000_000 + chapter * 1_000 + verse``.

Column expressions only; integer division is ``div`` (``/`` would be a double).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOOK, CHAPTER = 1_000_000, 1_000
FIRST_KEY, LAST_KEY = 1_000_000, 66_999_999


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a, F.lit(n).cast("long"))


def pack(book: Column, chapter: Column, verse: Column) -> Column:
    return book.cast("long") * BOOK + chapter.cast("long") * CHAPTER + verse.cast("long")


def book_of(key: Column) -> Column:
    return _div(key.cast("long"), BOOK)


def chapter_of(key: Column) -> Column:
    return _div(key.cast("long") % BOOK, CHAPTER)


def verse_of(key: Column) -> Column:
    return key.cast("long") % CHAPTER


def chapter_key(key: Column) -> Column:
    """Book and chapter together: the key without its verse."""
    return _div(key.cast("long"), CHAPTER)


def checked(key: Column) -> Column:
    """The key, or null outside of the 66 books."""
    return F.when(key.between(FIRST_KEY, LAST_KEY), key)


def format_ref(key: Column, book_name: Column) -> Column:
    """``Name c:v``; a key whose book has no name reads ``Unknown(key)``."""
    text = F.concat(book_name, F.lit(" "), chapter_of(key).cast("string"), F.lit(":"), verse_of(key).cast("string"))
    return F.coalesce(text, F.concat(F.lit("Unknown("), key.cast("string"), F.lit(")")))


def format_full(key: Column, book_name: Column) -> Column:
    """The same with ``BookN`` for a book without a name."""
    return F.concat(F.coalesce(book_name, F.concat(F.lit("Book"), book_of(key).cast("string"))), F.lit(" "), chapter_of(key).cast("string"), F.lit(":"), verse_of(key).cast("string"))


def format_range(start: Column, end: Column, start_name: Column, end_name: Column) -> Column:
    """``a-b``, or ``a`` where the end is null or equal."""
    one = format_ref(start, start_name)
    return F.when(end.isNull() | (end == start), one).otherwise(F.concat(one, F.lit("-"), format_ref(end, end_name)))


def range_end(start: Column, end: Column) -> Column:
    """A stored range's end: never null or 0, a single key ends where it starts."""
    return F.when(end > 0, end).otherwise(start)


def overlaps(start: Column, end: Column, low, high) -> Column:
    """Inclusive ranges that share a key; a null bound never matches."""
    return (start <= high) & (end >= low)


def contains_key(start: Column, end: Column, key) -> Column:
    """Whether the range holds ``key``; an open range (null end) goes on."""
    return (start <= key) & (end.isNull() | (end >= key))
