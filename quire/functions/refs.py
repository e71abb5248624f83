"""References in words: ``John 3:16``, ``1 Cor 5:19-21``, ``Josh.17.2``.

Helpers for single references, and one Arrow pass for a column of them.

The book table is data: number, name, short name, code and other spellings.
``standard_books`` has the 66 usual names; tables with more spellings are read
from a source and passed in, since different inputs need different ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 66 books: number, name, short name (fixed values).
BOOK_ROWS = [
    (1, "Genesis", "Gen"),
    (2, "Exodus", "Exod"),
    (3, "Leviticus", "Lev"),
    (4, "Numbers", "Num"),
    (5, "Deuteronomy", "Deut"),
    (6, "Joshua", "Josh"),
    (7, "Judges", "Judg"),
    (8, "Ruth", "Ruth"),
    (9, "1 Samuel", "1Sam"),
    (10, "2 Samuel", "2Sam"),
    (11, "1 Kings", "1Kgs"),
    (12, "2 Kings", "2Kgs"),
    (13, "1 Chronicles", "1Chr"),
    (14, "2 Chronicles", "2Chr"),
    (15, "Ezra", "Ezra"),
    (16, "Nehemiah", "Neh"),
    (17, "Esther", "Esth"),
    (18, "Job", "Job"),
    (19, "Psalms", "Ps"),
    (20, "Proverbs", "Prov"),
    (21, "Ecclesiastes", "Eccl"),
    (22, "Song of Solomon", "Song"),
    (23, "Isaiah", "Isa"),
    (24, "Jeremiah", "Jer"),
    (25, "Lamentations", "Lam"),
    (26, "Ezekiel", "Ezek"),
    (27, "Daniel", "Dan"),
    (28, "Hosea", "Hos"),
    (29, "Joel", "Joel"),
    (30, "Amos", "Amos"),
    (31, "Obadiah", "Obad"),
    (32, "Jonah", "Jonah"),
    (33, "Micah", "Mic"),
    (34, "Nahum", "Nah"),
    (35, "Habakkuk", "Hab"),
    (36, "Zephaniah", "Zeph"),
    (37, "Haggai", "Hag"),
    (38, "Zechariah", "Zech"),
    (39, "Malachi", "Mal"),
    (40, "Matthew", "Matt"),
    (41, "Mark", "Mark"),
    (42, "Luke", "Luke"),
    (43, "John", "John"),
    (44, "Acts", "Acts"),
    (45, "Romans", "Rom"),
    (46, "1 Corinthians", "1Cor"),
    (47, "2 Corinthians", "2Cor"),
    (48, "Galatians", "Gal"),
    (49, "Ephesians", "Eph"),
    (50, "Philippians", "Phil"),
    (51, "Colossians", "Col"),
    (52, "1 Thessalonians", "1Thess"),
    (53, "2 Thessalonians", "2Thess"),
    (54, "1 Timothy", "1Tim"),
    (55, "2 Timothy", "2Tim"),
    (56, "Titus", "Titus"),
    (57, "Philemon", "Phlm"),
    (58, "Hebrews", "Heb"),
    (59, "James", "Jas"),
    (60, "1 Peter", "1Pet"),
    (61, "2 Peter", "2Pet"),
    (62, "1 John", "1John"),
    (63, "2 John", "2John"),
    (64, "3 John", "3John"),
    (65, "Jude", "Jude"),
    (66, "Revelation", "Rev"),
]
SINGLE_CHAPTER = frozenset({31, 57, 63, 64, 65})


@dataclass(frozen=True)
class Book:
    number: int
    name: str
    short: str
    code: str
    others: tuple[str, ...] = field(default=())


def standard_books() -> list[Book]:
    return [Book(number, name, short, short) for number, name, short in BOOK_ROWS]


def _squeezed(s: str) -> str:
    return re.sub(r"[\s.]+", "", s).lower()


class Books:
    """Lookup by any spelling: spaces and case do not count; the first book in order wins."""

    def __init__(self, books: list[Book] | None = None, extra: dict[str, int] | None = None):
        self.books = books or standard_books()
        self.by_number = {b.number: b for b in self.books}
        self.spellings: dict[str, int] = {}
        for b in self.books:
            for s in (b.name, b.short, b.code, *b.others):
                self.spellings.setdefault(_squeezed(s), b.number)
        for s, n in (extra or {}).items():
            self.spellings.setdefault(_squeezed(s), n)

    def number(self, name: str) -> int | None:
        return self.spellings.get(_squeezed(name))

    def by_prefix(self, name: str) -> int | None:
        """An exact spelling, else the one book whose name the text begins."""
        key = _squeezed(name)
        found = self.spellings.get(key)
        if found or not key:
            return found
        fits = {n for s, n in self.spellings.items() if s.startswith(key)}
        return fits.pop() if len(fits) == 1 else None

    def code_number(self, code: str) -> int:
        """A code without separators -> number, or 0."""
        key = re.sub(r"[ _.\-]", "", code).lower()
        return next((b.number for b in self.books if b.code.lower() == key), 0)

    def short(self, number: int) -> str | None:
        b = self.by_number.get(number)
        return b.short if b else None

    def format(self, key: int) -> str:
        short = self.short(key // 1_000_000)
        return f"{short} {key // 1000 % 1000}:{key % 1000}" if short else f"Unknown({key})"

    def format_range(self, start: int, end: int | None) -> str:
        return self.format(start) if end is None or end == start else f"{self.format(start)}-{self.format(end)}"


def pack(book: int, chapter: int, verse: int) -> int:
    return book * 1_000_000 + chapter * 1000 + verse


def parse_reference(text: str, books: Books) -> tuple[int, int]:
    """``Book c``, ``Book c:v``, ``Book c:v-w`` -> inclusive key range; a whole chapter is 1 to 999.

    The end may lie before the start, which then matches nothing.
    """
    m = re.fullmatch(r"\s*((?:\d\s*)?[^\W\d_][\w\s.]*?)\.?\s+(\d+)(?:\s*:\s*(\d+)(?:\s*[-–]\s*(\d+))?)?\s*", text)
    number = books.number(m[1]) if m else None
    if not m or number is None:
        raise ValueError(f"no reference: {text!r}")
    chapter, verse = int(m[2]), m[3]
    if verse is None:
        return pack(number, chapter, 1), pack(number, chapter, 999)
    return pack(number, chapter, int(verse)), pack(number, chapter, int(m[4] or verse))


def parse_loose(text: str, books: Books) -> int | None:
    """Digits as they are; else ``Book c.v`` or ``Book c:v``, the book by any unique beginning."""
    text = text.strip()
    if text.isdigit():
        return int(text)
    m = re.fullmatch(r"(.+?)[\s.]+(\d+)[.:](\d+)", text)
    number = books.by_prefix(m[1]) if m else None
    return pack(number, int(m[2]), int(m[3])) if number else None


def code_reference(ref: str, books: Books) -> int:
    """``Josh.17.1-Josh.17.2`` -> the key of its start, or 0; work prefixes (``Bible:``) are skipped."""
    head = ref.split("-")[0].split(":")[-1].strip()
    parts = head.split(".")
    number = books.code_number(parts[0])
    if not number or len(parts) < 3 or not all(re.match(r"\d+", p) for p in parts[1:3]):
        return 0
    chapter, verse = (int(re.match(r"\d+", p)[0]) for p in parts[1:3])
    return pack(number, chapter, verse) if chapter and verse else 0


def reference_columns(text: Column, books: Books | None = None) -> Column:
    """(low, high, loose, start) of references in a column: ``parse_reference``'s range, ``parse_loose``'s and ``code_reference``'s key.

    What is no reference of a kind is null there (``start``: 0); null texts give nulls.
    """
    table = books or Books()

    def one(t: str | None) -> dict:
        if t is None:
            return dict.fromkeys(("low", "high", "loose", "start"))
        try:
            low, high = parse_reference(t, table)
        except ValueError:
            low = high = None
        return {"low": low, "high": high, "loose": parse_loose(t, table), "start": code_reference(t, table)}

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [one(None if pd.isna(t) else t) for t in texts]
        return pd.DataFrame({c: pd.array([r[c] for r in rows], "Int64") for c in ("low", "high", "loose", "start")})

    return F.pandas_udf(run, "low long, high long, loose long, start long")(text)


# Lists of references -------------------------------------------------------------


def _number_list(book: int, chapter: int, text: str) -> list[tuple[int, int]]:
    """``1-3,7``: inverted ranges are dropped; a single key ends where it starts."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        ends = re.fullmatch(r"(\d+)\s*-\s*(\d+)\D*", part)
        if ends:
            a, b = int(ends[1]), int(ends[2])
            if b >= a:
                out.append((pack(book, chapter, a), pack(book, chapter, b)))
        elif "-" not in part or part.count("-") > 1:
            if m := re.match(r"\d+", part):
                out.append((pack(book, chapter, int(m[0])),) * 2)
    return out


_PLACE = re.compile(r"(?P<c1>\d+):(?P<v1>\d+)\s*-\s*(?P<c2>\d+):(?P<v2>\d+)|(?P<c>\d+):(?P<list>\d+(?:[,-]\d+)*)|(?P<bare>\d+)")


def _places(book: int, text: str) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    chapter = None
    for m in _PLACE.finditer(text):
        if m["c1"]:
            chapter = int(m["c2"])
            out.append((pack(book, int(m["c1"]), int(m["v1"])), pack(book, chapter, int(m["v2"]))))
        elif m["c"]:
            chapter = int(m["c"])
            out += _number_list(book, chapter, m["list"])
        elif chapter is not None and re.search(r",\s*$", text[: m.start()]):
            out.append((pack(book, chapter, int(m["bare"])),) * 2)
        elif book in SINGLE_CHAPTER:
            chapter = 1
            out.append((pack(book, 1, int(m["bare"])),) * 2)
        else:
            chapter = int(m["bare"])
            out.append((pack(book, chapter, 1),) * 2)
    return out


def parse_reference_list(text: str | None, book: int, chapter: int, books: Books) -> list[tuple[int, int]]:
    """``35-39; 5:3,4; Ge 50:20`` read at a place -> inclusive ranges.

    A named book carries on to the groups after it; before the first, the
    source's book holds, and bare numbers are verses of its chapter.
    """
    out: list[tuple[int, int]] = []
    current: int | None = None
    for group in filter(None, (g.strip() for g in (text or "").split(";"))):
        named = re.match(r"(\d?\s*[A-Za-z]+)(?:\s+(?=\d)|\s*$)", group)
        number = books.number(named[1]) if named else None
        if number:
            current = number
            out += _places(number, group[named.end() :])
        elif re.match(r"\d+:", group):
            out += _places(current or book, group)
        elif group[:1].isdigit():
            out += _places(current, group) if current else _number_list(book, chapter, group)
    return out


def phrase_groups(html: str | None) -> list[tuple[str | None, list[str]]]:
    """Groups of an entry: text is a phrase, links after it are its references.

    A link that is just a number heads a chapter: it and the text after it are
    skipped. Links before any phrase form a group without one. Groups without
    links are dropped.
    """
    groups: list[tuple[str | None, list[str]]] = []
    heading = False
    for piece in filter(None, (p.strip() for p in re.split(r"(?i)<br\s*/?>", html or ""))):
        if re.match(r"<a[ >]", piece):
            found = re.search(r">([^<]*)</a>", piece)
            body = found[1].strip() if found else ""
            if not body:
                continue
            heading = body.isdigit() and body.isascii()
            if not heading:
                if not groups:
                    groups.append((None, []))
                groups[-1][1].append(body)
        elif heading:
            heading = False
        elif phrase := re.sub(r"<[^>]*>", "", piece).strip():
            groups.append((phrase, []))
    return [g for g in groups if g[1]]
