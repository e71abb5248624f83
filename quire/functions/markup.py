"""Markup of one record -> clean text with word-offset annotations.

``parse`` reads OSIS and the HTML that filters make of other formats. It is a
fold over tokens (tags, entities, text runs) with a little state: the words so
far, open elements, open ``<w>`` elements, and how deep it is in notes, titles
and dropped readings. Offsets are 0-based inclusive word indexes of a text whose
words are joined by single spaces.

``parsed`` runs it as an Arrow function, since the state has no SQL form.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .refs import Books, code_reference

SCHEMA = (
    "text string, word_count int, trailing_paragraph boolean, "
    "block struct<paragraph_start:boolean,poetry_level:int,heading:string,selah:boolean>, "
    "spans array<struct<type:string,start:int,end:int,ref:bigint>>, "
    "words array<struct<start:int,end:int,original_word:string,strongs_number:string,all_strongs:string,morphology:string,gloss:string>>"
)
#: Tags that end a word; elements whose ends pair with their starts; escaped tags that are restored (fixed values).
LAYOUT = frozenset("br hr p div ul ol li dl dt dd table tr td th blockquote lb l lg title".split())
PAIRED = frozenset("divinename transchange hi q seg foreign translit transliteration reference i b em strong small font cite sup".split())
ESCAPED = "note title q hi divineName transChange lb l lg milestone foreign seg w reference p div catchWord rdg".split()
#: Named entities (fixed values).
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "para": "¶", "ndash": "–", "mdash": "—",
    "hellip": "…", "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“",
}
_SPACE = " \t\n\r\x0b\x0c\u00a0\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_TOKEN = re.compile(
    r"<(?P<tag>[^>]*)>|&(?P<entity>[^;]{1,9});|(?P<para>¶)|\\(?P<usfm>\+?[a-z]{1,8}(?![a-z])[0-9]*\*?)|(?P<space>[" + re.escape(_SPACE) + r"]+)|(?P<text>[^<&¶\\" + re.escape(_SPACE) + r"]+|[<&\\])"
)
_RESTORE = re.compile(r"&lt;(/?(?:" + "|".join(ESCAPED) + r")(?=[ /]|&gt;)(?:(?!&lt;|&gt;).){0,380}?)&gt;", re.DOTALL)


def attribute(body: str, name: str) -> str:
    """An attribute's value, quoted either way or bare; '' if absent."""
    m = re.search(rf"(?:^|\s){re.escape(name)}=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>/\"'][^\s>/]*))", body)
    return next((g for g in m.groups() if g is not None), "") if m else ""


def entity(name: str) -> str | None:
    """What ``&name;`` stands for, or None."""
    if m := re.fullmatch(r"#(?:[xX]([0-9A-Fa-f]+)|([0-9]+))", name):
        code = int(m[1], 16) if m[1] else int(m[2])
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    return ENTITIES.get(name.lower())


def strongs_in(lemma: str) -> list[str]:
    return [n[0].upper() + n[1:] for n in re.findall(r"strong:([GHgh]\S*)", lemma)]


def original_in(lemma: str) -> str:
    m = re.search(r"lemma\.TR:(\S+)", lemma) or re.search(r"lemma:(\S+)", lemma)
    return m[1] if m else ""


def morphology_in(morph: str) -> str:
    return " ".join(filter(None, (t.split(":", 1)[-1] for t in morph.split())))


@dataclass
class Element:
    name: str
    kind: str
    sid: str
    start: int
    ref: int
    drop: bool


@dataclass
class Reader:
    """The state of one record's reading."""

    books: Books
    words: list[str] = field(default_factory=list)
    pending: str = ""
    heading: str = ""
    open: list[Element] = field(default_factory=list)
    tokens: list[dict] = field(default_factory=list)
    open_tokens: list[dict] = field(default_factory=list)
    spans: list[tuple[int, int, str, int]] = field(default_factory=list)
    notes: int = 0
    titles: int = 0
    drops: int = 0
    last_mark: int = -1
    paragraph: bool = False
    poetry: int = 0
    selah: bool = False

    def flush(self) -> None:
        if self.pending:
            self.words.append(self.pending)
            self.pending = ""

    def last_word(self) -> int:
        """The index of the word being written, or of the one before."""
        return len(self.words) - (not self.pending)

    def mark_paragraph(self) -> None:
        self.last_mark = len(self.words) + bool(self.pending)
        self.paragraph = self.paragraph or self.last_mark == 0

    def write(self, s: str) -> None:
        """Text in the place that is open for it."""
        if self.notes:
            return
        if self.titles:
            self.heading += s
        elif not self.drops:
            self.pending += s

    def space(self) -> None:
        if self.notes:
            return
        if self.titles:
            self.heading += " "
        else:
            self.flush()

    def decoded(self, s: str) -> None:
        """An entity's text: a pilcrow marks a paragraph, a space ends a word."""
        if self.titles or self.notes:
            self.write(s)
        elif s == "¶":
            self.mark_paragraph()
        elif not self.drops:
            if s in " \t\n\r\x0b\x0c":
                self.flush()
            else:
                self.pending += s

    def close_span(self, e: Element, end: int) -> None:
        if e.drop and self.drops:
            self.drops -= 1
        if e.kind and end >= e.start:
            self.spans.append((e.start, end, e.kind, e.ref))

    def close(self, name: str, eid: str = "") -> None:
        """The innermost open element of that name, and of that milestone id where both have one."""
        for i in range(len(self.open) - 1, -1, -1):
            e = self.open[i]
            if e.name == name and (not eid or not e.sid or e.sid == eid):
                self.close_span(self.open.pop(i), self.last_word())
                return

    def close_token(self, t: dict, end: int) -> None:
        t |= {"end": end, "gloss": True}
        if end >= t["start"] and t["strongs_number"]:
            self.tokens.append(t)

    def tag(self, body: str) -> None:
        if body.startswith("!"):
            if not self.notes and not self.titles:
                self.flush()
                if body[1:2] in ("P", "p"):
                    self.mark_paragraph()
            return
        closing, empty = body.startswith("/"), body.endswith("/")
        m = re.match(r"[/\s]*([^\s/>]*)", body)
        name = m[1].lower()
        if not self.notes and not self.titles and name in LAYOUT:
            self.flush()
        if name == "note":
            self.notes = max(0, self.notes - 1) if closing else self.notes + (not empty)
        elif self.notes:
            return
        elif name == "title":
            if closing:
                self.titles = max(0, self.titles - 1)
            elif not empty:
                self.titles += 1
                self.heading += " " if self.heading else ""
        elif not self.titles:
            self.element(name, body, closing, empty)

    def element(self, name: str, body: str, closing: bool, empty: bool) -> None:
        kind = attribute(body, "type").lower()
        if name == "w":
            self.token(body, closing, empty)
        elif name == "lb":
            pass
        elif name == "milestone":
            if "x-p" in kind or "paragraph" in kind:
                self.mark_paragraph()
        elif name == "p" or name == "div":
            if not closing and (name == "p" or "paragraph" in kind):
                self.mark_paragraph()
        elif name == "lg":
            if not closing and not empty:
                self.poetry = self.poetry or 1
        elif name == "l":
            if not closing:
                self.selah = self.selah or "selah" in kind
                level = re.match(r"\s*([+-]?\d+)", attribute(body, "level"))
                self.poetry = max(self.poetry, min(3, max(1, int(level[1]) if level else 1)))
        else:
            self.paired(name, body, kind, closing, empty)

    def token(self, body: str, closing: bool, empty: bool) -> None:
        if closing:
            if self.open_tokens:
                self.close_token(self.open_tokens.pop(), self.last_word())
            return
        lemma = attribute(body, "lemma") or attribute(body, "savlm")
        numbers = strongs_in(lemma)
        t = {
            "start": len(self.words), "end": len(self.words), "original_word": original_in(lemma), "strongs_number": numbers[0] if numbers else "",
            "all_strongs": " ".join(numbers), "morphology": morphology_in(attribute(body, "morph")), "gloss": False,
        }
        if not empty:
            self.open_tokens.append(t)
        elif numbers:
            self.tokens.append(t)

    def meaning(self, name: str, body: str, kind: str, closing: bool) -> tuple[str, int, bool]:
        """(span type, reference, whether the element's text is dropped)."""
        if name == "divinename":
            return "divine_name", 0, False
        if name == "transchange":
            return ("supplied" if not kind or "added" in kind else "emphasis"), 0, False
        if name == "hi":
            plain = "supplied" if "italic" in kind else "emphasis" if not kind or "emphasis" in kind or "bold" in kind else ""
            return plain, 0, False
        if name == "q":
            if "jesus" in attribute(body, "who").lower():
                return "words_of_christ", 0, False
            return "quotation", code_reference(attribute(body, "osisRef"), self.books), False
        if name == "seg":
            self.selah = self.selah or "selah" in kind
            sub = attribute(body, "subType").lower()
            return "", 0, not closing and "x-variant" in kind and sub not in ("", "x-1")
        if name == "reference":
            ref = code_reference(attribute(body, "osisRef"), self.books)
            return ("quotation" if ref else ""), ref, False
        if name == "font":
            size = attribute(body, "size").strip()
            if attribute(body, "color").lower() in ("red", "#ff0000", "#f00"):
                return "words_of_christ", 0, False
            return ("divine_name" if size.startswith("-") else ""), 0, False
        if name == "sup":
            return "", 0, not closing and "n" in attribute(body, "class").lower()
        simple = {"i": "supplied", "b": "emphasis", "strong": "emphasis", "em": "emphasis", "cite": "quotation"}
        simple |= dict.fromkeys(("foreign", "translit", "transliteration"), "transliteration")
        return simple.get(name, ""), 0, False

    def paired(self, name: str, body: str, kind: str, closing: bool, empty: bool) -> None:
        span, ref, drop = self.meaning(name, body, kind, closing)
        sid, eid = attribute(body, "sID"), attribute(body, "eID")
        if closing:
            self.close(name)
        elif eid:
            self.close(name, eid)
        elif (not empty or sid) and (span or sid or drop or name in PAIRED):
            self.open.append(Element(name, span, sid, len(self.words), ref, drop))
            self.drops += drop

    def finish(self) -> dict:
        self.flush()
        n = len(self.words)
        while self.open_tokens:
            self.close_token(self.open_tokens.pop(), n - 1)
        while self.open:
            self.close_span(self.open.pop(), n - 1)
        tokens = []
        for t in self.tokens if n else []:
            start, end = min(t["start"], n - 1), max(min(t["start"], n - 1), min(t["end"], n - 1))
            tokens.append(t | {"start": start, "end": end, "gloss": " ".join(self.words[start : end + 1]) if t["gloss"] else None})
        tokens.sort(key=lambda t: t["start"])
        return {
            "text": " ".join(self.words), "word_count": n, "trailing_paragraph": n > 0 and self.last_mark == n,
            "block": {"paragraph_start": self.paragraph, "poetry_level": self.poetry, "heading": " ".join(self.heading.split()), "selah": self.selah},
            "spans": [{"type": k, "start": a, "end": b, "ref": r} for a, b, k, r in sorted(self.spans, key=lambda s: s[:3])],
            "words": tokens,
        }


def restore_escaped(raw: str) -> str:
    """Well-known elements that were escaped as text become elements again."""
    return _RESTORE.sub(lambda m: "<" + m[1].replace("&quot;", '"').replace("&amp;", "&") + ">", raw) if "&lt;" in raw else raw


def parse(raw: str | None, books: Books | None = None) -> dict:
    """Null and empty records have no words."""
    r = Reader(books or _books())
    text, at = restore_escaped(raw or ""), 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:  # a backslash run that is no marker, or a stray character
            r.write(text[at])
            at += 1
            continue
        at = m.end()
        if m["tag"] is not None:
            r.tag(m["tag"])
        elif m["entity"] is not None:
            value = entity(m["entity"])
            if value is None:
                r.write("&")
                at = m.start() + 1
                continue
            if value == "&" and (twice := re.match(r"([^;&\s]{1,9});", text[at : at + 12])) and (inner := entity(twice[1])):
                value, at = inner, at + twice.end()
            r.decoded(value)
        elif m["para"]:
            if not r.notes and not r.titles:
                r.mark_paragraph()
        elif m["space"]:
            r.space()
        elif m["usfm"] is None:
            r.write(m["text"])
    return r.finish()


_PLAIN = re.compile(r"<(?P<tag>[^>]*)>|&(?P<entity>[^;]{0,8});|(?P<space>\s)|(?P<text>[^<&\s]+|[<&])")
#: What the plain reader tells apart: tag test on the lower-cased body -> kind of range.
_RANGES = (("red", r"font\b.*color.*red|q\b.*who=.*jesus"), ("italic", r"i(\s|$)"), ("bold", r"b(\s|$)"), ("underline", r"u(\s|$)"))
_ENDS = {"font": "red", "q": "red", "i": "italic", "b": "bold", "u": "underline"}


def plain_ranges(html: str) -> dict:
    """Text with its white space kept, and word ranges of four kinds; every tag ends a word.

    A range that closes before a whole word has been read is left out.
    """
    out: dict = {"text": "", "red": [], "italic": [], "bold": [], "underline": []}
    words, inside, open_tags = 0, False, []
    for m in _PLAIN.finditer(html or ""):
        entity = {"nbsp": " ", "lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}.get((m["entity"] or "").lower())
        if m["tag"] is not None or m["space"] or entity == " ":
            words, inside = words + inside, False
            out["text"] += "" if m["tag"] is not None else m["space"] or " "
        else:
            out["text"], inside = out["text"] + (entity or m[0]), True
        if m["tag"] is None:
            continue
        body = m["tag"].lower().strip()
        if body.startswith("/"):
            kind = _ENDS.get(body[1:].split()[0] if body[1:].split() else "")
            at = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == kind), None)
            if at is not None:
                start = open_tags.pop(at)[1]
                if words > start:
                    out[kind].append((start, words - 1))
        elif kind := next((k for k, test in _RANGES if re.match(test, body)), None):
            open_tags.append((kind, words))
    return out


_DEFAULT: list[Books] = []


def _books() -> Books:
    if not _DEFAULT:
        _DEFAULT.append(Books())
    return _DEFAULT[0]


def formatting_of(parsed: dict, source_verses: list[dict] | None = None) -> str | None:
    """The formatting document, or None where there is nothing to record."""
    block = {k: v for k, v in parsed["block"].items() if v}
    out: dict = {"v": 1}
    if block:
        out["block"] = block
    if parsed["spans"]:
        out["spans"] = [{k: v for k, v in s.items() if k != "ref" or v} for s in parsed["spans"]]
    if source_verses:
        out["source_verses"] = source_verses
    return json.dumps(out, ensure_ascii=False, separators=(",", ":")) if len(out) > 1 else None


def _parsed(raw: pd.Series) -> pd.DataFrame:
    rows = [parse(x) for x in raw]
    return pd.DataFrame(rows, columns=["text", "word_count", "trailing_paragraph", "block", "spans", "words"])


def parsed(raw: Column) -> Column:
    """A struct of text, word_count, trailing_paragraph, block, spans and words."""
    return F.pandas_udf(_parsed, SCHEMA)(raw)


def formatting(block: Column, spans: Column, source_verses: Column | None = None) -> Column:
    """The same document from columns: nulls are left out, key order is v, block, spans, source_verses."""
    blk = F.struct(
        F.when(block["paragraph_start"], F.lit(True)).alias("paragraph_start"),
        F.when(block["poetry_level"] > 0, block["poetry_level"]).alias("poetry_level"),
        F.nullif(block["heading"], F.lit("")).alias("heading"),
        F.when(block["selah"], F.lit(True)).alias("selah"),
    )
    some_block = block["paragraph_start"] | (block["poetry_level"] > 0) | (block["heading"] != "") | block["selah"]
    spn = F.transform(spans, lambda s: F.struct(s["type"].alias("type"), s["start"].alias("start"), s["end"].alias("end"), F.when(s["ref"] != 0, s["ref"]).alias("ref")))
    some_spans = F.size(spans) > 0
    parts = [F.lit(1).alias("v"), F.when(some_block, blk).alias("block"), F.when(some_spans, spn).alias("spans")]
    some = some_block | some_spans
    if source_verses is not None:
        parts.append(F.when(F.size(source_verses) > 0, source_verses).alias("source_verses"))
        some = some | (F.size(source_verses) > 0)
    return F.when(some, F.to_json(F.struct(*parts)))
