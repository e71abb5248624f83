"""Text functions as column expressions; Arrow functions where Spark has none."""

from __future__ import annotations

import html
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import matched_letters

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(x: Column) -> Column:
    """A-Z only, as a case-insensitive collation of plain ASCII does."""
    return F.translate(x, _UPPER, _LOWER)


def like_ci(x: Column, pattern: str) -> Column:
    """LIKE without regard to ASCII case."""
    return ascii_lower(x).like(pattern.translate(str.maketrans(_UPPER, _LOWER)))


# Five word counts, named apart ------------------------------------------------


def count_space_words(x: Column) -> Column:
    """Runs of non-space characters."""
    return F.coalesce(F.regexp_count(x, F.lit(r"\S+")), F.lit(0)).cast("long")


#: White space as two scripting languages know it (fixed values): with the separators of files to units, and with the byte order mark.
SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WEB_SPACES = r"\t-\r\x20\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


#: A character that is none of these. The letters that most texts are made of stand first, so
#: that few characters are held against every range of the long list.
_UNSPACED = rf"[!-~[\u00a1-\u167f[^{SPACES}]]]"
_WEB_UNSPACED = rf"[!-~[\u00a1-\u167f[^{WEB_SPACES}]]]"


def count_lettered_words(x: Column) -> Column:
    """Runs of characters that are no space of any script and hold a letter or a digit.

    A match begins at a run's first letter or digit and takes the rest of the
    run, so there is one in each run that has any, and no character is read twice.
    """
    return F.coalesce(F.regexp_count(x, F.lit(rf"[a-zA-Z[\p{{L}}\p{{N}}]]{_UNSPACED}*")), F.lit(0)).cast("long")


def count_web_words(x: Column) -> Column:
    """Runs of characters that are no ``WEB_SPACES``."""
    return F.coalesce(F.regexp_count(x, F.lit(f"{_WEB_UNSPACED}+")), F.lit(0)).cast("long")


def count_by_spaces(x: Column) -> Column:
    """Spaces of the trimmed text plus one."""
    t = F.btrim(x)
    return (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def count_split_words(x: Column) -> Column:
    """Non-empty pieces between single spaces."""
    return F.size(F.filter(F.split(x, " "), lambda w: w != "")).cast("long")


# Identity ------------------------------------------------------------------------


def sha256(x: Column) -> Column:
    return F.sha2(x, 256)


def identity_key(kind: Column, abbreviation: Column, language: Column) -> Column:
    """``type:abbreviation:language``, A-Z lower-cased; xref modules are ``cross_reference``."""
    return ascii_lower(F.concat_ws(":", F.when(kind == "xref", F.lit("cross_reference")).otherwise(kind), abbreviation, language))


def deterministic_uuid(key: Column, prefix: str = "urn:bible-module:v0.1:") -> Column:
    """A version-8 UUID from the SHA-256 of ``prefix`` and the key."""
    h = F.sha2(F.concat(F.lit(prefix), key), 256)
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3))
    variant = F.substring(F.lit("89ab"), nibble + 1, F.lit(1))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


# Licences, languages, years -----------------------------------------------------------


#: Parts of a licence text and the identifier that they mean, first hit wins (fixed values).
LICENCES = [
    (("public domain",), "PD"),
    (("cc0",), "CC0-1.0"),
    (("creative commons", "cc-by", "cc by"), "CC-BY"),
    (("gpl",), "GPL"),
    (("free non-commercial", "free noncommercial"), "LicenseRef-SWORD-FreeNonCommercial"),
    (("permission to distribute",), "LicenseRef-SWORD-DistributionPermitted"),
    (("copyright",), "LicenseRef-Proprietary"),
]
#: Parts that add to CC-BY, its versions, and the default version (fixed values).
CC_COMMERCE = [(("noncommercial", "non-commercial", "-nc"), "-NC")]
CC_SHARING = [(("noderiv", "-nd"), "-ND"), (("sharealike", "share alike", "-sa"), "-SA")]
CC_VERSIONS = [((v,), v) for v in ("4.0", "3.0", "2.5", "2.0", "1.0")]
GPL_VERSIONS = [(("3",), "GPL-3.0-or-later")]


def _first_part(low: Column, table: list[tuple[tuple[str, ...], str]], default: str) -> Column:
    out = F.lit(default)
    for parts, value in reversed(table):
        out = F.when(_any_part(low, parts), value).otherwise(out)
    return out


def licence_to_spdx(text: Column) -> Column:
    """The first rule that fits, on the lower-cased and trimmed text; '' for none."""
    low = F.lower(F.btrim(F.coalesce(text, F.lit(""))))
    kind = _first_part(low, LICENCES, "")
    creative = F.concat(F.lit("CC-BY"), _first_part(low, CC_COMMERCE, ""), _first_part(low, CC_SHARING, ""), F.lit("-"), _first_part(low, CC_VERSIONS, "4.0"))
    return F.when(kind == "CC-BY", creative).when(kind == "GPL", _first_part(low, GPL_VERSIONS, "GPL-2.0-or-later")).otherwise(kind)


def spdx_url(spdx: Column) -> Column:
    code = F.lower(F.regexp_extract(spdx, r"^CC-(.*)-[^-]*$", 1))
    version = F.regexp_extract(spdx, r"^CC-.*-([^-]*)$", 1)
    return (
        F.when(spdx == "PD", "https://creativecommons.org/publicdomain/mark/1.0/")
        .when(spdx.rlike("^CC-.*-"), F.concat(F.lit("https://creativecommons.org/licenses/"), code, F.lit("/"), version, F.lit("/")))
        .when(spdx == "GPL-3.0-or-later", "https://www.gnu.org/licenses/gpl-3.0.html")
        .when(spdx == "GPL-2.0-or-later", "https://www.gnu.org/licenses/old-licenses/gpl-2.0.html")
        .otherwise("")
    )


def first_year(x: Column) -> Column:
    """The first standalone four-digit number from 1000 to 2999, else 0."""
    found = F.regexp_extract(x, r"(?<!\d)([12]\d{3})(?!\d)", 1)
    return F.when(found != "", found.try_cast("int")).otherwise(F.lit(0))


def primary_language(tag: Column) -> Column:
    return F.lower(F.regexp_extract(F.btrim(tag), r"^([^-_]*)", 1))


#: Languages and script subtags that are written from right to left (fixed values).
RTL_LANGUAGES = ("he", "hbo", "ar", "arb", "arz", "apc", "acm", "fa", "pes", "prs", "ur", "yi", "ps", "sd", "ug", "ckb", "dv", "syr", "arc", "sam")
RTL_SCRIPTS = ("arab", "hebr", "syrc", "thaa", "nkoo", "adlm", "samr", "mand")


def is_right_to_left(tag: Column, direction: Column) -> Column:
    """An explicit direction decides; else the language, else a script subtag."""
    d = F.lower(F.btrim(F.coalesce(direction, F.lit(""))))
    script = F.lower(tag).rlike(f"-({'|'.join(RTL_SCRIPTS)})([-_]|$)")
    return F.when(d.isin("rtol", "rtl"), True).when(d.isin("ltor", "ltr"), False).otherwise(F.coalesce(primary_language(tag).isin(*RTL_LANGUAGES) | script, F.lit(False)))


# Markup and encoding --------------------------------------------------------------------


def strip_rtf(x: Column) -> Column:
    """Rich-text control words, braces and HTML tags out; entities decoded; spaces collapsed."""
    y = F.regexp_replace(x, r"\\([\\{}])", "\x01$1")  # escaped literals are kept apart
    y = F.regexp_replace(y, r"(?<!\x01)\\(par|line|pard|tab)(?![A-Za-z])-?[0-9]* ?", " ")
    y = F.regexp_replace(y, r"(?<!\x01)\\[A-Za-z]+-?[0-9]* ?", "")
    y = F.regexp_replace(y, r"(?<!\x01)\\", "")
    y = F.regexp_replace(y, r"<[A-Za-z/!][^>]{0,198}>", " ")
    y = F.regexp_replace(y, r"(?<!\x01)[{}]", "")
    y = F.replace(y, F.lit("\x01"), F.lit(""))
    for name, value in (("&nbsp;", " "), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        y = F.replace(y, F.lit(name), F.lit(value))
    return F.btrim(F.regexp_replace(y, r"\s+", " "))


def strip_markup(x: Column) -> Column:
    """Tags vanish (words may fuse), then five entities are decoded in a fixed order."""
    y = F.regexp_replace(x, r"<[^>]*>", "")
    for name, value in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"')):
        y = F.replace(y, F.lit(name), F.lit(value))
    return y


def strip_markup_clean(x: Column) -> Column:
    """``strip_markup`` without pilcrows, with single spaces, trimmed."""
    return F.btrim(F.regexp_replace(F.replace(strip_markup(x), F.lit("¶"), F.lit("")), r"\s+", " "))


#: Replacements that clean section HTML, in their order (fixed values).
SECTION_MARKUP = [
    (r"<!/P>\s*<br\s*/?>\s*<!P>\s*<br\s*/?>", "</p>\n<p>"),
    (r"<!P>\s*<br\s*/?>", ""),
    (r"<!/P>\s*<br\s*/?>", ""),
    (r"<!/?P>", ""),
    (r"<a\s+href=\"passagestudy\.jsp\?[^\"]*\">", ""),
    (r"</a>", ""),
]
SECTION_SPACE = [(r"\t{2,}", ""), (r" {2,}", " "), (r"\n{3,}", "\n\n")]


def clean_section_html(x: Column) -> Column:
    """Section HTML: paragraph markers become tags, study links their text; wrapped in ``<p>``, runs of space shortened."""
    y = x
    for pattern, put in SECTION_MARKUP:
        y = F.regexp_replace(y, pattern, put)
    opened = y.rlike(r"^[ \t\r\n]*<(p|h[123])")
    y = F.concat(F.when(opened, F.lit("")).otherwise(F.lit("<p>")), y)
    y = F.concat(y, F.when(y.rlike(r"</p>[ \t\r\n]*$"), F.lit("")).otherwise(F.lit("</p>")))
    for pattern, put in SECTION_SPACE:
        y = F.regexp_replace(y, pattern, put)
    return y


#: Kinds of dictionaries: (kind, parts of the name, of the description, of the category), first hit wins (fixed values).
DICTIONARY_KINDS = [
    ("glossary", (), ("glossary",), ("glossar",)),
    ("strongs", ("strong",), ("strong",), ()),
    ("greek_lexicon", ("greek", "thayer", "bdag", "liddell"), (), ()),
    ("hebrew_lexicon", ("hebrew", "bdb", "halot"), (), ()),
]


def _any_part(x: Column, parts: tuple[str, ...]) -> Column:
    low, out = F.lower(F.coalesce(x, F.lit(""))), F.lit(False)
    for p in parts:
        out = out | low.contains(p)
    return out


def dictionary_kind(name: Column, description: Column, category: Column) -> Column:
    out = F.lit("bible_dictionary")
    for kind, names, descriptions, categories in reversed(DICTIONARY_KINDS):
        out = F.when(_any_part(name, names) | _any_part(description, descriptions) | _any_part(category, categories), kind).otherwise(out)
    return out


def devotional_kind(description: Column) -> Column:
    """By the year unless the description names a fixed number of days."""
    yearly, fixed = _any_part(description, ("365", "daily", "year")), _any_part(description, ("40 day", "90 day", "30 day"))
    return F.when(~yearly & fixed, "fixed_length").otherwise("day_of_year")


def has_red_font(html: Column) -> Column:
    return F.lower(html).rlike(r"<font[^>]*color\s*=\s*[\"']?(red|#ff0000|#f00)\b")


_C1 = "".join(chr(c) for c in range(0x80, 0xA0))
_CP1252 = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")


def latin1_to_text(raw: Column) -> Column:
    """Latin-1 bytes, with the printable characters that CP1252 has at 0x80-0x9F."""
    return F.translate(F.decode(raw, "ISO-8859-1"), _C1, _CP1252)


@F.pandas_udf(T.StringType())
def repair_text(raw: pd.Series) -> pd.Series:
    """UTF-8 where the bytes are, CP1252 byte by byte where they are not."""

    def one(b: bytes | None) -> str | None:
        if b is None:
            return None
        out, b = [], bytes(b)
        while b:
            try:
                out.append(b.decode("utf-8"))
                break
            except UnicodeDecodeError as e:
                out.append(b[: e.start].decode("utf-8"))
                out.append(b[e.start : e.start + 1].decode("cp1252" if b[e.start] not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else "latin-1"))
                b = b[e.start + 1 :]
        return "".join(out)

    return raw.map(one)


#: UTF-8 by its structure alone: lead bytes and the number of bytes that follow. Surrogates and overlong forms of three and four bytes pass.
STRUCTURE = r"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})*+"


def is_structural_utf8(raw: Column) -> Column:
    """Whether bytes are UTF-8 in structure: an automaton over the bytes, read as one character each; linear, and in the JVM."""
    return F.decode(raw, "ISO-8859-1").rlike(rf"\A{STRUCTURE}\z")


def repaired(raw: Column, declared_utf8: bool = True) -> Column:
    """Text of a source's bytes: as they are if they are UTF-8 in structure, else by what the source declares.

    Forms that pass as structure and are no characters become U+FFFD. Only
    declared UTF-8 that is none leaves the JVM.
    """
    other = repair_text(raw) if declared_utf8 else latin1_to_text(raw)
    return F.when(is_structural_utf8(raw), F.make_valid_utf8(raw.cast("string"))).otherwise(other)


@F.pandas_udf(T.StringType())
def _fold(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else unicodedata.normalize("NFC", t).casefold())


def normal_text(x: Column) -> Column:
    """NFC, case-folded, letters, digits and marks only."""
    return F.regexp_replace(_fold(x), r"[^\p{L}\p{N}\p{M}]", "")


def similarity_of(a: str, b: str) -> float:
    """Twice the letters in matching blocks over all letters; if even the letters in common come to under a half, their share."""
    letters = len(a) + len(b)
    shared = sum((Counter(a) & Counter(b)).values())
    if a == b or 4 * shared < letters:
        return 2 * shared / letters if letters else 1.0
    return 2 * matched_letters(a, b) / letters


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else similarity_of(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """Equal texts, and lengths that leave at most a half in common (an empty text has nothing), are decided in the JVM; only the rest is compared letter by letter."""
    most = 2 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b))
    return F.when(a == b, 1.0).when(most < 0.5, most).otherwise(_similarity(a, b))


# Strong's numbers and morphology -------------------------------------------------------------


def strongs_numbers(lemma: Column) -> Column:
    """``G``/``H`` numbers named by ``strong:`` in a lemma attribute, in order."""
    raw = F.regexp_extract_all(lemma, F.lit(r"strong:([GHgh]\S*)"), F.lit(1))
    return F.transform(raw, lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1_000_000)))


def plain_strongs(number: Column) -> Column:
    """``H07225`` -> ``H7225``."""
    return F.regexp_replace(number, r"^([A-Z])0+(?=\d)", "$1")


def original_word(lemma: Column) -> Column:
    """``lemma.TR:`` before a bare ``lemma:``."""
    tr = F.regexp_extract(lemma, r"lemma\.TR:(\S+)", 1)
    return F.when(tr != "", tr).otherwise(F.regexp_extract(lemma, r"lemma:(\S+)", 1))


def plain_morphology(morph: Column) -> Column:
    """Codes without their scheme prefix, space-joined."""
    codes = F.transform(F.split(F.btrim(morph), r"\s+"), lambda t: F.regexp_replace(t, r"^[^:]*:", ""))
    return F.array_join(F.filter(codes, lambda c: c != ""), " ")


# Small ones ------------------------------------------------------------------------------------


def clip(x: Column, n: int = 300) -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def slug(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9]+", "_")


#: Text patterns that clean text must not hold: code, severity, expression (fixed values).
HYGIENE = [
    ("html_tag", "error", rf"<[{SPACES}]*/?[{SPACES}]*[A-Za-z!][^<>]{{0,200}}>"),
    ("angle_bracket", "warn", r"[<>]"),
    ("entity", "error", r"&(?:[A-Za-z]{2,8}|#\p{Nd}{2,7}|#[xX][0-9A-Fa-f]{2,6});"),
    ("pilcrow", "error", "\u00b6"),
    ("backslash", "error", r"\\"),
    ("usfm_attribute", "error", rf"\|[{SPACES}]*[a-z-]+[{SPACES}]*=[{SPACES}]*\""),
    ("strongs_tag", "error", rf"(?<![\p{{L}}\p{{N}}_])(?:strong|lemma|morph|robinson|strongMorph):[^{SPACES}]"),
    ("strongs_number", "warn", r"(?<![A-Za-z0-9])[GH]\p{Nd}{3,5}(?![0-9])"),
    ("braces", "warn", r"[{}]"),
    ("control_char", "error", r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x80-\x9f]"),
    ("replacement_char", "error", "\ufffd"),
    ("mojibake", "error", "\u00c3[\u0080-\u00bf]|\u00e2\u20ac|\u00c2[\u00a0-\u00bf]|\u00d0[\u0080-\u00bf]"),
    ("whitespace", "error", rf"^[{SPACES}]|[{SPACES}]$|[{SPACES}]{{2}}|[\t\n\r]"),
    ("odd_space", "warn", "[\u00a0\u2000-\u200a\u202f\u205f\u3000]"),
    ("zero_width", "info", "[\u200b\u2060\ufeff]"),
    ("private_use", "warn", "[\ue000-\uf8ff]"),
    ("note_marker", "info", "[*\u2020\u2021]"),
    ("double_bracket", "info", r"\[\[|\]\]"),
]


@F.pandas_udf(T.StringType())
def _unescaped(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else html.unescape(t))


def untagged(raw: Column) -> Column:
    """Raw markup with a blank for each tag and its entities resolved; only rows with an ``&`` leave the JVM."""
    plain = F.regexp_replace(raw, rf"<[{SPACES}]*/?[{SPACES}]*[A-Za-z][^<>]{{0,300}}>", " ")
    return F.when(plain.contains("&"), _unescaped(plain)).otherwise(plain)


def hygiene_codes(x: Column) -> Column:
    """The codes whose pattern the text holds; ``angle_bracket`` only without ``html_tag``."""
    tag = x.rlike(HYGIENE[0][2])
    hits = [F.when(x.rlike(p) & (~tag if code == "angle_bracket" else F.lit(True)), F.lit(code)) for code, _, p in HYGIENE]
    return F.filter(F.array(*hits), lambda c: c.isNotNull())
