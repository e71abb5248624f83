"""Full-text search: an inverted index as a table, BM25, and snippets.

Tokens are runs of letters and digits, folded and without combining marks;
with ``stem`` they are reduced by the Porter rules. Every operator of the query
language is a join or a grouping over postings: terms that follow one another
are AND-ed first, then ``NOT``, ``AND`` and ``OR`` bind in that order; there
are parentheses, ``"a phrase"``, ``pre*``, ``NEAR(a b, 5)`` and column filters
(``title: a``, ``{title body}: a``, ``- title: a``) over indexes of several columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import scratch

K1, B = 1.2, 0.75
_FROM = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_TO = "".join(unicodedata.normalize("NFD", c)[0].lower() for c in _FROM)


def folded(x: Column) -> Column:
    """Lower-cased without the marks of Latin letters; in the JVM."""
    return F.lower(F.translate(x, _FROM, _TO))


_UNMARK = str.maketrans(_FROM, _TO)


def unmarked(s: str) -> str:
    return s.translate(_UNMARK)


def fold(s: str) -> str:
    return unmarked(s).lower()


# Porter's rules --------------------------------------------------------------

_VOWEL = re.compile(r"[aeiou]|(?<=[^aeiou])y")


def _shape(w: str) -> str:
    out = []
    for i, c in enumerate(w):
        out.append("v" if c in "aeiou" or (c == "y" and i > 0 and out[-1] == "c") else "c")
    return "".join(out)


def _measure(w: str) -> int:
    return len(re.findall(r"v+c+", _shape(w)))


def _cvc(w: str) -> bool:
    return len(w) > 2 and _shape(w).endswith("cvc") and w[-1] not in "wxy"


#: Suffix rules of Porter's second to fourth step (fixed values of the published algorithm).
_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
          ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
          ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _swap(w: str, rules: list[tuple[str, str]]) -> str:
    for suffix, put in sorted(rules, key=lambda r: -len(r[0])):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            return stem + put if _measure(stem) > 0 else w
    return w


def porter(w: str) -> str:
    """Porter's stemmer for lower-case ASCII words; others stay."""
    if len(w) < 3 or not (w.isascii() and w.isalpha()):
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        for suffix in ("ed", "ing"):
            if w.endswith(suffix) and "v" in _shape(w[: -len(suffix)]):
                w = w[: -len(suffix)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif len(w) > 1 and w[-1] == w[-2] and _shape(w)[-1] == "c" and w[-1] not in "lsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _cvc(w):
                    w += "e"
                break
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(w, _STEP2), _STEP3)
    for suffix in sorted([*_STEP4, "ion"], key=len, reverse=True):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    if w.endswith("e") and (_measure(w[:-1]) > 1 or _measure(w[:-1]) == 1 and not _cvc(w[:-1])):
        w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


def _stems(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    known: dict[str, str] = {}
    for x in batches:
        if len(known) > 200_000:
            known.clear()
        yield pd.Series([known[t] if t in known else known.setdefault(t, porter(t)) for t in x], dtype=object)


# Index and ranking -----------------------------------------------------------------


def postings(docs: DataFrame, doc_id: str, text: str, stem: bool = False) -> DataFrame:
    """(doc_id, pos, token): the inverted index; null text has no tokens."""
    found = F.regexp_extract_all(folded(F.col(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(found).alias("pos", "token"))
    if stem:
        rows = rows.withColumn("token", F.pandas_udf(_stems, T.StringType())("token"))
    return rows


def columns_postings(docs: DataFrame, doc_id: str, columns: list[str], stem: bool = False) -> DataFrame:
    """(doc_id, pos, token, col): one index over several columns; places of different columns are far apart."""
    out = None
    for i, name in enumerate(columns):
        one = postings(docs, doc_id, name, stem).withColumns({"pos": F.col("pos") + F.lit(i * APART), "col": F.lit(name)})
        out = one if out is None else out.unionByName(one)
    return out


#: Places between the first tokens of two columns.
APART = 1 << 40
_LEXER = re.compile(r'(?P<cols>-?\s*(?:\w+|\{[^}]*\})\s*:)|(?P<near>NEAR\s*\([^)]*\))|"(?P<quoted>[^"]*)"\s*(?P<star>\*?)|(?P<sign>[()])|(?P<word>[^\s()":]+)')


def _terms(body: str, star: bool = False) -> list[str]:
    terms = re.findall(r"[^\W_]+", fold(body))
    return [*terms[:-1], terms[-1] + "*"] if terms and (star or body.endswith("*")) else terms


class _Reader:
    """Recursive descent over a query's tokens; nodes are tuples that begin with their kind."""

    def __init__(self, query: str):
        self.tokens, self.at = list(_LEXER.finditer(query)), 0

    def ahead(self) -> str | None:
        m = self.tokens[self.at] if self.at < len(self.tokens) else None
        return None if m is None else m["sign"] or (m["word"] if m["word"] in ("AND", "OR", "NOT") else "item")

    def chain(self, word: str, kind: str, part):
        parts = [part()]
        while self.ahead() == word:
            self.at += 1
            parts.append(part())
        parts = [p for p in parts if p is not None]
        return (kind, parts) if len(parts) > 1 else parts[0] if parts else None

    def any_of(self):
        return self.chain("OR", "or", lambda: self.chain("AND", "and", self.but))

    def but(self):
        left = self.row()
        while self.ahead() == "NOT":
            self.at += 1
            right = self.row()
            left = ("not", left, right) if left and right else left
        return left

    def row(self):
        parts = []
        while self.ahead() in ("item", "("):
            if one := self.item():
                parts.append(one)
        return ("and", parts) if len(parts) > 1 else parts[0] if parts else None

    def item(self):
        m = self.tokens[self.at]
        self.at += 1
        if m["sign"]:
            inner = self.any_of()
            if self.ahead() != ")":
                raise ValueError("a parenthesis is not closed")
            self.at += 1
            return inner
        if m["cols"]:
            names = re.findall(r"\w+", m["cols"])
            inner = self.item() if self.ahead() in ("item", "(") else None
            return ("cols", names, m["cols"].startswith("-"), inner) if inner else None
        if m["near"]:
            body, _, most = m["near"][m["near"].index("(") + 1 : -1].partition(",")
            parts = [t for q, w in re.findall(r'"([^"]*)"|([^\s"]+)', body) if (t := _terms(q or w))]
            return ("near", parts, int(most) if most.strip() else 10) if len(parts) > 1 else ("phrase", parts[0]) if parts else None
        terms = _terms(m["quoted"], bool(m["star"])) if m["word"] is None else _terms(m["word"])
        return ("phrase", terms) if terms else None


def parse_query(query: str) -> tuple | None:
    """The query as nested nodes (phrase, near, cols, and, or, not); None if it has no term."""
    reader = _Reader(query)
    node = reader.any_of()
    if reader.ahead() is not None:
        raise ValueError(f"syntax error in query: {query!r}")
    return node


def phrases(node: tuple | None, columns: tuple | None = None) -> list[tuple[list[str], tuple | None]]:
    """(terms, column filter) of the phrases that count for the rank: all but those after a NOT."""
    kind = node[0] if node else None
    if kind == "phrase":
        return [(node[1], columns)]
    if kind == "near":
        return [(terms, columns) for terms in node[1]]
    if kind == "cols":
        return phrases(node[3], (tuple(node[1]), node[2]))
    if kind == "not":
        return phrases(node[1], columns)
    return [p for part in node[1] for p in phrases(part, columns)] if node else []


def within_columns(index, columns: tuple | None):
    """The index over the named columns (or all others); an index is a table of places, or a stored one."""
    if columns is None:
        return index
    if not isinstance(index, DataFrame):
        return index.restricted(columns[0], columns[1])
    if "col" not in index.columns:
        raise ValueError(f"no such column: {columns[0][0]}")
    test = F.col("col").isin(*columns[0])
    return index.where(~test if columns[1] else test)


def matching(index, node: tuple, stem: bool = False) -> DataFrame:
    """(doc_id) of the documents that a node's condition holds for."""
    kind = node[0]
    if kind == "phrase":
        return clause_hits(index, node[1], stem).select("doc_id")
    if kind == "cols":
        return matching(within_columns(index, (tuple(node[1]), node[2])), node[3], stem)
    if kind == "not":
        return matching(index, node[1], stem).join(matching(index, node[2], stem), "doc_id", "left_anti")
    if kind == "near":
        return near(index, node[1], node[2], stem)
    parts = None
    for i, part in enumerate(node[1]):
        one = matching(index, part, stem).withColumn("i", F.lit(i))
        parts = one if parts is None else parts.unionByName(one)
    least = len(node[1]) if kind == "and" else 1
    return parts.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("doc_id")


def near(index, clauses: list[list[str]], most: int, stem: bool = False) -> DataFrame:
    """(doc_id) where all clauses stand together, at most ``most`` tokens between the first one's end and the last one's start."""
    places = None
    for i, clause in enumerate(clauses):
        one = clause_places(index, clause, stem).select("doc_id", "at", F.lit(i).alias("i"))
        places = one if places is None else places.unionByName(one)
    by_place = Window.partitionBy("doc_id").orderBy("at")
    after = {f"n{i}": F.size(F.collect_set("i").over(by_place.rangeBetween(0, len(c) + most))) for i, c in enumerate(clauses)}
    whole = F.lit(False)
    for i in range(len(clauses)):
        whole = whole | ((F.col("i") == i) & (F.col(f"n{i}") == len(clauses)))
    return places.withColumns(after).where(whole).select("doc_id").distinct()


def term_rows(index, term: str, stem: bool = False) -> DataFrame:
    """Places of a term or a ``prefix*``; a stored index knows where they are, and whether it is stemmed."""
    return index.where(_is_term(term, stem)) if isinstance(index, DataFrame) else index.term(term)


def _is_term(term: str, stem: bool) -> Column:
    return F.col("token").startswith(term[:-1]) if term.endswith("*") else F.col("token") == (porter(term) if stem else term)


def clause_places(index, clause: list[str], stem: bool = False) -> DataFrame:
    """(doc_id, at): where a term, a prefix or a phrase begins; with the document's ``len`` if the index has it."""
    parts, more = None, []
    for i, term in enumerate(clause):
        rows = term_rows(index, term, stem)
        more = [c for c in ("len",) if c in rows.columns]
        one = rows.select("doc_id", (F.col("pos") - i).cast("long").alias("at"), F.lit(i).alias("i"), *more)
        parts = one if parts is None else parts.unionByName(one)
    if len(clause) == 1:
        return parts.drop("i")
    met = parts.groupBy("doc_id", "at").agg(F.countDistinct("i").alias("n"), *[F.max(c).alias(c) for c in more])
    return met.where(F.col("n") == len(clause)).drop("n")


def clause_hits(index, clause: list[str], stem: bool = False) -> DataFrame:
    """(doc_id, hits) of one clause."""
    return clause_places(index, clause, stem).groupBy("doc_id").agg(F.count("*").alias("hits"))


def _all_terms(node: tuple) -> set[str]:
    """Every term that a query asks for, those after a NOT too."""
    kind = node[0]
    if kind == "phrase":
        return set(node[1])
    parts = {"near": [("phrase", p) for p in node[1]], "cols": [node[-1]], "not": node[1:]}.get(kind) or node[1]
    return set().union(*map(_all_terms, parts))


def _asked(index: DataFrame, node: tuple, stem: bool) -> tuple[DataFrame, DataFrame]:
    """(places of the query's terms, (doc_id, len) of all documents) as tables: the texts are read once for either, whatever the query joins."""
    spark, test = index.sparkSession, F.lit(False)
    for term in sorted(_all_terms(node)):
        test = test | _is_term(term, stem)
    out = []
    for name, rows in (("places", index.where(test)), ("lengths", index.groupBy("doc_id").agg(F.count("*").alias("len")))):
        path = scratch(spark, name)
        rows.write.parquet(path)
        out.append(spark.read.schema(rows.schema).parquet(path))
    return out[0], out[1]


def search(index: DataFrame, query: str, limit: int | None = 25, stem: bool = False, n_docs: int | None = None) -> DataFrame:
    """(doc_id, rank): minus BM25, so smaller is better; ties by doc_id.

    Places of the query's terms and document lengths are written to the shared
    folder; corpus size and mean length are one row. ``n_docs`` counts documents
    without tokens too, which a table of tokens does not know of.
    """
    node = parse_query(query)
    if node is None:
        return index.sparkSession.createDataFrame([], "doc_id long, rank double")
    index, lengths = _asked(index, node, stem)
    corpus = lengths.agg((F.count("*") if n_docs is None else F.lit(n_docs)).alias("n_docs"), (F.avg("len") if n_docs is None else F.sum("len") / n_docs).alias("mean"))
    hits = None
    for c, (clause, columns) in enumerate(phrases(node)):
        one = clause_hits(within_columns(index, columns), clause, stem).withColumn("c", F.lit(c))
        hits = one if hits is None else hits.unionByName(one)
    # A clause's document frequency counts all its documents, also those that the query does not match.
    freq = hits.groupBy("c").agg(F.count("*").alias("df"))
    matched = matching(index, node, stem)
    idf = F.greatest(F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    weight = F.col("hits") * (K1 + 1) / (F.col("hits") + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    scored = (
        hits.join(matched, "doc_id", "left_semi")
        .join(F.broadcast(freq), "c")
        .join(lengths, "doc_id")
        .join(F.broadcast(corpus))
        .groupBy("doc_id")
        .agg((-F.sum(idf * weight)).alias("rank"))
    )
    return scored if limit is None else scored.orderBy("rank", "doc_id").limit(limit)


def snippet_of(text: str, terms: list[str], size: int = 40, left: str = ">>>", right: str = "<<<", gap: str = "...", stem: bool = False) -> str:
    """The window of ``size`` tokens with the most different, then the most hits, marked; the first of equals."""
    spans = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
    norm = lambda t: porter(fold(t)) if stem else fold(t)
    wanted = {porter(t) if stem and not t.endswith("*") else t for t in terms}
    hit = []
    for a, b in spans:
        w = norm(text[a:b])
        hit.append(next((t for t in wanted if w == t or t.endswith("*") and w.startswith(t[:-1])), None))
    best, at = (-1, -1), 0
    for i in range(max(1, len(spans) - size + 1)):
        part = [h for h in hit[i : i + size] if h]
        if (len(set(part)), len(part)) > best:
            best, at = (len(set(part)), len(part)), i
    end = min(len(spans), at + size)
    if not spans:
        return text
    out, last = [], 0 if at == 0 else spans[at][0]
    for i in range(at, end):
        a, b = spans[i]
        out += [text[last:a], left + text[a:b] + right if hit[i] else text[a:b]]
        last = b
    tail = text[last:] if end == len(spans) else ""
    return ("" if at == 0 else gap) + "".join(out) + (tail if end == len(spans) else gap)


def snippets(hits: DataFrame, text: str, query: str, stem: bool = False) -> DataFrame:
    """``hits`` with a snippet; only the few ranked rows pass through Python."""
    terms = [t for clause, _ in phrases(parse_query(query)) for t in clause]
    make = F.pandas_udf(lambda x: x.map(lambda t: None if t is None else snippet_of(t, terms, stem=stem)), T.StringType())
    return hits.withColumn("snippet", make(F.col(text)))
