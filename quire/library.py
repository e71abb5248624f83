"""A folder of modules and the commands over it.

A module is a SQLite file ``<name>.db`` or a folder ``<name>`` with Parquet
tables: published ones (``sources.shared``), or one for each of its tables. ``COMMANDS`` is the registry: a command takes the
library, positional arguments and options, and returns a DataFrame or a dict
(small, already collected). ``run_command`` checks the arguments.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import keys
from .functions.refs import Books, parse_reference
from .operators import fulltext, lookup, stats, textindex, trees, validate, xrefs
from .sources import files, shared, sqlite



@dataclass(frozen=True)
class Searched:
    """How a module type is searched: its table, key and indexed columns, those a snippet is cut from (the first that is there), and what a hit shows."""

    table: str
    key: str
    indexed: tuple[str, ...]
    snippet: tuple[str, ...]
    shown: tuple[str, ...]


SEARCH = {
    "bible": Searched("bible_verse", "verse_id", ("text",), (), ("text",)),
    "commentary": Searched("commentary_entry", "entry_id", ("content",), ("content",), ("ref_start", "ref_end", "entry_level")),
    "dictionary": Searched("dictionary_entry", "entry_id", ("word", "definition", "usage_notes"), ("definition", "word"), ("entry_key", "word")),
    "book": Searched("book_section", "section_id", ("title", "content"), ("content",), ("title", "parent_section_id")),
    "devotional": Searched("devotional_entry", "entry_id", ("title", "content"), ("content",), ("day_number", "date_label", "title")),
    "topical": Searched("topic", "topic_id", ("name",), (), ("name", "parent_topic_id", "parent_name")),
}
PREFER = {"verse": "bible", "chapters": "bible", "verse-lookup": "bible", "commentary": "commentary", "define": "dictionary", "xref": "cross_reference", "sections": "book", "section": "book", "devotional": "devotional"}
PREFER |= dict.fromkeys(("topics", "topic", "topic-tree", "topic-verses", "verse-topics"), "topical")


class NotFound(LookupError):
    """No module, topic or section of that name."""


class Library:
    def __init__(self, spark: SparkSession, folder: str | None = None, books: Books | None = None):
        self.spark = spark
        self.folder = Path(folder or os.environ.get("QUIRE_MODULES", "modules"))
        self.books = books or Books()

    def names(self) -> DataFrame:
        rows = []
        for p in sorted(self.folder.glob("[!_.]*")) if self.folder.is_dir() else []:
            if p.suffix == ".db":
                rows.append((p.stem, round(p.stat().st_size / 1_048_576, 1)))
            elif p.is_dir() and any(p.glob("*/*.parquet")):
                rows.append((p.name, round(sum(f.stat().st_size for f in p.rglob("*")) / 1_048_576, 1)))
        return self.spark.createDataFrame(rows, "module string, size_mb double")

    def resolve(self, name: str, command: str = "", validator: bool = False) -> str:
        """The path of a module; the validator knows more type prefixes."""
        if Path(name).exists():
            return name
        found = files.resolve_module(self.names(), name.removesuffix(".db"), PREFER.get(command), files.VALIDATOR_PREFIXES if validator else files.PREFIXES).first()
        if found is None:
            raise NotFound(f"no module {name!r}")
        file = self.folder / f"{found['module']}.db"
        return str(file if file.exists() else self.folder / found["module"])

    def tables(self, name: str, command: str = "") -> dict[str, DataFrame]:
        path = self.resolve(name, command)
        if path.endswith(".db"):
            return sqlite.read_module(self.spark, path)
        if (Path(path) / "manifest").is_dir():
            return shared.published(self.spark, path)
        return {p.name: self.spark.read.parquet(str(p)) for p in sorted(Path(path).iterdir()) if p.is_dir()}

    def index_path(self, module: str) -> str:
        """Where a module's text index is stored: beside the modules."""
        return str(self.folder / "_index" / Path(self.resolve(module)).stem)

    def table(self, module: str, table: str, command: str = "") -> DataFrame:
        found = self.tables(module, command)
        if table not in found:
            raise NotFound(f"{module!r} has no {table}")
        return found[table]

    def refs(self, df: DataFrame, start: str = "verse_id_start", end: str = "verse_id_end") -> DataFrame:
        """``df`` with ``ref``: the range in words; the names are a map literal of 66 entries."""
        names = F.create_map(*[F.lit(x) for b in self.books.books for x in (b.number, b.short)])
        a, b = F.col(start), F.col(end)
        return df.withColumn("ref", keys.format_range(a, b, names[keys.book_of(a).cast("int")], names[keys.book_of(b).cast("int")]))


class Held(Library):
    """A library whose modules are given as tables: name -> table -> DataFrame; ``indexes`` is a folder for stored text indexes."""

    def __init__(self, spark: SparkSession, modules: dict[str, dict[str, DataFrame]], books: Books | None = None, indexes: str | None = None):
        super().__init__(spark, None, books)
        self.modules = modules
        self.indexes = indexes

    def index_path(self, module: str) -> str:
        if self.indexes is None:
            raise LookupError("no folder for indexes was given")
        return f"{self.indexes}/{self.resolve(module)}"

    def names(self) -> DataFrame:
        return self.spark.createDataFrame([(n, 0.0) for n in sorted(self.modules)], "module string, size_mb double")

    def resolve(self, name: str, command: str = "") -> str:
        found = files.resolve_module(self.names(), name, PREFER.get(command)).first()
        if found is None:
            raise NotFound(f"no module {name!r}")
        return found["module"]

    def tables(self, name: str, command: str = "") -> dict[str, DataFrame]:
        return self.modules[self.resolve(name, command)]


@dataclass(frozen=True)
class Command:
    usage: str
    description: str
    least: int
    run: Callable[..., object]


COMMANDS: dict[str, Command] = {}


def command(name: str, usage: str, description: str, least: int = 1):
    def add(run):
        COMMANDS[name] = Command(f"{name} {usage}".strip(), description, least, run)
        return run

    return add


def run_command(library: Library, name: str, args: list[str], options: dict[str, str] | None = None):
    """Unknown names and too few arguments are errors before anything is opened."""
    if name not in COMMANDS:
        raise NotFound(f"no command {name!r}")
    if len(args) < COMMANDS[name].least:
        raise ValueError("usage: " + COMMANDS[name].usage)
    return COMMANDS[name].run(library, *args, **{k.replace("-", "_"): v for k, v in (options or {}).items()})


@command("modules", "[--type=<type>]", "List the modules of the folder", 0)
def modules(lib: Library, type: str | None = None):
    df = lib.names()
    return df.where(F.col("module").startswith("cross_reference" if type == "xref" else type)) if type else df


@command("info", "<module>", "Identity and metadata of a module")
def info(lib: Library, module: str):
    tables = lib.tables(module)
    row = tables["module_info"].limit(1).first() if "module_info" in tables else None
    if row is None:
        return {"error": f"{module} has no module_info"}
    meta = {"metadata": lookup.parse_or_keep(F.col("metadata"))} if "metadata" in tables["module_info"].columns else {}
    return tables["module_info"].limit(1).withColumns(meta).first().asDict() | {"_file": lib.resolve(module)}


@command("schema", "<module>", "Tables and columns of a module")
def schema(lib: Library, module: str):
    path = lib.resolve(module)
    if path.endswith(".db"):
        return {t["table"]: t for t in sqlite.describe(path)}
    return {n: {"table": n, "columns": [{"name": f.name, "type": f.dataType.simpleString(), "notnull": not f.nullable} for f in df.schema]} for n, df in lib.tables(module).items()}


@command("tables", "<module>", "Row counts of a module's tables")
def tables(lib: Library, module: str):
    return stats.table_counts(lib.tables(module))


@command("stats", "<module>", "Summary by module type")
def stats_of(lib: Library, module: str):
    t = lib.tables(module)
    kind = next((k for name, k in validate.TYPE_ORDER["query"] if name in t), "unknown")
    n = lambda df: df.count()
    out: dict = {"type": kind}
    if kind == "bible":
        out |= t["bible_verse"].agg(F.count("*").alias("verses"), F.countDistinct(keys.book_of(F.col("verse_id"))).alias("books")).first().asDict()
    elif kind == "topical":
        out |= stats.node_stats(t["topic"], "parent_topic_id", t["verse_link"].where("source_type = 'topic'")).first().asDict()
    elif kind == "xref":
        out |= {"groups": n(t["cross_reference_group"]), "references": n(t["verse_link"].where("source_type = 'cross_reference'"))}
    elif kind == "commentary":
        out |= {"entries": n(t["commentary_entry"]), "levels": {r["entry_level"]: r["n"] for r in t["commentary_entry"].groupBy("entry_level").agg(F.count("*").alias("n")).collect()}}
    elif kind in SEARCH:
        out["entries"] = n(t[SEARCH[kind].table])
    return out


@command("sql", "<module> <query>", "A read-only query over a module's tables", 2)
def sql(lib: Library, module: str, query: str):
    return lookup.read_only_sql(lib.spark, query, lib.tables(module))


@command("verse", "<module> <reference>", "Verses of a reference", 2)
def verse(lib: Library, module: str, reference: str):
    low, high = parse_reference(reference, lib.books)
    df = lookup.key_range(lib.table(module, "bible_verse", "verse"), "verse_id", low, high).orderBy("verse_id")
    return lib.refs(df, "verse_id", "verse_id").select("verse_id", "ref", "text")


@command("verse-lookup", "<module> <verse-id> ...", "Verses by their keys", 2)
def verse_lookup(lib: Library, module: str, *ids: str):
    df = lookup.key_list(lib.table(module, "bible_verse", "verse-lookup"), "verse_id", ids).orderBy("verse_id")
    return lib.refs(df, "verse_id", "verse_id").select("verse_id", "ref", "text")


@command("verse-detail", "<module> <verse-id>", "A verse with its formatting and its interlinear words", 2)
def verse_detail(lib: Library, module: str, ident: str):
    t = lib.tables(module, "verse")
    wanted = lib.spark.createDataFrame([(int(ident),)], "verse_id long")
    row = lookup.verse_details(t["bible_verse"], t.get("interlinear_word"), wanted).withColumn("formatting", lookup.parse_or_keep(F.col("formatting")) if "formatting" in t["bible_verse"].columns else F.lit(None)).first()
    if row is None:
        raise NotFound(f"no verse {ident}")
    return row.asDict(recursive=True)


@command("chapters", "<module> <book>", "Chapters of a book with their verse counts", 2)
def chapters(lib: Library, module: str, book: str):
    number = int(book) if book.isdigit() else lib.books.number(book)
    if number is None:
        raise NotFound(f"no book {book!r}")
    df = lookup.key_range(lib.table(module, "bible_verse", "chapters"), "verse_id", number * keys.BOOK, number * keys.BOOK + keys.BOOK - 1)
    return lib.refs(stats.chapters(df, "verse_id"), "first_key", "last_key").orderBy("chapter")


def _searched(lib: Library, module: str) -> tuple[str, Searched, dict[str, DataFrame], list[str]]:
    t = lib.tables(module)
    kind = next((k for name, k in validate.TYPE_ORDER["query"] if name in t), "unknown")
    if kind not in SEARCH:
        raise ValueError(f"search is not supported for modules of type {kind}")
    columns = [c for c in SEARCH[kind].indexed if c in t[SEARCH[kind].table].columns]
    return kind, SEARCH[kind], t, columns


@command("index", "<module> [--compact]", "Store a module's text index, or bring a stored one up to date")
def index(lib: Library, module: str, compact: str | bool = False):
    _, how, t, columns = _searched(lib, module)
    path = lib.index_path(module)
    try:
        found = textindex.TextIndex(lib.spark, path)
    except LookupError:
        found = None
    if found is None or found.shape["columns"] != columns:
        found = textindex.build(t[how.table], how.key, columns, path, force=found is not None)
    else:
        found = found.refresh(t[how.table], how.key)
    if compact and len(found.segments) > 1:
        found = found.compact()
    return {"module": lib.resolve(module), "version": found.version, "segments": len(found.segments), "documents": found.shape["n"], "tokens": found.shape["total"]}


@command("search", "<module> <query> [--limit=N]", "Full-text search; a stored index is used where there is one", 2)
def search(lib: Library, module: str, query: str, limit: str | int = 25):
    kind, how, t, columns = _searched(lib, module)
    rows = t[how.table]
    try:
        hits = textindex.search(textindex.TextIndex(lib.spark, lib.index_path(module)), query, int(limit))
    except LookupError:
        hits = fulltext.search(fulltext.columns_postings(rows, how.key, columns, stem=True), query, int(limit), stem=True, n_docs=rows.count())
    found = hits.join(rows, hits["doc_id"] == rows[how.key])
    if kind == "topical":
        up = rows.select(F.col("topic_id").alias("_up"), F.col("name").alias("parent_name"))
        found = found.join(up, F.col("parent_topic_id") == F.col("_up"), "left")
    if kind == "commentary":
        found = lib.refs(lib.refs(found, "verse_id_start", "verse_id_start").withColumnRenamed("ref", "ref_start"), "verse_id_end", "verse_id_end").withColumnRenamed("ref", "ref_end")
    if kind == "bible":
        found = lib.refs(found, "verse_id", "verse_id")
    cut = next((c for c in how.snippet if c in found.columns), None)
    if how.snippet:
        found = fulltext.snippets(found, cut or columns[0], query, stem=True)
    shown = [c for c in ((how.key,) + (("ref",) if kind == "bible" else ()) + how.shown + (("snippet",) if how.snippet else ()) + ("rank",)) if c in found.columns]
    return found.select(*shown).orderBy("rank", how.key)


@command("commentary", "<module> <reference>", "Entries that overlap a reference", 2)
def commentary(lib: Library, module: str, reference: str):
    low, high = parse_reference(reference, lib.books)
    df = lookup.overlapping(lib.table(module, "commentary_entry", "commentary"), "verse_id_start", "verse_id_end", low, high)
    return lib.refs(df).orderBy("verse_id_start", "entry_id")


@command("define", "<module> <key>", "A dictionary entry by key, word or part of a word", 2)
def define(lib: Library, module: str, key: str):
    df = lookup.define(lib.table(module, "dictionary_entry", "define"), key)
    return df.withColumns({c: lookup.parse_or_keep(F.col(c)) for c in ("metadata", "related_words", "example_verses") if c in df.columns})


@command("devotional", "<module> <day-or-label>", "A devotional entry", 2)
def devotional(lib: Library, module: str, label: str):
    return lookup.devotional(lib.table(module, "devotional_entry", "devotional"), label)


def _topic(lib: Library, module: str, name: str, cmd: str) -> tuple[dict[str, DataFrame], DataFrame]:
    t = lib.tables(module, cmd)
    found = lookup.resolve_node(t["topic"], name)
    if found.first() is None:
        raise NotFound(f"no topic {name!r}")
    return t, found


def _topic_links(t: dict[str, DataFrame]) -> DataFrame:
    return t["verse_link"].where("source_type = 'topic'")


@command("topics", "<module> [--parent=<topic>] [--limit=N] [--offset=N]", "Topics with the numbers of their children and verses")
def topics(lib: Library, module: str, parent: str | None = None, limit: str | int = 50, offset: str | int = 0):
    t = lib.tables(module, "topics")
    of = None
    if parent is not None:
        row = lookup.resolve_node(t["topic"], parent).first()
        if row is None:
            raise NotFound(f"no topic {parent!r}")
        of = row["topic_id"]
    df = lookup.with_counts(lookup.children(t["topic"], "parent_topic_id", of), "topic_id", t["topic"], "parent_topic_id", "child_count")
    df = lookup.with_counts(df, "topic_id", _topic_links(t), "source_id", "verse_count")
    return lookup.page(df, [F.col("sort_order"), F.col("name"), F.col("topic_id")], int(limit), int(offset))


@command("topic", "<module> <topic>", "A topic with its way up, children and verses", 2)
def topic(lib: Library, module: str, name: str):
    t, found = _topic(lib, module, name, "topic")
    row = found.first().asDict()
    crumb = trees.breadcrumb(t["topic"], found, "topic_id", "parent_topic_id", "name").first()
    kids = lookup.with_counts(lookup.children(t["topic"], "parent_topic_id", row["topic_id"]), "topic_id", t["topic"], "parent_topic_id", "child_count")
    own = lib.refs(_topic_links(t).where(F.col("source_id") == row["topic_id"])).orderBy("verse_id_start", "link_id")
    return row | {
        "breadcrumb": list(crumb["crumb"]) if crumb else [], "children": [r.asDict() for r in kids.orderBy("sort_order", "topic_id").collect()], "verses": [r["ref"] for r in own.collect()],
    }


@command("topic-tree", "<module> <topic> [--depth=N]", "The tree under a topic", 2)
def topic_tree(lib: Library, module: str, name: str, depth: str | int = 3):
    t, found = _topic(lib, module, name, "topic-tree")
    walked = trees.descendants(t["topic"], found, "topic_id", "parent_topic_id", int(depth))
    counted = lookup.with_counts(t["topic"], "topic_id", _topic_links(t), "source_id", "verse_count")
    return walked.join(counted, F.col("node") == F.col("topic_id")).select("depth", "path", "topic_id", "parent_topic_id", "name", "sort_order", "verse_count").orderBy("depth", "parent_topic_id", "sort_order", "topic_id")


@command("topic-verses", "<module> <topic> [--recursive]", "Verses of a topic, with --recursive also of those below it", 2)
def topic_verses(lib: Library, module: str, name: str, recursive: str | bool = False):
    t, found = _topic(lib, module, name, "topic-verses")
    ids = trees.descendants(t["topic"], found, "topic_id", "parent_topic_id").select("node") if recursive else found.select(F.col("topic_id").alias("node"))
    hit = _topic_links(t).join(ids, F.col("source_id") == F.col("node"), "left_semi").select("verse_id_start", "verse_id_end").distinct()
    return lib.refs(hit).orderBy("verse_id_start", "verse_id_end")


@command("verse-topics", "<module> <reference>", "Topics that name a verse", 2)
def verse_topics(lib: Library, module: str, reference: str):
    low, high = parse_reference(reference, lib.books)
    t = lib.tables(module, "verse-topics")
    hit = lookup.overlapping(_topic_links(t), "verse_id_start", "verse_id_end", low, high).select(F.col("source_id").alias("topic_id")).distinct()
    up = t["topic"].select(F.col("topic_id").alias("_up"), F.col("name").alias("parent"))
    rows = hit.join(t["topic"], "topic_id").join(up, F.col("parent_topic_id") == F.col("_up"), "left")
    return rows.select("topic_id", "name", "parent").orderBy("name", "topic_id")


@command("xref", "<module> <reference> [--limit=N]", "Cross-references of a verse", 2)
def xref(lib: Library, module: str, reference: str, limit: str | int = 50):
    low, high = parse_reference(reference, lib.books)
    t = lib.tables(module, "xref")
    return lib.refs(xrefs.linked_passages(t["cross_reference_group"], t["verse_link"], low, high, int(limit))).orderBy("g_order", "l_order", "link_id")


@command("sections", "<module> [--parent=<id>] [--order=sort|text]", "Sections of a book; text order compares numbers as text")
def sections(lib: Library, module: str, parent: str | None = None, order: str = "sort"):
    df = lookup.children(lib.table(module, "book_section", "sections"), "parent_section_id", None if parent is None else int(parent))
    by = "sort_order" if order == "sort" and "sort_order" in df.columns else "section_number"
    return df.drop("content").orderBy(by, "section_id")


@command("section", "<module> <section-id>", "A section with its content and references", 2)
def section(lib: Library, module: str, ident: str):
    t = lib.tables(module, "section")
    row = lookup.point(t["book_section"], "section_id", int(ident)).first()
    if row is None:
        raise NotFound(f"no section {ident}")
    own = lib.refs(t["verse_link"].where((F.col("source_type") == "book_section") & (F.col("source_id") == int(ident)))).orderBy("sort_order", "link_id") if "verse_link" in t else None
    return row.asDict() | {"scripture_references": [r["ref"] for r in own.collect()] if own is not None else []}
