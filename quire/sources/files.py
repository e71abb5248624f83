"""Readers of the files around modules: canon, maps, dumps, settings, catalogues, logs."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROBE = "module string, i bigint, key string, osis string, book string, c int, v int, kjv string, raw string, plain string, red boolean, linked boolean, raw_latin1 boolean"
CANON = "books array<struct<book_number:int,name:string,abbreviation:string,testament:string,book_group:string,verse_counts:array<int>>>"
CATALOG = (
    "repository string, repository_status string, module_id string, sword_module_type string, app_module_type string, language_name string, app_language_code string, "
    "right_to_left string, versification_sword string, source_markup string, scope string, conversion_license_verdict string, license_class string, issues string, encrypted string, zip_download_url string"
)


def canon(spark: SparkSession, path: str) -> DataFrame:
    """(book, name, abbreviation, chapter, max_verse): one row for each chapter of a canon file."""
    books = spark.read.schema(CANON).json(path, multiLine=True).select(F.explode("books").alias("b"))
    return books.select(
        F.col("b.book_number").cast("long").alias("book"), F.col("b.name").alias("name"), F.col("b.abbreviation").alias("abbreviation"), F.posexplode("b.verse_counts").alias("chapter", "max_verse")
    ).withColumns({"chapter": (F.col("chapter") + 1).cast("long"), "max_verse": F.col("max_verse").cast("long")})


def probe(spark: SparkSession, path: str) -> DataFrame:
    """A source's records, one JSON object a line, in the order of ``i``."""
    return spark.read.schema(PROBE).json(path)


def verse_map(spark: SparkSession, path: str) -> DataFrame:
    """(book, chapter, low, high, to_chapter, shift, rule_order) of a map file; own rules come before those it extends."""
    rules, seen = [], set()
    at: Path | None = Path(path)
    while at is not None and at not in seen:
        seen.add(at)
        doc = json.loads(at.read_text(encoding="utf-8"))
        rules += [(r["b"], r["c"], r["from"], r["to"], r.get("dc", 0) + r["c"], r.get("off", 0)) for r in doc.get("rules", [])]
        at = at.parent / doc["extends"] if doc.get("extends") else None
    rows = [(*r, i) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "book long, chapter long, low long, high long, to_chapter long, shift long, rule_order long")


def overrides(path: str) -> dict[str, str]:
    """Only the entries under ``overrides`` are active."""
    return dict(json.loads(Path(path).read_text(encoding="utf-8")).get("overrides", {}))


def settings(spark: SparkSession, path: str) -> DataFrame:
    """(module, conf map) of ``key=value`` files: trimmed, values of a repeated key joined by a space.

    Each file is one value, so lines keep their order.
    """
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.conf)?$", 1).alias("module"), "value")
    lines = files.select("module", F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")).where("line LIKE '%=%' AND trim(line) NOT LIKE '#%'")
    pairs = lines.select("module", "n", F.btrim(F.substring_index("line", "=", 1)).alias("k"), F.btrim(F.expr("substring(line, instr(line, '=') + 1)")).alias("v"))
    values = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "v"))), lambda x: x["v"]), " ")
    return pairs.groupBy("module", "k").agg(values.alias("v")).groupBy("module").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("conf"))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue with a header, a BOM tolerated; ``position`` is the row's place in the file."""
    df = spark.read.csv(path, header=True, multiLine=True, encoding="UTF-8", escape='"')
    df = df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    return df.withColumn("position", F.monotonically_increasing_id())


def convert_log(spark: SparkSession, path: str, most: int = 30) -> DataFrame:
    """(kind, n, lines) of a converter's log: warnings, errors and skipped entries, the first lines of each."""
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    kind = F.when(F.lower("value").contains("error"), "error").when(F.lower("value").contains("warn"), "warning").when(F.lower("value").contains("skip"), "skipped")
    kept = lines.withColumn("kind", kind).where("kind IS NOT NULL")
    first = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("n", "value"))), 1, most), lambda x: x["value"])
    return kept.groupBy("kind").agg(F.count("*").alias("n"), first.alias("lines"))


def log_counters(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of lines like ``Verses converted: 31102``; the last one of a name counts."""
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    found = lines.select("n", F.regexp_extract("value", r"^\s*([A-Za-z][A-Za-z ]*?)\s*:\s*(\d+)\s*$", 1).alias("name"), F.regexp_extract("value", r":\s*(\d+)\s*$", 1).alias("value"))
    return found.where("name <> ''").groupBy("name").agg(F.max_by(F.col("value").cast("long"), "n").alias("value"))


def modules(spark: SparkSession, folder: str, kind: str | None = None) -> DataFrame:
    """(module, size_mb) of the files of a folder, by name; ``xref`` files begin with ``cross_reference``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.db").load(folder).select("path", "length")
    out = files.select(F.regexp_extract("path", r"([^/]+)\.db$", 1).alias("module"), F.round(F.col("length") / 1_048_576, 1).alias("size_mb"))
    if kind:
        out = out.where(F.col("module").startswith("cross_reference" if kind == "xref" else kind))
    return out.orderBy("module")


#: Type prefixes of module names in the order they are tried (fixed values): of the commands, and of the validator.
PREFIXES = ("bible", "commentary", "dictionary", "topical", "cross_reference", "book", "devotional")
VALIDATOR_PREFIXES = ("bible", "commentary", "dictionary", "lexicon", "topical", "book", "devotional", "xref", "tag_graph")


def resolve_module(found: DataFrame, name: str, prefer: str | None = None, prefixes: tuple[str, ...] = PREFIXES) -> DataFrame:
    """The module that a short name means: exact, then a type prefix (the preferred first), then a part of a name."""
    order = ([prefer] if prefer else []) + [p for p in prefixes if p != prefer]
    rank = F.when(F.col("module") == name, 0)
    for i, p in enumerate(order, 1):
        rank = rank.when(F.col("module") == f"{p}_{name}", i)
    rank = rank.when(F.lower("module").contains(name.lower()), len(order) + 1)
    return found.withColumn("_rank", rank).where("_rank IS NOT NULL").orderBy("_rank", "module").limit(1).drop("_rank")


def unzip(path: str, folder: str) -> list[str]:
    """Extract a source archive; names that would leave the folder are refused."""
    root = Path(folder).resolve()
    with zipfile.ZipFile(path) as z:
        for n in z.namelist():
            if not (root / n).resolve().is_relative_to(root):
                raise ValueError(f"archive entry outside of the folder: {n}")
        z.extractall(root)
        return z.namelist()


def schema_text(folder: str, name: str, _seen: tuple[str, ...] = ()) -> str:
    """DDL with ``-- @include file`` lines expanded and PRAGMA lines left out; a cycle is an error."""
    if name in _seen:
        raise ValueError("include cycle: " + " -> ".join([*_seen, name]))
    out = []
    for line in (Path(folder) / name).read_text(encoding="utf-8").splitlines():
        if line.strip().startswith("-- @include "):
            out.append(schema_text(folder, line.strip().removeprefix("-- @include ").strip(), (*_seen, name)))
        elif not line.strip().upper().startswith("PRAGMA"):
            out.append(line)
    return "\n".join(out)
