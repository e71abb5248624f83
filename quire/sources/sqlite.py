"""SQLite module files as Python data sources.

``sqlite_table``: one table of a file, or of all files of a folder or a glob.
Options: ``path`` (files that every executor can open), ``table``, and

* ``module``: a name for a column with the file's stem (a filter on it picks files);
* ``errors``: a name for a column that holds why a file could not be read. Such a
  file is a row of nulls and that reason; without the option it is an error.

Files are opened immutable; bytes that are no UTF-8 come back with replacement
characters. A read is cut into ranges of rowids over files. Comparisons with
whole numbers on a column are handed to SQLite: on the rowid's column they pick
the ranges that are read at all, on others they spare rows. Spark tests them
again, so values of another type than declared stay its matter. Columns: only
those of the schema are read, so ``columns=`` of ``read_table`` prunes.

``sqlite_catalog``: one row for each file: its tables with their columns, its
indexes, or why it could not be read.
"""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterable, Iterator
from contextlib import closing
from dataclasses import dataclass, field
from glob import glob, has_magic
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

ROWS = 50_000
#: Files up to which the driver looks into each to cut it into ranges; beyond, a file is one range.
PLAN_FILES = 256
#: Files that one task opens at most.
TASK_FILES = 16


def connect(path: str) -> sqlite3.Connection:
    c = sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1", uri=True)
    c.text_factory = lambda b: b.decode("utf-8", "replace")
    return c


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def files_of(path: str) -> list[str]:
    """A file, the ``*.db`` files of a folder, those of a glob, or a JSON list of files; by name."""
    if path.startswith("["):
        return json.loads(path)
    if has_magic(path):
        return sorted(glob(path))
    return sorted(str(p) for p in Path(path).glob("*.db")) if Path(path).is_dir() else [path]


def _kind(declared: str):
    d = (declared or "").upper()
    if "INT" in d or "BOOL" in d:
        return LongType()
    if "REAL" in d or "FLOA" in d or "DOUB" in d:
        return DoubleType()
    return BinaryType() if "BLOB" in d else StringType()


def _value(x, kind):
    if x is None:
        return None
    try:
        if isinstance(kind, StringType):
            return x.decode("utf-8", "replace") if isinstance(x, bytes) else str(x)
        if isinstance(kind, BinaryType):
            return x if isinstance(x, bytes) else str(x).encode()
        return int(x) if isinstance(kind, LongType) else float(x)
    except ValueError:
        return None


def _columns(c: sqlite3.Connection, table: str) -> list[tuple]:
    return c.execute(f"PRAGMA table_info({quoted(table)})").fetchall()


def _rowid_column(columns: list[tuple]) -> str | None:
    """The column that is the rowid: a lone INTEGER PRIMARY KEY."""
    keys = [x for x in columns if x[5]]
    return keys[0][1] if len(keys) == 1 and (keys[0][2] or "").upper() == "INTEGER" else None


@dataclass
class Bounds:
    """What filters leave of a whole-number column."""

    low: int | None = None
    high: int | None = None
    values: set[int] | None = None

    def add(self, f: Filter) -> None:
        if isinstance(f, (EqualTo, In)):
            new = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.values = new if self.values is None else self.values & new
            return
        step = isinstance(f, GreaterThan) - isinstance(f, LessThan)
        at = f.value + step
        if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = at if self.low is None else max(self.low, at)
        else:
            self.high = at if self.high is None else min(self.high, at)

    def span(self, low: int, high: int) -> list[tuple[int, int]]:
        """The ranges of at most ROWS within [low, high] that can hold a row."""
        low = low if self.low is None else max(low, self.low)
        high = high if self.high is None else min(high, self.high)
        if self.values is None:
            return [(a, min(a + ROWS - 1, high)) for a in range(low, high + 1, ROWS)]
        kept = sorted(v for v in self.values if low <= v <= high)
        out: list[tuple[int, int]] = []
        for v in kept:
            if out and v - out[-1][0] < ROWS:
                out[-1] = (out[-1][0], v)
            else:
                out.append((v, v))
        return out

    def sql(self, name: str, exact: bool) -> tuple[str, list[int]]:
        tests, args = [], []
        for op, v in ((">=", self.low), ("<=", self.high)):
            if v is not None:
                tests.append(f"{name} {op} ?")
                args.append(v)
        if self.values is not None and len(self.values) <= 500:
            tests.append(f"{name} IN ({', '.join('?' * len(self.values))})")
            args += sorted(self.values)
        test = " AND ".join(tests) or "1"
        return (test if exact else f"(typeof({name}) <> 'integer' OR ({test}))"), args


@dataclass
class Rows(InputPartition):
    """Ranges of rowids of one or several files; without bounds a file is read whole."""

    spans: list[tuple[str, int | None, int | None]]


@dataclass
class TableReader(DataSourceReader):
    schema: StructType
    options: dict[str, str]
    bounds: dict[str, Bounds] = field(default_factory=dict)
    modules: set[str] | None = None

    def __post_init__(self):
        self.path, self.table = self.options["path"], self.options["table"]
        self.module, self.errors = self.options.get("module"), self.options.get("errors")
        self.many = self.path.startswith("[") or has_magic(self.path) or Path(self.path).is_dir()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        kinds = {f.name: f.dataType for f in self.schema}
        whole = lambda v: isinstance(v, int) and not isinstance(v, bool)
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = list(f.value) if isinstance(f, In) else [getattr(f, "value", None)]
            if self.module and name == self.module and isinstance(f, (EqualTo, In)):
                self.modules = set(values) if self.modules is None else self.modules & set(values)
            elif isinstance(kinds.get(name), LongType) and isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and all(map(whole, values)):
                self.bounds.setdefault(name, Bounds()).add(f)
            yield f  # Spark tests every filter again

    def partitions(self) -> list[Rows]:
        files = [f for f in files_of(self.path) if self.modules is None or Path(f).stem in self.modules]
        if len(files) > PLAN_FILES:
            return [Rows([(f, None, None) for f in files[a : a + TASK_FILES]]) for a in range(0, len(files), TASK_FILES)]
        out: list[Rows] = []
        held = ROWS
        for span in (r for f in files for r in self._ranges(f)):  # small files share a task
            size = ROWS if span[1] is None else span[2] - span[1] + 1
            if held + size > ROWS or len(out[-1].spans) >= TASK_FILES:
                out.append(Rows([]))
                held = 0
            out[-1].spans.append(span)
            held += size
        return out or [Rows([])]

    def _ranges(self, file: str) -> list[tuple[str, int | None, int | None]]:
        try:
            with closing(connect(file)) as c:
                low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
                key = _rowid_column(_columns(c, self.table))
        except sqlite3.Error:  # a table without rowid, no table, or no database: the task finds out
            return [(file, None, None)]
        if low is None:
            return []
        return [(file, a, b) for a, b in self.bounds.get(key, Bounds()).span(low, high)]

    def read(self, partition: Rows) -> Iterator[tuple]:
        for file, low, high in partition.spans:
            stem = Path(file).stem
            try:
                yield from self._rows(file, low, high, stem)
            except sqlite3.Error as e:
                if not self.errors:
                    raise
                yield tuple(stem if f.name == self.module else str(e) if f.name == self.errors else None for f in self.schema)

    def _rows(self, file: str, low: int | None, high: int | None, stem: str) -> Iterator[tuple]:
        with closing(connect(file)) as c:
            columns = _columns(c, self.table)
            if not columns:
                if self.many and c.execute("SELECT count(*) FROM sqlite_master").fetchone():
                    return  # another kind of module
                raise sqlite3.OperationalError(f"no such table: {self.table}")
            have, key = {x[1] for x in columns}, _rowid_column(columns)
            read = [f.name for f in self.schema if f.name in have and f.name not in (self.module, self.errors)]
            tests, args = [], []
            if low is not None:
                tests, args = ["rowid BETWEEN ? AND ?"], [low, high]
            for name, bound in self.bounds.items():
                if name in have:
                    test, more = bound.sql(quoted(name), name == key)
                    tests.append(test)
                    args += more
            sql = f"SELECT {', '.join(map(quoted, read)) or '1'} FROM {quoted(self.table)}" + (" WHERE " + " AND ".join(tests) if tests else "")
            at = {n: i for i, n in enumerate(read)}
            for row in c.execute(sql, args):
                yield tuple(stem if f.name == self.module else _value(row[at[f.name]], f.dataType) if f.name in at else None for f in self.schema)


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> StructType:
        """Columns of the table in the order of the files; a column declared in two ways is text."""
        found: dict[str, object] = {}
        files = files_of(self.options["path"])
        for file in files[:PLAN_FILES]:
            try:
                with closing(connect(file)) as c:
                    for x in _columns(c, self.options["table"]):
                        found[x[1]] = _kind(x[2]) if found.get(x[1], _kind(x[2])) == _kind(x[2]) else StringType()
            except sqlite3.Error:
                if "errors" not in self.options:
                    raise
        if not found:
            raise ValueError(f"no table {self.options['table']!r}")
        more = [self.options[k] for k in ("module", "errors") if k in self.options]
        return StructType([*[StructField(n, StringType()) for n in more], *[StructField(n, k) for n, k in found.items() if n not in more]])

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(schema, dict(self.options))


CATALOG = "module string, file string, size long, tables map<string,array<string>>, types map<string,array<string>>, indexes array<string>, error string"


@dataclass
class Several(InputPartition):
    files: list[str]


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def partitions(self) -> list[Several]:
        files = files_of(self.path)
        return [Several(files[a : a + TASK_FILES]) for a in range(0, len(files), TASK_FILES)] or [Several([])]

    def read(self, partition: Several) -> Iterator[tuple]:
        for file in partition.files:
            stem, size, tables, types, indexes, error = Path(file).stem, None, {}, {}, [], None
            try:
                size = Path(file).stat().st_size
                with closing(connect(file)) as c:
                    for kind, name in c.execute("SELECT type, name FROM sqlite_master WHERE type IN ('table', 'view', 'index') AND name NOT LIKE 'sqlite_%' ORDER BY name").fetchall():
                        if kind == "index":
                            indexes.append(name)
                        else:
                            columns = _columns(c, name)
                            tables[name], types[name] = [x[1] for x in columns], [x[2] or "" for x in columns]
            except FileNotFoundError:
                error = "file_not_found"
            except (OSError, sqlite3.Error) as e:
                error = f"{type(e).__name__}: {e}"
            yield stem, file, size, tables, types, indexes, error


class SqliteCatalog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_catalog"

    def schema(self) -> str:
        return CATALOG

    def reader(self, schema: StructType) -> CatalogReader:
        return CatalogReader(dict(self.options))


def _register(spark: SparkSession) -> None:
    for source in (SqliteTable, SqliteCatalog):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_table(spark: SparkSession, path: str, table: str, columns: list[str] | None = None, module: str | None = None, errors: str | None = None, schema: StructType | None = None) -> DataFrame:
    """A table of a file, or of every file that has it (see the module's options)."""
    _register(spark)
    options = {"path": path, "table": table} | ({"module": module} if module else {}) | ({"errors": errors} if errors else {})
    reader = spark.read.format("sqlite_table").options(**options)
    if schema is None and columns is not None:
        whole = SqliteTable(options).schema()
        schema = StructType([f for f in whole if f.name in (*columns, module, errors)])
    return (reader.schema(schema) if schema is not None else reader).load()


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """(module, file, size, tables, types, indexes, error) of the files of a folder or glob."""
    _register(spark)
    return spark.read.format("sqlite_catalog").option("path", path).load()


def read_library(spark: SparkSession, path: str, wanted: tuple[str, ...] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(catalogue, tables by name): the tables of all modules as one frame each, with ``module`` and ``_error``.

    Schemas come from the catalogue, whatever the number of files: the driver
    sees each table's different columns and types once. A column that is declared
    in two ways is text.
    """
    known = catalog(spark, path)
    each = known.select(F.explode("tables").alias("name", "columns"), "types").select("name", F.posexplode(F.arrays_zip("columns", F.col("types")[F.col("name")].alias("t"))).alias("at", "c"))
    rows = each.groupBy("name", F.col("c.columns").alias("column"), F.col("c.t").alias("t")).agg(F.min("at").alias("at")).orderBy("name", "at", "column", "t").collect()
    found: dict[str, dict[str, object]] = {}
    for r in rows:
        if "_fts" not in r["name"] and (wanted is None or r["name"] in wanted):
            columns = found.setdefault(r["name"], {})
            columns[r["column"]] = _kind(r["t"]) if columns.get(r["column"], _kind(r["t"])) == _kind(r["t"]) else StringType()
    more = [StructField("module", StringType()), StructField("_error", StringType())]
    schemas = {n: StructType(more + [StructField(c, k) for c, k in columns.items() if c not in ("module", "_error")]) for n, columns in found.items()}
    return known, {n: read_table(spark, path, n, module="module", errors="_error", schema=s) for n, s in schemas.items()}


def table_names(path: str) -> list[str]:
    with closing(connect(path)) as c:
        return [r[0] for r in c.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name")]


def index_names(path: str) -> list[str]:
    with closing(connect(path)) as c:
        return [r[0] for r in c.execute("SELECT name FROM sqlite_master WHERE type = 'index' AND name NOT LIKE 'sqlite_%' ORDER BY name")]


def describe(path: str) -> list[dict]:
    """Tables with their columns and DDL; ``pk`` is true for the first part of a key only."""
    with closing(connect(path)) as c:
        out = []
        for name, ddl in c.execute("SELECT name, sql FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name").fetchall():
            columns = [{"name": x[1], "type": x[2], "notnull": bool(x[3]), "pk": x[5] == 1, "default": x[4]} for x in _columns(c, name)]
            out.append({"table": name, "columns": columns, "ddl": ddl})
    return out


def read_module(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All tables of a module file but the shadow tables of its text index."""
    return {t: read_table(spark, path, t) for t in table_names(path) if "_fts" not in t}


def metadata_rules(path: str, links: tuple[str, ...], key_first: dict[str, str]) -> list[tuple[str, str]]:
    """(code, detail) of rules on a file's own metadata: named indexes, and text indexes whose first column is the key."""
    names = set(index_names(path))
    out = [("missing_verse_link_index", i) for i in links if i not in names]
    with closing(connect(path)) as c:
        for table, key in key_first.items():
            columns = [x[1] for x in _columns(c, table)]
            if columns and columns[0] != key:
                out.append(("fts_column_order", table))
    return out
