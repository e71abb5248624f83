"""Module files written by tasks: ``format("sqlite_module")``, and ``write_modules`` before it.

A SQLite file is one sequence, so a module is built by one task: its tables, the
rows in one transaction, then its indexes. The file has a hidden name in its
folder (``.<job>-<module>-<attempt>.part``) until all tasks are done; the job's
commit renames the files one by one, each of them whole. A task that fails
removes its own file; what a lost executor leaves goes by the job's prefix, on
commit as well as on abort. Without ``force`` a module that is there already is
refused before a row of it is written.

The rows that go to the sink are (module, table_no, n, s, cells): a table's
number, two columns that give the order inside the table, and the cells as text.
``cells`` null opens a module, so modules without rows become files as well.
"""

from __future__ import annotations

import json
import os
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from glob import escape, glob
from pathlib import Path

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegralType, StructType

from .sqlite import quoted

KEEP = ("all", "flagged", "none")
#: Rows that are inserted at a time.
ROWS = 2_000
#: Set while a file is built, and before it is closed: a finished file stands alone, without a log beside it.
PRAGMAS = ("journal_mode = OFF", "synchronous = OFF", "cache_size = -32768", "temp_store = MEMORY")
ROW_SCHEMA = "module string, table_no int, n long, s string, cells array<string>"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # hidden name, final name


def _cell(kind: str):
    if kind == "int":
        return lambda x: None if x is None else int(x)
    if kind == "real":
        return lambda x: None if x is None else float(x)
    if kind == "bool":
        return lambda x: None if x is None else int(x == "true")
    return (lambda x: None if x is None else bytes.fromhex(x)) if kind == "blob" else lambda x: x


def _kind(t: DataType) -> str:
    if isinstance(t, IntegralType):
        return "int"
    if isinstance(t, (DoubleType, FloatType)):
        return "real"
    return "bool" if isinstance(t, BooleanType) else "blob" if isinstance(t, BinaryType) else "text"


class ModuleFile:
    """One file while it is built."""

    def __init__(self, hidden: str, tables: list[dict], pragmas: tuple[str, ...]):
        self.tables, self.pending, self.at = tables, [], None
        self.con = sqlite3.connect(hidden, isolation_level=None)
        for p in pragmas:
            self.con.execute(f"PRAGMA {p}")
        self.con.execute("BEGIN")
        for t in tables:
            for statement in t["before"]:
                self.con.execute(statement)
        self.cells = [[_cell(k) for k in t["kinds"]] for t in tables]

    def add(self, table: int, cells: list[str | None]) -> None:
        if table != self.at or len(self.pending) >= ROWS:
            self.flush()
            self.at = table
        self.pending.append([f(x) for f, x in zip(self.cells[table], cells, strict=True)])

    def flush(self) -> None:
        if self.pending:
            t = self.tables[self.at]
            names = ", ".join(map(quoted, t["columns"]))
            self.con.executemany(f"INSERT INTO {quoted(t['name'])} ({names}) VALUES ({', '.join('?' * len(t['columns']))})", self.pending)
            self.pending = []

    def finish(self) -> None:
        self.flush()
        for t in self.tables:
            for statement in t["after"]:
                self.con.execute(statement)
        self.con.execute("COMMIT")
        self.con.close()


class ModuleWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.folder, self.force = options["path"], options.get("force", "false") == "true"
        self.job = options.get("job") or uuid.uuid4().hex
        self.tables, self.pragmas = json.loads(options["tables"]), tuple(json.loads(options.get("pragmas", "null")) or PRAGMAS)

    def write(self, iterator: Iterator[Row]) -> Written:
        done: list[tuple[str, str]] = []
        now, file, hidden = None, None, ""
        try:
            for row in iterator:
                if row.module != now:
                    if file is not None:
                        file.finish()
                        done.append((hidden, self.final(now)))
                    now, file = row.module, None
                    if not self.force and os.path.exists(self.final(now)):
                        raise FileExistsError(f"{self.final(now)} is there; force is needed to replace it")
                    hidden = os.path.join(self.folder, f".{self.job}-{now}-{uuid.uuid4().hex}.part")
                    file = ModuleFile(hidden, self.tables, self.pragmas)
                if row.cells is not None:
                    file.add(row.table_no, row.cells)
            if file is not None:
                file.finish()
                done.append((hidden, self.final(now)))
            return Written(done)
        except BaseException:
            for path in [*(h for h, _ in done), hidden]:
                if path and os.path.exists(path):
                    os.unlink(path)
            raise

    def final(self, module: str) -> str:
        if not module or module.startswith(".") or os.sep in module or "/" in module:
            raise ValueError(f"not a name for a module: {module!r}")
        return os.path.join(self.folder, f"{module}.db")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        if not self.force and (there := [f for _, f in files if os.path.exists(f)]):
            self.abort(messages)
            raise FileExistsError(f"{there[0]} is there; force is needed to replace it")
        for hidden, final in files:
            os.replace(hidden, final)
        self._sweep()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._sweep()

    def _sweep(self) -> None:
        for path in glob(os.path.join(escape(self.folder), f".{self.job}-*")):
            os.unlink(path)


class SqliteModule(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_module"

    def schema(self) -> str:
        return ROW_SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> ModuleWriter:
        return ModuleWriter(dict(self.options))


def _declared(df: DataFrame, name: str, ddl: dict[str, list[str]], after: dict[str, list[str]]) -> dict:
    fields = [f for f in df.schema if f.name != "module"]
    kinds = [_kind(f.dataType) for f in fields]
    types = {"int": "INTEGER", "bool": "INTEGER", "real": "REAL", "blob": "BLOB", "text": "TEXT"}
    plain = f"CREATE TABLE {quoted(name)} ({', '.join(f'{quoted(f.name)} {types[k]}' for f, k in zip(fields, kinds, strict=True))})"
    return {"name": name, "columns": [f.name for f in fields], "kinds": kinds, "before": ddl.get(name, [plain]), "after": after.get(name, [])}


def _rows(df: DataFrame, number: int, spec: dict, order: str | None) -> DataFrame:
    def cell(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, BinaryType):
            return F.hex(c)
        return c.cast("string") if _kind(f.dataType) != "text" or f.dataType.typeName() == "string" else F.to_json(c) if f.dataType.typeName() in ("struct", "array", "map") else c.cast("string")

    fields = [f for f in df.schema if f.name != "module"]
    by = F.col(f"`{order or fields[0].name}`")
    whole = isinstance(df.schema[order or fields[0].name].dataType, IntegralType)
    n = by.cast("long") if whole else F.lit(None).cast("long")
    return df.where("module IS NOT NULL").select("module", F.lit(number).alias("table_no"), n.alias("n"), (F.lit(None).cast("string") if whole else by.cast("string")).alias("s"), F.array(*map(cell, fields)).alias("cells"))


def write_modules(
    tables: dict[str, DataFrame], folder: str, ddl: dict[str, list[str]] | None = None, after: dict[str, list[str]] | None = None, order: dict[str, str] | None = None,
    modules: DataFrame | None = None, status: DataFrame | None = None, keep: str = "all", force: bool = False, pragmas: tuple[str, ...] | None = None,
) -> None:
    """Write a file for each module from frames that bear a ``module`` column.

    ``ddl`` has the statements that make a table (and its text index and
    triggers), ``after`` those that follow its rows; a table without ``ddl`` is
    made from its columns. ``order`` names the column that rows are stored by
    (the first one). ``modules`` (module) adds modules without rows. With
    ``keep`` other than ``all``, ``status`` (module, status) decides: ``flagged``
    writes the modules whose status is not PASS, ``none`` writes none; a module
    without a status counts as flagged.
    """
    if keep not in KEEP:
        raise ValueError(f"keep is one of {', '.join(KEEP)}")
    if keep == "none":
        return
    spark = next(iter(tables.values())).sparkSession
    specs = [_declared(df, name, ddl or {}, after or {}) for name, df in tables.items()]
    whole = None
    for number, (name, df) in enumerate(tables.items()):
        one = _rows(df, number, specs[number], (order or {}).get(name))
        whole = one if whole is None else whole.unionByName(one)
    if modules is not None:
        opened = modules.select("module", F.lit(-1).alias("table_no"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("s"), F.lit(None).cast("array<string>").alias("cells"))
        whole = whole.unionByName(opened.where("module IS NOT NULL").distinct())
    if keep == "flagged":
        passed = status.where("status = 'PASS'").select("module").distinct()
        whole = whole.join(passed, "module", "left_anti")
    Path(folder).mkdir(parents=True, exist_ok=True)
    spark.dataSource.register(SqliteModule)
    options = {"path": folder, "tables": json.dumps(specs), "force": str(force).lower(), "job": uuid.uuid4().hex} | ({"pragmas": json.dumps(pragmas)} if pragmas else {})
    # A module's rows stand together and in order: that is what one file needs. Long modules are sorted on disk.
    laid = whole.repartition("module").sortWithinPartitions("module", "table_no", "n", "s")
    laid.select("module", "table_no", "n", "s", "cells").write.format("sqlite_module").mode("append").options(**options).save()


#: What a text module's file has (fixed values): tables, indexes, a text index kept by triggers.
BIBLE_DDL = {
    "bible_verse": [
        "CREATE TABLE bible_verse (verse_id INTEGER PRIMARY KEY, text TEXT NOT NULL, formatting TEXT, word_count INTEGER)",
        "CREATE VIRTUAL TABLE bible_verse_fts USING fts5(verse_id UNINDEXED, text, content='bible_verse', content_rowid='verse_id', tokenize='porter unicode61')",
        "CREATE TRIGGER bible_verse_fts_insert AFTER INSERT ON bible_verse BEGIN INSERT INTO bible_verse_fts(rowid, verse_id, text) VALUES (new.verse_id, new.verse_id, new.text); END",
        "CREATE TRIGGER bible_verse_fts_delete AFTER DELETE ON bible_verse BEGIN INSERT INTO bible_verse_fts(bible_verse_fts, rowid, verse_id, text) VALUES ('delete', old.verse_id, old.verse_id, old.text); END",
        "CREATE TRIGGER bible_verse_fts_update AFTER UPDATE ON bible_verse BEGIN INSERT INTO bible_verse_fts(bible_verse_fts, rowid, verse_id, text) VALUES ('delete', old.verse_id, old.verse_id, old.text);"
        " INSERT INTO bible_verse_fts(rowid, verse_id, text) VALUES (new.verse_id, new.verse_id, new.text); END",
    ],
    "verse_link": [
        "CREATE TABLE verse_link (link_id INTEGER PRIMARY KEY, source_type TEXT NOT NULL, source_id INTEGER NOT NULL, verse_id_start INTEGER NOT NULL, verse_id_end INTEGER NOT NULL, sort_order INTEGER)",
    ],
}
BIBLE_AFTER = {
    "verse_link": ["CREATE INDEX idx_verse_link_source ON verse_link (source_type, source_id)", "CREATE INDEX idx_verse_link_range ON verse_link (verse_id_start, verse_id_end)"],
}
