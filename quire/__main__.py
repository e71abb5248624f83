"""``python -m quire <command> ... [--modules=<folder>] [--format=json|pretty|table|count]``.

``validate --all [--type=<type>]`` or ``validate <module> ...`` checks module
files: ``[--main-db=<file>] [--canon=<file>] [--json] [--quiet]``. It ends with 0
if all passed, 1 if one failed, and 2 if there was nothing to check or no canon.

``select --catalog=<file> [--types=bible,...] [--license=<tier>] [--repos=a,b]
[--modules=a,b] [--sample=N] [--seed=N] [--limit=N] [--verbose]`` tells which rows
of a catalogue a batch would take, and why not the others. ``summary
--work=<folder>`` counts the latest results of ``results.jsonl``.
"""

from __future__ import annotations

import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .library import COMMANDS, Library, run_command
from .operators import catalog, libcheck, sequence
from .sources import files, sinks
from .sources.sinks import formatted


#: Findings of a module that are shown in full.
MOST = 12


def arguments(argv: list[str]) -> tuple[list[str], dict[str, str]]:
    """Positional arguments, and options ``--k=v`` (a bare ``--k`` is true)."""
    plain = [a for a in argv if not a.startswith("--")]
    named = dict((a[2:].split("=", 1) if "=" in a else (a[2:], "true")) for a in argv if a.startswith("--"))
    return plain, named


def validate(spark: SparkSession, names: list[str], options: dict[str, str]) -> tuple[str, int]:
    """(report, exit code) of the validator's command line."""
    folder = options.get("modules") or os.environ.get("QUIRE_MODULES", "modules")
    if not names and "all" not in options:
        return "usage: validate --all [--type=<type>] | validate <module> ...", 2
    try:
        canon, source = libcheck.load_canon(spark, options.get("main-db") or os.environ.get("QUIRE_MAIN_DB"), options.get("canon") or os.environ.get("QUIRE_CANON"))
        paths = None if "all" in options else [Library(spark, folder).resolve(n, validator=True) for n in names]
        found, checked = libcheck.check_folder(spark, folder, canon, options.get("type"), paths)
    except LookupError as e:
        return str(e), 2
    rows = {r["module"]: r.asDict() | {"errors": [], "warnings": []} for r in checked.orderBy("module").collect()}
    for f in found.orderBy("module", "severity", "code").collect():
        rows[f["module"]]["errors" if f["severity"] == "error" else "warnings"].append({"code": f["code"], "n": f["n"], "example": f["example"]})
    failed = [m for m, r in rows.items() if not r["ok"]]
    code = 1 if failed else 0
    if "json" in options:
        return json.dumps({"canon_source": source, "total": len(rows), "passed": len(rows) - len(failed), "failed": len(failed), "results": list(rows.values())}, ensure_ascii=False, indent=2), code
    lines = [f"Canon source: {source}", f"Validating {len(rows)} module(s)", ""]
    for m, r in rows.items():
        if "quiet" in options and r["ok"]:
            continue
        lines.append(f"{'PASS' if r['ok'] else 'FAIL'} {m} ({r['module_type'] or 'unknown'})")
        shown = [("ERROR", e) for e in r["errors"]] + ([] if "quiet" in options else [("WARN", w) for w in r["warnings"]])
        lines += [f"    {level} {e['code']}: {e['n']}" + (f" (e.g. {e['example']})" if e["example"] else "") for level, e in shown[:MOST]]
        lines += [f"    ... and {len(shown) - MOST} more"] if len(shown) > MOST else []
    lines += ["", f"All {len(rows)} module(s) passed." if not failed else f"{len(failed)} of {len(rows)} module(s) FAILED: {', '.join(failed)}"]
    return "\n".join(lines), code


def select(spark: SparkSession, names: list[str], options: dict[str, str]) -> tuple[str, int]:
    """(report, exit code): the dry run of a batch."""
    if "catalog" not in options:
        return "usage: select --catalog=<file>", 2
    listed = lambda k: options[k].split(",") if options.get(k) else None
    number = lambda k: int(options[k]) if options.get(k) else None
    rows = files.catalog(spark, options["catalog"])
    chosen, excluded = catalog.select_rows(rows, options.get("license", "open"), tuple(listed("types") or ["bible"]), listed("repos"), listed("modules"), number("sample"), number("limit"), number("seed") or 1)
    lines = [f"{chosen.count()} module(s) selected"] + [f"  excluded {r['n']:5d}  {r['reason']}" for r in excluded.orderBy(F.desc("n"), "reason").collect()]
    if "verbose" in options:
        lines += [f"  {r['repository'][:14]:14} {r['module_id']:24} {r['app_module_type']:10} {r['versification_sword'] or '':14} {r['conversion_license_verdict']}" for r in chosen.orderBy("repository", F.lower("module_id")).collect()]
    return "\n".join(lines), 0


def summary(spark: SparkSession, names: list[str], options: dict[str, str]) -> tuple[str, int]:
    """(report, exit code): counts over the latest result of each module; ``summary.csv`` has a row for each."""
    path = os.path.join(options.get("work", ""), "results.jsonl")
    if not os.path.exists(path):
        return f"no results: {path}", 2
    # The place of a line decides which result is the latest: one file, read in order.
    rows = spark.read.json(path).withColumn("line_no", F.monotonically_increasing_id())
    parts = catalog.summary(rows)
    last = sequence.latest(rows, ["module_id", "repository"], "line_no").drop("line_no")
    sinks.write_summary(last.orderBy("repository", F.lower("module_id")), os.path.join(options["work"], "summary.csv"))
    lines = ["# Summary", ""]
    for name, key in (("status", "status"), ("codes", "code"), ("reasons", "reason")):
        found = parts[name].orderBy(F.desc("n"), key).collect()
        lines += [f"## {name}", "", "| " + key + " | n |", "| --- | --- |", *[f"| {r[key]} | {r['n']} |" for r in found], ""]
    text = "\n".join(lines)
    with open(os.path.join(options["work"], "summary.md"), "w", encoding="utf-8") as f:
        f.write(text)
    return text, 0


#: Subcommands with an exit code of their own.
RUNS = {"validate": validate, "select": select, "summary": summary}


def main(argv: list[str]) -> int:
    plain, options = arguments(argv)
    if plain and plain[0] in RUNS:
        spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        try:
            text, code = RUNS[plain[0]](spark, plain[1:], options)
            print(text, file=sys.stderr if code == 2 else sys.stdout)
            return code
        finally:
            spark.stop()
    if not plain or plain[0] not in COMMANDS:
        print("\n".join(f"{c.usage}\n    {c.description}" for c in COMMANDS.values()))
        return 0 if not plain else 1
    style, folder = options.pop("format", "pretty"), options.pop("modules", None)
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    try:
        out = run_command(Library(spark, folder), plain[0], plain[1:], options)
        if isinstance(out, DataFrame):
            print(formatted(out, style))
        else:
            print("1" if style == "count" else json.dumps(out, ensure_ascii=False, indent=None if style == "json" else 2, default=str))
        return 0
    except (LookupError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
