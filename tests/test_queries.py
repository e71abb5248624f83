"""Every registered query against its SQL; the entry point; independence of the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from quire.plans.queries import oracle_sql, queries
from tests.conftest import ROOT, same_rows


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    if name in oracle_sql():
        same_rows(df, duck, oracle_sql()[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "chapter" in df.columns


def test_every_page_is_an_entry(spark, tmp_path):
    rows = [(1, "first<br/><a>Jude 3</a>"), (901, "second<br/><a>Gen 50:20</a>"), (1_000_000, None)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries()["c19_import_xrefs"](spark, str(tmp_path)).collect()
    assert {r["context"] for r in got} == {"first", "second", "phrase 1", "phrase 901", "phrase 1000000"}
    assert len({r["group_key"].split(":")[0] for r in got}) == 3


def test_the_rest_works_without_the_optional_part(tmp_path):
    for p in Path(ROOT).iterdir():
        if p.name in ("quire", "__spark_entry__.py"):
            (tmp_path / p.name).symlink_to(p) if p.is_file() else None
    (tmp_path / "quire").mkdir()
    for p in (Path(ROOT) / "quire").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "quire" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((Path(ROOT) / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'a1_chapters' in q and not any(n.startswith('op1') for n in q) and 'pipeline' not in q; assert e.oracle_sql()"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
