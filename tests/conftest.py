import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from quire import ship

    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture
def sf():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def same_rows(df, con, sql, places=9):
    """Both results hold the same rows under the same names, in any order."""
    import pandas as pd

    a, b = df.toPandas(), con.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)

    def plain(x):
        if not isinstance(x, str) and pd.isna(x):
            return None
        x = x.item() if hasattr(x, "item") else x
        return round(float(x), places) if isinstance(x, (int, float)) and not isinstance(x, bool) else x

    rows = lambda t: sorted((tuple(plain(x) for x in r) for r in t[sorted(t.columns)].itertuples(index=False)), key=repr)
    assert rows(a) == rows(b)
