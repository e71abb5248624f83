"""quire: keyed, marked-up text collections and ordinary tables on Spark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

_SHIPPED: dict[str, str] = {}


def ship(spark) -> None:
    """Give the executors this package, once a Spark application (Arrow functions import it)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="quire-"), "quire_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED[app] = path
