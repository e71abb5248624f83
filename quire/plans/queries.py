"""All queries of this package's own operators, and their SQL."""

from __future__ import annotations

from . import checks, commands, keyed, stored, texts  # noqa: F401  (they register themselves)
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
