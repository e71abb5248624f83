"""Operators for preparing language-model training data.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
``queries()`` and ``oracle_sql()`` live in :mod:`quire.llm.queries`.
"""
