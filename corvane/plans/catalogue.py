"""All named queries and their oracles."""

from __future__ import annotations

from functools import wraps

from corvane.plans import corpus, landed, pair_text, record_linkage, text_search
from corvane.session import ship_package

MODULES = [text_search, corpus, record_linkage, pair_text, landed]


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _shipped(q) for module in MODULES for name, q in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
