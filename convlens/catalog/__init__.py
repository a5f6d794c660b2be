"""Registered queries with their SQL counterparts.

Each module registers functions of a `Tables` reader. The SQL states the same
result independently, for another engine to run on the same tables.
"""

from convlens.catalog.base import REGISTRY, Tables

from convlens.catalog import conversations, corpora, evaluation, features, profiles, samples, texts  # noqa: E402,F401


def queries():
    return {name: (lambda spark, folder, run=run: run(Tables(spark, folder))) for name, (run, _) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
