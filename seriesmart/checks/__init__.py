"""Registered queries: one per operator, each with its SQL where SQL can say it.

Every query reads the whole given tables. Those that exercise readers and writers
first write data derived from the tables to a fresh shared folder.
"""

from seriesmart.checks import (  # noqa: F401 - importing registers the queries
    aggregates,
    dimensions,
    files,
    history,
    joins,
    questions,
    rows,
    transforms,
)
from seriesmart.checks.base import CHECKS


def all_queries():
    return {name: check.run for name, check in CHECKS.items()}


def all_sql():
    return {name: check.full_sql() for name, check in CHECKS.items() if check.sql}
