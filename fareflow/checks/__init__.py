"""Registered queries, one per operator."""

from fareflow.checks import (  # noqa: F401  (imported to register their queries)
    analytics,
    sessions,
    sources,
    streams,
    tables,
)
from fareflow.checks.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
