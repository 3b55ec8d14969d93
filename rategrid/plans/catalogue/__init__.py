"""Every registered query with the SQL that checks it."""

from __future__ import annotations

from rategrid.plans.catalogue import (  # noqa: F401 - importing registers the queries
    bands,
    columns,
    html,
    links,
    rates,
    runs,
    sections,
    tables,
    words,
)
from rategrid.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
