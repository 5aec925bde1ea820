"""Registered queries: each runs a library operator on the given tables, with SQL to compare."""

from checks import catalog, curation, findings, ingest, registered, text  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
