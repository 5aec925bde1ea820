"""Curation batch: CSV rows become checked catalogue entries in one plan and one write."""

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from advisorium.operators import enrich, quality
from advisorium.sources.writers import require_unique, write_by_service


class Curated(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def curate(csv_rows: DataFrame, at, contributor: str, source: str) -> Curated:
    """Import, classify, fill and validate rows of ``sources.files.read_csv``."""
    entries = enrich.entries_from_csv(csv_rows, at, contributor, source)
    moved = enrich.record_move(enrich.reclassify(entries), contributor, at).drop("moved")
    filled = enrich.fill_missing(moved).drop("modified")
    checked = quality.with_errors(filled)
    return Curated(
        checked.filter(F.size("errors") == 0).drop("errors"),
        checked.filter(F.size("errors") > 0))


def publish(entries: DataFrame, path: str) -> None:
    """Write valid entries by service; a repeated id aborts."""
    write_by_service(require_unique(entries), path)
