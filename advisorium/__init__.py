"""Curation and analytics of recommendation catalogues as PySpark DataFrame jobs."""

__version__ = "0.1.0"
