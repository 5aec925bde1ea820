"""Readers for catalogue files, landed feeds, rule files and tables."""
