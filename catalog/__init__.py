"""Queries over the driver tables, each with its check in plain SQL."""

import importlib

GROUPS = ["ingest", "diagnosis", "budgets", "aggregation", "planning", "texts", "projection", "overview"]


def load():
    """The register with every group of queries loaded."""
    for group in GROUPS:
        importlib.import_module(f"catalog.{group}")
    return importlib.import_module("catalog.registry")
