"""Every operator run over the test tables, with the SQL that must give the same rows."""

from cadastra.catalog import columns, pipelines, rows, sources, summaries  # noqa: F401
from cadastra.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
