"""Every operator run over the benchmark tables, each with an independent SQL statement where SQL can say it."""

from tallytide.catalog import modelling, ordered, rows, runs, summary  # noqa: F401  (they register themselves)
from tallytide.catalog.base import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
