"""All registered queries over the shared tables, with DuckDB SQL for each that SQL can express."""

from __future__ import annotations

from strataforge.plans import distribution_queries, join_queries, sampling_queries, source_queries, standard_queries, text_queries  # noqa: F401  they register
from strataforge.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
