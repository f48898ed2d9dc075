"""All registered queries."""

from workload import document_queries, ledger_queries, lifecycle_queries, maintenance_queries, statement_queries  # noqa: F401
from workload.registry import ORACLES, QUERIES

FLAGSHIP = "statements_to_features"
__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
