"""All queries of the workload."""

from opslake.workload import (  # noqa: F401  (importing registers the queries)
    change_queries,
    graph_queries,
    relational_queries,
    retrieval_queries,
    view_queries,
)
from opslake.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
