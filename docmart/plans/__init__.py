from .registry import QUERIES, run_query
from .oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL", "run_query"]
