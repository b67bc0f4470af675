from placecount.plans.catalog import queries
from placecount.plans.oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]
