"""Every operator as a query over the given tables, with its SQL."""

from . import accounting, catalog, coercions, landing, reads, streams
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "accounting", "catalog", "coercions", "landing", "reads", "streams"]
