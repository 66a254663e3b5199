"""Every operator over the benchmark tables."""

from millrace.queries import analytics, cleaning, loads, nested, star_schema
from millrace.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "analytics", "cleaning", "loads", "nested", "star_schema"]
