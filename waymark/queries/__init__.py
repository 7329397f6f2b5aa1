"""Every job on the given tables, each with the SQL its result is checked against."""

from waymark.queries import assist, campaign, identity, inquiry, quality, signup, sources, web
from waymark.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "assist", "campaign", "identity", "inquiry", "quality", "signup", "sources", "web"]
