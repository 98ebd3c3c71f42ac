"""Query name -> function of (spark, folder of tables), and the SQL that gives the same rows."""

from __future__ import annotations

from . import curation, match_queries, record_queries, scalar_queries, table_queries

MODULES = [curation, scalar_queries, table_queries, match_queries, record_queries]

FLAGSHIP = "flagship_reduction_summary"
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
