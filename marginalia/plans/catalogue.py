"""Registered queries of the engine and their DuckDB SQL."""

from . import flow_queries, source_queries, text_queries

QUERIES = {**text_queries.QUERIES, **flow_queries.QUERIES, **source_queries.QUERIES}
ORACLE_SQL = {**text_queries.ORACLE_SQL, **flow_queries.ORACLE_SQL, **source_queries.ORACLE_SQL}
