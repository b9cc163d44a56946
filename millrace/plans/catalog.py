"""All queries of the engine and their DuckDB SQL."""

from millrace.plans import file_queries, queries

QUERIES = queries.QUERIES | file_queries.QUERIES
ORACLES = queries.ORACLES | file_queries.ORACLES
