"""All queries of the library and, where SQL can say the same, the SQL."""

from millrace.plans import entity_queries, source_queries

QUERIES: dict = {**source_queries.QUERIES, **entity_queries.QUERIES}
SQL: dict = {**source_queries.SQL, **entity_queries.SQL}
