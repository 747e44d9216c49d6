"""Relations over the given tables, the query registry and its reference SQL."""
