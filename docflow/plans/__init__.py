"""Named queries over the driver tables, each with an independent DuckDB SQL
oracle.  ``registry.queries()`` / ``registry.oracle_sql()`` collect them."""
