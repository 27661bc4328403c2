"""DataFrame -> DataFrame operators built from the column expressions."""
