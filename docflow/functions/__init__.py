"""Column expressions (pyspark.sql.Column -> Column).  All JVM-side except
``nfkc`` in ``text``, which is an Arrow-batched pandas UDF."""
