def value(spark, sql):
    """Result of one SQL expression."""
    return spark.sql(f"SELECT {sql} AS r").first().r
